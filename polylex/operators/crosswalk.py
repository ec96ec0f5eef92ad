"""Titles of concepts from an outside table, asked in batches and kept.

A lookup is a function from a list of bare concept numbers to rows (number, uri, url, lang). It
runs on executors. Every concept that was asked leaves a record in the cache, one without a
title too, so it is asked once; a batch that fails for good leaves none, and is asked again by
the next run. Batches are committed in waves (sources/reply_log.py).
"""

from __future__ import annotations

import json
import time
import warnings
from collections.abc import Callable, Iterator
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import qid_short, title_from_url
from ..schema import LANGS
from ..shipping import ship
from ..sources.reply_log import ReplyLog, ask_in_waves
from .waits import Busy, patiently

Lookup = Callable[[list[str]], list[tuple[str, str, str, str]]]
RECORD = "chebi_id string, uri string, pages array<struct<lang:string,url:string>>"


def _log(spark: SparkSession, cache_path: str) -> ReplyLog:
    return ReplyLog(spark, cache_path, RECORD, "chebi_id")


def complete(ids: DataFrame, lookup: Lookup, cache_path: str, batch: int = 50, tries: int = 7, tasks: int = 1, wave: int = 20, pause: Callable[[float], None] = time.sleep) -> None:
    """Asks for the concepts of ids (chebi_id) that the cache lacks; at most so many tasks ask at a time, and what wave batches of each bring is committed."""
    ship(ids.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), batch):
                asked = pdf["chebi_id"].iloc[a : a + batch].tolist()
                own = [x.split(":", 1)[-1] for x in asked]
                rows = patiently(lambda: lookup(own), tries, pause)  # noqa: B023
                if rows is None:
                    continue
                uri: dict[str, str] = {}
                pages: dict[str, list[dict]] = {}
                for number, of, url, lang in rows:
                    uri[number] = of
                    pages.setdefault(number, []).append({"lang": lang, "url": url})
                yield pd.DataFrame({"chebi_id": asked, "uri": [uri.get(n) for n in own], "pages": [pages.get(n, []) for n in own]})

    left = ask_in_waves(_log(ids.sparkSession, cache_path), ids.select("chebi_id"), run, wave * batch, tasks)
    if left:
        warnings.warn(f"{left} concepts have no answer; the next run asks them again", stacklevel=2)


def titles(ids: DataFrame, cache_path: str) -> DataFrame:
    """(chebi_id, qid, lang, title) of ids that the cache has: the first page of a concept and language."""
    each = _log(ids.sparkSession, cache_path).read().join(ids.select("chebi_id").distinct(), "chebi_id", "left_semi").select("chebi_id", "uri", F.posexplode("pages").alias("k", "p"))
    first = each.groupBy("chebi_id", "uri", F.col("p.lang").alias("lang")).agg(F.min_by("p.url", "k").alias("url"))
    return first.select("chebi_id", qid_short(F.col("uri")).alias("qid"), "lang", title_from_url(F.col("url")).alias("title"))


def crosswalk(ids: DataFrame, lookup: Lookup, cache_path: str, **settings) -> DataFrame:
    """titles of ids, after what the cache lacks has been asked."""
    complete(ids, lookup, cache_path, **settings)
    return titles(ids, cache_path)


def sparql(endpoint: str, agent: str = "polylex", langs: tuple[str, ...] = LANGS) -> Lookup:
    """A lookup at a SPARQL endpoint that knows concept numbers as property P683 and encyclopedia pages."""

    def ask(numbers: list[str]) -> list[tuple[str, str, str, str]]:
        words = lambda xs: " ".join(json.dumps(x) for x in xs)
        query = (
            f"SELECT ?n ?item ?page ?lang WHERE {{ VALUES ?n {{ {words(numbers)} }} VALUES ?code {{ {words(langs)} }} ?item wdt:P683 ?n . "
            '?page schema:about ?item ; schema:inLanguage ?lang ; schema:isPartOf/wikibase:wikiGroup "wikipedia" . FILTER(STR(?lang) = ?code) }'
        )
        request = Request(f"{endpoint}?{urlencode({'query': query, 'format': 'json'})}", headers={"User-Agent": agent, "Accept": "application/sparql-results+json"})
        try:
            with urlopen(request, timeout=120) as reply:
                found = json.load(reply)
        except HTTPError as e:
            if e.code != 429 and e.code < 500:
                raise RuntimeError(f"the endpoint refuses the query: {e.code}") from e
            after = e.headers.get("Retry-After", "")
            raise Busy(float(after) if after.isdigit() else None) from e
        return [tuple(b[c]["value"] for c in ("n", "item", "page", "lang")) for b in found.get("results", {}).get("bindings", [])]

    return ask
