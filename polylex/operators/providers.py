"""Terms and checks from outside, behind a cache; off unless a provider is given.

A provider is a function from a list of requests to a list of replies. It runs on executors,
in batches; replies are written as cache records in committed waves (sources/reply_log.py), so
neither a lost executor nor a failing provider loses what is paid for, and a later run looks
them up. A batch that fails is tried again after waits, then request by request; a request that
fails for good has no record and no response, and is asked again by the next run.
"""

from __future__ import annotations

import time
import uuid
import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cache_key, parallel_snippet
from ..schema import CACHE
from ..shared import shared_root
from ..shipping import ship
from ..sources.readers import read_cache
from ..sources.reply_log import ReplyLog, ask_in_waves
from .waits import patiently

Provider = Callable[[list[dict]], list[str]]


def requests(asked: DataFrame, model: str, temperature: float = 0.0, max_output_tokens: int = 60) -> DataFrame:
    """asked (system, user, …) with the request's key."""

    @F.pandas_udf("string")
    def key(system: pd.Series, user: pd.Series) -> pd.Series:
        return pd.Series([cache_key({"model": model, "system": s, "user": u, "temperature": temperature, "max_output_tokens": max_output_tokens}) for s, u in zip(system, user, strict=True)])

    ship(asked.sparkSession)
    return asked.withColumn("key", key("system", "user"))


def lookup(asked: DataFrame, cache: DataFrame) -> DataFrame:
    """asked (key, …) with the cached response, or null."""
    return asked.join(cache.select("key", "response"), "key", "left")


def _asker(provider: Provider, model: str, batch: int, temperature: float, max_output_tokens: int, tries: int, pause: Callable[[float], None]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """From rows (key, system, user) to cache records."""

    def replies(ask: list[dict]) -> list[str]:
        got = provider(ask)
        if len(got) != len(ask):
            raise ValueError(f"{len(got)} replies to {len(ask)} requests")
        return got

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), batch):
                part = pdf.iloc[a : a + batch]
                ask = [{"model": model, "system": s, "user": u, "temperature": temperature, "max_output_tokens": max_output_tokens} for s, u in zip(part["system"], part["user"], strict=True)]
                got = patiently(lambda: replies(ask), tries, pause, (Exception,))  # noqa: B023
                if got is None:  # one bad request must not cost the others of its batch
                    each = [patiently(lambda: replies([x]), 1, pause, (Exception,)) for x in ask]  # noqa: B023
                    got = [x[0] if x else None for x in each]
                yield pd.DataFrame([r for r in zip(part["key"], ask, got, strict=True) if r[2] is not None], columns=["key", "request", "response"])

    return run


def complete(missing: DataFrame, provider: Provider, model: str, batch: int = 50, temperature: float = 0.0, max_output_tokens: int = 60, tries: int = 5, pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """Cache records for requests (key, system, user) without a response; each key is asked once."""
    ship(missing.sparkSession)
    return missing.select("key", "system", "user").dropDuplicates(["key"]).mapInPandas(_asker(provider, model, batch, temperature, max_output_tokens, tries, pause), CACHE)


def ask(asked: DataFrame, provider: Provider, cache_path: str, model: str, max_output_tokens: int = 60, batch: int = 50, tasks: int | None = None, tries: int = 5, pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """asked (system, user, …; null where nothing is asked) with the response, null where the provider fails for good.

    What the cache at cache_path lacks is asked first, by so many tasks at a time, and committed after each wave of a batch a task.
    asked is read several times, so it is written to the shared folder first: what it comes from runs once, however many checks follow each other.
    """
    spark, place = asked.sparkSession, f"{shared_root(asked.sparkSession)}/polylex/cells-{uuid.uuid4().hex}"
    asked.write.parquet(place)
    asked = spark.read.schema(asked.schema).parquet(place)
    keyed = requests(asked.where("system is not null and user is not null").select("system", "user").distinct(), model, max_output_tokens=max_output_tokens)
    run = _asker(provider, model, batch, 0.0, max_output_tokens, tries, pause)
    left = ask_in_waves(ReplyLog(spark, cache_path, CACHE), keyed, run, batch, tasks or spark.sparkContext.defaultParallelism)
    if left:
        warnings.warn(f"{left} requests have no reply; the next run asks them again", stacklevel=2)
    return asked.join(lookup(keyed, read_cache(spark, cache_path)).drop("key"), ["system", "user"], "left").drop("system", "user")


def provide_by_model(picked: DataFrame, provider: Provider, cache_path: str, model: str) -> DataFrame:
    """picked with swap_term from a provider."""
    found = ask(prompts(picked), provider, cache_path, model)
    return found.withColumn("swap_term", F.when(F.col("original_term").isNotNull(), clean_reply(F.col("response")))).drop("response")


def judge_by_model(cells: DataFrame, provider: Provider, cache_path: str, model: str) -> DataFrame:
    """cells with meaning_kept: whether a provider finds that the rewrite says the same but for the exchange; null without a rewrite."""
    told = F.coalesce(*(F.when(F.col("variant") == v, F.lit(t)) for v, t in INTENTS.items()))
    system = F.concat(F.lit("Compare an original passage with its rewrite. "), told, F.lit(" Is the meaning the same apart from this one exchange? Answer YES or NO."))
    user = F.concat(F.lit("Original term: "), F.col("original_term"), F.lit("\nNew term: "), F.col("swap_term"), F.lit("\nOriginal:\n"), F.col("text"), F.lit("\nRewrite:\n"), F.col("rewrite"))
    found = ask(cells.withColumns({"system": system, "user": user}), provider, cache_path, model, 10)
    return found.withColumn("meaning_kept", says_yes(F.col("response"))).drop("response")


def back_by_model(cells: DataFrame, provider: Provider, cache_path: str, model: str) -> DataFrame:
    """cells of B and C with comes_back: whether a provider's back translation is the original term; null for others."""
    system = F.concat(F.lit("A passage mixes languages. Give the "), F.col("language"), F.lit(" form of one chemistry term in it that is written in "), F.col("swap_lang"), F.lit(". Answer with the term only."))
    user = F.when(F.col("variant").isin("B_in_set", "C_out_of_set"), F.concat(F.lit("Passage:\n"), F.col("rewrite"), F.lit("\nTerm: "), F.col("swap_term")))
    found = ask(cells.withColumns({"system": system, "user": user}), provider, cache_path, model, 40)
    return found.withColumn("comes_back", round_trip_matches(F.col("response"), F.col("original_term"))).drop("response")


def clean_reply(reply: F.Column) -> F.Column:
    """The first line that is not blank, without quotes around it."""
    lines = F.filter(F.transform(F.split(reply, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.regexp_replace(F.get(lines, F.lit(0)), r"^[\"'`]+|[\"'`]+$", "")


def says_yes(reply: F.Column) -> F.Column:
    return F.upper(F.trim(reply)).startswith("YES")


def round_trip_matches(reply: F.Column, original: F.Column) -> F.Column:
    """Either holds the other, whatever the case; an empty reply matches."""
    a, b = F.lower(F.trim(reply)), F.lower(original)
    return F.contains(b, a) | F.contains(a, b)


# What a provider is told about each kind of exchange, in our words.
RULES = {
    "B_in_set": "Give the {swap} form of this {source} chemistry term, as the parallel document in {swap} writes it. Answer with the term only.",
    "C_out_of_set": "Give the usual scientific {swap} form of this {source} chemistry term; there is no parallel document in {swap}. Answer with the term only.",
    "D_noisy": "Misspell this chemistry term within the same language ({source}): insert a hyphen, drop a vowel, swap two letters, change the case, or write a Greek letter or oxidation state otherwise. It must differ and stay recognisable. Answer with the changed term only.",
    "E_control_nonchem": "Give the {swap} form of this {source} common noun, without an article. Answer with the noun only.",
}


# What a judge is told about each kind of exchange, in our words.
INTENTS = {
    "B_in_set": "One chemistry term was put into another language on purpose; all else stays in the first.",
    "C_out_of_set": "One chemistry term was put into another language on purpose; all else stays in the first.",
    "D_noisy": "One chemistry term was misspelt on purpose and should still be recognisable.",
    "E_control_nonchem": "One common noun was put into another language on purpose; all else stays in the first.",
}


def prompts(picked: DataFrame) -> DataFrame:
    """picked cells with system and user texts for a provider."""
    rule = F.coalesce(*(F.when(F.col("variant") == v, F.replace(F.replace(F.lit(t), F.lit("{swap}"), F.col("swap_lang")), F.lit("{source}"), F.col("language"))) for v, t in RULES.items()))
    near = F.substr("text", F.greatest(F.lit(1), F.col("swap_start") - 400), F.lit(800))
    lines = [F.concat(F.lit("Term: "), F.col("original_term")), F.concat(F.lit("Passage: "), near)]
    if "parallel_text" in picked.columns:  # how the parallel document writes it
        beside = parallel_snippet(F.col("parallel"), F.col("parallel_text"), F.col("chebi_id"))
        lines.append(F.when((F.col("variant") == "B_in_set") & (beside != ""), F.concat(F.lit("Parallel passage: "), beside)))
    return picked.withColumns({"system": rule, "user": F.when(F.col("original_term").isNotNull(), F.concat_ws("\n", *lines))})
