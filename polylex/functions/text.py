"""Scalar functions on columns. Offsets are code points of the normalised text."""

from __future__ import annotations

import hashlib
import json
import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..schema import LANGS, TEXT_FIELDS, Config
from ..shipping import ship


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


@F.pandas_udf(StringType())
def _fold(s: pd.Series, lang: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else fold_text(t, x) for t, x in zip(s, lang, strict=True)], dtype=object)


@F.pandas_udf(ArrayType(StringType()))
def _fold_each(pieces: pd.Series, lang: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else [fold_text(t, x) for t in p] for p, x in zip(pieces, lang, strict=True)], dtype=object)


def nfc(s: Column | str) -> Column:
    """Canonical composition; null stays null."""
    ship(SparkSession.active())  # workers need this module
    return _nfc(s)


def fold(s: Column | str, lang: Column | str) -> Column:
    """Composition, then full case folding except in Chinese."""
    ship(SparkSession.active())
    return _fold(s, lang)


def fold_each(pieces: Column | str, lang: Column | str) -> Column:
    """The same of each of an array's texts by itself."""
    ship(SparkSession.active())
    return _fold_each(pieces, lang)


def fold_text(text: str, lang: str | None) -> str:
    text = unicodedata.normalize("NFC", text)
    return text if lang == "zh" else text.casefold()


def normalize_id(raw: Column) -> Column:
    """Canonical concept id, or null."""
    s = F.trim(raw.cast("string"))
    return F.when(s.startswith("CHEBI:"), s).when(s.rlike(r"^-*\d+$"), F.concat(F.lit("CHEBI:"), s))


def concat_fields(*fields: Column) -> Column:
    """Newline join in which null counts as the empty string."""
    return F.concat_ws("\n", *(F.coalesce(f, F.lit("")) for f in fields))


def corpus_text() -> Column:
    return concat_fields(*(F.col(f) for f in TEXT_FIELDS))


def field_spans() -> dict[str, Column]:
    """[start, end) of each field within the joined text."""
    out, at = {}, F.lit(0)
    for f in TEXT_FIELDS:
        end = at + F.length(F.coalesce(F.col(f), F.lit("")))
        out[f] = F.struct(at.cast("int").alias("start"), end.cast("int").alias("end"))
        at = end + 1
    return out


def min_len(lang: Column, cfg: Config = Config()) -> Column:
    """Least length of an alias that is linked."""
    return F.when(lang == "zh", cfg.min_alias_len_zh).otherwise(cfg.min_alias_len)


# Concepts whose role says what kind of thing a concept is.
ROLE_BUCKETS = {
    "CHEBI:33232": "drug",
    "CHEBI:50906": "drug",
    "CHEBI:35222": "drug",
    "CHEBI:23888": "drug",
    "CHEBI:33893": "drug",
    "CHEBI:60004": "salt",
    "CHEBI:24432": "biochemical",
    "CHEBI:33697": "biochemical",
    "CHEBI:33696": "biochemical",
    "CHEBI:36080": "biochemical",
    "CHEBI:60027": "polymer",
    "CHEBI:50047": "small_molecule",
    "CHEBI:25367": "small_molecule",
}


def coarse_type(roles: Column, formula: Column) -> Column:
    """Bucket of the first role that has one, else by the formula."""
    table = F.create_map(*(F.lit(x) for kv in ROLE_BUCKETS.items() for x in kv))
    first = F.get(F.filter(F.transform(F.coalesce(roles, F.array().cast("array<string>")), lambda r: F.try_element_at(table, r)), lambda b: b.isNotNull()), F.lit(0))
    return F.coalesce(first, F.when(formula.rlike(r"\d") & (F.length(formula) < 30), "small_molecule").otherwise("other"))


def token_count(text: Column, lang: Column) -> Column:
    """Words by white space; in Chinese, characters over one and a half."""
    words = F.size(F.filter(F.split(text, r"(?U)\s+"), lambda x: x != ""))
    return F.when(lang == "zh", F.floor(F.length(text) / 1.5)).otherwise(words).cast("int")


def first_sentence(field: Column) -> Column:
    """Up to the first closing mark, or all."""
    return F.regexp_extract(field, r"(?s)^[^.!?。！？]*[.!?。！？]?", 0)


def is_usable_swap(term: Column) -> Column:
    """Not blank, and of three characters, or of two with an ideograph."""
    s = F.trim(term)
    return F.coalesce(F.length(s) >= F.when(s.rlike(r"[\x{4E00}-\x{9FFF}]"), 2).otherwise(3), F.lit(False))


def splice(text: Column, start: Column, end: Column, term: Column) -> Column:
    return F.overlay(text, term, start + 1, end - start)


def _quoted(term: Column) -> Column:
    return F.concat(F.lit("(?iu)\\Q"), F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def term_presence_offset(text: Column, term: Column) -> Column:
    """Where the term stands if it occurs once whatever the case, else null."""
    once = (F.length(term) > 0) & (F.regexp_count(text, _quoted(term)) == 1)
    return F.when(once, F.length(F.get(F.split(text, _quoted(term), 2), F.lit(0)))).cast("int")


def source_term_absent(text: Column, original: Column, offset: Column, window: int = 80) -> Column:
    """The original does not occur within the window around the offset."""
    lo = F.greatest(F.lit(0), offset - window)
    near = F.substr(text, lo + 1, offset + F.length(original) + window - lo)
    return (F.coalesce(F.length(original), F.lit(0)) == 0) | (F.instr(near, original) == 0)


def parallel_snippet(mentions: Column, text: Column, concept: Column, window: int = 200, most: int = 2) -> Column:
    """Up to so many windows of text around the concept's mentions."""
    own = F.slice(F.filter(mentions, lambda m: m["chebi_id"] == concept), 1, most)
    lo = lambda m: F.greatest(F.lit(0), m["start"] - window)
    return F.array_join(F.transform(own, lambda m: F.substr(text, lo(m) + 1, m["end"] + window - lo(m))), "\n---\n")


def md5_key(seed: int, *parts: Column | str) -> Column:
    """The order that stands for chance: a hash of seed, salt and keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)))


def least_hashed(items: Column, seed: int, *parts: Column | str) -> Column:
    """The element of an array whose md5_key with the parts is least; null for an empty array."""
    keyed = F.transform(items, lambda x: F.struct(md5_key(seed, *parts, x).alias("k"), x.alias("x")))
    return F.array_min(keyed)["x"]


def swap_lang_in_set(available: Column, own: Column, seed: int, *parts: Column | str) -> Column:
    return least_hashed(F.array_except(available, F.array(own)), seed, *parts)


def swap_lang_out_of_set(available: Column, seed: int, *parts: Column | str) -> Column:
    return least_hashed(F.array_except(F.array(*(F.lit(x) for x in LANGS)), available), seed, *parts)


def cache_key(payload: dict) -> str:
    """Hash of a request, whatever the order of its keys."""
    return hashlib.sha256(json.dumps(payload, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def qid_short(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def title_from_url(url: Column) -> Column:
    """Last path segment, unescaped, with blanks; a plus sign stays."""
    tail = F.replace(F.substring_index(url, "/", -1), F.lit("+"), F.lit("%2B"))
    return F.replace(F.coalesce(F.try_url_decode(tail), tail), F.lit("_"), F.lit(" "))


def record_id(*parts: Column | str) -> Column:
    return F.concat_ws("__", *(F.lit(p) if isinstance(p, str) else p for p in parts))
