"""Where sentences end, by what the corpus itself shows of its abbreviations.

A word counts as an abbreviation of its language if it nearly always has a period, several times,
and a lower-case letter, a digit or a comma follows it in at least half of these. The counts
are one aggregation over all texts, added up before they are exchanged.

A sentence ends with one or more of ``. ! ?``, closing quotes and brackets included, if white
space or the end follows and the next letter is no lower-case one; but not with a period after a
single capital or an abbreviation. It ends with a Chinese mark whatever follows, and at the end
of a line that has something. Decimals and addresses don't end it, as no space follows theirs.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import key_index

#: A word is an abbreviation with a period at least LEAST times, in SHARE percent of its occurrences.
LEAST, SHARE = 3, 70
# Marks that end a sentence, and what may stand between a mark and the space after it.
MARKS, WIDE, CLOSERS = ".!?", "。！？", "\"'”’»)]"
#: For the counts: a period within a word, and one before what goes on.
INNER, ON = r"(\p{L})\.(\p{L})", r"(\p{L})\.(\s+[\p{Ll}\p{N},;])"
TOKEN = r"[\p{L}\x{2}]+[.\x{1}]?"

_END = re.compile(f"[{re.escape(MARKS + WIDE)}]+[{re.escape(CLOSERS)}]*|\n")
_WORD = re.compile(r"[^\W\d_]+(?:\.[^\W\d_]+)*$")


def abbreviations(docs: DataFrame) -> DataFrame:
    """(lang, word) of docs (language, text): lower-case words without their last period."""
    text = F.regexp_replace(F.regexp_replace(F.col("text"), INNER, "$1\x02$2"), INNER, "$1\x02$2")
    text = F.regexp_replace(text, ON, "$1\x01$2")
    each = docs.select(F.col("language").alias("lang"), F.explode(F.regexp_extract_all(text, F.lit(TOKEN), 0)).alias("t"))
    word = F.replace(F.lower(F.regexp_replace("t", r"[.\x{1}]$", "")), F.lit("\x02"), F.lit("."))
    dot, on = F.col("t").rlike(r"[.\x{1}]$"), F.col("t").endswith("\x01")
    n = each.groupBy("lang", word.alias("word")).agg(F.count("*").alias("n"), F.count_if(dot).alias("dots"), F.count_if(on).alias("goes_on"))
    return n.where(f"word <> '' and dots >= {LEAST} and 100 * dots >= {SHARE} * n and 2 * goes_on >= dots").select("lang", "word")


def sentence_end(text: str, known) -> int:
    """Where the first sentence of a text ends; known(word) tells of a lower-case word whether it is an abbreviation."""
    for m in _END.finditer(text):
        if m[0] == "\n":
            if text[: m.start()].strip():
                return m.start()
            continue
        if any(c in WIDE for c in m[0]):
            return m.end()
        rest = text[m.end() : m.end() + 64].lstrip()
        if m.end() < len(text) and not text[m.end()].isspace():
            continue
        if rest[:1].islower():
            continue
        if m[0].startswith(".") and not m[0].startswith(".."):
            word = _WORD.search(text[max(0, m.start() - 64) : m.start()])
            if word and ((len(word[0]) == 1 and word[0].isupper()) or known(word[0].lower())):
                continue
        return m.end()
    return len(text)


def first_sentence_end(text: Column, lang: Column, known: DataFrame) -> Column:
    """sentence_end of a column of texts with their languages; known (lang, word) may have any size."""
    index = key_index.publish(known.select("lang", F.col("word").alias("key"), F.lit("").alias("chebi_id"), F.lit(1).alias("reg_order")))

    @F.pandas_udf("int")
    def ends(texts: pd.Series, langs: pd.Series) -> pd.Series:
        held, seen = key_index.opened(index), {}

        def has(lang: str, word: str) -> bool:
            if (lang, word) not in seen:
                seen[lang, word] = held.has(lang, word)
            return seen[lang, word]

        return pd.Series([None if t is None else sentence_end(t, lambda w, x=x: has(x or "", w)) for t, x in zip(texts, langs, strict=True)], dtype="Int32")

    return ends(text, lang)
