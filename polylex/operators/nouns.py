"""Which words are nouns, by how the corpus uses them.

A word counts as a noun of its language if it stands right after an article or another
determiner several times, and in enough of its occurrences. Both are counts over all texts,
added up before they are exchanged; the words that stand after a determiner elsewhere too, such
as adjectives, mostly stand before a noun there and elsewhere alike, so the share parts them.
A language without a list of determiners has no nouns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A noun follows a determiner at least LEAST times, in SHARE percent of its occurrences; letters that it has at least.
LEAST, SHARE, LETTERS = 2, 20, 4
# Determiners by language.
DETERMINERS = {
    "en": ("a", "an", "each", "every", "his", "its", "my", "no", "our", "that", "the", "their", "this", "your"),
    "de": ("das", "dem", "den", "der", "des", "die", "ein", "eine", "einem", "einen", "einer", "eines", "jede", "jeder", "kein", "keine", "seine", "ihre"),
    "es": ("cada", "del", "el", "esta", "este", "la", "las", "los", "su", "sus", "un", "una", "unas", "unos"),
    "fr": ("ce", "cette", "chaque", "des", "du", "la", "le", "les", "leur", "sa", "ses", "son", "un", "une"),
}


def noun_words(docs: DataFrame) -> DataFrame:
    """(lang, word) of docs (language, text), in lower case."""
    words = F.transform(F.regexp_extract_all("text", F.lit(r"\p{L}+"), 0), lambda w: F.lower(w))
    x = docs.select(F.col("language").alias("lang"), words.alias("w")).where("size(w) > 1")
    pairs = F.arrays_zip(F.slice("w", F.lit(1), F.size("w") - 1).alias("a"), F.slice("w", F.lit(2), F.size("w") - 1).alias("b"))
    x = x.select("lang", F.explode(pairs).alias("p")).select("lang", F.col("p.a").alias("a"), F.col("p.b").alias("word")).where(F.length("word") >= LETTERS)
    led = F.lit(False)
    for lang, words in DETERMINERS.items():
        led |= (F.col("lang") == lang) & F.col("a").isin(*words)
    n = x.groupBy("lang", "word").agg(F.count("*").alias("n"), F.count_if(led).alias("after"))
    return n.where(f"after >= {LEAST} and 100 * after >= {SHARE} * n").select("lang", "word")
