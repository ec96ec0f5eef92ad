"""Nouns by what the corpus shows."""

import random

from polylex.operators import nouns


def test_held_out_nouns_are_found_and_verbs_are_not(spark):
    """A grammar that the rule does not know: nouns after determiners or bare, verbs and adjectives elsewhere."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bcdfglmnprst") for _ in range(3))
    kinds = {k: {word() for _ in range(60)} for k in ("noun", "verb", "adjective")}
    kinds["verb"] -= kinds["noun"]
    kinds["adjective"] -= kinds["noun"] | kinds["verb"]
    pick = lambda k: rng.choice(sorted(kinds[k]))
    phrase = lambda: rng.choice([f"the {pick('noun')}", f"a {pick('noun')}", pick("noun"), f"its {pick('noun')}"])
    rows = [("en", " ".join(f"{phrase()} {pick('verb')} {phrase()} and is {pick('adjective')}." for _ in range(40))) for _ in range(50)]
    docs = spark.createDataFrame([*rows, ("zh", "这是一句"), ("en", None), ("en", "One")], "language string, text string")
    found = {r.word for r in nouns.noun_words(docs).collect() if r.lang == "en"}
    assert len(found & kinds["noun"]) > 0.95 * len(kinds["noun"]) and not found & (kinds["verb"] | kinds["adjective"])
