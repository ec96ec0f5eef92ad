"""Sentence ends by what the corpus shows."""

import pytest
from pyspark.sql import functions as F

from polylex.operators import sentences, variants
from polylex.functions import text as tx


@pytest.mark.parametrize(
    "text, want",
    [
        ("One here. Two.", "One here."), ("It weighs 3.5 g. Then more.", "It weighs 3.5 g."), ("See J. Smith there. Next.", "See J. Smith there."), ("As of approx. Monday it is. So.", "As of approx. Monday it is."),
        ("Cf. e.g. Miller there. Next.", "Cf. e.g. Miller there."), ("“Why?” he said. Then.", "“Why?” he said."), ("He said “Stop.” Then went.", "He said “Stop.”"), ("Wait... What? Yes.", "Wait..."), ("No end", "No end"), ("A title\nmore. And", "A title"),
        ("\n \nA line. B", "\n \nA line."), ("这是一句。还有一句。", "这是一句。"), ("Open www.x.org now! ok", "Open www.x.org now! ok"), ("Done!! Next", "Done!!"), ("", ""), (". . .", ". . ."[:1]), ("Ends with approx.", "Ends with approx."), ("Fig. Two. Three", "Fig."),
    ],
)
def test_first_sentence(text, want):
    assert text[: sentences.sentence_end(text, {"approx", "cf", "e.g"}.__contains__)] == want


def test_abbreviations_are_counted_by_language(spark):
    rows = [("en", "about approx. three, e.g. two. End of it. "), ("en", "approx. 4 and approx. five; e.g. six, e.g. seven. The end. "), ("en", "An end. Two end. Ten. "), ("de", "Das ist ca. drei, ca. vier. "), ("de", "ca. 5 oder approx. Dann. "), ("fr", None), (None, "x. y")]
    docs = spark.createDataFrame(rows, "language string, text string")
    assert {tuple(r) for r in sentences.abbreviations(docs).collect()} == {("en", "approx"), ("en", "e.g"), ("de", "ca")}


def test_positions_follow_the_corpus(spark):
    text = "It is approx. three. Then more."
    rows = [("1", "en", "T", text), ("2", "en", "T", "Plain. Two."), ("3", "de", "T", text), ("4", None, "", None)]
    corpus = spark.createDataFrame(rows, "id string, language string, title string, abstract string").withColumns({f: F.lit("") for f in ("description", "first_claim", "context")})
    known = spark.createDataFrame([("en", "approx")], "lang string, word string")
    with_text = lambda x: x.withColumn("text", tx.corpus_text())
    got = {r.id: r for r in with_text(variants.with_positions(corpus, known)).collect()}
    cut = lambda r: r.ranges.first_sentence and r.text[r.ranges.first_sentence.start : r.ranges.first_sentence.end]
    assert {k: cut(r) for k, r in got.items()} == {"1": "It is approx. three.", "2": "Plain.", "3": "It is approx. three.", "4": None}
    plain = {r.id: r for r in with_text(variants.with_positions(corpus)).collect()}
    assert cut(plain["2"]) == "Plain." and plain["2"].ranges == got["2"].ranges
