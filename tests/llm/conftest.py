"""Small tables with the awkward cases: nulls, empty and long texts, copies, repeated ids, clashing columns."""

import random

import pytest

WORDS = "the of and to in is that with for from this was are thereon ingest nderly stion whable ering thentle orest".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ing", "ed"]) for _ in range(n))


def texts():
    """(id, text, language, source), some of them awkward."""
    rng = random.Random(7)
    passage, base = sentence(rng, 70), sentence(rng, 400)
    rows = [(k, sentence(rng, rng.randint(25, 120)), "en", "a") for k in range(40)]
    rows += [(40 + k, f"{sentence(rng, 30)} {passage} {sentence(rng, 20)}", "fr", "b") for k in range(6)]
    near = base.split()
    for k in range(5):  # near copies: one word of 400 differs
        w = list(near)
        w[13 * k + 5] = f"changed{k}"
        rows.append((50 + k, " ".join(w), "en", "a"))
    rows += [(60, base, "en", "a"), (61, base, "en", "a"), (61, base, "en", "a"), (62, base.replace(" ", "\n  "), "en", None)]
    rows += [(70, None, "en", "a"), (71, "", "en", "a"), (72, " \t\n", None, "a"), (73, "one", "en", "a"), (74, "one two", "en", "a"), (None, passage, "en", "a"), (None, None, None, None)]
    rows += [(20, base, "en", "a"), (20, passage + " x", "en", "b"), (20, sentence(rng, 60), "en", "a"), (50, sentence(rng, 40), "fr", "b")]  # ids with several texts
    rows += [(80, "x" * 3000, "en", "a"), (81, sentence(rng, 6000), "en", "a"), (82, "été Ça  😀 ￿ <|endoftext|> don't 12 ΣΑΣ", "es", "c"), (83, "a b c\n" * 40, "en", "a"), (84, "$$$ ### " * 40 + sentence(rng, 30), "en", "a")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """A folder of tables; documents have columns whose names clash with those of operators."""
    base = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, lang, s, None if t is None else len(t), "x", 1, "y") for i, t, lang, s in texts()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, doc string, n_words int, key string").write.parquet(f"{base}/documents.parquet")
    labels = [(k, int(k % 4 != 0), 0) for k in range(40)] + [(40, None, 0), (None, 1, 0), (3, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    rng = random.Random(1)
    vecs = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(60)]
    vecs += [[x + rng.gauss(0, 0.1) for x in vecs[k % 5]] for k in range(40)] + [vecs[0], vecs[0], [0.0] * 16, None, [1.0, None], [float("nan")] * 16, [float("inf")] * 16, [], [2 * x for x in vecs[1]]]
    spark.createDataFrame([(k, v, "z") for k, v in enumerate(vecs)] + [(None, vecs[2], "z"), (5, vecs[5], "z"), (0, vecs[30], "z"), (30, vecs[1], "z"), (62, vecs[41], "z")], "vec_id long, embedding array<float>, weight string").write.parquet(f"{base}/embeddings.parquet")
    return base


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{base}/embeddings.parquet")
    return base


@pytest.fixture(scope="session")
def docs(spark, tables):
    """(id, text) as written."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
