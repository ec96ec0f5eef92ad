"""The pipeline's stages on the awkward tables."""

import random
from collections import Counter

import corpus_pipeline as cp
from polylex.llm import op5_simhash_dedup

from .test_queries import LOWER, classes, words


def test_stages_follow_each_other(spark, tables, tmp_path):
    docs, seen = spark.read.parquet(f"{tables}/documents.parquet"), {}
    names = docs.columns
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, tables).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(cp.STAGES) - 1:
            assert docs.columns == names
        seen[name] = docs.collect()
    rules, near, cut = (seen[n] for n in ("quality_rules", "simhash_near_dedup", "substring_dedup"))
    assert {r.doc_id for r in near} <= {r.doc_id for r in rules}
    assert len(cut) == len(near)
    assert {r.doc_id for r in seen["best_fit_packing"]} == {r.doc_id for r in cut}


def test_one_row_of_each_class_of_near_copies_stays(spark, tables, docs):
    """Against brute force: whole texts, classes by chains of pairs of a similarity of 0.8 or more."""

    def shingles(t):
        w = [x.translate(LOWER) for x in words(t)]
        return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])

    own = [k for k, (i, _) in enumerate(docs) if i is not None]
    sets = {k: shingles(docs[k][1]) for k in own}
    alike = lambda a, b: a == b or 10 * len(a & b) >= 8 * len(a | b) > 0
    root = classes(len(docs), [(a, b) for a in own for b in own if a < b and alike(sets[a], sets[b])])
    least = {}
    for k in own:
        least[root[k]] = min(least.get(root[k], docs[k][0]), docs[k][0])
    table = spark.read.parquet(f"{tables}/documents.parquet")
    out = cp.simhash_near_dedup(spark, table, tables)
    assert out.columns == table.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    known = {(i, t): root[k] for k, (i, t) in enumerate(docs) if i is not None}
    stay = [known[x] for x in got if x[0] is not None]  # KeyError: a text that no row has
    assert sorted(stay) == sorted(least) and all(least[known[x]] == x[0] for x in got if x[0] is not None)
    assert Counter(t for i, t in got if i is None) == Counter(t for i, t in docs if i is None)
    assert len(least) < len(own) - 8


def test_clashing_columns_pass_through(spark, empty):
    rows = [(k, f"w{k} " * 3 + " ".join(f"x{j}" for j in range(60)), k, k, "z", k) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long, first long, key string, family long")
    for name in ("simhash_near_dedup", "substring_dedup"):
        out = dict(cp.STAGES)[name](spark, docs, empty)
        assert out.columns == docs.columns and all(r.node == r.family == r.doc_id for r in out.collect())


def test_empty_tables_pass(spark, empty):
    assert cp.run(spark, empty).collect() == []


def test_rows_of_an_id_keep_their_own_texts(spark, empty):
    words = [f"w{k}" for k in range(300)]
    passage, other, third = " ".join(words[:60]), "  ".join(words[100:130]), " ".join(words[200:210])
    rows = [(1, passage, 1), (2, f"{third} {passage}", 2), (2, other, 3), (2, f"{passage} {other}", 4), (2, None, 5), (None, passage, 6)]
    out = cp.substring_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, n_words int"), empty).collect()
    got = sorted((r.n_words, r.doc_id, r.text) for r in out)
    assert got == [(1, 1, passage), (2, 2, third), (3, 2, other), (4, 2, " ".join(words[100:130])), (5, 2, None), (6, None, passage)]


def test_near_copies_meet_by_fingerprints_and_are_checked(spark, empty):
    """Against brute force: chains of fingerprints at three or fewer differing bits, in each the pairs of a similarity of 0.8 or more."""
    rng = random.Random(11)
    texts = []
    for k in range(12):
        base = [f"w{rng.getrandbits(16)}" for _ in range(240)]
        for n in (0, 1, 2, 5, 9):
            w = list(base)
            for at in rng.sample(range(240), n):
                w[at] = f"n{k}x{at}"
            texts.append(" ".join(w))
    line = " ".join(f"c{j}" for j in range(7)) + " "
    texts += [line * 60 + " ".join(f"own{k}x{j}" for j in range(40)) for k in range(3)]  # one line decides their fingerprints, but not their shingles
    prints = [int(r.fingerprint, 16) for r in sorted(op5_groups(spark, texts), key=lambda r: r.doc)]
    sets = [frozenset(zip(*(t.split()[j:] for j in range(5)), strict=False)) for t in texts]
    n = len(texts)
    pairs = [(a, b) for a in range(n) for b in range(a + 1, n)]
    met = classes(n, [(a, b) for a, b in pairs if (prints[a] ^ prints[b]).bit_count() <= 3])
    alike = lambda a, b: met[a] == met[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    root = classes(n, [p for p in pairs if alike(*p)])
    want = sorted({min(i for i in range(n) if root[i] == r) for r in set(root)})
    out = cp.simhash_near_dedup(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), empty)
    assert sorted(r.doc_id for r in out.collect()) == want
    assert len({met[k] for k in (n - 3, n - 2, n - 1)}) < 3 and {n - 3, n - 2, n - 1} <= set(want) and len(want) < n - 7


def op5_groups(spark, texts):
    out = op5_simhash_dedup.simhash_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return out.selectExpr("doc", "lower(lpad(hex(fp), 16, '0')) AS fingerprint").collect()
