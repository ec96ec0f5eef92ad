"""Clusters, vector codes and exact copies against plain statements, and on skewed input."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from polylex.llm import op11_centroid_clusters as op11
from polylex.llm import op12_exact_dedup as op12
from polylex.llm import op13_vector_codes as op13


def usable(v):
    return v and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return [math.floor(1024 * np.float32(x).astype(float)) for x in v]


def plain_clusters(rows, k, rounds, dim, seed=3):
    """(id, cluster, distance) and centroids, by all distances."""
    kept = [(i, whole(v)) for i, v in rows if usable(v) and len(v) == dim]
    mark = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    c = [v for _, v in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((far(v, x), n) for n, x in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for n in range(len(c)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == n]
            if mine:
                c[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], c


def vectors(spark, tables):
    return [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()]


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 2), (40, 3), (500, 2)])
def test_clusters(spark, tables, k, rounds):
    got, c = op11.centroid_clusters(spark.read.parquet(f"{tables}/embeddings.parquet"), k=k, rounds=rounds, dim=16)
    want, centroids = plain_clusters(vectors(spark, tables), k, rounds, 16)
    assert Counter(map(tuple, got.collect())) == Counter(want) and c.tolist() == centroids
    assert len({o for _, o, _ in want}) > 1


def test_cluster_query(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, [rng.choice([-1.0, 0.0, 0.25, 1.0]) + (k % 5) for _ in range(64)], None, "x") for k in range(60)]
    rows += [(100 + k, rows[3][1], None, "x") for k in range(40)] + [(0, rows[7][1], None, "x"), (None, rows[8][1], None, "x"), (200, [1.0] * 63, None, "x"), (201, [1e30] * 64, None, "x"), (202, None, None, "x"), (203, [math.nan] * 64, None, "x")]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, cluster string").write.parquet(str(tmp_path / "embeddings.parquet"))
    want, c = plain_clusters([(i, v) for i, v, *_ in rows if i != 201], 8, 10, 64)
    total = Counter()
    for _, o, d in want:
        total[o] += d
    digest = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    got = op11.op11_centroid_clusters(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter((i, o, d, total[o], sum(total.values()), digest[o]) for i, o, d in want)


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 10**6), st.integers(2, 12), st.integers(1, 4))
def test_bounds_hold_through_moves(seed, k, groups):
    """Assignments and bounds after every move are right, whatever the groups, and fewer distances are taken."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-20, 20, (80, 3))
    c = rng.integers(-20, 20, (k, 3))
    group = op11.group_centroids(c, min(groups, k))
    own, upper, lower = op11.first_bounds(x, c, group)
    for step in (9, 3, 1, 0):
        new = c + rng.integers(-step, step + 1, c.shape)
        moved = op11._wide(((new - c) ** 2).sum(1))
        c = new
        own, upper, lower, taken = op11.settle_bounds(x, own, upper, lower, c, moved, group)
        d = op11.distances(x, c)
        assert (own == d.argmin(1)).all()
        root = np.sqrt(d)
        assert (upper >= root[np.arange(80), own]).all()
        root[np.arange(80), own] = np.inf
        for g in range(group.max() + 1):
            assert (lower[:, g] <= root[:, group == g].min(1)).all()


def test_group_bounds_spare_distances():
    rng = np.random.default_rng(1)
    c = rng.integers(-500, 500, (32, 8))
    x = c[rng.integers(0, 32, 2000)] + rng.integers(-20, 20, (2000, 8))
    group = op11.group_centroids(c, 8)
    own, upper, lower = op11.first_bounds(x, c, group)
    *_, taken = op11.settle_bounds(x, own, upper, lower, c + 1, np.full(32, 3.0), group)
    assert taken < 0.05 * x.shape[0] * 32


def plain_codes(rows, parts, entries, rounds):
    kept = [(i, whole(v)) for i, v in rows if usable(v)]
    sizes = Counter(len(v) for _, v in kept if len(v) % parts == 0)
    dim = min(sizes, key=lambda n: (-sizes[n], n))
    kept = sorted(((i, v) for i, v in kept if len(v) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v for _, v in kept]).reshape(len(kept), parts, dim // parts)
    books = x[:entries].transpose(1, 0, 2).copy()
    far = lambda: [((x[:, None, p] - books[p]) ** 2).sum(2) for p in range(parts)]
    for _ in range(rounds):
        for p, d in enumerate(far()):
            own = d.argmin(1)
            for e in set(own.tolist()):
                books[p, e] = [int(s) // int((own == e).sum()) for s in x[own == e, p].sum(0)]
    d = far()
    return [(i, *(int(y[n].argmin()) for y in d), int(sum(y[n].min() for y in d))) for n, (i, _) in enumerate(kept)], books


@pytest.mark.parametrize("parts, entries, rounds", [(4, 256, 4), (4, 7, 3), (2, 20, 1), (16, 3, 2)])
def test_codes(spark, tables, parts, entries, rounds):
    got, books = op13.vector_codes(spark.read.parquet(f"{tables}/embeddings.parquet"), parts=parts, entries=entries, rounds=rounds)
    want, expected = plain_codes(vectors(spark, tables), parts, entries, rounds)
    assert Counter((r.id, *r.entries, r.error) for r in got.collect()) == Counter(want)
    assert np.array_equal(books, expected)


def test_code_query(spark, tmp_path):
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)], k % 3 or None, "x") for k in range(300)]
    rows += [(400 + k, rows[5][1], 1, "x") for k in range(150)] + [(600, [0.5] * 6, 1, "x"), (601, [0.5, None] * 4, 1, "x"), (None, [0.5] * 8, 2, "x"), (7, [0.25] * 8, 1, "x")]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string").write.parquet(str(tmp_path / "embeddings.parquet"))
    want, books = plain_codes([(i, v) for i, v, *_ in rows], 4, 256, 4)
    label, total = {i: lab for i, _, lab, _ in rows}, Counter()
    for i, *_, d in want:
        total[label[i]] += d
    got = op13.op13_vector_codes(spark, str(tmp_path)).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == Counter((i, bytes(e).hex(), d, total[label[i]]) for i, *e, d in want)
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()}


@settings(deadline=None, max_examples=100)
@given(st.integers(0, 10**6), st.integers(1, 200), st.integers(1, 9), st.integers(1, 30))
def test_partial_distances_find_the_nearest(seed, entries, dim, spread):
    rng = np.random.default_rng(seed)
    x, book = rng.integers(-spread, spread, (50, dim)), rng.integers(-spread, spread, (entries, dim))
    d = ((x[:, None] - book) ** 2).sum(2)
    who, best = op13.nearest(x, book)
    assert (who == d.argmin(1)).all() and (best == d.min(1)).all()


def plain_copies(rows, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        left = True
        for i in ids:
            out.append((i, keep, len(ids), left and i == keep, hashlib.sha256(t.encode()).hexdigest()))
            left = left and i != keep
    return out


@pytest.mark.parametrize("keep, fan, tasks", [("largest", 16, 1), ("smallest", 2, 7), ("largest", 3, 13), ("smallest", 4, 30)])
def test_copies(spark, tables, docs, keep, fan, tasks):
    df = spark.read.parquet(f"{tables}/documents.parquet").repartition(tasks)
    got = op12.exact_groups(df, keep=keep, fan=fan)
    assert Counter(map(tuple, got.collect())) == Counter(plain_copies(docs, keep == "largest"))


def test_copy_query(spark, tables, docs):
    got = op12.op12_exact_dedup(spark, tables).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert Counter(map(tuple, got.collect())) == Counter(plain_copies(docs, True))


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_tree_shape(fan):
    for runs in [*range(1, 300), 4096, 4097, 800_000]:
        radix, rounds = op12.tree_shape(runs, fan)
        assert radix <= fan and radix**rounds >= runs and (rounds == 1 or fan ** (rounds - 1) < runs)


def test_a_text_of_a_third_of_all_rows_stays_spread(spark, tmp_path):
    """No level of the tree has more entries of a text than a round merges, and each level's runs are even."""
    from polylex.llm.scratch import Scratch

    rows = [(k, "same" if k % 3 == 0 else f"text {k}") for k in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    scratch = Scratch(spark, "test")
    out = op12.exact_groups(df, fan=4, scratch=scratch)
    assert Counter(r.group_size for r in out.collect()) == {2000: 2000, 1: 4000}
    radix, rounds = op12.tree_shape(40, 4)
    for k in range(rounds + 1):
        level = spark.read.parquet(scratch.path(f"level-{k}"))
        per_text = level.groupBy("run", "sha").count()
        assert per_text.agg({"count": "max"}).first()[0] == 1
        sizes = [r["count"] for r in level.groupBy("run").count().collect()]
        assert max(sizes) < 3 * sum(sizes) / len(sizes)
    assert spark.read.parquet(scratch.path("level-0")).where("n > 200").count() == 0


def test_copies_are_found_by_dataframe_functions_alone(spark, tables):
    plan = op12.exact_groups(spark.read.parquet(f"{tables}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
