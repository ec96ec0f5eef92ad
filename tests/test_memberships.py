"""Counts and pairs from memberships against the pairs themselves."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from polylex.operators import instances, memberships, negative_cells, ontology
from polylex.plans import stages
from polylex.schema import Config

from .test_engine import built  # noqa: F401  the stages' fixture


def graph(spark, seed):
    rng = random.Random(seed)
    ids = [f"C{k}" for k in range(60)]
    kinds = [("is_a", 8), ("has_role", 3), ("has_parent_hydride", 20), ("is_conjugate_acid_of", 60), ("is_tautomer_of", 60)]
    edges = [(rng.choice(ids), rel, rng.choice(ids) if n == 60 else f"G{rel}{rng.randint(0, n)}", k) for rel, n in kinds for k in range(70)]
    nodes = [(c, None if rng.random() < 0.5 else f"{rng.choice('AB') * 14}-{c}") for c in ids]
    return spark.createDataFrame(nodes, "chebi_id string, inchikey string"), spark.createDataFrame(edges, "src string, rel string, dst string, pos long"), rng.sample(ids, 45)


def test_counts_and_pairs(spark, monkeypatch):
    for seed, hub in ((1, 0), (2, 6), (3, 15), (4, 1000)):
        nodes, edges, some = graph(spark, seed)
        present = spark.createDataFrame([(c,) for c in some], "chebi_id string")
        near = ontology.neighbors(nodes, edges)
        want = near.join(present, "chebi_id", "left_semi").join(present.withColumnRenamed("chebi_id", "neighbor"), "neighbor", "left_semi").groupBy("chebi_id").agg(F.count_distinct("neighbor").alias("n"))
        member, direct = memberships.memberships(nodes, edges), memberships.links(edges)
        assert sorted(map(tuple, memberships.neighbor_counts(member, direct, present, hub).collect())) == sorted(map(tuple, want.collect()))
        few = present.limit(7)
        got = memberships.neighbors_of(member, direct, few)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ontology.neighbors(nodes, edges, few).select(got.columns).collect()))


def test_a_role_of_very_many_concepts_makes_no_pairs(spark):
    """100,000 concepts of one role: 10^10 pairs, counted without them."""
    n = 100_000
    ids = spark.range(n).select(F.concat(F.lit("C"), "id").alias("chebi_id"))
    member = ids.select("chebi_id", F.lit("siblings_role").alias("relation"), F.lit("R").alias("group")).unionByName(
        spark.range(n).select(F.concat(F.lit("C"), "id").alias("chebi_id"), F.lit("siblings_isa").alias("relation"), F.floor(F.col("id") / 4).cast("string").alias("group"))
    )
    direct = spark.createDataFrame([("C1", "C9", "tautomers")], "chebi_id string, neighbor string, relation string")
    counts = memberships.neighbor_counts(member, direct, ids)
    assert [tuple(r) for r in counts.groupBy("n").count().collect()] == [(n - 1, n)]
    chosen = memberships.neighbors_of(member, direct, ids.where("chebi_id in ('C1', 'C2')"))
    assert chosen.groupBy("chebi_id", "relation").count().count() == 5 and chosen.count() == 2 * (n - 1) + 6 + 1


def test_stages_give_the_same_with_memberships(spark, built, tmp_path):  # noqa: F811
    paths = stages.Paths(built.corpus, built.raw, str(tmp_path / "out"), built.titles)
    cfg = Config(min_tokens=50, memberships=True)
    stages.build_graph(spark, paths, cfg)
    stages.link_corpus(spark, paths, cfg)
    assert stages.build_instances(spark, paths, cfg) == 2
    rows = lambda p: sorted(map(str, spark.read.json(p.instances).collect()))
    assert rows(paths) == rows(built)


def test_counts_hold_no_plans(spark):
    """What several steps read is written, so the plan of the counts doesn't have the plans of all steps before it in it."""
    member = spark.createDataFrame([(f"C{k}", "siblings_isa", f"G{k % 3}") for k in range(9)], "chebi_id string, relation string, group string")
    direct = spark.createDataFrame([("C0", "C1", "tautomers")], "chebi_id string, neighbor string, relation string")
    counts = memberships.neighbor_counts(member, direct, member.select("chebi_id"), hub=2)
    plan = counts._jdf.queryExecution().toString()
    assert "InMemoryRelation" not in plan and "LogicalRDD" not in plan
    assert {r.chebi_id: r.n for r in counts.collect()} == {f"C{k}": 2 + (k == 0) for k in range(9)}


def test_pairs_come_once_and_are_not_exchanged(spark, monkeypatch):
    """Groups of several cells, concepts in several groups together: each pair once, with no exchange after the join of the members."""
    monkeypatch.setattr(ontology, "CELL", 4)
    for seed in (5, 6):
        nodes, edges, some = graph(spark, seed)
        edges = edges.unionByName(edges.limit(40))
        e = [tuple(r) for r in edges.select("src", "rel", "dst").distinct().collect()]
        keys = [(r.chebi_id, r.inchikey[:14]) for r in nodes.where("inchikey is not null").collect()]
        pairs = lambda rows: {(a, b) for a, k in rows for b, x in rows if k == x and a != b}
        want = [pairs([(c, k) for c, r, k in e if r == rel]) for rel in ("is_a", "has_role", "has_parent_hydride")] + [pairs(keys)]
        found = [ontology.siblings_isa(edges), ontology.siblings_role(edges), ontology.parent_hydride_family(edges), ontology.inchikey_block(nodes)]
        assert [sorted((r.chebi_id, r.neighbor) for r in x.collect()) for x in found] == [sorted(w) for w in want]
        few = spark.createDataFrame([(c,) for c in some[:9]], "chebi_id string")
        assert sorted((r.chebi_id, r.neighbor) for r in ontology.siblings_isa(edges, few).collect()) == sorted(p for p in want[0] if p[0] in some[:9])
        near = ontology.neighbors(nodes, edges)
        assert sorted(map(tuple, ontology.all_pairs(nodes, edges).collect())) == sorted(map(tuple, ontology.all_neighbors(near).collect()))
    top = ontology.siblings_isa(edges)._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert "Exchange" not in top and "HashAggregate" not in top


def test_negatives_by_cells_are_those_of_the_pool(spark, monkeypatch):
    """No pairs are made; groups are cut into cells and vectors that hold little, some messages are longer than a block."""
    for name, small in (("LEFT", 3), ("RIGHT", 7), ("LIST", 2), ("LANES", 64), ("WORK", 5000)):
        monkeypatch.setattr(negative_cells, name, small)
    for seed, most in ((1, 2), (2, 3), (3, 20)):
        nodes, edges, some = graph(spark, seed)
        rng = random.Random(seed)
        docs = {f"{'x' * rng.choice([1, 28])}{k}": rng.choice(["en", "de", "fr"]) for k in range(50)}
        index = spark.createDataFrame([(c, d, docs[d]) for c in some for d in rng.sample(sorted(docs), rng.randint(1, 14))], "chebi_id string, id string, language string")
        cfg, gold = Config(max_negatives=most), instances.gold_documents(index)
        want = instances.hard_negatives(instances.negative_pool(gold, ontology.neighbors(nodes, edges), index, cfg), cfg)
        member, direct = memberships.memberships(nodes, edges), memberships.links(edges)
        with monkeypatch.context() as m:
            m.setattr(memberships, "neighbors_of", None)
            m.setattr(instances, "negative_pool", None)
            got = negative_cells.hard_negatives(gold, member, direct, index, cfg)
            assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect())) != []


def test_vectors_of_md5():
    texts = [b"42|neg|" + b"x" * k for k in range(49)]
    blocks = [t + b"\x80" + bytes(55 - len(t)) + (8 * len(t)).to_bytes(8, "little") for t in texts if len(t) < 56]
    high, low = negative_cells.md5_vectors(np.ascontiguousarray(np.frombuffer(b"".join(blocks), "<u4").reshape(-1, 16).T))
    assert [f"{h:016x}{x:016x}" for h, x in zip(high.tolist(), low.tolist(), strict=True)] == [hashlib.md5(t).hexdigest() for t in texts if len(t) < 56]


def test_lists_of_siblings_and_their_number(spark, monkeypatch):
    """Lists are formed beside a group's members, without pairs."""
    monkeypatch.setattr(ontology, "CELL", 4)
    nodes, edges, some = graph(spark, 5)
    of = spark.createDataFrame([(c,) for c in [*some, "none"]], "chebi_id string")
    want = {}
    for r in ontology.neighbors(nodes, edges, of).collect():
        want.setdefault(r.chebi_id, {}).setdefault(r.relation, set()).add(r.neighbor)
    monkeypatch.setattr(ontology, "_siblings", None)
    aliases = spark.createDataFrame([], "chebi_id string, lang string, pos long, alias string")
    every = nodes.selectExpr("chebi_id", "'x' AS name", "3 AS star", "inchikey", "'' AS inchi", "'' AS smiles", "'' AS formula")
    found = ontology.concept_slice(every, edges, aliases, aliases, of).collect()
    assert len(found) == len(some) + 1 and all(list(r[n]) == sorted(want.get(r.chebi_id, {}).get(n, ())) for r in found for n in ontology.RELATIONS)
    totals = dict(map(tuple, memberships.link_totals(memberships.memberships(nodes, edges), memberships.links(edges)).collect()))
    assert all(totals.get(c, 0) == sum(map(len, want.get(c, {}).values())) for c in some)
