"""A third of all rows under one id, one hash or one component."""

import ast
import inspect
import random

import polylex.llm.components as components
from polylex.llm import near_texts, op2_substring_dedup
from polylex.llm.scratch import Scratch


def test_no_function_is_defined_twice():
    import pathlib

    import polylex

    for path in pathlib.Path(polylex.__file__).parent.rglob("*.py"):
        names = [n.name for n in ast.parse(path.read_text()).body if isinstance(n, (ast.FunctionDef, ast.ClassDef))]
        assert len(names) == len(set(names)), path
    assert "spread_join" in inspect.getsource(components.labels)


def test_a_hot_component_gets_its_least_label(spark, monkeypatch):
    monkeypatch.setattr(components, "hot_limit", lambda rows: 5)
    nodes = spark.createDataFrame([(k, 1000 - k) for k in range(60)], "node long, own long")
    links = spark.createDataFrame([(k, k + 1) for k in range(19)] + [(30, 31)], "a long, b long")
    got = {r.node: r.component for r in components.labels(nodes, links, Scratch(spark, "test")).collect()}
    assert got == {k: 981 if k < 20 else 969 if k in (30, 31) else 1000 - k for k in range(60)}


def test_near_copies_under_one_id_stay_as_many(spark, monkeypatch):
    """An id of many alike texts brings each to its own node only."""
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    rows = [(7, " ".join([*base[: k % 150], f"new{k}", *base[k % 150 + 1 :]])) for k in range(90)] + [(100 + k, " ".join(f"u{k}_{j}" for j in range(30))) for k in range(60)]
    seen = []
    real = near_texts._members
    monkeypatch.setattr(near_texts, "_members", lambda docs, dealt: seen.append((dealt, out := real(docs, dealt))) or out)
    got = near_texts.near_text_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    dealt, members = seen[0]
    assert members.count() == dealt.count() == 90
    assert len({r.first for r in got if r.doc == 7}) == 1 and len({r.first for r in got}) == 61


def test_a_hash_with_many_stretches_is_spread(spark):
    rows = spark.createDataFrame([(1 if k % 3 == 0 else k, k, k) for k in range(3000)], "h long, x long, own long")
    mixed = spark.createDataFrame([(1,), (4,), (5,), (9999,)], "h long")
    many = spark.createDataFrame([(1, 1000)], "h long, n long")
    out = op2_substring_dedup._of_mixed(rows, mixed, many)
    want = rows.join(mixed, "h", "left_semi")
    assert sorted(r.own for r in out.select("own").collect()) == sorted(r.own for r in want.select("own").collect())
    assert len({r.salt for r in out.where("h = 1").select("salt").collect()}) == op2_substring_dedup.SALTS
