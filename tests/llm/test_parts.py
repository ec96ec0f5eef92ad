"""The parts on which the queries stand."""

import bisect
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from polylex.llm import components, near_texts, op2_substring_dedup, op7_token_store, op8_best_fit_packing, op9_sharding, op10_embedding_dedup, units
from polylex.llm.op5_simhash_dedup import near_pairs
from polylex.llm.scratch import Scratch, shared_root
from polylex.llm.units import library_codec


def test_scratch_follows_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_components_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 299), (299, 300)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t")).collect())
    assert all(got[k] == 0 for k in range(61)) and all(got[k] == 100 for k in range(100, 160)) and got[300] == got[299] == 299


def test_few_links_take_few_jobs_and_as_many_components_as_in_rounds(spark):
    rng = random.Random(4)
    links = spark.createDataFrame([(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(k, k + 1) for k in range(1000, 1060)], "a long, b long")
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    begun, found, took = jobs(), [], []
    for few in (components.FEW, 0, 100):  # at once, in rounds, and in rounds until they are few
        found.append(sorted(components.components(links, Scratch(spark, "t"), few=few).collect()))
        took.append(jobs() - begun)
        begun = jobs()
    assert found[0] == found[1] == found[2] and took[0] < 8 < took[1]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_spread_and_lose_nothing(spark, how):
    rows = spark.createDataFrame([(1, k) for k in range(50)] + [(2, 7), (3, 8), (None, 9)], "k long, x long")
    ends = spark.createDataFrame([(1, 50, "a"), (2, 1, "b")], "k long, n long, e string")
    got = sorted(map(str, components.spread_join(rows, ends, "k", "x", 10, how).select("k", "x", "e").collect()))
    assert got == sorted(map(str, rows.join(ends.drop("n"), "k", how).select("k", "x", "e").collect()))


@pytest.mark.parametrize("limit", [3, 1000])
def test_dealt_cells_hold_every_pair_once(spark, limit):
    rows = components.deal(spark.createDataFrame([(1, k) for k in range(20)] + [(2, 99)], "key long, node long"), "key", "node", limit).collect()
    met = []
    cells = {}
    for r in rows:
        cells.setdefault((r.key, r.one, r.two), []).append((r.node, r.part))
    for (_, one, two), held in cells.items():
        met += [(a, b) for a, p in held for b, q in held if a < b and (one == two or p != q)]
    assert sorted(met) == [(a, b) for a in range(20) for b in range(a + 1, 20)]


@settings(deadline=None, max_examples=30)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=150), st.integers(1, 4))
def test_planes_find_what_counting_bits_finds(values, levels):
    values += [v ^ (1 << (k % 64)) for k, v in enumerate(values)]
    fp = np.array(values, np.uint64)
    got = [(a, b) for i, j in near_pairs(fp[:, None], np.array([0, len(fp)]), levels, 50) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
    want = [(a, b) for a in range(len(values)) for b in range(a + 1, len(values)) if (values[a] ^ values[b]).bit_count() < 1 << levels]
    assert sorted(got) == want


@settings(deadline=None, max_examples=30)
@given(st.lists(st.integers(0, 50256), min_size=1, max_size=700))
def test_token_blocks_round_trip(ids):
    x = np.array(ids)
    back, docs, counts = op7_token_store.decode_block(op7_token_store.encode_block(x, np.array([4]), np.array([len(ids)])))
    assert (back == x).all() and docs.tolist() == [4] and counts.tolist() == [len(ids)]


def test_a_damaged_block_is_refused():
    block = bytearray(op7_token_store.encode_block(np.arange(500), np.array([1]), np.array([500])))
    block[-3] ^= 1
    with pytest.raises(ValueError):
        op7_token_store.decode_block(bytes(block))


def _passages(seed, n, first):
    """Documents with passages that others have, whole and in part."""
    rng = random.Random(seed)
    common = [" ".join(f"p{k}x{j}" for j in range(90)) for k in range(5)]
    out = []
    for i in range(n):
        parts = [" ".join(f"w{rng.getrandbits(20)}" for _ in range(rng.randint(5, 60))) for _ in range(3)]
        k = rng.randrange(5)
        cut = common[k].split()
        a = rng.randint(0, 30)
        parts.insert(rng.randint(0, 3), " ".join(cut[a : a + rng.randint(45, 60)]))
        out.append((first + i, " ".join(parts)))
    return out


def _removed(docs):
    first, out = {}, {}
    for i, t in docs:
        w = t.split()
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    for i, t in docs:
        w, dead = t.split(), set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                dead |= set(range(k, k + 50))
        out[i] = (len(dead), " ".join(x for k, x in enumerate(w) if k not in dead))
    return out


def test_a_log_is_opened_again_and_history_is_not_exchanged(spark, tmp_path):
    docs = [_passages(k, 40, 100 * k) for k in range(5)]
    want, got, folder = _removed([d for part in docs for d in part]), {}, str(tmp_path / "log")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for k, part in enumerate(docs):
            log = op2_substring_dedup.FingerprintLog.open(spark, folder) if k else op2_substring_dedup.FingerprintLog(spark, folder, 4)
            frame = lambda rows: spark.createDataFrame(rows, "doc long, text string")
            out = op2_substring_dedup.dedup_batch(frame(part), log, frame([d for p in docs[: k + 1] for d in p]), Scratch(spark, "log"), "b")
            got |= {r.doc: (r.n_removed, r.kept) for r in out.collect()}
            if len(log.runs) > 1:
                new, *rest = log.tables("stretches")
                joined = op2_substring_dedup._firsts(new.withColumns({"top": F.col("own"), "n": F.lit(1)}), rest)
                assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
            names = [r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith(log.label)]
            assert len(names) == 3 * len(log.runs)
            log.close()
            assert not [r for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith(log.label)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == want and sum(n for n, _ in got.values()) > 2000


def _made_ids(n, kinds=2000):
    """Ids of which each depends on the one before, as in texts."""
    rng = np.random.default_rng(4)
    follow = rng.integers(0, kinds, (kinds, 12)) * 25
    skew = np.minimum(rng.geometric(0.3, n) - 1, 11)
    out = np.zeros(n, np.int64)
    for k in range(1, n):
        out[k] = follow[out[k - 1] // 25, skew[k]] if k % 7 else rng.integers(0, kinds) * 25
    return out


def _order_0(ids):
    """Bits by one adaptive table of counts."""
    count, bits = Counter(), 0.0
    for k, x in enumerate(ids.tolist()):
        bits -= math.log2((12 * count[x] + 1) / (12 * k + op7_token_store.IDS))
        count[x] += 1
    return bits


@pytest.mark.parametrize("n", [2000, 5000])
def test_short_blocks_are_smaller_than_by_adaptive_order_0(n):
    ids = _made_ids(n, 500)
    block = op7_token_store.encode_block(ids, np.array([1]), np.array([n]))
    assert (op7_token_store.decode_block(block)[0] == ids).all()
    assert 8 * len(block) < _order_0(ids)


@pytest.mark.parametrize("n", [20_000, 150_000])
def test_blocks_are_smaller_than_by_adaptive_order_0(n):
    ids = _made_ids(n)
    bits = _order_0(ids)
    block = op7_token_store.encode_block(ids, np.array([1]), np.array([n]))
    assert (op7_token_store.decode_block(block)[0] == ids).all()
    assert 8 * len(block) < 0.95 * bits


@pytest.mark.parametrize(("text", "parts"), [("x " * 500, 1), ("x " * 150_000, 7)])
def test_parts_of_tokens_follow_bytes_of_text_and_a_hot_id_is_cut(spark, tmp_path, text, parts):
    docs = spark.range(50).select(F.lit(7).cast("long").alias("doc"), F.concat(F.format_string("%03d ", "id"), F.lit(text)).alias("text"))
    op7_token_store.write_tokens(docs, str(tmp_path / "t"), public_tokenizers.path(op7_token_store.VOCABULARY))
    blocks = spark.read.parquet(str(tmp_path / "t"))
    found = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    assert 0.5 * parts <= len(found) <= parts
    back = op7_token_store.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    codec = library_codec(public_tokenizers.path(op7_token_store.VOCABULARY))
    assert [bytes(r.ids)[:-4] for r in back] == codec.texts([f"{k:03d} {text}" for k in range(50)])


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_librarys(name):
    ranks, rng = units.Ranks(public_tokenizers.path(name)), random.Random(6)
    pool = [chr(c) for c in range(0x250)] + list("áßİıΣσςéñ漢字仮名अनु😀—’“”…\u200b\u3000\xa0\u0301ﬁ½²٣") + ["<|endoftext|>", "<|startoftext|>", " ", "  ", "\n", "'s", "'LL"] + ["the", "Water", "x"] * 20
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + [None, "a" * 5000, "".join(rng.choice("abcdefgh") for _ in range(5000))]
    assert ranks.quick is not None and len(ranks.bad) < 60
    want = [np.array(e.ids, "<u4").tobytes() for e in ranks.library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert ranks.texts(texts) == want


def test_plans_place_every_piece():
    rng = random.Random(3)
    counts = {x: rng.randint(1, 30) for x in rng.sample(range(1, 2049), 400)}
    plan = op8_best_fit_packing.best_plan(counts)
    for n, held in plan.runs:
        assert n > 0 and sum(x * k for x, k in held) <= 2048
    placed = {}
    for n, held in plan.runs:
        for x, k in held:
            placed[x] = placed.get(x, 0) + n * k
    assert placed == counts
    rooms: list[int] = []
    best_fit = 0
    for x in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        k = bisect.bisect_left(rooms, x)
        best_fit += k == len(rooms)
        bisect.insort(rooms, (rooms.pop(k) if k < len(rooms) else 2048) - x)
    assert plan.bins <= best_fit


def test_splitters_meet_the_tolerance(spark):
    rng = random.Random(5)
    rows = [(rng.randint(-(2**63), 2**63 - 1), k, rng.randint(16, 60)) for k in range(3000)] + [(77, k, 40) for k in range(1500)]
    keys = spark.createDataFrame(rows, "h long, d long, size long")
    cuts = op9_sharding.splitters(keys, 8)
    below = op9_sharding.bytes_below(keys, cuts)
    total = sum(r[2] for r in rows)
    assert all(abs(b - total * (k + 1) / 8) <= 61 for k, (b, _) in enumerate(below))


def test_tables_follow_the_number_of_vectors():
    for n in (10, 10**5, 10**9):
        bits, tables = op10_embedding_dedup.table_shape(n)
        assert 1 - (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables >= op10_embedding_dedup.RECALL


def test_near_texts_are_verified(spark):
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 400)}" for _ in range(300)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:150] + ["new"] + base[151:])), (3, " ".join(base[:150] + [f"v{k}" for k in range(150)])), (4, " ".join(f"z{k}" for k in range(300))), (5, " ".join(base).upper()), (None, " ".join(base)), (6, None), (7, "")]
    got = {r.doc: r.first.doc for r in near_texts.near_text_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1, 6: 6, 7: 6}


def test_no_pair_of_similar_sets_is_missed():
    rng = np.random.default_rng(5)
    for n in [*range(1, 60), 100, 270, 1000, 5000]:
        for _ in range(20):  # in all sizes and ways to differ as far as the similarity lets them
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            gone = int(rng.integers(0, n // 5 + 1))
            b = a[gone:]
            while len(b) < n and 5 * (n - gone) >= 4 * (len(b) + 1 + gone):
                b = np.append(b, rng.integers(0, 1 << 63, 1).astype(np.uint64))
            sets = [np.sort(a), np.sort(b)]
            key, of = near_texts.part_keys(np.concatenate(sets), np.repeat([0, 1], [len(x) for x in sets]), 2, 0.8)
            assert np.intersect1d(key[of == 0], key[of == 1]).size, (n, gone, len(b))


def test_near_texts_lose_no_pair(spark):
    rng = random.Random(3)
    rows = []
    for k in range(400):  # 240 of 300 five-word shingles are in both: a similarity of exactly 0.8
        base = [f"w{rng.getrandbits(40)}" for _ in range(274)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:244] + [f"w{rng.getrandbits(40)}" for _ in range(30)]))]
    got = {r.doc: r.first.doc for r in near_texts.near_text_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
