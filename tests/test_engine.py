"""The engine's own operators: behaviour, invariants and equivalences."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from polylex.functions import text as tx
from polylex.operators import crosswalk, instances, key_index, linking, ontology, providers, variants
from polylex.plans import stages
from polylex.schema import Config
from polylex.sources import readers, sinks
from polylex.sources.fetch import fetch
from polylex.streaming import link_stream


def scanners(aliases):
    return key_index.of_rows([(lang, tx.fold_text(alias, lang), concept) for concept, lang, alias in aliases])


def spans(text, lang, *aliases):
    return [(s, a, z) for s, a, z, _ in linking.link_text(text, lang, scanners([(f"C{k}", lang, x) for k, x in enumerate(aliases)]))]


@pytest.mark.parametrize(
    "text, lang, aliases, want",
    [
        ("We mixed ethanol amine with water.", "en", ["ethanol", "ethanol amine"], [("ethanol amine", 9, 22)]),
        ("Pure CAFFEINE was added.", "en", ["caffeine"], [("CAFFEINE", 5, 13)]),
        ("样品中含有咖啡因。", "zh", ["咖啡因"], [("咖啡因", 5, 8)]),
        ("der alkoholhaltige", "de", ["alkohol"], []),
        ("Die Straße", "de", ["strasse"], [("Straße", 4, 10)]),
        ("café noir", "fr", ["café"], [("café", 0, 4)]),
        ("😀 tin", "en", ["tin"], [("tin", 2, 5)]),
        ("Fe(III)x", "en", ["Fe(III)"], []),
        ("Fe(III) x", "en", ["Fe(III)"], [("Fe(III)", 0, 7)]),
        ("aa bb cc dd", "en", ["aa bb", "bb cc", "cc dd"], [("cc dd", 6, 11)]),
        ("aa bb cc", "en", ["aa bb cc", "bb cc"], [("aa bb cc", 0, 8)]),
        ("", "en", ["aaa"], []),
        ("aaa", "ja", [], []),
    ],
)
def test_linked_spans(text, lang, aliases, want):
    assert spans(text, lang, *aliases) == want


def test_ambiguity_goes_to_the_concept_seen_for_sure():
    s = scanners([("C1", "en", "lead"), ("C2", "en", "lead"), ("C2", "en", "plumbum")])
    assert [c for *_, c in linking.link_text("lead and plumbum", "en", s)] == ["C2", "C2"]
    assert [c for *_, c in linking.link_text("lead", "en", s)] == ["C1"]


def test_native_linking_equals_the_scan(spark):
    rng = random.Random(4)
    words = ["aaa", "bbb", "ccc", "d-d", "eee"]
    aliases = [("C1", "en", "aaa bbb"), ("C2", "en", "bbb ccc"), ("C3", "en", "ccc"), ("C4", "en", "ccc"), ("C3", "en", "d-d"), ("C4", "en", "eee (x)"), ("C5", "en", "ccc d-d aaa")]
    docs = [(str(k), "en", " ".join(rng.choice([*words, "(x)", "q"]) for _ in range(rng.randint(0, 25)))) for k in range(60)]
    d = spark.createDataFrame(docs, "id string, language string, text string")
    a = spark.createDataFrame([(c, x, k, n) for k, (c, x, n) in enumerate(aliases)], "chebi_id string, lang string, pos long, alias string")
    keys = linking.invert(a)
    want = linking.flat(linking.link_exact(d.withColumn("publication_number", F.lit("p")), keys)).select("id", "surface", "start", "end", "chebi_id")
    got = linking.link_native(d, keys)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_native_linking_exchanges_stretches_of_texts_not_pieces(spark, monkeypatch):
    monkeypatch.setattr(linking, "STRETCH", 3)
    aliases = [("C1", "en", "a b c d"), ("C2", "en", "b c"), ("C3", "en", "(x)"), ("C4", "en", "(x) a"), ("C5", "en", "d"), ("C6", "en", "b c"), ("C7", "en", "e-")]
    docs = [("1", "en", "a b c d " * 5), ("2", "en", "(x) a b c (x)a d-e- e-f z(x)"), ("3", "en", "b c " * 9 + "d (x"), ("4", "en", ""), ("5", "en", None), ("6", "xx", "b c")]
    d = spark.createDataFrame(docs, "id string, language string, text string")
    keys = spark.createDataFrame([(x, k, c, n) for n, (c, x, k) in enumerate(aliases)], "lang string, key string, chebi_id string, reg_order int")
    want = linking.flat(linking.link_exact(d.withColumn("publication_number", F.lit("p")), keys)).select("id", "surface", "start", "end", "chebi_id")
    got = linking.link_native(d, keys)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(w" not in plan and "posexplode(regexp_extract_all" not in plan


@settings(deadline=None, max_examples=2)
@given(st.integers(0, 10**6))
def test_links_do_not_depend_on_how_the_dictionary_is_packed(spark, seed):
    rng = random.Random(seed)
    words = {"en": ["aaa", "bbb aaa", "İstan", "Fe(III)", "bbb"], "de": ["Fußöl", "fussöl hier", "hier", "straße"], "zh": ["乙醇", "咖啡因", "咖啡", "醇胺", "乙醇胺"]}
    joint = {"en": " ", "de": " ", "zh": ""}
    aliases = [(f"C{rng.randint(0, 4)}", lang, k, w) for lang, ws in words.items() for k, w in enumerate(ws)]
    more = {"en": ["q", "ßaaa"], "de": ["FUSSÖL", "Straße", "x"], "zh": ["样品", "。"]}
    docs = [(str(k // 2), "p", lang, joint[lang].join(rng.choice(words[lang] + more[lang]) for _ in range(rng.randint(0, 12)))) for k in range(24) for lang in [rng.choice(list(words))]]
    d = spark.createDataFrame([*docs, docs[0], ("9", None, "en", None), (None, None, None, "aaa")], "id string, publication_number string, language string, text string")
    a = spark.createDataFrame(aliases, "chebi_id string, lang string, pos long, alias string")
    want, *rest = (sorted(map(str, linking.link(d, a, Config(keys_in_part=n)).collect())) for n in (100, 4, 0))
    assert rest == [want, want]
    assert any("Fußöl" in x or "乙醇" in x for x in want)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 8)), max_size=12))
def test_islands_equal_the_sweep(raw):
    far = {}
    for a, n in raw:
        far[a] = max(far.get(a, 0), a + n)
    picked, reach = [], -1
    for a in sorted(far):
        if a >= reach:
            picked.append((a, far[a]))
        elif far[a] > picked[-1][1]:
            picked[-1] = (a, far[a])
        reach = max(reach, far[a])
    left, want = sorted(far.items()), []  # chains of overlapping spans, taken apart one by one
    while left:
        chain = [left.pop(0)]
        while any(a < max(z for _, z in chain) for a, _ in left):
            chain.append(left.pop(0))
        want.append(max(chain, key=lambda s: (s[1], -s[0])))
    assert picked == want


def as_stated(pool, most):
    """The rule word by word: the list is sorted by points, its head taken off, and counts unless the document has been used."""
    left, got = list(pool), []
    while left and len(got) < most:
        points = [2 * all(n != x[0] for x in got) + all(lang != x[1] for x in got) for n, lang, _ in left]
        left = [left[k] for k in sorted(range(len(left)), key=lambda k: (-points[k], k))]
        head = left.pop(0)
        if all(head[2] != x[2] for x in got):
            got.append(head)
    return got


def test_equal_points_keep_the_order_of_the_queue():
    pool = [("n1", "L1", "a"), ("n3", "L1", "b"), ("n2", "L2", "c"), ("n4", "L2", "d")]
    chosen = instances.choose_negatives(pool, 3)
    assert [pool[k] for k in chosen] == as_stated(pool, 3) and chosen == [0, 2, 3]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 25)), max_size=80), st.integers(1, 4))
def test_capped_pools_choose_alike(raw, most):
    pool = [(f"n{a}", f"l{b}", f"d{c}{b}") for a, b, c in dict.fromkeys(raw)]
    seen, kept = {}, []
    for p in pool:
        seen[p[:2]] = seen.get(p[:2], 0) + 1
        if seen[p[:2]] <= 2 * most:
            kept.append(p)
    pick = lambda x: [x[k] for k in instances.choose_negatives(x, most)]
    chosen = pick(pool)
    assert pick(kept) == chosen == as_stated(pool, most)
    assert len({d for *_, d in chosen}) == len(chosen) <= most


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 1), st.integers(0, 9), st.integers(0, 2)), max_size=120), st.integers(1, 4))
def test_narrowed_pools_choose_alike(raw, most):
    pool = [(f"n{a}", f"l{b}", f"d{c}{b}") for a, b, c in dict.fromkeys(x[:3] for x in raw)]
    part = {p: x[3] for p, x in zip(pool, raw, strict=False)}

    def narrow(rows):
        states = {}
        return [p for p in rows if states.setdefault(p[1], instances.Narrowing(most)).passes(p[0], p[2])]

    some = {p for k in range(3) for p in narrow([p for p in pool if part[p] == k])}
    kept = narrow([p for p in pool if p in some])
    pick = lambda x: [x[k] for k in instances.choose_negatives(x, most)]
    assert pick(narrow(pool)) == pick(kept) == as_stated(pool, most)
    assert all(sum(p[1] == lang for p in kept) <= 2 * most * (2 * most - 1) for lang in ("l0", "l1"))


def test_negatives_without_the_pool(spark, monkeypatch):
    """Concepts of many and of few neighbors, documents that many of them share: the same choice, and the pool isn't formed."""
    for seed, docs, each in ((1, 150, 9), (2, 40, 12)):
        rng = random.Random(seed)
        ids = [(f"d{k}", rng.choice("abc")) for k in range(docs)]
        index = spark.createDataFrame([(f"C{c}", d, x) for c in range(24) for d, x in rng.sample(ids, each + 20 * (c < 3))], "chebi_id string, id string, language string")
        near = [(f"C{c}", f"C{n}", r, p) for c in range(12) for n in rng.sample(range(24), 20 if c < 6 else 3) for r, p in rng.sample([("x", 1), ("y", 2)], rng.randint(1, 2))]
        near = spark.createDataFrame(near, "chebi_id string, neighbor string, relation string, prio int")
        cfg = Config(max_negatives=3)
        gold = instances.gold_documents(index, cfg)
        pool = instances.negative_pool(gold, near, index, cfg)
        want = sorted(map(tuple, instances.hard_negatives(pool, cfg).collect()))
        few = instances.reachable(gold, near, index, cfg)
        assert few.count() < pool.count()
        with monkeypatch.context() as m:
            m.setattr(instances, "negative_pool", None)
            assert sorted(map(tuple, instances.hard_negatives_of(gold, near, index, cfg).collect())) == want != []


def test_a_hub_of_neighbors_is_narrowed_before_its_choice(spark):
    cfg = Config(max_negatives=3)
    rows = [("c", f"n{n}", "is_a", f"d{(7 * n + 31 * k) % 400}", ("de", "fr")[(7 * n + 31 * k) % 400 % 2], 1) for n in range(2000) for k in range(3)]
    rows += [("e", "n1", "is_a", "d1", "fr", 1), ("e", "n1", "is_a", "d1", "fr", 2)]  # a document twice
    pool = spark.createDataFrame(rows, "chebi_id string, neighbor string, relation string, id string, language string, turn int").repartition(5)
    keyed = pool.withColumn("k", tx.md5_key(cfg.seed, "neg", F.col("chebi_id"), F.col("neighbor"), F.col("id"))).cache()
    assert instances.narrowed(keyed.where("chebi_id = 'c'").coalesce(1), 3).count() <= 2 * 2 * 3 * 5
    order = sorted((r.k, r.neighbor, r.id, r.language) for r in keyed.where("chebi_id = 'c'").collect())
    want = as_stated([(n, lang, d) for _, n, d, lang in order], 3)
    got = sorted(instances.hard_negatives(pool, cfg).collect(), key=lambda r: (r.chebi_id, r.rank))
    assert [(r.neighbor, r.language, r.id) for r in got if r.chebi_id == "c"] == want
    assert [(r.rank, r.id) for r in got if r.chebi_id == "e"] == [(1, "d1")]


def test_ids_and_types(spark):
    df = spark.createDataFrame([(" 12 ",), ("CHEBI:5",), ("null",), ("",), (None,), ("x",), ("-3",)], "r string")
    assert [r[0] for r in df.select(tx.normalize_id(F.col("r"))).collect()] == ["CHEBI:12", "CHEBI:5", None, None, None, None, "CHEBI:-3"]
    df = spark.createDataFrame([(["x", "CHEBI:60004", "CHEBI:23888"], None), ([], "C2H6"), (None, "NaCl"), (["x"], "H" * 40 + "2")], "r array<string>, f string")
    assert [r[0] for r in df.select(tx.coarse_type(F.col("r"), F.col("f"))).collect()] == ["salt", "small_molecule", "other", "other"]


def fields(**given):
    return {f: given.get(f, "") for f in tx.TEXT_FIELDS}


def test_positions(spark):
    rows = [{"id": "1", **fields(title="T", abstract="One here. Two.", context="Body.")}, {"id": "2", **fields(description="First. Rest of it.", first_claim="Claim")}, {"id": "3", **fields()}]
    x = variants.with_positions(spark.createDataFrame(rows)).withColumn("text", tx.corpus_text())
    got = {r.id: r for r in x.collect()}
    a, b, c = got["1"].ranges, got["2"].ranges, got["3"].ranges
    cut = lambda r, s: r.text[s.start : s.end]
    assert tuple(a.title) == (0, 1) and cut(got["1"], a.first_sentence) == "One here." and [cut(got["1"], s) for s in a.body] == ["Body."]
    assert b.title is None and cut(got["2"], b.first_sentence) == "First." and [cut(got["2"], s) for s in b.body] == [" Rest of it.", "Claim"]
    assert c.title is None and c.first_sentence is None and c.body == []
    where = x.where("id = '1'").select(*(variants.position_of(F.lit(k), F.col("ranges")) for k in (0, 2, 13, 19))).first()
    assert list(where) == ["title", "first_sentence", None, "body"]


def test_swaps_and_presence(spark):
    df = spark.createDataFrame([("a lead pipe", "Lead"), ("lead lead", "lead"), ("no", "x"), ("a.b", ".")], "t string, s string")
    assert [r[0] for r in df.select(tx.term_presence_offset(F.col("t"), F.col("s"))).collect()] == [2, None, None, 1]
    df = spark.createDataFrame([("or",), ("ore",), ("金",), ("黄金",), (None,), ("  ",)], "s string")
    assert [r[0] for r in df.select(tx.is_usable_swap(F.col("s"))).collect()] == [False, True, False, True, False, False]
    noisy = spark.createDataFrame([(w,) for w in ("cobalt", "α-tocopherol", "Fe(III)", "1,2-dichloroethane", "H₂O", "xyz")], "t string")
    for r in noisy.select("t", variants.noisy(F.col("t"), 42, F.col("t")).alias("n")).collect():
        assert r.n and r.n.lower() != r.t.lower()
    absent = spark.createDataFrame([("x lead y", "lead", 2), ("x tin y", "lead", 2)], "t string, o string, k int")
    assert [r[0] for r in absent.select(tx.source_term_absent(F.col("t"), F.col("o"), F.col("k"))).collect()] == [False, True]
    url = spark.createDataFrame([("https://x.org/wiki/Tin_%28metal%29+C",)], "u string")
    assert url.select(tx.title_from_url(F.col("u"))).first()[0] == "Tin (metal)+C"


def test_structures_take_rows_until_an_inchi_is_known(spark):
    rows = [("1", "F", None, "K1", "s1"), ("1", "F", "I1", None, "s2"), ("1", "F", "I2", "K2", "s3"), ("1", "T", None, "K3", None)]
    raw = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "pos long, compound_id string, default_structure string, standard_inchi string, standard_inchi_key string, smiles string")
    assert tuple(ontology.parse_structures(raw).first()) == ("CHEBI:1", "I1", "K3", "s2")


def test_cache(spark, tmp_path):
    assert tx.cache_key({"a": 1, "b": "é"}) == tx.cache_key({"b": "é", "a": 1}) != tx.cache_key({"a": 2, "b": "é"})
    asked = providers.requests(spark.createDataFrame([("s", "u1"), ("s", "u2"), ("s", "u1")], "system string, user string"), "m")
    sinks.append_jsonl(providers.complete(asked.where("user = 'u1'"), lambda rs: [r["user"].upper() for r in rs], "m"), str(tmp_path / "cache"))
    found = providers.lookup(asked, readers.read_cache(spark, str(tmp_path / "cache")))
    assert sorted((r.user, r.response) for r in found.collect() if r.response) == [("u1", "U1"), ("u1", "U1")]
    reply = spark.createDataFrame([('\n "zinc" \nmore',)], "r string")
    assert reply.select(providers.clean_reply(F.col("r"))).first()[0] == "zinc"


def test_a_provider_is_asked_once_for_each_request(spark, tmp_path):
    cells = [("B_in_set", "lead", "a lead pipe", 2, "fr", "en"), ("D_noisy", "lead", "a lead pipe", 2, "en", "en"), ("B_in_set", None, "none", None, "fr", "en")]
    picked = spark.createDataFrame(cells, "variant string, original_term string, text string, swap_start int, swap_lang string, language string")
    cache = str(tmp_path / "cache")
    reply = lambda asked: [f'"{r["system"].split()[0]} {len(r["user"])}"' for r in asked]
    got = {(r.variant, r.original_term): r.swap_term for r in providers.provide_by_model(picked, reply, cache, "m").collect()}
    assert got == {("B_in_set", "lead"): "Give 31", ("D_noisy", "lead"): "Misspell 31", ("B_in_set", None): None}
    refuse = lambda asked: [1 / 0 for _ in asked]
    assert {r.swap_term for r in providers.provide_by_model(picked, refuse, cache, "m").collect()} == set(got.values())
    noise = providers.RULES["D_noisy"]
    assert all(x in noise for x in ("hyphen", "case", "same language", "{source}"))


def test_a_model_judges_and_translates_back(spark, tmp_path):
    rows = [("1", "B_in_set", "en", "fr", "tin", "étain", "C1"), ("2", "B_in_set", "en", "fr", "lead", "plomb", "C2"), ("3", "D_noisy", "en", "en", "zinc", "zi-nc", None), ("4", "C_out_of_set", "en", "es", "tin", "xx", "C1")]
    filled = spark.createDataFrame([(i, v, lang, to, f"some {a} here", 5, 5 + len(a), a, b, c) for i, v, lang, to, a, b, c in rows], "id string, variant string, language string, swap_lang string, text string, swap_start int, swap_end int, original_term string, swap_term string, chebi_id string")
    aliases = spark.createDataFrame([], "chebi_id string, lang string, pos long, alias string")

    def reply(asked):
        say = lambda r: ("NO" if "plomb" in r["user"] else " yes") if "YES or NO" in r["system"] else "Tin"
        return [say(r) for r in asked]

    model = stages.Model(reply, "m", str(tmp_path / "cache"))
    hooks = model.hooks()
    got = {r.id: (r.reject_reason, r.round_trip_flag) for r in variants.verify(filled, aliases, hooks["judge"], hooks["back"]).collect()}
    assert got == {"1": (None, False), "2": ("semantic_preservation", True), "3": (None, None), "4": ("swap_term_unusable", True)}
    refuse = stages.Model(lambda asked: [1 / 0 for _ in asked], "m", str(tmp_path / "cache")).hooks()
    again = variants.verify(filled, aliases, refuse["judge"], refuse["back"])
    assert {r.id: (r.reject_reason, r.round_trip_flag) for r in again.collect()} == got


def test_titles_are_asked_for_what_is_new(spark, tmp_path):
    ids = lambda *xs: spark.createDataFrame([(f"CHEBI:{x}",) for x in xs], "chebi_id string")
    cache = str(tmp_path / "cache")
    page = lambda n, lang: (n, f"http://x/entity/Q{n}", f"https://{lang}.x/wiki/T_{n}", lang)
    reply = lambda numbers: [page(n, lang) for n in numbers if n != "3" for lang in ("en", "fr")]
    got = crosswalk.crosswalk(ids(1, 2, 3, 3, 1), reply, cache, batch=2)
    assert sorted(map(tuple, got.collect())) == [(f"CHEBI:{n}", f"Q{n}", lang, f"T {n}") for n in (1, 2) for lang in ("en", "fr")]

    def only_four(numbers):
        if numbers != ["4"]:
            raise ValueError(numbers)
        return [page("4", "en")]

    got = crosswalk.crosswalk(ids(1, 3, 4), only_four, cache)
    assert sorted(map(tuple, got.collect())) == [("CHEBI:1", "Q1", "en", "T 1"), ("CHEBI:1", "Q1", "fr", "T 1"), ("CHEBI:4", "Q4", "en", "T 4")]

    def away(numbers):
        raise TimeoutError

    assert crosswalk.crosswalk(ids(5), away, cache, pause=lambda s: None).collect() == []
    assert [r.title for r in crosswalk.crosswalk(ids(5), reply, cache).where("lang = 'en'").collect()] == ["T 5"]  # a failed batch is asked again
    assert crosswalk.crosswalk(ids(), away, str(tmp_path / "none")).collect() == []


def test_a_lookup_is_tried_again_after_waits():
    waits, left = [], [crosswalk.Busy(9), OSError(), crosswalk.Busy(), "found"]

    def lookup(numbers):
        x = left.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    assert crosswalk.patiently(lambda: lookup(["1"]), 7, waits.append) == "found" and waits == [9, 8, 16]
    left[:], waits[:] = [OSError()] * 7, []
    assert crosswalk.patiently(lambda: lookup(["1"]), 7, waits.append) is None and waits == [4, 8, 16, 32, 60, 60]


def test_fetched_files_are_kept_with_their_dates(tmp_path):
    import io

    class Reply(io.BytesIO):
        headers = {"Last-Modified": "Mon"}

    asked = []

    def opener(url, timeout):
        asked.append(url)
        if url.endswith("bad"):
            raise OSError
        return Reply(url.encode())

    folder = tmp_path / "raw"
    assert fetch({"a": "x/a"}, str(folder), opener=opener) == {"a": "Mon"}
    assert fetch({"a": "x/a", "b": "x/b"}, str(folder), opener=opener) == {"a": "Mon", "b": "Mon"}
    assert asked == ["x/a", "x/b"] and (folder / "b").read_bytes() == b"x/b"
    with pytest.raises(OSError):
        fetch({"c": "x/bad"}, str(folder), opener=opener)
    assert sorted(x.name for x in folder.iterdir()) == ["a", "b", "release.json"]
    fetch({"a": "x/a"}, str(folder), refresh=True, opener=opener)
    assert asked[-1] == "x/a"


def gz_tsv(path, header, rows):
    import gzip

    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join("\t".join(map(str, r)) for r in [header.split(), *rows]) + "\n")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    raw = base / "raw"
    raw.mkdir()
    (raw / "chebi.obo").write_text("format-version: 1.2\n\n[Term]\nid: CHEBI:1\nname: tin\nis_a: CHEBI:9\n\n[Term]\nid: CHEBI:2\nname: zinc\nis_a: CHEBI:9\n\n[Term]\nid: CHEBI:9\nname: metal\n\n[Typedef]\nid: part\n")
    gz_tsv(raw / "compounds.tsv.gz", "id chebi_accession name stars parent_id", [(1, "CHEBI:1", "tin", 3, ""), (2, "CHEBI:2", "zinc", 3, "")])
    names = [(1, "tin", "en"), (1, "étain", "fr"), (1, "Zinn", "de"), (2, "zinc", "en"), (2, "zinc", "fr"), (2, "Zink", "de"), (2, "cinc", "es")]
    gz_tsv(raw / "names.tsv.gz", "compound_id name language_code", names)
    gz_tsv(raw / "structures.tsv.gz", "compound_id default_structure standard_inchi standard_inchi_key smiles", [(1, "T", "I", "AAAAAAAAAAAAAA-B", "[Sn]")])
    gz_tsv(raw / "chemical_data.tsv.gz", "compound_id formula", [(1, "Sn"), (2, "Zn")])
    gz_tsv(raw / "relation.tsv.gz", "relation_type_id init_id final_id status_id", [(1, 1, 23888, 1), (1, 2, 23888, 1)])
    gz_tsv(raw / "relation_type.tsv.gz", "id code", [(1, "has_role")])
    word = {"en": ("tin", "zinc"), "fr": ("étain", "zinc"), "de": ("Zinn", "Zink")}
    lines = ["id,language,title,abstract,description,first_claim,context,publication_number"]
    for k in range(6):
        for lang, (a, b) in word.items():
            term = a if k % 2 else b
            lines.append(f'P{k}_{lang},{lang},Title {term},"First, ""quoted"" {term}.\nSecond.",{"word " * 210}{term} end,,,P{k}')
    (base / "corpus.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (base / "titles.jsonl").write_text(json.dumps({"chebi_id": "CHEBI:1", "qid": "Q1", "lang": "es", "title": "estaño"}) + "\n", encoding="utf-8")
    paths = stages.Paths(str(base / "corpus.csv"), str(raw), str(base / "out"), str(base / "titles.jsonl"))
    stages.run_all(spark, paths, Config(min_tokens=50))
    return paths


def test_graph_and_links(spark, built):
    concepts = {r.chebi_id: r for r in readers.read_concepts(spark, built.concepts).collect()}
    assert set(concepts) == {"CHEBI:1", "CHEBI:2"}
    assert concepts["CHEBI:1"].siblings_isa == concepts["CHEBI:1"].siblings_role == ["CHEBI:2"]
    assert concepts["CHEBI:1"].aliases_combined.es == ["estaño"] and concepts["CHEBI:1"].wikidata_qid == "Q1"
    linked = readers.read_linked(spark, built.linked).collect()
    assert len(linked) == 18
    for r in linked:
        assert r.mentions and all(r.text[m.start : m.end] == m.surface for m in r.mentions)
        assert all(a.end <= b.start for a, b in zip(r.mentions, r.mentions[1:], strict=False))


def test_graph_with_asked_titles(spark, built, tmp_path):
    paths = stages.Paths(built.corpus, built.raw, str(tmp_path / "out"))
    lookup = lambda numbers: [(n, f"http://x/entity/Q{n}", "https://es.x/wiki/esta%C3%B1o", "es") for n in numbers if n == "1"]
    stages.build_graph(spark, paths, Config(min_tokens=50), lookup)
    cols = ["chebi_id", "wikidata_qid", "aliases_combined", "wikipedia_titles"]
    got, want = (sorted(map(str, readers.read_concepts(spark, p.concepts).select(cols).collect())) for p in (paths, built))
    assert got == want


def test_instances(spark, built):
    found = spark.read.json(built.instances).collect()
    assert len(found) == 2
    for r in found:
        assert r.gold_document.language == r.gold_language
        assert 0 < len(r.hard_negative_documents) <= 10
        for n in r.hard_negative_documents:
            assert n.language != r.gold_language and n.neighbor_chebi_id != r.chebi_id
        assert len({n.id for n in r.hard_negative_documents}) == len(r.hard_negative_documents)


def test_variants(spark, built):
    rows = readers.read_variants(spark, built.variants).collect()
    texts = {r.id: r.text for r in readers.read_linked(spark, built.linked).collect()}
    tags = {r.variant_tag for r in rows}
    assert {"A_clean", "B_in_set", "C_out_of_set", "D_noisy"} <= tags
    per = {}
    for r in rows:
        per[r.source_row_id] = per.get(r.source_row_id, 0) + 1
        if r.variant_tag == "A_clean":
            assert r.text == texts[r.source_row_id]
            continue
        k = r.swap_char_offset
        assert r.text[:k] + r.original_term + r.text[k + len(r.swap_term) :] == texts[r.source_row_id]
        assert (r.swap_lang in r.available_languages) == (r.variant_tag != "C_out_of_set")
    assert max(per.values()) <= 9 and len({r.publication_number for r in rows}) == len(per)


def test_stream(spark, built, tmp_path):
    linked = readers.read_linked(spark, built.linked)
    linked.select("id", "publication_number", "language", "text").write.parquet(str(tmp_path / "in"))
    keys = linking.invert(ontology.aliases_of_slice(readers.read_concepts(spark, built.concepts)))
    q = link_stream.write_linked(link_stream.linked_stream(link_stream.read_documents(spark, str(tmp_path / "in")), keys), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    assert sorted(map(str, readers.read_linked(spark, str(tmp_path / "out")).collect())) == sorted(map(str, linked.collect()))


def test_jsonl_keeps_nulls(spark, tmp_path):
    assert sinks.write_jsonl(spark.createDataFrame([(1, None)], "a int, b string").coalesce(1), str(tmp_path / "x")) == 1
    assert json.loads(spark.read.text(str(tmp_path / "x")).first()[0]) == {"a": 1, "b": None}
