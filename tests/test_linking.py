"""Linking against a plain statement of its rules, where folding changes lengths, and with any dictionary."""

import os
import random
import subprocess
import sys
import unicodedata
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from polylex.functions.text import fold_text
from polylex.operators import key_index, linking


def plain_links(text, lang, rows):
    """The rules one by one: all matches on folded places, the longest from each start, islands, ambiguity."""
    known = {}
    for at, key, concept in rows:
        if at == lang:
            known.setdefault(key, []).append(concept)
    text = unicodedata.normalize("NFC", text)
    folded, place = "", []
    for k, c in enumerate(text):
        f = c if lang == "zh" else c.casefold()
        folded += f
        place += [k] * len(f)
    word = lambda c: c == "_" or unicodedata.category(c)[0] in "LN"
    found = {}
    for a in range(len(folded)):
        for key in known:
            z = a + len(key)
            if folded[a:z] != key:
                continue
            x, y = place[a], place[z - 1] + 1
            if lang != "zh" and ((x and word(text[x - 1])) or (y < len(text) and word(text[y]))):
                continue
            if a not in found or z > found[a][0]:
                found[a] = (z, key)
    chosen, left = [], sorted((a, z, k) for a, (z, k) in found.items())
    while left:
        island, reach = [left.pop(0)], 0
        reach = island[0][1]
        while left and left[0][0] < reach:
            island.append(left.pop(0))
            reach = max(reach, island[-1][1])
        chosen.append(min(island, key=lambda m: (-m[1], m[0])))
    sure = Counter(known[k][0] for *_, k in chosen if len(known[k]) == 1)
    pick = lambda k: sorted(known[k], key=lambda c: (-sure[c] if len(known[k]) > 1 else 0, known[k].index(c)))[0]
    return [(text[place[a] : place[z - 1] + 1], place[a], place[z - 1] + 1, pick(k)) for a, z, k in chosen]


def index_of(aliases):
    return [(lang, fold_text(x, lang), c) for c, lang, x in aliases if x]


def test_the_longer_of_two_keys_that_end_in_one_character():
    rows = index_of([("A", "de", "das"), ("B", "de", "dass"), ("C", "de", "mas"), ("D", "de", "mass")])
    index = key_index.of_rows(rows)
    assert linking.link_text("Er sagt, daß das Maß", "de", index) == [("daß", 9, 12, "B"), ("das", 13, 16, "A"), ("Maß", 17, 20, "D")]
    assert linking.link_text("daß", "de", key_index.of_rows(rows[:1])) == [("daß", 0, 3, "A")]


LETTERS = ["s", "S", "ß", "ss", "ŉ", "n", "ʼ", "ﬁ", "f", "i", "İ", "i̇", " ", "-", "a", "é", "é", "ΐ", "_", "1", "😀"]


@settings(deadline=None, max_examples=400)
@given(st.lists(st.lists(st.sampled_from(LETTERS), min_size=1, max_size=4), min_size=1, max_size=8), st.lists(st.lists(st.sampled_from(LETTERS), max_size=14), min_size=1, max_size=4), st.sampled_from(["de", "en", "zh"]), st.integers(0, 5))
def test_any_folding_links_by_the_rules(keys, texts, lang, salt):
    rows = [(lang, fold_text("".join(k), lang), f"C{n % 4}") for n, k in enumerate(keys)]
    rows = list(dict.fromkeys(rows))
    index = key_index.of_rows(rows, salt)
    docs = ["".join(t) for t in texts]
    want = [plain_links(t, lang, rows) for t in docs]
    assert linking.link_texts(docs, [lang] * len(docs), index) == want


def test_long_keys_and_many_pieces():
    rng = random.Random(3)
    rows = [("en", " ".join(rng.choice("ab") for _ in range(n)), f"C{n}") for n in (1, 2, 3, 40, 62, 63, 64, 70, 100)]
    rows += [("zh", "".join(rng.choice("乙醇") for _ in range(n)), f"Z{n}") for n in (2, 5, 64, 80)]
    index = key_index.of_rows(rows)
    docs = [(lang, key) for lang, key, _ in rows] + [("en", "x " + " ".join(rng.choice("ab") for _ in range(300))), ("zh", "样" + "".join(rng.choice("乙醇") for _ in range(300)))]
    got = linking.link_texts([t for _, t in docs], [x for x, _ in docs], index)
    assert got == [plain_links(t, x, rows) for x, t in docs]
    assert [g[0][3] for g in got[:9]] == [c for _, _, c in rows[:9]]


def test_slices_do_not_matter(monkeypatch):
    rng = random.Random(4)
    rows = index_of([(f"C{k}", "de", w) for k, w in enumerate(["das", "dass", "straße", "auf der straße", "der"])])
    docs = [" ".join(rng.choice(["das", "daß", "Straße", "auf", "der", "STRASSE", "x"]) for _ in range(rng.randint(0, 30))) for _ in range(40)] + [None, ""]
    index = key_index.of_rows(rows)
    want = linking.link_texts(docs, ["de"] * len(docs), index)
    monkeypatch.setattr(linking, "SLICE", 50)
    assert linking.link_texts(docs, ["de"] * len(docs), index) == want == [plain_links(t or "", "de", rows) for t in docs]
    assert linking.link_texts(["das", "das", None], ["de", None, "de"], index) == [[("das", 0, 3, "C0")], [], []]


def test_packed_index_equals_the_one_in_memory(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeß") for _ in range(rng.randint(1, 5))) for _ in range(300)]
    aliases = [(f"C{rng.randint(0, 80)}", rng.choice(["en", "de"]), " ".join(rng.choice(words) for _ in range(rng.randint(1, 3)))) for _ in range(900)]
    rows = list(dict.fromkeys((lang, fold_text(x, lang), c) for c, lang, x in aliases))
    seen = Counter()
    table = []
    for lang, key, c in rows:
        seen[lang, key] += 1
        table.append((lang, key, c, seen[lang, key]))
    df = spark.createDataFrame(table, "lang string, key string, chebi_id string, reg_order int")
    docs = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(30)]
    want = linking.link_texts(docs, ["de"] * 30, key_index.of_rows(rows))
    for size in (1 << 20, 50, 7):
        index = key_index.opened(key_index.publish(df, size))
        assert linking.link_texts(docs, ["de"] * 30, index) == want
        assert (index.hash[1:] > index.hash[:-1]).all()
    assert any(want)


def test_an_empty_dictionary_links_nothing(spark):
    docs = spark.createDataFrame([("1", "en", "a text")], "id string, language string, text string")
    none = spark.createDataFrame([], "lang string, key string, chebi_id string, reg_order int")
    assert [r.mentions for r in linking.link_exact(docs, none).collect()] == [[]]


def test_linking_starts_where_workers_have_no_package(tmp_path):
    """From a folder of its own, with the package on the driver's path only."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
from polylex.operators import linking
docs = spark.createDataFrame([("1", "en", "a lead pipe")], "id string, language string, text string")
names = spark.createDataFrame([("C1", "en", 0, "Lead")], "chebi_id string, lang string, pos long, alias string")
print([tuple(m) for r in linking.link(docs, names).collect() for m in r.mentions])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "[('lead', 2, 6, 'C1')]" in done.stdout, done.stderr[-2000:]


def test_linking_again_for_changed_keys_only(spark):
    """As linking everything anew, and few rows are."""
    rng = random.Random(6)
    words = [f"w{k}" for k in range(60)]
    docs = [(k, str(k), "en", " ".join(rng.choice(words) for _ in range(12))) for k in range(200)]
    d = spark.createDataFrame(docs, "row long, id string, language string, text string")
    base = [("C1", "w1"), ("C2", "w2"), ("C3", "w2"), ("C4", "w3 w4"), ("C5", "w5"), ("C6", "w6 w7")]
    more = [*base, ("C7", "w4"), ("C7", "w8 w9"), ("C8", "w5"), ("C9", "w1 w2")]
    less = [x for x in more if x[1] != "w6 w7"]
    dictionary = lambda rows: linking.invert(spark.createDataFrame([(c, "en", k, x) for k, (c, x) in enumerate(rows)], "chebi_id string, lang string, pos long, alias string"), linking.Config(min_alias_len=2))
    known = linking.mentioned_by_row(linking.link_exact(d, dictionary(base)))
    for new in (more, less, base):
        got = {r.row: (sorted(r.ids), r.fresh) for r in linking.mentioned_again(d, known, dictionary(base), dictionary(new)).collect()}
        want = {r.row: sorted(r.ids) for r in linking.mentioned_by_row(linking.link_exact(d, dictionary(new))).collect()}
        assert {k: v for k, (v, _) in got.items() if v} == want
        assert sum(f for _, f in got.values()) < 150 and (new != base or not any(f for _, f in got.values()))
    assert {r.key for r in linking.changed_keys(dictionary(base), dictionary(less)).collect()} == {"w4", "w8 w9", "w5", "w1 w2", "w6 w7"}


def test_keys_of_whole_characters_as_joins_link_them(spark):
    """A key that starts or ends within what one character folds to is found by the reference's rules only."""
    rows = index_of([("A", "de", "sschach"), ("B", "de", "das"), ("C", "de", "ssein"), ("D", "de", "straße")])
    docs = ["ßschach", "daß das", "x ßein ssein", "Straße, STRASSE sschach"]
    index = key_index.of_rows(rows)
    got = linking.link_texts(docs, ["de"] * 4, index, whole=True)
    assert got == [[], [("das", 4, 7, "B")], [("ßein", 2, 6, "C"), ("ssein", 7, 12, "C")], [("Straße", 0, 6, "D"), ("STRASSE", 8, 15, "D"), ("sschach", 16, 23, "A")]]
    assert linking.link_texts(docs[:2], ["de"] * 2, index) == [[("ßschach", 0, 7, "A")], [("daß", 0, 3, "B"), ("das", 4, 7, "B")]]
    table = spark.createDataFrame([(str(k), "p", "de", t) for k, t in enumerate(docs)], "id string, publication_number string, language string, text string")
    dictionary = spark.createDataFrame([(lang, key, c, 1) for lang, key, c in rows], "lang string, key string, chebi_id string, reg_order int")
    exact = linking.flat(linking.link_exact(table, dictionary, linking.Config(whole_characters=True))).select("id", "surface", "start", "end", "chebi_id")
    assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, linking.link_native(table, dictionary).collect())) == sorted((str(k), *m) for k, x in enumerate(got) for m in x)
