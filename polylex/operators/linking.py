"""Entity linking: all dictionary keys in every text, one mention where matches overlap.

``link_exact`` looks the spans of a text up in an index of all keys (``key_index``), many at a
time, and settles everything within a document, so it reads a text once and has no shuffle,
whatever the size of the dictionary. ``link_native`` is linking by DataFrame operations alone,
for languages with word boundaries and keys that end between a text's characters.

Where folding makes a text longer, all is decided on folded places, and only the mention that
stays is taken back to the text: of the keys "das" and "dass", "dass" is the longer in "daß".
With ``Config.whole_characters`` a key starts and ends between a text's characters, as in
``link_native``: then "das" is not found in "daß" at all.
Of a chain of overlapping matches (the longest from each start), the one that ends furthest
stays, the earliest among those. A key of several concepts goes to the one with the most
mentions in the document by keys of its own alone, the first registered among those.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold, fold_each, min_len
from ..schema import MENTION, Config
from ..shipping import ship
from . import key_index
from .key_index import Index, SpanHashes, characters, code_points, in_words, language_seed, piece_ends
from .ontology import _sql

#: Pieces of a text that link_native looks at together.
STRETCH = 64
_PIECES = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]"


def invert(aliases: DataFrame, cfg: Config = Config(), fold_with=None) -> DataFrame:
    """(lang, key, chebi_id, reg_order): the dictionary; short aliases go."""
    key = fold("alias", "lang") if fold_with is None else fold_with
    least = min_len(F.col("lang"), cfg)
    x = aliases.withColumn("key", key).where((F.length("alias") >= least) & (F.length("key") >= least))
    x = x.groupBy("lang", "key", "chebi_id").agg(F.min("pos").alias("pos"))
    order = F.row_number().over(Window.partitionBy("lang", "key").orderBy("chebi_id", "pos"))
    return x.select("lang", "key", "chebi_id", order.alias("reg_order"))


@dataclass
class Folded:
    """Some documents' folded texts, one after the other."""

    plain: list[str]  # composed, not folded
    text: str
    points: np.ndarray
    first: np.ndarray  # where each document begins, and the end
    places: dict[int, np.ndarray]  # of documents that folding makes longer: each folded character's place
    starts: np.ndarray  # whether a key may start at a character
    ends: np.ndarray  # whether a key may end after it
    pieces: np.ndarray  # whether a piece ends after it


def fold_texts(texts: list[str], langs: list[str], whole: bool = False) -> Folded:
    plain = [unicodedata.normalize("NFC", t) for t in texts]
    folded = [p if x == "zh" else p.casefold() for p, x in zip(plain, langs, strict=True)]
    text = "".join(folded)
    points, first = code_points(text), np.concatenate([[0], np.cumsum([len(f) for f in folded])]).astype(np.int64)
    zh = np.repeat(np.array([x == "zh" for x in langs], bool), np.diff(first))
    pieces = piece_ends(points, first, zh)
    ends, starts = pieces.copy(), np.ones(len(points), bool)
    starts[1:] = ~in_words(points[:-1])
    starts[first[:-1][first[:-1] < len(points)]] = True
    starts |= zh
    places = {}
    for d, (p, f) in enumerate(zip(plain, folded, strict=True)):
        if len(p) == len(f):
            continue
        own = code_points(p)
        size = characters()[1][np.minimum(own, key_index.PLANES)]
        at, word = np.repeat(np.arange(len(own)), size), in_words(own)
        here = slice(first[d], first[d + 1])
        starts[here] = (at == 0) | ~word[at - 1]
        ends[here] = (at + 1 == len(own)) | ~word[np.minimum(at + 1, len(own) - 1)]
        if whole:
            new = np.append(True, at[1:] != at[:-1])
            starts[here] &= new
            ends[here] &= np.append(new[1:], True)
        places[d] = at
    return Folded(plain, text, points, first, places, starts, ends, pieces)


def _spans(x: Folded, langs: list[str], index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, key) of every key that may start and end where it does, by its hash."""
    h = SpanHashes(x.points)
    seed = np.repeat(np.array([language_seed(lang, index.salt) for lang in langs], key_index.U), np.diff(x.first))
    ends, s = np.flatnonzero(x.pieces) + 1, np.flatnonzero(x.starts)
    doc_end = np.repeat(x.first[1:], np.diff(x.first))
    k, last = np.searchsorted(ends, s, "right"), np.searchsorted(ends, doc_end[s])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def look(start: np.ndarray, end: np.ndarray) -> None:
        ok = x.ends[end - 1]
        start, end = start[ok], end[ok]
        some, key = index.find(h.of(start, end, seed[start]))
        found.append((start[some], end[some], key))

    look(s, ends[k])  # one piece
    more = np.flatnonzero(k < last)
    at, head = index.find_head(h.of(s[more], ends[k[more] + 1], ~seed[s[more]]))
    at = more[at]
    mask, most = index.mask[head], index.most[head]
    for n in range(2, int(most.max()) + 1 if len(most) else 0):
        some = at[((mask >> min(n, key_index.MANY)) & 1 == 1) & (most >= n) & (k[at] + n - 1 <= last[at])]
        look(s[some], ends[k[some] + n - 1])
    for e in (np.flatnonzero(x.ends & ~x.pieces) + 1).tolist():  # within a character that folding made longer
        a, z = np.searchsorted(k, np.searchsorted(ends, e) - index.most_pieces + 1), np.searchsorted(s, e)
        own = s[a:z]
        own = own[doc_end[own] >= e]
        look(own, np.full(len(own), e))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


@dataclass
class Matches:
    """The longest key from each start, in order: folded places within all texts, and the key."""

    start: np.ndarray
    end: np.ndarray
    key: np.ndarray


def scan(x: Folded, langs: list[str], index: Index) -> Matches:
    start, end, key = _spans(x, langs, index)
    same = [x.text[a:z] == index.entry(k)[0] for a, z, k in zip(start.tolist(), end.tolist(), key.tolist(), strict=True)]
    start, end, key = (c[np.array(same, bool)] for c in (start, end, key))
    order = np.lexsort((end, start))
    start, end, key = start[order], end[order], key[order]
    longest = np.append(start[1:] != start[:-1], True)[: len(start)]
    return Matches(start[longest], end[longest], key[longest])


def settle(m: Matches) -> Matches:
    """What stays of matches: of each island of overlapping ones the one that ends furthest, the earliest among those."""
    n = len(m.start)
    if not n:
        return m
    new = np.append(True, m.start[1:] >= np.maximum.accumulate(m.end)[:-1])
    order = np.lexsort((m.start, -m.end, np.cumsum(new)))
    best = order[np.flatnonzero(new)]
    return Matches(m.start[best], m.end[best], m.key[best])


Mention = tuple[str, int, int, str]
#: Characters of text worked on at a time; a longer text is worked on alone.
SLICE = 1 << 18


def link_texts(texts: list[str | None], langs: list[str | None], index: Index, whole: bool = False) -> list[list[Mention]]:
    """(surface, start, end, concept) in order, for each text; a null text or language has none."""
    out: list[list[Mention]] = [[] for _ in texts]
    rows = [k for k, (t, x) in enumerate(zip(texts, langs, strict=True)) if t and x]
    while rows:
        size = np.cumsum([len(texts[k]) for k in rows])
        n = max(1, int(np.searchsorted(size, SLICE, "right")))
        some, rows = rows[:n], rows[n:]
        own = [langs[k] for k in some]
        x = fold_texts([texts[k] for k in some], own, whole)
        kept = settle(scan(x, own, index))
        doc = np.searchsorted(x.first, kept.start, "right") - 1
        edge = np.searchsorted(doc, np.arange(n + 1))
        a, z = kept.start - x.first[doc], kept.end - x.first[doc]
        for d in range(n):
            if edge[d] < edge[d + 1]:
                part = slice(edge[d], edge[d + 1])
                out[some[d]] = _mentions(x.plain[d], x.places.get(d), a[part], z[part], [index.entry(k)[1] for k in kept.key[part].tolist()])
    return out


def _mentions(plain: str, place: np.ndarray | None, start: np.ndarray, end: np.ndarray, who: list[tuple[str, ...]]) -> list[Mention]:
    """Back to the text's own places, each mention with one concept."""
    if place is not None:
        start, end = place[start], place[end - 1] + 1
    if any(len(w) > 1 for w in who):
        sure = Counter(w[0] for w in who if len(w) == 1)
        one = [w[0] if len(w) == 1 else max(w, key=lambda c: sure[c]) for w in who]
    else:
        one = [w[0] for w in who]
    return [(plain[a:z], a, z, c) for a, z, c in zip(start.tolist(), end.tolist(), one, strict=True)]


def link_text(text: str | None, lang: str | None, index: Index) -> list[Mention]:
    """(surface, start, end, concept) of one text, in order."""
    return link_texts([text], [lang], index)[0]


def _mention_lists(found: list[list[Mention]]) -> pa.ListArray:
    flat = [m for f in found for m in f]
    s, a, z, c = zip(*flat, strict=True) if flat else ((), (), (), ())
    rows = pa.StructArray.from_arrays([pa.array(s, pa.string()), pa.array(a, pa.int32()), pa.array(z, pa.int32()), pa.array(c, pa.string())], names=["surface", "start", "end", "chebi_id"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), rows)


def _with_mentions(docs: DataFrame) -> T.StructType:
    return T.StructType([*docs.schema.fields, T.StructField("mentions", T._parse_datatype_string(f"array<{MENTION}>"))])


def link_exact(docs: DataFrame, dictionary: DataFrame, cfg: Config = Config()) -> DataFrame:
    """docs with mentions (an empty list where there are none)."""
    ship(docs.sparkSession)
    return link_by_index(docs, key_index.publish(dictionary, cfg.keys_in_part), cfg.whole_characters)


def link_by_index(docs: DataFrame, index: str, whole: bool = False) -> DataFrame:
    """As link_exact, by an index that is published already."""
    ship(docs.sparkSession)
    schema, names = _with_mentions(docs), docs.columns
    text, lang = names.index("text"), names.index("language")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = key_index.opened(index)
        for b in batches:
            found = link_texts(b.column(text).to_pylist(), b.column(lang).to_pylist(), held, whole)
            yield pa.RecordBatch.from_arrays([*b.columns, _mention_lists(found)], names=schema.names)

    return docs.mapInArrow(run, schema)


def mark_with_a_key(docs: DataFrame, dictionary: DataFrame, cfg: Config = Config()) -> DataFrame:
    """docs with touched: whether some key of the dictionary is found in the text, whatever else overlaps it."""
    ship(docs.sparkSession)
    index, whole = key_index.publish(dictionary, cfg.keys_in_part), cfg.whole_characters
    text, lang = docs.columns.index("text"), docs.columns.index("language")
    schema = T.StructType([*docs.schema.fields, T.StructField("touched", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = key_index.opened(index)
        for b in batches:
            found = link_texts(b.column(text).to_pylist(), b.column(lang).to_pylist(), held, whole)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([bool(f) for f in found], pa.bool_())], names=schema.names)

    return docs.mapInArrow(run, schema)


def with_a_key(docs: DataFrame, dictionary: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Those of docs in whose text some key of the dictionary is found, whatever else overlaps it."""
    ship(docs.sparkSession)
    index, whole = key_index.publish(dictionary, cfg.keys_in_part), cfg.whole_characters
    text, lang = docs.columns.index("text"), docs.columns.index("language")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = key_index.opened(index)
        for b in batches:
            found = link_texts(b.column(text).to_pylist(), b.column(lang).to_pylist(), held, whole)
            yield b.filter(pa.array([bool(f) for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def link_native(docs: DataFrame, dictionary: DataFrame, fold_with: Callable[[F.Column], F.Column] | None = None) -> DataFrame:
    """(id, surface, start, end, chebi_id) by joins and windows, in languages with word boundaries, of keys that end between characters.

    A text's pieces stay together, in stretches: a stretch's distinct pieces are exchanged to learn
    which of them begin keys, and of how many pieces; only spans that begin so are rows of their own.
    """
    who = F.transform(F.sort_array(F.collect_list(F.struct("reg_order", "chebi_id"))), lambda s: s["chebi_id"])
    keys = dictionary.groupBy(F.col("lang").alias("language"), "key").agg(who.alias("who")).withColumn("pieces", F.regexp_extract_all("key", F.lit(_PIECES), 0))
    keys = keys.select("language", "key", F.size("pieces").alias("np"), "who", F.get("pieces", F.lit(0)).alias("w"))
    most = keys.agg(F.coalesce(F.max("np"), F.lit(1))).first()[0]
    folded = lambda x: x.withColumn("w", fold_each("p", "language") if fold_with is None else F.transform("p", fold_with))
    x, pieces = _stretches(docs, most), F.regexp_extract_all("text", F.lit(_PIECES), 0)  # cut between pieces, so the same ones
    own = folded(x.select("id", "k", "language", F.array_distinct(pieces).alias("p"))).select("id", "k", "language", F.explode(F.array_distinct("w")).alias("w"))
    begun = own.join(keys.groupBy("language", "w").agg(F.collect_set("np").alias("nps")), ["language", "w"])
    begun = begun.groupBy("id", "k").agg(F.map_from_entries(F.collect_list(F.struct("w", "nps"))).alias("begun"))
    hits = folded(x.join(begun, ["id", "k"]).withColumn("p", pieces)).select("id", "language", F.explode(_begun_spans(max(STRETCH, most))).alias("s")).select("id", "language", "s.*")
    return _settle(hits.join(keys.drop("w"), ["language", "key", "np"]).select("id", "start", "end", "surface", "who"))


def _stretches(docs: DataFrame, most: int) -> DataFrame:
    """(id, language, k, lead, text, shift): STRETCH pieces of each text at a time, lead of the one before, and most of those after; shift: characters before them."""
    piece = r"(?:[\p{L}\p{N}_]++|[^\p{L}\p{N}_])"
    parts = F.regexp_extract_all("text", F.lit(f"{piece}{{1,{max(STRETCH, most)}}}+"), F.lit(0))
    x = docs.select("id", "language", F.posexplode(F.transform(F.array(parts), lambda p: F.transform(p, lambda t, k: F.struct(F.when(k > 0, F.get(p, k - 1)).alias("before"), t.alias("text"), F.get(p, k + 1).alias("after"))))[0]).alias("k", "part"))
    t = F.col("part.text")
    shift = (F.sum(F.length(t)).over(Window.partitionBy("id").orderBy("k")) - F.length(t)).cast("int")
    near = lambda c, pattern: F.coalesce(F.regexp_extract(c, pattern, 0), F.lit(""))
    text = F.concat(near("part.before", f"{piece}\\z"), t, near("part.after", f"^{piece}{{1,{most}}}+"))
    return x.select("id", "language", "k", F.when(F.col("k") > 0, 1).otherwise(0).alias("lead"), text.alias("text"), shift.alias("shift"))


def _begun_spans(stretch: int) -> F.Column:
    """(key, np, surface, start, end) of a stretch's spans that begin as keys of so many pieces do and may start and end there."""
    word, no_word = r"^[\p{L}\p{N}_]", lambda c: c.isNull() | ~c.rlike(r"^[\p{L}\p{N}_]")
    joined = lambda c, a, n: F.array_join(F.slice(c, a + 1, n), "")

    def span(i: F.Column, n: F.Column) -> F.Column:
        surface, start = joined("p", i, n), F.col("shift") + F.length(joined("p", F.col("lead"), i - F.col("lead")))
        return F.struct(joined("w", i, n).alias("key"), n.alias("np"), surface.alias("surface"), start.alias("start"), (start + F.length(surface)).alias("end"))

    def spans(i: F.Column) -> F.Column:
        first, before = F.get("w", i), F.when(i > 0, F.get("w", i - 1))
        ends = lambda n: (i + n <= F.size("w")) & (F.get("w", i + n - 1).rlike(r"[\p{L}\p{N}_]$") | no_word(F.get("w", i + n)))
        sizes = F.when(first.rlike(word) | no_word(before), F.filter(F.try_element_at("begun", first), ends))
        return F.transform(sizes, lambda n: span(i, n))

    own = F.sequence(F.col("lead"), F.least(F.size("w"), F.col("lead") + stretch) - 1)
    return F.flatten(F.transform(F.filter(own, lambda i: F.try_element_at("begun", F.get("w", i)).isNotNull()), lambda i: F.coalesce(spans(i), F.array())))


def _settle(hits: DataFrame) -> DataFrame:
    """Longest from each start, islands, ambiguity; hits (id, start, end, surface, who) are exchanged once, by text."""
    return _sql(
        """
        WITH far AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, start ORDER BY end DESC) AS n FROM {hits}) WHERE n = 1),
        gap AS (SELECT *, max(end) OVER (PARTITION BY id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM far),
        isle AS (SELECT *, sum(CASE WHEN reach IS NULL OR start >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY start) AS k FROM gap),
        won AS (SELECT id, start, end, surface, who FROM (SELECT *, row_number() OVER (PARTITION BY id, k ORDER BY end DESC, start) AS m FROM isle) WHERE m = 1),
        cand AS (SELECT id, start, end, surface, size(who) AS c, posexplode(who) AS (reg_order, chebi_id) FROM won),
        sure AS (SELECT *, count_if(c = 1) OVER (PARTITION BY id, chebi_id) AS n FROM cand),
        best AS (SELECT *, row_number() OVER (PARTITION BY id, start ORDER BY n DESC, reg_order) AS r FROM sure)
        SELECT id, surface, start, end, chebi_id FROM best WHERE r = 1
        """,
        hits=hits.repartition("id"),
    )


def link(docs: DataFrame, aliases: DataFrame, cfg: Config = Config()) -> DataFrame:
    """docs with mentions, by the aliases (chebi_id, lang, pos, alias)."""
    return link_exact(docs, invert(aliases, cfg), cfg)


def changed_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """(lang, key, chebi_id, reg_order) of the keys of two dictionaries that one lacks or that name other concepts, or in another order."""
    lists = lambda d, name: d.groupBy("lang", "key").agg(F.sort_array(F.collect_list(F.struct("reg_order", "chebi_id"))).alias(name))
    both = lists(old, "a").join(lists(new, "b"), ["lang", "key"], "full").where(~F.col("a").eqNullSafe(F.col("b")))
    return both.select("lang", "key", F.coalesce("b", "a")[0]["chebi_id"].alias("chebi_id"), F.lit(1).alias("reg_order"))


def mentioned_by_row(linked: DataFrame) -> DataFrame:
    """(row, ids): the distinct concepts of each row that has some."""
    return linked.where(F.size("mentions") > 0).select("row", F.array_distinct("mentions.chebi_id").alias("ids"))


def mentioned_again(docs: DataFrame, known: DataFrame, old: DataFrame, new: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(row, ids, fresh): mentioned_by_row under the dictionary new, of docs (row, ...), from what is known under old.

    Only a row with some match of a key that has changed can have other mentions than before, so
    the texts are looked through for those keys alone, and linked anew where one is found; both
    happen while a text is read once. fresh tells which rows were. A row linked anew and left
    without mentions is there with no ids.
    """
    touched = with_a_key(docs, changed_keys(old, new), cfg)
    fresh = link_exact(touched, new, cfg).select("row", F.array_distinct("mentions.chebi_id").alias("ids"), F.lit(True).alias("fresh"))
    kept = known.select("row", F.col("ids").alias("had")).join(fresh, "row", "full")
    return kept.select("row", F.coalesce("ids", "had").alias("ids"), F.coalesce("fresh", F.lit(False)).alias("fresh"))


def primary_concept(mentions: str = "mentions"):
    """The most frequent concept of a document, the first to appear among those; null without mentions. One walk over the sorted mentions."""
    pairs = F.array_sort(F.transform(F.col(mentions), lambda m, i: F.struct(m["chebi_id"].alias("c"), i.alias("i"))))
    none = F.lit(None).cast("string")
    state = lambda c, n, p, best_n, best_p, best: F.struct(c.alias("c"), n.cast("int").alias("n"), p.cast("int").alias("p"), best_n.cast("int").alias("best_n"), best_p.cast("int").alias("best_p"), best.alias("best"))

    def step(s: F.Column, x: F.Column) -> F.Column:
        same = s["c"].eqNullSafe(x["c"])
        n, p = F.when(same, s["n"] + 1).otherwise(1), F.when(same, s["p"]).otherwise(x["i"])
        more = (n > s["best_n"]) | ((n == s["best_n"]) & (p < s["best_p"]))
        return state(x["c"], n, p, F.when(more, n).otherwise(s["best_n"]), F.when(more, p).otherwise(s["best_p"]), F.when(more, x["c"]).otherwise(s["best"]))

    zero = F.lit(0)
    return F.aggregate(pairs, state(none, zero, zero, zero, zero, none), step, lambda s: s["best"])


def linked_documents(linked: DataFrame) -> DataFrame:
    """The artifact's columns, a row for each document."""
    return linked.select("id", "publication_number", "language", "text", "mentions", primary_concept().alias("primary_chebi_id"))


def flat(linked: DataFrame) -> DataFrame:
    """A row for each mention."""
    return linked.select("id", "publication_number", "language", F.posexplode("mentions").alias("n", "m")).select("id", "publication_number", "language", "n", "m.*")


def mentioned_ids(linked: DataFrame) -> DataFrame:
    return linked.select(F.explode("mentions.chebi_id").alias("chebi_id")).distinct()


def link_counts(linked: DataFrame) -> DataFrame:
    return linked.agg(F.count("*").alias("documents"), F.count_if(F.size("mentions") > 0).alias("with_mentions"), F.sum(F.size("mentions")).cast("long").alias("mentions"))
