"""Near-duplicate texts, each link verified by exact Jaccard similarity; what meets comes by parts of shingles, which miss no link, or by SimHash.

Texts link when the sets of their five-word shingles (words as in op5_simhash_dedup, A-Z in
lower case, shingles by 64-bit hash) have a Jaccard similarity of SIMILARITY or more.

* Texts of equal words are one node, by a digest of 64 bits; a second one keeps apart what only
  the first has alike: such a text, if there is one among very many, is left in a class of its own.
* Sets of n and m shingles at the similarity differ in at most (n + m) (1 - s) / (1 + s)
  shingles. The hashes are cut into more parts than that by their value, so two such sets have
  equal shingles in some part: a row for each part, by the digest of its shingles, brings
  them together. Sizes go in classes, as the number of parts must be the same on both sides; a
  set is also in those classes above in which it can be the smaller one.
* A part without shingles would bring together what has nothing in common. A set with few such
  parts needs none of them, as more parts than these are equal; one with many is cut again in
  another way, up to WAYS times, and gives rows for its empty parts at the last. Of a pair,
  either both sets get to a way or one of them needed no other.
* What meets is linked to the least of the batch and then of all, never in pairs. In each
  component of these links, pairs that the sizes and the parities of shingles by hash values
  allow (both bounds are exact) are linked; their components are families: what may be
  alike. A large component is cut into cells of sizes and parities, not of texts.
* Only members of families are read again, for their shingles. In a family, pairs within the
  bounds are compared, except where verified links connect the two already, so a group of
  thousands of copies costs few comparisons. A large family is cut into cells.
* With by_fingerprints, the pipeline's way, the first steps are SimHash's instead: texts whose
  fingerprints link at op5's radius, directly or over others, come together, and the bounds and
  the check on the shingle sets follow. No link of fingerprints is lost, and only texts of the
  similarity stay linked; similar texts that no chain of fingerprints joins are not compared.

Defined cases: null and empty texts are alike; a text below five words is one shingle; a null
id belongs to no class. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import cells, components, deal, edges_of, hot_limit, spread_join
from .kernels import U64, Words, mix, signed, slices, text_buffer
from .op5_simhash_dedup import _LOWER, majority, near_links, shingle_hashes, single_spaced
from .op5_simhash_dedup import SHINGLE as PRINTED
from .scratch import Scratch

SHINGLE = 5
SIMILARITY = 0.8
#: How often a set with too many empty parts is cut again.
WAYS = 8
CELL = 8192
#: Bytes of texts whose families are compared together.
ROOM = 1 << 22
#: Shingles compared with one set at a time.
CHUNK = 1 << 20
FAMILY = 2048


def size_classes(top: int) -> np.ndarray:
    """Least sizes of the classes, up to one above top.

    Wider classes leave more sets of their lower end with many empty parts."""
    out = [1]
    while out[-1] <= top:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4))
    return np.array(out)


def differing(total: np.ndarray, similarity: float) -> np.ndarray:
    """In how many shingles sets of so many together can differ at the similarity."""
    return np.floor(total * (1 - similarity) / (1 + similarity) + 1e-6).astype(np.int64)


def _digests(w: Words, which: int = 0) -> np.ndarray:
    """64 bits of each document's words, the first or the second."""
    flat, pos = single_spaced(w)
    a, z = pos[w.first[:-1]].tolist(), pos[w.first[1:]].tolist()
    raw = b"".join([hashlib.blake2b(flat[x : max(x, y - 1)], digest_size=16).digest() for x, y in zip(a, z, strict=True)])
    return np.frombuffer(raw, "<i8").reshape(-1, 2)[:, which]


def tag(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with __node and __check, the digests of the row's words: equal for texts of equal words."""
    schema = T.StructType([*docs.schema.fields, T.StructField("__node", T.LongType()), T.StructField("__check", T.LongType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffer(b.column(at))
            parts = [Words(_LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i]) for i, j in slices(off)]
            both = [np.concatenate([_digests(w, k) for w in parts]) if parts else np.zeros(0, np.int64) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x, pa.int64()) for x in both)], names=schema.names)

    return docs.mapInArrow(run, schema)


def _shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted in each document, and their documents."""
    h, doc = shingle_hashes(w, SHINGLE)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[new], doc[new]


def part_keys(h: np.ndarray, doc: np.ndarray, docs: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(key, document): two sets at the similarity have a key in common."""
    size = np.bincount(doc, minlength=docs)
    low = size_classes(int(size.max(initial=1)) * 4)
    own = np.searchsorted(low, size, "right") - 1
    keys, of = [], []
    first = np.concatenate([[0], np.cumsum(size)])
    for up in range(len(low) - 1):
        level = np.minimum(own + up, len(low) - 2)
        who = np.flatnonzero((size > 0) & (own + up < len(low) - 1) & ((size >= similarity * low[level] - 1e-6) | (up == 0)))
        if not len(who):
            break
        most = differing(2 * (low[level + 1] - 1), similarity)
        for way in range(WAYS):
            n, d = size[who], most[who]
            parts = d + 1 + -(-d // 10)
            base = np.concatenate([[0], np.cumsum(parts)])
            at = np.repeat(first[who] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
            where = np.repeat(base[:-1], n) + (mix(h[at] + U64((2 * way + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.repeat(parts, n).astype(U64)).astype(np.int64)
            have = np.bincount(where, minlength=base[-1])
            digest = np.zeros(base[-1], U64)
            np.add.at(digest, where, mix(h[at] ^ U64(0xD6E8FEB86659FD93)))
            whose = np.repeat(np.arange(len(who)), parts)
            part = np.arange(base[-1]) - base[whose]
            short = np.bincount(whose[have == 0], minlength=len(who)) > parts - d - 1  # it may share empty parts only
            use = have > 0
            if way == WAYS - 1:
                use |= short[whose]
            place = mix(mix(part.astype(U64) + U64(1)) + ((own + up)[who[whose]] * WAYS + way).astype(U64))
            keys.append(mix(digest + place)[use])
            of.append(who[whose[use]])
            who = who[short]
            if not len(who):
                break
    return (np.concatenate(keys), np.concatenate(of)) if keys else (np.zeros(0, U64), np.zeros(0, np.int64))


def _levels(size: np.ndarray) -> np.ndarray:
    """Logarithm of the bits of a set's parities: 64 at least, and two for each hash."""
    return np.maximum(6, np.ceil(np.log2(np.maximum(1, 2 * size))).astype(np.int64))


def parities(h: np.ndarray, doc: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Each document's hashes counted by value, only the parities: sets differ in as many hashes as in bits, or more."""
    wide = 1 << _levels(size)
    first = np.concatenate([[0], np.cumsum(wide)])
    flips = np.zeros(first[-1], np.uint8)
    np.add.at(flips, first[doc] + (mix(h ^ U64(0xA0761D6478BD642F)) & (wide[doc] - 1).astype(U64)).astype(np.int64), 1)
    raw, cut = np.packbits(flips & 1, bitorder="little").tobytes(), (first // 8).tolist()
    return [raw[a:z] for a, z in zip(cut[:-1], cut[1:], strict=True)]


class Bounds:
    """Which pairs sizes and parities let be similar; of parities of two widths the wider are folded."""

    def __init__(self, size: np.ndarray, parity: list[bytes], similarity: float):
        self.size, self.similarity, self.level = size, similarity, _levels(size)
        self.place, self.at = np.zeros(len(size), np.int64), {}
        for k in np.unique(self.level).tolist():
            who = np.flatnonzero(self.level == k)
            self.place[who] = np.arange(len(who))
            bits = np.frombuffer(b"".join([parity[x] for x in who.tolist()]), "<u8").reshape(len(who), -1)
            self.at[k, k] = bits
            if k > 6:
                self.at[k, k - 1] = bits[:, : bits.shape[1] // 2] ^ bits[:, bits.shape[1] // 2 :]

    def allowed(self, x: int, other: np.ndarray) -> np.ndarray:
        size, k = self.size, int(self.level[x])
        other = other[np.minimum(size[other], size[x]) >= self.similarity * np.maximum(size[other], size[x]) - 1e-6]
        out = [other[:0]]
        for j in range(6, 64) if self.similarity <= 0.5 else (k - 1, k, k + 1):
            some = other[self.level[other] == j]
            if len(some) and abs(j - k) < 2:
                narrow = min(j, k)
                most = differing(size[some] + size[x], self.similarity)
                mine, bits = self.at[k, narrow][self.place[x]], self.at[j, narrow]
                for words in {min(4, len(mine)), len(mine)}:
                    ok = np.bitwise_count(bits[self.place[some], :words] ^ mine[:words]).sum(axis=1, dtype=np.int64) <= most
                    some, most = some[ok], most[ok]
            out.append(some)
        return np.sort(np.concatenate(out))


def _nodes(docs: DataFrame) -> DataFrame:
    """(doc, mark, node, check, size, parity, fp) of docs (doc, text, mark)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffer(b.column(1))
            for i, j in slices(off):
                w = Words(_LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i])
                h, doc = _shingles(w)
                size = np.bincount(doc, minlength=j - i)
                fp = majority(*shingle_hashes(w, PRINTED), j - i).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(_digests(w)), pa.array(_digests(w, 1)), pa.array(size), pa.array(parities(h, doc, size), pa.binary()), pa.array(fp)], names=["doc", "mark", "node", "check", "size", "parity", "fp"])

    return docs.mapInArrow(run, "doc long, mark long, node long, check long, size long, parity binary, fp long")


def _alike(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links that connect those of a family's members (family, node, size, parity) that the bounds let be similar."""
    dealt = deal(members, "family", "node", CELL).select("family", "one", "two", "part", "node", "size", "parity")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in cells(batches, ("family", "one", "two"), 1 << 14):
            family, one, two, part, node, size = (t.column(c).to_numpy() for c in ("family", "one", "two", "part", "node", "size"))
            bounds = Bounds(size, t.column("parity").to_pylist(), similarity)
            root, edge = np.arange(len(node)), edges_of(family, one, two)  # sorted by size in a cell
            for start, end in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                last = start + np.searchsorted(size[start:end], size[start:end] / similarity + 1e-6, "right")
                own = root[start:end]
                for x in range(start, end - 1):
                    other = np.arange(x + 1, last[x - start])
                    other = other[root[other] != root[x]]
                    if one[x] != two[x]:
                        other = other[part[other] != part[x]]
                    if len(other):
                        for r in np.unique(root[bounds.allowed(x, other)]):
                            lo, hi = sorted((int(r), int(root[x])))
                            own[own == hi] = lo
            out = np.flatnonzero(root != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[out]), pa.array(node[root[out]])], names=["a", "b"])

    return dealt.repartition("family", "one", "two").sortWithinPartitions("family", "one", "two", "size").mapInArrow(run, "a long, b long")


def _candidates(docs: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links that connect nodes of docs (doc, text) that have a key in common.

    A batch gives one row (key, node) for each key, and (any key, node, least) for its other nodes
    of that key, so a key has at most as many rows as there are batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffer(b.column(1))
            for i, j in slices(off):
                w = Words(_LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i])
                node, one = np.unique(_digests(w), return_index=True)
                h, doc = _shingles(w)
                new = np.full(j - i, -1)
                new[one] = np.arange(len(one))
                use = new[doc] >= 0
                h, doc = h[use], new[doc[use]]
                order = np.argsort(doc, kind="stable")
                key, of = part_keys(h[order], doc[order], len(node), similarity)
                order = np.lexsort((of, key))
                key, of = key[order], of[order]
                edge = edges_of(key)
                least = np.repeat(of[edge[:-1]], np.diff(edge)) if len(key) else of
                head = edge[:-1] if len(key) else np.zeros(0, np.int64)
                head = head[np.argsort(of[head], kind="stable")]  # equal nodes together take less room
                a, z = np.divmod(np.unique((of * len(node) + least)[of != least]), max(1, len(node)))
                to = pa.array(np.concatenate([np.zeros(len(head), np.int64), node[z]]), mask=np.arange(len(head) + len(a)) < len(head))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([signed(key[head]), node[a]])), pa.array(np.concatenate([node[of[head]], node[a]])), to], names=["key", "node", "least"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head = None, 0  # the key that is open and its first node
        for b in batches:
            if not b.num_rows:
                continue
            key, node, least = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2)
            tied = np.asarray(least.is_valid())
            a, z = node[tied], least.drop_null().to_numpy()
            key, node = key[~tied], node[~tied]
            if len(key):
                edge = edges_of(key)
                to = node[edge[:-1]].copy()
                if last is not None and key[0] == last:
                    to[0] = head
                to = np.repeat(to, np.diff(edge))
                last, head = key[-1], to[-1]
                far = node != to
                a, z = np.concatenate([a, node[far]]), np.concatenate([z, to[far]])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(z)], names=["a", "b"])

    rows = docs.mapInArrow(run, "key long, node long, least long")
    return rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(meet, "a long, b long")


def _members(docs: DataFrame, dealt: DataFrame) -> DataFrame:
    """dealt (doc, mark, node, family, part, one, two) with the node's text, which docs (doc, mark, text) has; a batch gives a node's copies once.

    An id may have many texts: the mark, a hash of the text as it is, brings a node to its own text alone.
    """
    names = ["family", "one", "two", "part", "node", "text"]
    rows = docs.join(dealt, ["doc", "mark"]).select("family", "one", "two", "part", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffer(b.column(5))
            parts = [_digests(Words(_LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i])) for i, j in slices(off)]
            if not parts:
                continue
            mine = np.flatnonzero(np.concatenate(parts) == b.column(4).to_numpy())
            once = np.unique(np.stack([b.column(c).to_numpy()[mine].astype(np.int64) for c in (1, 2, 4)]), axis=1, return_index=True)[1]
            yield b.take(pa.array(mine[np.sort(once)]))

    return rows.mapInArrow(run, rows.schema).select(*names)


def _sets(texts: pa.Array) -> list[np.ndarray]:
    data, off = text_buffer(texts)
    out = []
    for i, j in slices(off):
        h, doc = _shingles(Words(_LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i]))
        out += np.split(h, np.searchsorted(doc, np.arange(1, j - i)))
    return out


def _rooms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut between cells where their texts are more than ROOM, as a cell of its own may be."""
    for t in batches:
        edge = edges_of(*(t.column(c).to_numpy() for c in ("family", "one", "two")))
        _, off = text_buffer(t.column("text"))
        full = np.flatnonzero(np.diff(off[edge[1:]] // ROOM)) + 1
        cut = [0, *edge[full].tolist(), t.num_rows]
        for a, z in zip(cut[:-1], cut[1:], strict=True):
            if z > a:
                yield t.slice(a, z - a)


def _verify(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b): verified links that connect members (family, one, two, part, node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _rooms(cells(batches, ("family", "one", "two"), 256)):
            family, one, two, part, node = (t.column(c).to_numpy() for c in ("family", "one", "two", "part", "node"))
            new = edges_of(family, one, two, node)[:-1]  # copies from several batches
            family, one, two, part, node = (x[new] for x in (family, one, two, part, node))
            raw = _sets(t.column("text").take(pa.array(new)))
            size = np.array([len(x) for x in raw])
            words, ids = np.unique(np.concatenate(raw), return_inverse=True)
            first = np.concatenate([[0], np.cumsum(size)])
            mark, root = np.zeros(len(words) + 1, np.int64), np.arange(len(node))
            bounds = Bounds(size, parities(np.concatenate(raw), np.repeat(np.arange(len(node)), size), size), similarity)
            edge = edges_of(family, one, two)
            for start, end in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                for x in range(start, end - 1):
                    other = np.arange(x + 1, end)
                    other = other[root[x + 1 : end] != root[x]]
                    if one[x] != two[x]:
                        other = other[part[other] != part[x]]
                    other = bounds.allowed(x, other)
                    if not len(other):
                        continue
                    mark[ids[first[x] : first[x + 1]]] = 1
                    for some in np.split(other, np.flatnonzero(np.diff(np.cumsum(size[other]) // CHUNK)) + 1):
                        some = some[root[some] != root[x]]
                        if not len(some):
                            continue
                        n = size[some]
                        begin = np.concatenate([[0], np.cumsum(n)[:-1]])
                        both = np.add.reduceat(mark[ids[np.repeat(first[some] - begin, n) + np.arange(int(n.sum()))]], begin)
                        same = both * (1 + similarity) >= similarity * (n + size[x]) - 1e-9
                        for r in np.unique(root[some[same]]):  # the two sides become one
                            lo, hi = sorted((int(r), int(root[x])))
                            root[root == hi] = lo
                    mark[ids[first[x] : first[x + 1]]] = 0
            out = np.flatnonzero(root != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[out]), pa.array(node[root[out]])], names=["a", "b"])

    return members.repartition("family", "one", "two").sortWithinPartitions("family", "one", "two", "node").mapInArrow(run, "a long, b long")


def _by_fingerprints(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, family): nodes (node, fp) whose fingerprints link at op5's radius, directly or over others; those alone are left out."""
    prints = scratch.settle(nodes.groupBy("fp").agg(F.count("*").alias("n")), "prints")
    comp = scratch.settle(components(near_links(prints), scratch, "prints-near"), "prints-components")
    named = prints.join(comp.withColumnRenamed("node", "fp"), "fp", "left").where("component is not null or n > 1")
    named = named.select("fp", F.coalesce("component", "fp").alias("family"), "n")
    return spread_join(nodes.select("node", "fp"), named, "fp", "node", hot_limit(nodes.count())).select("node", "family")


def near_text_classes(df: DataFrame, doc: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, scratch: Scratch | None = None, by_fingerprints: bool = False) -> DataFrame:
    """(doc, node, check, first): each row's digests and the (doc, node, check) that is first in its class; rows with a null id have none.

    With by_fingerprints, texts meet by their SimHash fingerprints (op5_simhash_dedup) instead of by parts of their shingles.
    """
    scratch = scratch or Scratch(df.sparkSession, "near")
    docs = df.select(F.col(doc).cast("long").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where("doc is not null")
    docs = docs.withColumn("mark", F.xxhash64("text"))
    rows = scratch.settle(_nodes(docs), "rows")
    least = F.min(F.struct("check", "doc", "mark", "size", "parity", "fp")).alias("x")  # of one check, so all from equal words
    nodes = rows.groupBy("node").agg(least, F.count("*").alias("n")).select("node", "x.check", F.col("x.doc").alias("own"), "x.mark", "x.size", "x.parity", "x.fp", "n")
    nodes = scratch.settle(nodes, "nodes")
    named = ["node", F.col("component").alias("family")]
    wide = scratch.settle(_by_fingerprints(nodes, scratch) if by_fingerprints else components(_candidates(docs, similarity), scratch, "meeting").select(*named), "wide")
    family = components(_alike(nodes.join(wide, "node").select("family", "node", "size", "parity"), similarity), scratch, "alike").select(*named)
    family = scratch.settle(family, "families")
    dealt = deal(nodes.join(family, "node").select(F.col("own").alias("doc"), "mark", "node", "family"), "family", "node", FAMILY)
    comp = components(_verify(_members(docs, dealt), similarity), scratch, "classes")
    named = nodes.select("node", "check", "own", F.col("n").alias("copies")).join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = scratch.settle(named, "named")
    first = named.groupBy("component").agg(F.min(F.struct(F.col("own").alias("doc"), "node", "check")).alias("first"), F.count("*").alias("n"))
    first = spread_join(named, first, "component", "node", hot_limit(named.count())).select("node", F.col("check").alias("known"), F.col("copies").alias("n"), "first")
    same = spread_join(rows.select("doc", "node", "check"), first, "node", "doc", hot_limit(rows.count()))
    own = F.struct("doc", "node", "check")
    return same.select("doc", "node", "check", F.when(F.col("check") == F.col("known"), F.col("first")).otherwise(own).alias("first"))
