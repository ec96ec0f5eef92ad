"""Byte-pair encoding by speculation and verification, and decoding.

For a word, greedy longest match proposes tokens. The proposal is what merging in rank order
would give exactly if each adjacent pair is compatible, that is, if merging the two tokens'
joined bytes leaves the two. ``BytePairs.compatible`` tests all pairs of all new words of a
slice at once: it takes both tokens apart along the boundary, latest merge first, and looks
whether the pieces that meet at some time would have merged before either was used up. Only
words with an incompatible pair are merged step by step. Words are encoded once for each
slice, and a bounded number is kept (units.Codec).

Defined cases: null and empty texts have no tokens and decode to the empty text; the two
special tokens' strings in a text are their tokens, as in the library; repeated rows are
encoded alike; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..shipping import ship
from .units import _CODECS, Codec, byte_letters, text_slices

VOCABULARY = "word_bpe_49k.json"
_NONE = np.int64(1) << 40
# Fixed value: the pattern that the vocabulary's file names for cutting texts before merging.
_CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")


class BytePairs:
    """A merge table whose ids ascend with merge rank, with word ends marked."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, self.rules = file["model"], Tokenizer.from_file(path)
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.vocab = model["vocab"]
        self.name = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.letters = byte_letters()
        self.merge = {(self.vocab[a], self.vocab[b]): self.vocab[a + b] for a, b in model["merges"]}
        size = max(self.vocab.values()) + 1
        self.left, self.right = np.arange(size), np.arange(size)
        for (a, b), c in self.merge.items():
            self.left[c], self.right[c] = a, b
        self.base = size - len(self.merge)  # ids from here on are merged
        keys = np.array([a * size + b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self.keys, self.size = np.append(keys[order], _NONE), size
        self.made = np.append(np.array(list(self.merge.values()), np.int64)[order], _NONE)
        made = np.arange(self.base, size)
        whole = np.ones(size, bool)  # tokens that merging their own bytes gives
        whole[made] = self.compatible(self.left[made], self.right[made], made)
        for c in made.tolist():
            whole[c] &= whole[self.left[c]] and whole[self.right[c]]
        self.inner = {s: i for s, i in self.vocab.items() if whole[i] and not s.endswith(self.end)}
        self.last = {s[: -len(self.end)]: i for s, i in self.vocab.items() if whole[i] and s.endswith(self.end)}
        self.longest: dict[str, int] = {}
        for s in [*self.inner, *self.last]:
            self.longest[s[:2]] = max(self.longest.get(s[:2], 1), len(s))

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair of tokens: do both stay when their bytes are merged together."""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), _NONE) if limit is None else limit.copy()
        out, at = np.ones(len(a), bool), np.arange(len(a))
        while len(at):
            key = a * self.size + b
            k = np.searchsorted(self.keys, key)
            meets = np.where(self.keys[k] == key, self.made[k], _NONE) < limit
            out[at[meets]] = False
            go = ~meets & (np.maximum(a, b) >= self.base)
            a, b, at = a[go], b[go], at[go]
            back = a > b
            limit = np.where(back, a, b + 1)
            a, b = np.where(back, self.right[a], a), np.where(back, b, self.left[b])
        return out

    def propose(self, word: str) -> list[int]:
        """Greedy longest match; word in byte letters."""
        out, i, n = [], 0, len(word)
        inner, last, longest = self.inner, self.last, self.longest
        while i < n:
            j = min(n, i + longest.get(word[i : i + 2], 1))
            if j == n:
                t = last.get(word[i:])
                if t is not None:
                    out.append(t)
                    break
                j -= 1
            while (t := inner.get(word[i:j])) is None:
                j -= 1
            out.append(t)
            i = j
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ids that pairs merge into, or _NONE."""
        key = a * self.size + b
        k = np.searchsorted(self.keys, key)
        return np.where(self.keys[k] == key, self.made[k], _NONE)

    def exact(self, words: list[str]) -> list[list[int]]:
        """Merging in rank order, leftmost first: a merge in every word at a time. Words of one call are of like length."""
        n, wide = len(words), max(map(len, words)) + 1
        ids = np.full((n, wide), -1)
        for k, w in enumerate(words):
            ids[k, : len(w)] = [*(self.vocab[c] for c in w[:-1]), self.vocab[w[-1] + self.end]]
        after = np.tile(np.arange(1, wide + 1), (n, 1))
        before = np.tile(np.arange(-1, wide - 1), (n, 1))
        rank = np.full((n, wide), _NONE)
        i, j = np.nonzero(ids[:, 1:] >= 0)
        rank[i, j] = self._ranks(ids[i, j], ids[i, j + 1])
        row = np.arange(n)
        while len(row):
            p = rank[row].argmin(axis=1)
            made = rank[row, p]
            go = made < _NONE
            row, p, made = row[go], p[go], made[go]
            q = after[row, p]
            s = after[row, q]
            ids[row, p], ids[row, q], rank[row, q] = made, -1, _NONE
            after[row, p] = s
            inner = s < wide
            before[row[inner], s[inner]] = p[inner]
            right = np.where(inner, ids[row, np.minimum(s, wide - 1)], -1)
            rank[row, p] = np.where(right >= 0, self._ranks(made, np.maximum(right, 0)), _NONE)
            o = before[row, p]
            left = o >= 0
            rank[row[left], o[left]] = self._ranks(ids[row[left], o[left]], made[left])
        return [x[x >= 0].tolist() for x in ids]

    def words(self, words: list[str]) -> list[list[int]]:
        """Ids of words in byte letters: proposed, all pairs checked at once, failing words merged."""
        got = [self.propose(w) for w in words]
        n = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((t for g in got for t in g), np.int64, int(n.sum()))
        word = np.repeat(np.arange(len(got)), n)
        pair = np.flatnonzero(word[1:] == word[:-1])
        kinds, where = np.unique(flat[pair] * self.size + flat[pair + 1], return_inverse=True)
        bad = ~self.compatible(kinds // self.size, kinds % self.size)[where]
        failed = sorted(np.unique(word[pair[bad]]).tolist(), key=lambda k: len(words[k]))
        a = 0
        while a < len(failed):
            most = 2 * len(words[failed[a]]) + 8  # letters of the longest word in the part
            z = a + 1
            while z < len(failed) and z - a < 4096 and len(words[failed[z]]) <= most:
                z += 1
            for k, ids in zip(failed[a:z], self.exact([words[k] for k in failed[a:z]]), strict=True):
                got[k] = ids
            a = z
        return got

    def cut(self, unit: str) -> list[str | int]:
        """A unit's words in byte letters, and special tokens as ids."""
        found = [(unit.find(s), s) for s in self.special if s in unit]
        if found:
            a, s, b = unit.partition(min(found)[1])
            return [*self.cut(a), self.special[s], *self.cut(b)]
        if unit.isascii():
            unit = unit.lower()
        elif max(unit) > "\u024f":  # what is a letter there depends on the version of Unicode, so the file's own rules cut
            return [w for w, _ in self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(unit))]
        else:
            unit = "".join(map(str.lower, unicodedata.normalize("NFC", unit)))
        return [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.letters) for w in _CUT.findall(unit)]

    def units(self, units: list[str]) -> list[tuple[bytes, bytes]]:
        """For each unit: ids as bytes, and decoded tokens with a space after each."""
        cut = [self.cut(u) for u in units]
        words = list({w for c in cut for w in c if isinstance(w, str)})
        ids = dict(zip(words, self.words(words), strict=True))
        out = []
        for c in cut:
            flat = [t for w in c for t in (ids[w] if isinstance(w, str) else [w])]
            out.append((np.array(flat, "<u4").tobytes(), "".join([self.name[t] + " " for t in flat]).encode()))
        return out


def pair_codec(path: str) -> Codec:
    if ("pairs", path) not in _CODECS:
        _CODECS["pairs", path] = Codec(BytePairs(path).units, lambda parts: (b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])))
    return _CODECS["pairs", path]


def encode_decode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc, ids, decoded): ids as little-endian unsigned 32-bit integers, and the text decoded from them."""
    ship(df.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pair_codec(path)
        for b in batches:
            for a, texts in text_slices(b.column(1)):
                got = codec.texts(texts)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, len(texts)), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1][:-1] for g in got], pa.binary()).cast(pa.string())], names=["doc", "ids", "decoded"])

    return df.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc long, ids binary, decoded string")


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("doc").alias("doc_id"), F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2(F.col("ids"), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
