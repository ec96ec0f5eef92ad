"""Token ids of whole texts, as the tokenizers library gives them, by a quicker way where that is proved equal.

A vocabulary file of one of two known shapes is turned into rank tables for tiktoken, whose
merging is quicker. Three checks, made when a worker opens the file, guard equality: merged
ids ascend with their rules, every token of the vocabulary is encoded alike by both, and
every character is tried in both, in words, alone and beside digits and marks, before the
first text with it takes the quick way. A text with a special token's string or a character
that fails goes to the library, and so does everything where a file has another shape.

``Codec`` is for encoders that treat words alone: it keeps what they gave, up to ``KEPT`` bytes.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from tokenizers import Tokenizer

_BARE = re.compile(r"[^\x20\x09-\x0D]+")
#: Bytes of texts encoded at a time.
SLICE = 2 << 20
#: Bytes of units and of what belongs to them that a worker keeps; units that come later are encoded once for each slice.
KEPT = 96 << 20
#: What a kept unit takes besides its own letters, about.
_ENTRY = 300

# The pattern that the files with word ends name for cutting texts, and what marks a word's end here.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MARK = "\x01"
_SPACES = " \t\n\r\x0b\x0c"
_CUT_ASCII = re.compile(r"('s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0Da-z0-9]+)[\x20\x09-\x0D]*")
_CUT_ANY = regex.compile(r"('s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+)\p{White_Space}*")
_LEADING = regex.compile(r"^\p{White_Space}+")


def byte_letters() -> dict[int, str]:
    """The printable letter by which vocabularies of this kind write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _marked(text: str) -> str:
    """The words of a text, each followed by the mark."""
    if text.isascii():
        return _CUT_ASCII.sub("\\1" + _MARK, text.lower().lstrip(_SPACES))
    return _CUT_ANY.sub("\\1" + _MARK, _LEADING.sub("", unicodedata.normalize("NFC", text).lower()))


class Ranks:
    """Ids of texts with the vocabulary file at path; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.special = [t["content"] for t in file["added_tokens"]]
        self.good: set[str] = set()
        self.bad: set[str] = set()
        self.quick = self._quick(file)
        if self.quick:
            self._learn({chr(c) for c in range(128)})
        self.odd = re.compile("[" + re.escape("".join(sorted(c for c in self.bad if c < "\x80"))) + "]") if any(c < "\x80" for c in self.bad) else None

    def _quick(self, file: dict) -> tiktoken.Encoding | None:
        model, cut, rule = file["model"], file.get("pre_tokenizer") or {}, file.get("normalizer")
        plain = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
        if model.get("type") != "BPE" or any(model.get(k, v) != v for k, v in plain.items()) or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in file["added_tokens"]):
            return None
        end = model.get("end_of_word_suffix")
        if end:
            parts = [{k: v for k, v in p.items() if k in ("type", "pattern", "invert", "behavior", "use_regex", "add_prefix_space")} for p in cut.get("pretokenizers", [])]
            known = [{"type": "Split", "pattern": {"Regex": _CUT}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}]
            if parts != known or [n.get("type") for n in (rule or {}).get("normalizers", [])] != ["NFC", "Replace", "Lowercase"]:
                return None
        elif rule or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex"):
            return None
        self.end, vocab, back = end, model["vocab"], {c: b for b, c in byte_letters().items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [vocab[a + b] for a, b in merges]
        ranks: dict[bytes, int] = {}
        for s, i in vocab.items():
            if s not in self.special:
                stem = s[: -len(end)] if end and s.endswith(end) else s
                if not all(c in back for c in stem):
                    return None
                ranks[bytes(back[c] for c in stem) + (_MARK.encode() if stem != s else b"")] = i
        merged = set(made)
        firsts = [i for i in ranks.values() if i not in merged]
        if made != sorted(merged) or len(ranks) != len(vocab) - sum(s in vocab for s in self.special) or (made and max(firsts) >= made[0]):
            return None
        quick = tiktoken.Encoding("ranks", pat_str=f"[^{_MARK}]+{_MARK}" if end else public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        tokens = []
        for b in ranks:
            try:
                tokens.append(b.removesuffix(_MARK.encode()).decode() if end else b.decode())
            except UnicodeDecodeError:  # never a whole piece of a text
                continue
        tokens = [t for t in tokens if _MARK not in t]
        same = all(e.ids == quick.encode_ordinary(_marked(t) if end else t) for e, t in zip(self.library.encode_batch(tokens, add_special_tokens=False), tokens, strict=True))
        return quick if same else None

    def _learn(self, chars: set[str]) -> None:
        """Try characters that have not been met in both ways."""
        for c in chars:
            text = f"a{c}b {c} 1{c}2 !{c}? {c}{c}\n{c}  {c}x{c} x{c}"
            same = c != _MARK and self.library.encode(text, add_special_tokens=False).ids == self.quick.encode_ordinary(_marked(text) if self.end else text)
            (self.good if same else self.bad).add(c)

    def _sure(self, text: str) -> bool:
        if any(s in text for s in self.special) or (self.odd and self.odd.search(text)):
            return False
        if text.isascii():
            return True
        new = set(text)
        if not new <= self.good:
            self._learn(new - self.good - self.bad)
            return new <= self.good
        return True

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids; null counts as the empty text."""
        out = []
        for t in texts:
            if not t:
                out.append(b"")
            elif self.quick and self._sure(t):
                out.append(self.quick.encode_to_numpy(_marked(t) if self.end else t, disallowed_special=()).astype("<u4").tobytes())
            else:
                out.append(np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes())
        return out


class Codec:
    """What encode gives for the words ``[^\\x20\\x09-\\x0D]+`` of texts, joined; encode: words to such values."""

    def __init__(self, encode: Callable[[list[str]], list], joiner: Callable[[list], object]):
        self.encode, self.join = encode, joiner
        self.kept: dict = {}
        self.room = KEPT

    def texts(self, texts: list[str | None]) -> list:
        """A value for each text; null counts as the empty text."""
        units = [_BARE.findall(t or "") for t in texts]
        new = list(set().union(*units).difference(self.kept)) if units else []
        known = self.kept
        if new:
            made = dict(zip(new, self.encode(new), strict=True))
            size = sum(4 * len(u) for u in new) + _ENTRY * len(new)
            if size <= self.room:
                self.room -= size
                self.kept.update(made)
            else:
                known = _Both(made, self.kept)
        return [self.join([known[u] for u in us]) for us in units]


class _Both:
    """Two dictionaries as one."""

    def __init__(self, new: dict, old: dict):
        self.new, self.old = new, old

    def __getitem__(self, key: str) -> object:
        found = self.old.get(key)
        return self.new[key] if found is None else found


_CODECS: dict[tuple, object] = {}


def library_codec(path: str) -> Ranks:
    """The vocabulary at path, opened once for each worker."""
    if ("ranks", path) not in _CODECS:
        _CODECS["ranks", path] = Ranks(path)
    return _CODECS["ranks", path]


def text_slices(col: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of about SLICE bytes together."""
    a, n = 0, len(col)
    while a < n:
        z, size = a, 0
        while z < n and (z == a or size < SLICE):
            v = col[z]
            size += v.as_buffer().size if v.is_valid else 0
            z += 1
        yield a, col.slice(a, z - a).to_pylist()
        a = z
