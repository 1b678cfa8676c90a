"""Byte-pair encoding and decoding with a pair occurrence index.

A text is cut into pre-tokens by the vocabulary's pattern, and every
distinct pre-token that a partition meets is encoded once.  All new pre-tokens
of a block are laid out in one array of symbols, with a border after each, and
an index maps every pair that has a rank to all its positions in that array.
Active ranks are then applied in ascending order: each position that still holds
the pair is merged, and the pairs that its neighbours form with the new symbol
are added to the lists of their own ranks.  A merge can only form pairs of
higher rank (:class:`Encoder` refuses a vocabulary where it could not), so each
rank is visited once and the result is that of merging every pre-token by
itself, lowest rank first, leftmost first.

Two kinds of ``.json`` vocabularies are read: byte-level BPE with its usual
pattern and no normaliser, and BPE with word ends whose pattern drops white
space.  Texts with characters on which Unicode versions differ, or that are not
in normal form, are normalised and cut by the vocabulary's own library, so its
tables decide.

Defined results: a null or empty text has no ids and decodes to an empty text;
strings of added tokens inside a text are those tokens unless ``special`` is
off; texts are never cut; repeated rows and rows without doc_id are each
encoded; an empty table gives an empty frame; columns other than those named
are not read, so their names may be any.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loadstone.llm.textnum import slices
from loadstone.llm.tokens import PATTERN, byte_letters

REMEMBERED = 250_000  # pre-tokens after which a worker starts a new dictionary; it keeps two
LONGEST = 128  # characters of a pre-token that is kept
BLOCK = 3 << 20  # bytes of text that are encoded at a time
SYMBOLS = 1 << 20  # letters of one index, unless one pre-token has more
MANY = 40  # places of a pair that are merged at once
MARK = "\ud800"  # stands before the strings of added tokens; no text has it
_SHIFT = 20  # bits of an id in a packed pair


def _kind_of(category: str) -> str:
    return category[0] if category[0] in "LN" else "white" if category in ("Zs", "Zl", "Zp") else "other"


def _class(points: Iterable[int]) -> str:
    """The inside of a character class."""
    out, points = [], sorted(points)
    for _, run in itertools.groupby(enumerate(points), lambda x: x[1] - x[0]):
        run = [p for _, p in run]
        out.append(f"\\u{run[0]:04x}-\\u{run[-1]:04x}")
    return "".join(out)


def _stable(char: str) -> bool:
    """A letter, digit, white space or none of these in Unicode 3.2 as now: every library agrees on it."""
    old = unicodedata.ucd_3_2_0.category(char)
    return char.isascii() or (old != "Cn" and _kind_of(old) == _kind_of(unicodedata.category(char)))


_STABLE = [p for p in range(0x80, 0xD800) if all(map(_stable, chr(p) + chr(p).lower()))]
_ASCII = [p for p in range(0x80) if p not in range(0x1C, 0x20)]
UNSTABLE = re.compile(f"[^{_class(_STABLE + _ASCII)}]|\u0085")
SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to this library and not to others
_OF = {k: _class(p for p in _STABLE + _ASCII if _kind_of(unicodedata.category(chr(p))) == k) for k in ("L", "N")}


def stable_pattern(pattern: str) -> str:
    """A pattern of letters and digits for texts without :data:`UNSTABLE` characters."""
    for name, inside in _OF.items():
        pattern = pattern.replace(f"[\\p{{{name}}}]", f"[{inside}]")
        head, *rest = re.split(r"(\[\^[^]]*\])", pattern)
        pattern = "".join(part.replace(f"\\p{{{name}}}", inside if part.startswith("[^") else f"[{inside}]") for part in (head, *rest))
    return pattern


class _Folded(dict):
    """What the vocabulary's normaliser makes of a single character, by code point."""

    def __init__(self, normalizer):
        self.normalizer = normalizer

    def __missing__(self, point: int) -> str:
        self[point] = found = self.normalizer.normalize_str(chr(point)) if self.normalizer else chr(point)
        return found


class Encoder:
    """Ids of texts for one ``.json`` BPE vocabulary."""

    def __init__(self, path: str, special: bool = True, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.remembered = remembered

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("only BPE without dropout, unknown token, prefix and byte fallback is encoded here")
        if any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must stand for their own string only")
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self._folded = _Folded(self.normalizer)
        self._kind(spec)

        self.vocab = vocab = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        if any(c not in vocab or c + end not in vocab for c in letters):
            raise ValueError("the vocabulary lacks a byte")
        self.inner, self.last = ([vocab[c + tail] for c in sorted(letters, key=letters.get)] for tail in ("", end))  # by byte
        self._of_byte, self._of_last = (np.array([*ids[:255], -1], dtype=np.int64) for ids in (self.inner, self.last))
        pairs = [(vocab[a], vocab[b], vocab[a + b.removeprefix(model["continuing_subword_prefix"] or "")]) for a, b in model["merges"]]
        self.left, self.right, self.made = map(list, zip(*pairs, strict=True))
        there = {*self.inner, *self.last}
        for rank, (a, b, c) in enumerate(pairs):
            if c in there or a not in there or b not in there:
                raise ValueError(f"merge {rank} does not follow the merges of its parts")
            there.add(c)
        self.rank = {a << _SHIFT | b: rank for rank, (a, b, _) in enumerate(pairs)}
        keys = np.fromiter(self.rank, dtype=np.int64, count=len(self.rank))
        self._order = np.argsort(keys)
        self._keys = keys[self._order]

        strings = sorted((x["content"] for x in added), key=len, reverse=True) if special else []
        self._added = re.compile("(" + "|".join(map(re.escape, strings)) + ")") if strings else None
        self.special = {MARK + x["content"]: np.array([x["id"]], dtype="<i4").tobytes() for x in added}
        # pre-token: its ids as little-endian 32-bit numbers; when full, what is used again moves on from the dictionary before
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _kind(self, spec: dict) -> None:
        pre, normal = spec["pre_tokenizer"], spec["normalizer"]
        if pre["type"] == "ByteLevel" and not pre["add_prefix_space"] and pre["use_regex"] and normal is None:
            self._lower, self._find = False, re.compile(stable_pattern(PATTERN)).findall
            return
        steps = pre.get("pretokenizers", [])
        kinds = [n["type"] for n in (normal or {}).get("normalizers", [])]
        if [s["type"] for s in steps] == ["Split", "ByteLevel"] and kinds == ["NFC", "Replace", "Lowercase"]:
            split, byte_level = steps
            found = stable_pattern(split["pattern"].get("Regex", ""))
            # white space is in no pre-token, so what takes its place does not matter
            if split["behavior"] == "Removed" and split["invert"] and not re.search(found, " ") and not byte_level["use_regex"] and not byte_level["add_prefix_space"]:
                self._lower, self._find = True, re.compile(found).findall
                return
        raise ValueError("this normaliser or pre-tokeniser is not known here")

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text, in order; strings of added tokens after :data:`MARK`."""
        if self._added and self._added.search(text):
            cut = self._added.split(text)
            return [w for k, s in enumerate(cut) for w in ([MARK + s] if k % 2 else self._plain(s))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii() and not SEPARATORS.search(text):
            return self._find(text.lower() if self._lower else text)
        if not UNSTABLE.search(text) and (not self._lower or unicodedata.is_normalized("NFC", text)):
            return self._find(text.translate(self._folded) if self._lower else text)
        normal = self.normalizer.normalize_str(text) if self.normalizer else text
        return [normal[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(normal)]

    def merge(self, words: list[str]) -> list[bytes]:
        """The ids of each pre-token (of :data:`SYMBOLS` bytes together, or one)."""
        # FF, which is in no UTF-8, stands for the borders
        raw = np.frombuffer(b"\xff" + b"\xff".join([w.encode() for w in words]) + b"\xff", dtype=np.uint8)
        at = self._of_byte[raw]
        ends = np.flatnonzero(raw == 255)[1:] - 1
        at[ends] = self._of_last[raw[ends]]
        sym = array("i", at.astype(np.int32).tobytes())
        packed = at[:-1] << _SHIFT | at[1:]
        packed[(at[:-1] < 0) | (at[1:] < 0)] = -1
        near = np.minimum(np.searchsorted(self._keys, packed), len(self._keys) - 1)
        places = np.flatnonzero(self._keys[near] == packed)
        ranks = self._order[near[places]]
        order = np.argsort(ranks, kind="stable")
        active, first = np.unique(ranks[order], return_index=True)
        index = {int(r): part.tolist() for r, part in zip(active, np.split(places[order], first[1:]), strict=True)} if len(active) else {}
        heap = list(index)
        heapq.heapify(heap)
        del raw, at, ends, packed, near, places, ranks, order

        nxt, prv = array("i", range(1, len(sym) + 1)), array("i", range(-1, len(sym) - 1))
        views = [np.frombuffer(x, dtype=np.int32) for x in (sym, nxt, prv)]
        left, right, made, rank_of = self.left, self.right, self.made, self.rank.get
        while heap:
            rank = heapq.heappop(heap)
            a, b, c = left[rank], right[rank], made[rank]
            places = index.pop(rank)
            if len(places) >= MANY and a != b:
                for new, found in self._merge_many(*views, a, b, c, np.array(places)):
                    if new in index:
                        index[new] += found
                    else:
                        index[new] = found
                        heapq.heappush(heap, new)
                continue
            for p in places if a != b else sorted(places):  # two different symbols cannot overlap
                if sym[p] != a or sym[q := nxt[p]] != b:
                    continue  # an earlier merge took one of the two
                after, before = nxt[q], prv[p]
                sym[p], sym[q] = c, -2
                nxt[p], prv[after] = after, p
                if (s := sym[before]) >= 0 and (new := rank_of(s << _SHIFT | c)) is not None:
                    if new in index:
                        index[new].append(before)
                    else:
                        index[new] = [before]
                        heapq.heappush(heap, new)
                if (s := sym[after]) >= 0 and (new := rank_of(c << _SHIFT | s)) is not None:
                    if new in index:
                        index[new].append(p)
                    else:
                        index[new] = [p]
                        heapq.heappush(heap, new)
        out = np.frombuffer(sym, dtype=np.int32)
        borders = np.flatnonzero(out == -1)
        kept = np.concatenate([[0], np.cumsum(out >= 0)])[borders]
        ids = out[out >= 0].astype("<i4").tobytes()
        return [ids[4 * i : 4 * j] for i, j in zip(kept[:-1].tolist(), kept[1:].tolist(), strict=True)]

    def _merge_many(self, sym: np.ndarray, nxt: np.ndarray, prv: np.ndarray, a: int, b: int, c: int, p: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Merges all places of a pair of two different symbols, which cannot overlap; the ranks and places of the new pairs."""
        q = nxt[p]
        held = (sym[p] == a) & (sym[q] == b)
        p, q = p[held], q[held]
        after = nxt[q]
        sym[p], sym[q] = c, -2
        nxt[p], prv[after] = after, p
        before = prv[p]
        one, two = sym[before].astype(np.int64), sym[after].astype(np.int64)
        packed = np.concatenate([np.where(one >= 0, one << _SHIFT | c, -1), np.where(two >= 0, c << _SHIFT | two, -1)])
        near = np.minimum(np.searchsorted(self._keys, packed), len(self._keys) - 1)
        hit = np.flatnonzero(self._keys[near] == packed)
        ranks, places = self._order[near[hit]], np.concatenate([before, p])[hit]
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order].tolist()
        edges = np.flatnonzero(np.diff(ranks, prepend=-1, append=-1)).tolist() if len(ranks) else []
        for i, j in itertools.pairwise(edges):
            yield int(ranks[i]), places[i:j]

    def learn(self, words: Iterable[str]) -> None:
        """Adds the ids of distinct pre-tokens to those known; they share an index."""
        block, size = [], 0
        for w in words:
            if w[0] == MARK:
                self.known[w] = self.special[w]
                continue
            block.append(w)
            size += len(w) + 1
            if size >= SYMBOLS:
                self.known.update(zip(block, self.merge(block), strict=True))
                block, size = [], 0
        if block:
            self.known.update(zip(block, self.merge(block), strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        cut = [self.pre_tokens(t) for t in texts]
        if len(self.known) > self.remembered:
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        fresh = []
        for word in set().union(*cut) - known.keys():
            if word in before:
                known[word] = before[word]
            else:
                fresh.append(word)
        self.learn(fresh)
        out = [b"".join([known[w] for w in words]) for words in cut]
        for word in fresh:
            if len(word) > LONGEST:
                del known[word]
        return out


class Decoder:
    """Texts of ids for one ``.json`` vocabulary: its decoder, or tokens with a blank between them if it has none."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec["decoder"] and spec["decoder"]["type"]
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"decoder {kind} is not known here")
        strings = {n: w for w, n in spec["model"]["vocab"].items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}
        letters = byte_letters()
        self.bytes = kind is not None
        if self.bytes:
            self.of = {n: bytes(letters[c] for c in w) if all(c in letters for c in w) else w.encode() for n, w in strings.items()}
        else:
            self.of = strings

    def __call__(self, ids: list[int]) -> str:
        parts = [self.of[i] for i in ids if i in self.of]
        return b"".join(parts).decode("utf-8", "replace") if self.bytes else " ".join(parts)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}
_DECODERS: dict[str, Decoder] = {}


def encoder(path: str, special: bool = True) -> Encoder:
    """The worker's encoder of a vocabulary; what it has learned stays for later tasks."""
    if (path, special) not in _ENCODERS:
        _ENCODERS[path, special] = Encoder(path, special)
    return _ENCODERS[path, special]


def text_blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) in blocks of ``limit`` bytes or one text; null texts are empty."""
    sizes = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(sizes.buffers()[1], dtype=np.int64)[sizes.offset : sizes.offset + len(sizes) + 1] if len(sizes) else np.zeros(1, np.int64)
    for a, b in slices(ends - ends[0], limit):
        yield a, sizes.slice(a, b - a).to_pylist()


def encode(docs: DataFrame, vocabulary: str, special: bool = True) -> DataFrame:
    """doc_id, ids per row of ``docs`` (doc_id, text).

    ``vocabulary`` is a path that every executor can read, as the library is
    installed on each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(vocabulary, special)
        for batch in batches:
            for at, texts in text_blocks(batch.column(1)):
                found = encode_texts(texts)
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])])
                values = pa.array(np.frombuffer(b"".join(found), dtype="<i4"))
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], names=["doc_id", "ids"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids, text per row of ``encoded`` (doc_id, ids); special tokens are kept, ids that the vocabulary lacks are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _DECODERS:
            _DECODERS[vocabulary] = Decoder(vocabulary)
        one = _DECODERS[vocabulary]
        for batch in batches:
            ids = batch.column(1)
            for a in range(0, batch.num_rows, 512):
                part = ids.slice(a, 512)
                texts = [one(x.values.to_pylist()) if x.is_valid else "" for x in part]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, 512), part, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")
