"""Alignment of two tokenizers on the same bytes, by galloping intersection.

Both tokenizers cut ``blank + text`` into tokens; a token ends at a byte offset.
The shorter of the two ascending lists of ends drives: each of its ends is looked
for in the longer list by leaps that double, and then by binary search inside the
last leap (:func:`gallop`).  That gives the rank of every end of the shorter list
in the longer one.  Ends in both lists cut the tokens into groups; the
difference of the ranks of a token's two ends is the range of the other side's
tokens that share bytes with it, its links.

A blank between two characters that are no white space starts a token on both
sides (:class:`Aligner` proves it of the piece vocabulary, the byte-level pattern
has it by construction), so both lists have an end there.  Texts are taken segment
by segment between such blanks, and a segment that comes again is not aligned
again.

Corpus-wide, a link's count is the number of documents that hold its pair of ids.
Documents lie in parts of about :data:`PART` bytes; a part's distinct pairs are
counted inside it first, so a pair that every document holds is one row a part.
The totals come back to each part once, and documents look their own pairs up there.

Defined results: texts that are null or empty, or whose bytes a tokenizer changes
(U+2581 is a blank to the pieces), have no tokens: zeros and an empty ``groups``.
Texts are never cut; repeated rows and rows without doc_id are documents each; an
empty table gives an empty frame; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.llm.bpe import Encoder, text_blocks
from loadstone.llm.tokens import byte_letters

PART = 16 << 20  # bytes of text in a part
BLOCK = 2 << 20  # bytes of text that are aligned at a time
REMEMBERED = 120_000  # segments after which a worker starts a new dictionary; it keeps two
LONGEST = 128  # characters of a segment that is kept
BLANK = "▁"


def gallop(ends: np.ndarray, longer: np.ndarray, low: np.ndarray, top: np.ndarray) -> np.ndarray:
    """The first place of ``longer`` that is not less than each of ``ends``, from ``low`` on; that of ``top`` is not.

    All ends gallop at once: those not there yet leap on, twice as far each
    time, and then halve their last leap.
    """
    low, high, step = low.copy(), low.copy(), 1
    behind = np.flatnonzero(longer[high] < ends)
    while len(behind):
        low[behind] = high[behind] + 1
        high[behind] = np.minimum(high[behind] + step, top[behind])
        step += step
        behind = behind[longer[high[behind]] < ends[behind]]
    between = np.flatnonzero(low < high)
    while len(between):
        middle = (low[between] + high[between]) // 2
        less = longer[middle] < ends[between]
        low[between], high[between] = np.where(less, middle + 1, low[between]), np.where(less, high[between], middle)
        between = between[low[between] < high[between]]
    return low


class Aligner:
    """Aligns texts for a byte-level ``.json`` vocabulary (A) and a piece ``.model`` (B)."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a, self.b = Encoder(a_path, special=False, remembered=50_000), sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        self.size_a, self.size_b = vocabulary_sizes(a_path, b_path)
        self.bytes_a = {i: bytes(letters[c] for c in w) for w, i in self.a.vocab.items() if all(c in letters for c in w)}
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        if any(regex.search(f"[^{BLANK}]{BLANK}", p) for p in pieces):
            raise ValueError("a piece goes on over a blank: texts cannot be cut at blanks")
        self.length_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(self.size_a)])
        self.length_b = np.array(list(map(len, self.bytes_b)))
        self.kind = pair_type(self.size_a, self.size_b)[1]
        # the text of a token inside a group, and of the last of its side
        self.text_a = np.array([[f"{i},", f"{i}|"] for i in range(self.size_a)], dtype=object)
        self.text_b = np.array([[f"{i},", f"{i};"] for i in range(self.size_b)], dtype=object)
        self.digits = np.array([len(str(i)) + 1 for i in range(max(self.size_a, self.size_b))])
        self.known: dict[str, tuple | None] = {}
        self.before: dict[str, tuple | None] = {}

    def same_bytes(self, segment: str, a: bytes, b: list[int]) -> bool:
        raw = b" " + segment.encode()
        return b"".join([self.bytes_b[i] for i in b]) == raw == b"".join([self.bytes_a[i] for i in np.frombuffer(a, dtype="<i4").tolist()])

    def align(self, segments: list[str], ids_a: list[bytes], ids_b: list[list[int]]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, n_links, groups, pairs) of each segment; None if a tokenizer changes its bytes."""
        a, b = np.frombuffer(b"".join(ids_a), dtype="<i4"), np.fromiter(chain.from_iterable(ids_b), dtype=np.int32)
        n_a, n_b = np.array([len(x) // 4 for x in ids_a]), np.array(list(map(len, ids_b)))
        first_a, first_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        raw = " " + " ".join(segments)
        ok = len(n_a) > 0 and n_a.all() and n_b.all() and np.array_equal(ends_a[first_a[1:] - 1], ends_b[first_b[1:] - 1])
        ok = ok and b"".join([self.bytes_b[i] for i in b.tolist()]) == raw.encode() == b"".join([self.bytes_a[i] for i in a.tolist()])
        if not ok:
            same = [self.same_bytes(*x) for x in zip(segments, ids_a, ids_b, strict=True)]
            if all(same):
                return []
            rest = iter(self.align(*([x for x, s in zip(y, same, strict=True) if s] for y in (segments, ids_a, ids_b))))
            return [next(rest) if s else None for s in same]

        # the shorter list drives; each of its ends starts where its segment starts in the longer
        swap = len(b) < len(a)
        ends, longer, n, first, first_longer = (ends_b, ends_a, n_b, first_b, first_a) if swap else (ends_a, ends_b, n_a, first_a, first_b)
        rank = gallop(ends, longer, np.repeat(first_longer[:-1], n), np.repeat(first_longer[1:] - 1, n))
        common = longer[rank] == ends
        start = np.concatenate([[0], (rank + common)[:-1]])  # where the bytes of the token start, as a rank
        shared = rank - start + 1
        one = np.repeat(np.arange(len(ends)), shared)
        two = np.arange(len(one)) - np.repeat(np.cumsum(shared) - shared - start, shared)
        pairs = (a[two].astype(self.kind) * self.size_b + b[one] if swap else a[one].astype(self.kind) * self.size_b + b[two]).astype(self.kind)
        n_links = np.add.reduceat(shared, first[:-1])
        n_groups = np.add.reduceat(common.astype(np.int64), first[:-1])

        # tokens in the order of groups, A's before B's
        common_longer = np.zeros(len(longer), dtype=bool)
        common_longer[rank[common]] = True
        last_a, last_b = (common_longer, common) if swap else (common, common_longer)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        upto_a, upto_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        at_a, at_b = np.arange(len(a)) + np.concatenate([[0], upto_b])[group_a], np.arange(len(b)) + upto_a[group_b]
        listed, width = np.empty(len(a) + len(b), dtype=object), np.empty(len(a) + len(b), dtype=np.int64)
        listed[at_a], listed[at_b] = self.text_a[a, last_a.astype(np.int8)], self.text_b[b, last_b.astype(np.int8)]
        width[at_a], width[at_b] = self.digits[a], self.digits[b]
        text = "".join(listed.tolist())
        edge = np.concatenate([[0], np.cumsum(width)])[first_a + first_b].tolist()
        raw_pairs, step = pairs.tobytes(), pairs.itemsize
        links = (np.concatenate([[0], np.cumsum(n_links)]) * step).tolist()
        numbers = zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), strict=True)
        return [(*x, text[edge[k] : edge[k + 1] - 1], raw_pairs[links[k] : links[k + 1]]) for k, x in enumerate(numbers)]

    def segments(self, text: str) -> list[str]:
        """The text cut at, and without, the blanks that start tokens on both sides."""
        return _CUT(text) if _MORE_WHITE.search(text) else text.split(" ")

    def __call__(self, texts: list[str]) -> list[tuple | None]:
        cut = [self.segments(t) if t and BLANK not in t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        known, before, fresh = self.known, self.before, []
        for s in set().union(*cut) - known.keys():
            if s in before:
                known[s] = before[s]
            else:
                fresh.append(s)
        if fresh:
            known.update(zip(fresh, self.align(fresh, self.a([" " + s for s in fresh]), self.b.encode(fresh, num_threads=1)), strict=True))
        out = []
        for segments in cut:
            found = [known[s] for s in segments]
            out.append(None if not found or None in found else tuple(zip(*found, strict=True)))
        for s in fresh:
            if len(s) > LONGEST:
                del known[s]
        return out


_CUT = regex.compile(r"(?<=\S) (?=\S)").split
_MORE_WHITE = re.compile(r"\s | \s|^ | \Z")  # a blank beside white space or at an end of the text
_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def vocabulary_sizes(a_path: str, b_path: str) -> tuple[int, int]:
    import json

    import sentencepiece

    with open(a_path, encoding="utf-8") as f:
        spec = json.load(f)
    ids = [*spec["model"]["vocab"].values(), *(x["id"] for x in spec["added_tokens"])]
    return max(ids) + 1, sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def pair_type(size_a: int, size_b: int) -> tuple[str, str]:
    """The Spark and numpy type of ``a * size_b + b``."""
    return ("int", "<i4") if size_a * size_b < 1 << 31 else ("long", "<i8")


def align_tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, part, n_a, n_b, n_groups,
    n_links, groups (``a1,a2|b1;a3|b2,b3``: ids of each group in order), and the
    distinct linked pairs of ids, ``a * size of B + b``, ascending, with how often
    each is linked in the document (``pairs``, ``times``).
    """
    kind, numpy_kind = pair_type(*vocabulary_sizes(a_path, b_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (a_path, b_path) not in _ALIGNERS:
            _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
        aligner = _ALIGNERS[a_path, b_path]
        part, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for at, texts in text_blocks(batch.column(1), BLOCK):
                found = aligner(texts)
                numbers = np.array([[sum(c) for c in f[:4]] if f else [0, 0, 0, 0] for f in found], dtype=np.int64).reshape(-1, 4)
                distinct = [np.unique(np.frombuffer(b"".join(f[5]), dtype=numpy_kind), return_counts=True) if f else None for f in found]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(d[0]) if d else 0 for d in distinct])]).astype(np.int32))
                some = [d for d in distinct if d]
                pairs = np.concatenate([d[0] for d in some]) if some else np.zeros(0, numpy_kind)
                times = np.concatenate([d[1] for d in some]).astype(np.int32) if some else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)), pa.array(np.full(len(texts), part)), *(pa.array(numbers[:, k]) for k in range(4)),
                        pa.array([";".join(f[4]) if f else "" for f in found], pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(pairs)), pa.ListArray.from_arrays(offsets, pa.array(times)),
                    ],
                    names=["doc_id", "part", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                )
                filled += sum(map(len, texts))
                if filled >= PART:
                    part, filled = part + 1, 0

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, part long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<{kind}>, times array<int>")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(in_part, pair, total, best) for the distinct pairs of each part: the
    documents of all parts that hold the pair, and whether no pair of its A id has more."""
    parts = aligned.select(F.col("part").alias("in_part"), F.explode("pairs").alias("pair")).groupBy("in_part", "pair").agg(F.count("*").alias("n"))
    totals = parts.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("a", F.expr(f"pair div {size_b}"))
    # one row an A id at most, so its size is that of the vocabulary
    highest = totals.groupBy("a").agg(F.max("total").alias("highest"))
    told = totals.join(F.broadcast(highest), "a").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    return parts.select("in_part", "pair").join(told, "pair")


def with_link_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``aligned`` (a stored table: it is read twice) without part, pairs and
    times, with n_best and count_sum: how many of a document's links have their A
    id's highest count, and the sum of the counts of its links."""
    kept = [f for f in aligned.schema if f.name not in ("part", "pairs", "times")]

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs, order = right["pair"].to_numpy(), np.argsort(right["pair"].to_numpy())
        keys, total, best = pairs[order], right["total"].to_numpy()[order], right["best"].to_numpy(zero_copy_only=False)[order]
        lists, times = left["pairs"].combine_chunks(), left["times"].combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        at = np.searchsorted(keys, lists.flatten().to_numpy())
        n = times.flatten().to_numpy().astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        sums = [np.concatenate([[0], np.cumsum(n * x[at])])[edges] if len(at) else np.zeros(len(edges), np.int64) for x in (best.astype(np.int64), total)]
        return pa.table([*(left[f.name] for f in kept), *(pa.array(np.diff(s).astype(np.int64)) for s in sums)], names=[*(f.name for f in kept), "n_best", "count_sum"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_best long, count_sum long"])
    return aligned.groupBy("part").cogroup(pair_counts(aligned, size_b).groupBy("in_part")).applyInArrow(look_up, schema)
