"""Benchmark decontamination: edit-distance search by CGK embedding and LSH.

Texts are word sequences (A-Z folded, ASCII punctuation at word edges dropped).
A document is contaminated by an item of m words if some window of it is within
``m // 5`` word edits of the item.

The CGK embedding walks over a sequence with a pointer that stays or advances
by a random bit of (step, word), and writes the word under the pointer at each
step; with high probability, near sequences have walks that meet again after
an edit, so edit distance becomes Hamming distance.  LSH samples ``SAMPLED``
of the steps as one key.  Each of the ``REPEATS`` repetitions has its own walk,
its own steps and its own start in the item (one of its long words, so that few
document positions share its first word); windows start at every word of every
document, and steps reach over what is left of the item, to its end in classes
of two to one.  In long items edits pull walks apart before they end; these have
``REPEATS`` windows of ``LOCAL`` words besides.  A walk goes on only
while the words sampled so far are those of some item, which changes no key.

Recall is measured in ``test_op3_recall`` and ``test_op3_long_items`` of
``tests/llm/test_ops.py``: 1 for exact passages and above 0.9 at the largest
distance.  Every candidate is then verified by the exact edit distance
(bit-parallel, free ends), so precision is 1.  Items of fewer than
``MIN_WORDS`` words allow no edit, and are looked up exactly, as the hash of so
many words in a row.

The items are a stated query set: they are broadcast in blocks of ``BLOCK``,
and each block is searched against all documents.

Defined results: null and empty texts and items match nothing; repeated rows
each give a row; of several places of one item the nearest, then the first, is
told.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.llm.textnum import buffers, mix, slices, word_hashes, words

REPEATS = 16
SAMPLED = 4  # steps in a key, the first included
MIN_WORDS = 5  # of an item that is searched by LSH
LOCAL = 24  # words of the further windows of long items
BLOCK = 20_000

_U = np.uint64
_MARK = np.zeros(256, dtype=bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def trimmed_words(part: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, lengths, first) of the words of each text."""
    starts, ends, first = words(part, offsets)
    for _ in range(3):
        if len(starts):
            ends = ends - ((ends - starts > 1) & _MARK[part[ends - 1]])
            starts = starts + ((ends - starts > 1) & _MARK[part[starts]])
    return (word_hashes(part, starts, ends) if len(starts) else np.zeros(0, _U)), ends - starts, first


def _bit(symbols: np.ndarray, step: int, seed: int) -> np.ndarray:
    """The random bit of (step, word) in one repetition; words are well mixed."""
    turn, place = divmod(step, 48)
    if turn:
        symbols = symbols * _U(2 * (turn * 7919 + seed) + 1)
    return ((symbols >> _U((place + 11 * seed) % 64)) & _U(1)).astype(np.int64)


def steps_of(seed: int, width: int) -> list[int]:
    """The sampled steps of a repetition for windows of at least ``width`` words."""
    rng = np.random.default_rng(1000 * seed + width)
    return sorted(rng.choice(np.arange(1, 2 * width), SAMPLED - 1, replace=False).tolist())


def _walk(symbols: np.ndarray, at: np.ndarray, from_step: int, to_step: int, seed: int) -> np.ndarray:
    for step in range(from_step, to_step):
        at = at + _bit(symbols[at], step, seed)
    return at


def _join(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mix(key * _U(0x9E3779B97F4A7C15) + symbol)


def width_class(left: int) -> int:
    """Words left in an item, to a power of two: windows of a class sample the same steps."""
    return max(2, 1 << (int(left).bit_length() - 1))


class Index:
    """LSH tables over a block of items, and the hashes of its short items."""

    def __init__(self, item_ids: list, texts: list[str | None]):
        data, offsets = buffers(pa.array(texts, pa.string()))
        hashes, lengths, first = trimmed_words(data, offsets)
        spans = list(zip(item_ids, first[:-1].tolist(), first[1:].tolist(), strict=True))
        long = [x for x in spans if x[2] - x[1] >= MIN_WORDS]
        short = [x for x in spans if 0 < x[2] - x[1] < MIN_WORDS]
        self.items = [(i, hashes[a:b]) for i, a, b in [*long, *short]]
        sizes = [lengths[a:b] for _, a, b in long]
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for m in sorted({b - a for _, a, b in short}):
            own = [len(long) + k for k, (_, a, b) in enumerate(short) if b - a == m]
            keys = np.array([runs_of(self.items[k][1], m)[0] for k in own])
            order = np.argsort(keys, kind="stable")
            self.short[m] = (keys[order], np.array(own)[order])
        self.widest = 2
        self.tables = []
        # windows of the item's size first; in long items edits pull the walks apart, so as many windows of LOCAL words more
        for seed in range(2 * REPEATS):
            by_class: dict[int, list[tuple[int, int]]] = {}
            for k, ((_, seq), size) in enumerate(zip(self.items, sizes, strict=False)):
                usable = max(1, (3 * len(seq)) // 4)
                if seed >= REPEATS and len(seq) <= 2 * LOCAL:
                    continue
                # the long words first; each repetition takes another
                order = np.lexsort((np.arange(usable), -size[:usable]))
                at = int(order[seed % min(usable, 12)])
                width = width_class(len(seq) - at)
                by_class.setdefault(width if seed < REPEATS else min(width, LOCAL), []).append((k, at))
            for width, members in sorted(by_class.items()):
                steps = steps_of(seed, width)
                self.widest = max(self.widest, width)
                padded = [np.concatenate([self.items[k][1][s:], np.zeros(2 * width + 1, _U)]) for k, s in members]
                keys = [np.array([p[0] for p in padded])]
                for n, step in enumerate(steps):
                    sampled = []
                    for p in padded:
                        at = np.zeros(1, np.int64)
                        for t in range(step):
                            at = at + _bit(p[at], t, seed)
                        sampled.append(p[at][0])
                    keys.append(_join(keys[n], np.array(sampled)))
                table = np.zeros(1 << 16, dtype=bool)
                table[(keys[0] & _U(0xFFFF)).astype(np.int64)] = True
                order = np.argsort(keys[-1], kind="stable")
                self.tables.append((seed, steps, table, [np.unique(k) for k in keys[:-1]], keys[-1][order], np.array(members)[order]))
        self.bits = [self._positions(seq) for _, seq in self.items]
        self.bits_back = [self._positions(seq[::-1]) for _, seq in self.items]

    @staticmethod
    def _positions(seq: np.ndarray) -> dict[int, int]:
        out: dict[int, int] = {}
        for i, x in enumerate(seq.tolist()):
            out[x] = out.get(x, 0) | 1 << i
        return out

    def candidates(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(position, item, start in the item) of windows that share a key."""
        padded = np.concatenate([symbols, np.zeros(2 * self.widest + 1, _U)])
        low = (symbols & _U(0xFFFF)).astype(np.uint16)
        for seed, steps, table, partial, keys, members in self.tables:
            at = np.flatnonzero(table[low])
            key = padded[at]
            ok = _among(key, partial[0])
            start, at, key, done = at[ok], at[ok], key[ok], 0
            for k, step in enumerate(steps):
                if not len(start):
                    break
                at = _walk(padded, at, done, step, seed)
                at = np.minimum(at, len(padded) - 1)
                done = step
                key = _join(key, padded[at])
                ok = _among(key, partial[k + 1] if k + 1 < len(partial) else keys)
                start, at, key = start[ok], at[ok], key[ok]
            if len(start):
                a, b = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                reps = b - a
                which = np.repeat(a, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
                yield np.repeat(start, reps), members[which, 0], members[which, 1]

    def exact(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(position, item) of short items."""
        for m, (keys, own) in self.short.items():
            found = runs_of(symbols, m)
            a, b = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
            reps = b - a
            which = np.repeat(a, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            yield np.repeat(np.arange(len(found)), reps), own[which]

    def nearest(self, item: int, window: list[int], most: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of the nearest part of ``window`` (bit-parallel),
        if within ``most`` edits."""
        m, bits = len(self.items[item][1]), self.bits[item]
        if sum(map(bits.__contains__, window)) < m - most:  # that many words must be the item's
            return None
        distance, end = _least(bits, m, window, True)
        if distance > most:
            return None
        _, back = _least(self.bits_back[item], m, window[:end][::-1], False)
        return distance, end - back, end


def runs_of(symbols: np.ndarray, m: int) -> np.ndarray:
    """A hash of each m words in a row."""
    n = max(len(symbols) - m + 1, 0)
    key = np.zeros(n, dtype=_U)
    for k in range(m):
        key = _join(key, symbols[k : k + n])
    return key


def _least(bits: dict[int, int], m: int, window: list[int], anywhere: bool) -> tuple[int, int]:
    """(distance, end): the least edit distance of a pattern to a part of
    ``window`` that starts anywhere (or at its start), and where it first ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for i, symbol in enumerate(window):
        eq = bits.get(symbol, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
        score += bool(up & top) - bool(down & top)
        up = up << 1 | (0 if anywhere else 1)
        plus = (down << 1 | (full & ~(diagonal | up))) & full
        minus = up & diagonal & full
        if score < best:
            best, end = score, i + 1
    return best, end


def _among(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def _search(index: Index, batch: pa.RecordBatch, tolerance: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, distance, start, end): the nearest place of each item in each text."""
    data, offsets = buffers(batch.column(1))
    for a, b in slices(offsets):
        part = data[offsets[a] : offsets[b]]
        symbols, _, first = trimmed_words(part, offsets[a : b + 1] - offsets[a])
        if not len(symbols):
            continue
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for at, item in index.exact(symbols):
            row = np.searchsorted(first, at, side="right") - 1
            for r, k, p in zip(row.tolist(), item.tolist(), (at - first[row]).tolist(), strict=True):
                m = len(index.items[k][1])
                if p + m <= first[r + 1] - first[r]:  # all of it is in this text
                    best[r, k] = min(best.get((r, k), (0, p, p + m)), (0, p, p + m))
        if found := list(index.candidates(symbols)):
            at, item, start = (np.concatenate(x) for x in zip(*found, strict=True))
            row = np.searchsorted(first, at, side="right") - 1
            begin = at - start  # where the item would begin
            # windows of one item that meet are one stretch, read once from end to end
            stretches: list[list[int]] = []
            for r, k, p in sorted(set(zip(row.tolist(), item.tolist(), begin.tolist(), strict=True))):
                m = len(index.items[k][1])
                slack = m // tolerance
                lo, hi = max(p - slack, int(first[r])), min(p + m + slack, int(first[r + 1]))
                if stretches and stretches[-1][:2] == [r, k] and lo <= stretches[-1][3]:
                    stretches[-1][3] = max(hi, stretches[-1][3])
                elif hi > lo:
                    stretches.append([r, k, lo, hi])
            for r, k, lo, hi in stretches:
                if near := index.nearest(k, symbols[lo:hi].tolist(), len(index.items[k][1]) // tolerance):
                    distance, s, e = near
                    place = (distance, int(lo - first[r] + s), int(lo - first[r] + e))
                    best[r, k] = min(best.get((r, k), place), place)
        for (r, k), (distance, s, e) in sorted(best.items()):
            yield a + r, k, distance, s, e


def find_leaks(docs: DataFrame, benchmark: DataFrame, tolerance: int = 5) -> DataFrame:
    """doc_id, item_id, distance, n_words, start_word, end_word of each
    (document, item) within ``n_words // tolerance`` word edits."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    blocks = -(-items.count() // BLOCK)
    rows = docs.select("doc_id", "text")
    kinds = {c: f.schema[c].dataType.simpleString() for f, c in ((rows, "doc_id"), (items, "item_id"))}
    schema = f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, distance int, n_words int, start_word int, end_word int"
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        block_rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        block_rows.sort(key=lambda r: (str(r["item_id"]), r["text"]))
        index = spark.sparkContext.broadcast(Index([r["item_id"] for r in block_rows], [r["text"] for r in block_rows]))
        out = out.union(rows.mapInArrow(_searcher(index, tolerance), schema))
    return out


def _searcher(held, tolerance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            found = list(_search(index, batch, tolerance))
            at = pa.array([f[0] for f in found], pa.int64())
            ids = pa.array([index.items[f[1]][0] for f in found])
            numbers = [pa.array([f[c] for f in found], pa.int32()) for c in (2, 3, 4)]
            sizes = pa.array([len(index.items[f[1]][1]) for f in found], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), ids if found else pa.nulls(0, pa.int64()), numbers[0], sizes, numbers[1], numbers[2]], names=["doc_id", "item_id", "distance", "n_words", "start_word", "end_word"])

    return run
