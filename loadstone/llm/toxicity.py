"""Toxicity scores from a factorization machine over hashed terms.

A text is the set of its distinct words, hashed; the machine scores
``sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>)`` over the terms it knows, so a
pair such as an insult and a group mention has a weight of its own that no sum
of single weights can give.  It is fitted by Adagrad on a bounded sample of
labelled rows (``SAMPLE``, drawn by hash of the id) and has at most ``TERMS``
terms: those of the ``PAIRS`` pairs whose joint presence tells the classes apart
most beyond what the two tell alone (counted for the ``PAIR_TERMS`` most usable
terms of the sample), then those that tell the classes apart best by themselves.
So terms that say nothing alone are there if they say something together.  The
model is a few hundred KB whatever the corpus.  Only the texts are inputs: label, language, source and id
never are.

Defined results: null, empty and unknown-only texts get the score of a text
without known terms; without labelled rows of both classes every score is the
share of label 1 (0 without rows); different labels of one id each train, rows
that repeat an id and a label train once; a row without doc_id is not held out
and has no label; repeated rows are each scored; extra columns are passed on,
but for ``score`` and ``predicted``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.llm.textnum import buffers, slices, word_hashes, words

SAMPLE = 12_000  # labelled rows that train, at most
TERMS = 4096  # terms of the model, at most
PAIR_TERMS, PAIRS = 1024, 256  # terms whose pairs are counted in the sample, and pairs whose terms are kept
PAIR_SIGNAL = 18.0  # of a pair beyond its two terms, in nats: chance makes none of a million
FACTORS = 4
POSITIVE = 3.0  # weight of a row of label 1: missing one costs more
EPOCHS = 12
TEST_REMAINDER = 2  # of crc32(doc_id) mod 4: rows whose labels are never read


@dataclass
class Machine:
    terms: np.ndarray  # sorted hashes
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, groups: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Scores of n texts; known term ``at[k]`` is in text ``groups[k]``."""
        linear = np.bincount(groups, weights=self.weights[at], minlength=n)
        pairs = np.zeros(n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            pairs += np.bincount(groups, weights=v, minlength=n) ** 2 - np.bincount(groups, weights=v * v, minlength=n)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -30, 30)))


def _terms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, text, hash): distinct words of texts first to last, letters only at the edges."""
    data, offsets = buffers(texts)
    for a, b in slices(offsets):
        part = data[offsets[a] : offsets[b]]
        starts, ends, first = words(part, offsets[a : b + 1] - offsets[a])
        for _ in range(3):  # trailing and leading ASCII punctuation
            if len(starts):
                ends = ends - ((ends - starts > 1) & _MARK[part[np.maximum(ends - 1, 0)]])
                starts = starts + ((ends - starts > 1) & _MARK[part[np.minimum(starts, len(part) - 1)]])
        hashes = word_hashes(part, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        yield a, b, np.repeat(np.arange(b - a), np.diff(first)), hashes


_MARK = np.zeros(256, dtype=bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == TEST_REMAINDER, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """(_id, text, toxic) of at most ``limit`` labels outside the held-out part.

    The labels are cut to the sample first: what is broadcast to find its
    texts is ``limit`` short rows.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("_id"), "_id", "toxic").limit(limit)
    texts = docs.select(F.col("doc_id").alias("_doc"), "text")
    return texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Machine:
    """Terms are taken from the texts on executors; a bounded sample of term
    lists comes to the driver, where the small machine is fitted."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [b""] * batch.num_rows
            for a, b, text, hashes in _terms(batch.column(1)):
                cuts = np.searchsorted(text, np.arange(b - a + 1))
                for i in range(b - a):
                    out[a + i] = np.unique(hashes[cuts[i] : cuts[i + 1]]).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), batch.column(2)], names=["_id", "terms", "toxic"])

    sample = labelled_sample(docs, labels, limit)
    rows = sample.mapInArrow(take, f"_id {sample.schema['_id'].dataType.simpleString()}, terms binary, toxic int")
    # one row for an id and a label, so no more than ``limit`` come here however often a document repeats
    rows = rows.groupBy("_id", "toxic").agg(F.min("terms").alias("terms")).select("terms", "toxic").toArrow()
    # the order of collected rows is not fixed; that of their contents is
    rows = rows.sort_by([("terms", "ascending"), ("toxic", "ascending")])
    sizes = pa.compute.binary_length(rows.column("terms")).to_numpy() // 8
    flat = np.frombuffer(b"".join(rows.column("terms").to_pylist()), dtype=np.uint64)
    labels = rows.column("toxic").to_numpy().astype(float)
    del rows
    return fit_machine(flat, sizes, labels)


def strong_pairs(flat: np.ndarray, owner: np.ndarray, labels: np.ndarray, one: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, sign) of at most PAIRS pairs of terms, strongest first, whose joint
    presence departs from what the two say alone (their log odds added up).

    ``flat`` are term numbers, ``owner`` the rows they are in, one entry each.
    """
    n, p = len(labels), labels.mean()
    usable = np.minimum(total, n - total)
    chosen = np.flatnonzero(usable >= 8)
    chosen = np.sort(chosen[np.argsort(-usable[chosen], kind="stable")[:PAIR_TERMS]])
    place = np.full(len(total), -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))
    known = place[flat] >= 0
    at, row = place[flat[known]], owner[known]
    # the rows of a term as bits, those of label 1 first; joint counts are counts of common bits
    order = np.argsort(-labels, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    ones = int(labels.sum())
    bits = []
    for first, last in ((0, ones), (ones, n)):
        mine = (rank[row] >= first) & (rank[row] < last)
        present = np.zeros((len(chosen), -(-max(last - first, 1) // 64) * 64), dtype=bool)
        present[at[mine], rank[row[mine]] - first] = True
        bits.append(np.packbits(present, axis=1).view(np.uint64))
    odds = np.log((one[chosen] + 0.5 * p + 1e-3) / (total[chosen] - one[chosen] + 0.5 * (1 - p) + 1e-3))
    found: list[tuple[float, int, int, float]] = []
    for k in range(len(chosen) - 1):
        one_k, zero_k = (np.bitwise_count(x[k] & x[k + 1 :]).sum(axis=1, dtype=np.int64).astype(float) for x in bits)
        count = one_k + zero_k
        rate = 1 / (1 + np.exp(-np.clip(odds[k] + odds[k + 1 :] - np.log(p / (1 - p)), -30, 30)))
        g = one_k * np.log(np.maximum(one_k, 1e-9) / (count * rate + 1e-9)) + zero_k * np.log(np.maximum(zero_k, 1e-9) / (count * (1 - rate) + 1e-9))
        for j in np.flatnonzero((count >= 8) & (g > PAIR_SIGNAL)).tolist():
            found.append((-float(g[j]), int(chosen[k]), int(chosen[k + 1 + j]), 1.0 if one_k[j] > count[j] * rate[j] else -1.0))
    found = sorted(found)[:PAIRS]
    return np.array([f[1] for f in found], dtype=np.int64), np.array([f[2] for f in found], dtype=np.int64), np.array([f[3] for f in found])


def fit_machine(flat: np.ndarray, sizes: np.ndarray, labels: np.ndarray, seed: int = 7) -> Machine:
    """The machine of texts whose distinct terms, so many each, are in ``flat`` one after the other."""
    n, positive = len(labels), float(labels.sum())
    if not 0 < positive < n:
        share = positive / n if n else 0.0
        return Machine(np.zeros(0, np.uint64), float(np.log((share + 1e-9) / (1 - share + 1e-9))), np.zeros(0), np.zeros((0, FACTORS)))
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    terms = np.unique(flat)
    at = np.searchsorted(terms, flat).astype(np.int32)
    one = np.bincount(at[labels[owner] > 0], minlength=len(terms)).astype(float)
    zero = np.bincount(at, minlength=len(terms)) - one
    # signed G statistic of presence against the label
    total, p = one + zero, positive / n
    expected = total * p
    g = one * np.log(np.maximum(one, 1e-9) / expected) + zero * np.log(np.maximum(zero, 1e-9) / (total - expected))
    pair_a, pair_b, pair_sign = strong_pairs(at, owner, labels, one, total)
    paired = np.unique(np.concatenate([pair_a, pair_b]))
    keep = np.flatnonzero((total >= 4) & (g > 4.0))
    keep = np.union1d(keep[np.argsort(-g[keep], kind="stable")[: TERMS - len(paired)]], paired)
    place = np.full(len(terms), -1)
    place[keep] = np.arange(len(keep))
    known = place[at] >= 0
    at, owner = place[at[known]], owner[known]
    cuts = np.searchsorted(owner, np.arange(n + 1))

    rng = np.random.default_rng(seed)
    bias, w = float(np.log(p / (1 - p))), np.zeros(len(keep))
    v = rng.normal(0, 0.02, (len(keep), FACTORS))
    for f, (a, b, sign) in enumerate(zip(place[pair_a[:FACTORS]], place[pair_b[:FACTORS]], pair_sign, strict=False)):
        v[a, f] += 0.3  # each of the strongest pairs begins on a factor of its own
        v[b, f] += 0.3 * sign
    gw, gv, gb = np.full(len(keep), 1e-2), np.full(v.shape, 1e-2), 1e-2
    rate, decay = 0.15, 2e-4
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for i in order:
            x = at[cuts[i] : cuts[i + 1]]
            s = v[x].sum(axis=0)
            z = bias + w[x].sum() + 0.5 * float((s * s).sum() - (v[x] ** 2).sum())
            d = (1 / (1 + np.exp(-min(max(z, -30), 30))) - labels[i]) * (POSITIVE if labels[i] else 1.0)
            gb += d * d
            bias -= rate * d / np.sqrt(gb)
            if len(x):
                step = d + decay * w[x]
                gw[x] += step * step
                w[x] -= rate * step / np.sqrt(gw[x])
                step = d * (s - v[x]) + decay * v[x]
                gv[x] += step * step
                v[x] -= 0.3 * rate * step / np.sqrt(gv[x])
    return Machine(terms[keep], bias, w, v)


def score_toxicity(docs: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """All columns of docs with score (double) and predicted (int) appended."""
    docs = docs.drop("score", "predicted")
    held = docs.sparkSession.sparkContext.broadcast(machine)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for a, b, text, hashes in _terms(batch.column(columns.index("text"))):
                at = np.searchsorted(model.terms, hashes)
                known = at < len(model.terms)
                known[known] = model.terms[at[known]] == hashes[known]
                pair = np.unique(text[known] * max(len(model.terms), 1) + at[known])
                out[a:b] = model.score(pair // max(len(model.terms), 1), pair % max(len(model.terms), 1), b - a)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out), pa.array((out >= threshold).astype(np.int32))], names=[*columns, "score", "predicted"])

    schema = T.StructType([*(f for f in docs.schema), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(run, schema)
