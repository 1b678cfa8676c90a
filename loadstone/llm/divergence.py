"""Source divergence audit: how far the words of each source of a language are
from those of its other sources, and which words tell.

Only terms that enough documents of the language hold are compared.  They are
found by iceberg refinement of byte prefixes.  A level counts, for every prefix
of its length, the documents that hold it; prefixes under the threshold are
discarded, and the next level counts longer prefixes only of terms whose shorter
one is left.  The last level has complete terms.  A term in enough documents has
all its prefixes in as many, so none is lost, and the many rare terms are never
shuffled.  Levels count by 64-bit hashes of (lang, prefix); two that collide are
counted together, which only keeps more for the exact last level.

What is left of a level reaches the next scan as a filter of :data:`FILTER_BITS`
bits, whatever the size of the corpus: when it fills up it lets more through and
the counts of the last level are the same.

Probabilities are integers, in billionths: a group's term has
``1 + floor(10^9 (count + 1) / (N + V))``.  Divergences of two sources are summed
over all V terms, yet only terms that both have are looked at in pairs: for the
rest the other side's probability is that of a count of 0, so a histogram of each
source's counts is enough.

Defined results: null text, lang and source are empty strings; each row is a
document, with or without doc_id; a source without any term is compared as one
that has each term 0 times; without kept terms divergences are 0; an empty table
gives an empty frame.  Inside a slice of :data:`SLICE` bytes terms are told apart
by 64-bit hashes (n of them collide with a probability of n * n / 2**65).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadstone.llm._io import stored
from loadstone.llm.textnum import _LOWER, buffers, mix, slices, word_hashes, words

LEVELS = (3, 6, 12)  # bytes of the prefixes; then complete terms
LEAST_DOCS = 3
TOP_TERMS = 200
ONE = 1_000_000_000
FILTER_BITS = 1 << 27
SLICE = 4 << 20  # bytes of text handled at a time
HELD = 4_000_000  # prefix counts that a task merges at a time
ADDED = 200_000  # term counts that a task holds to add others to
BLOCK = 100_000  # counted terms of sources in one block of the pairwise sums
_PIECE = 1 << 20  # bits of the filter that one group makes
_U = np.uint64

#: No letter of A-Z or a-z, and no byte of a character beyond ASCII.
_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _salts(names: pa.Array) -> np.ndarray:
    coded = names.dictionary_encode()
    each = np.array([xxhash.xxh3_64_intdigest(x.as_py()) for x in coded.dictionary], dtype=_U)
    return each[coded.indices.to_numpy()] if len(each) else np.zeros(0, _U)


class _Terms:
    """The terms of some texts: spans, the text of each, and hashes of prefixes by language."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, salts: np.ndarray):
        self.data = data
        self.starts, self.ends, first = words(data, offsets, _BETWEEN)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        self.salts = salts

    def hashes(self, length: int | None) -> np.ndarray:
        ends = self.ends if length is None else np.minimum(self.ends, self.starts + length)
        return mix(word_hashes(self.data, self.starts, ends, long=32) + self.salts[self.text])

    def keep(self, mask: np.ndarray) -> None:
        self.starts, self.ends, self.text = self.starts[mask], self.ends[mask], self.text[mask]


def _runs(hashes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place of one of each hash, texts with it, times, order): ``texts`` ascend."""
    order = np.argsort(hashes, kind="stable")
    h, t = hashes[order], texts[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    other = new.copy()
    other[1:] |= t[1:] != t[:-1]
    heads = np.flatnonzero(new)
    return order[heads], np.add.reduceat(other.astype(np.int64), heads) if len(heads) else np.zeros(0, np.int64), np.diff(np.append(heads, len(h))), order


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def _left(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & _U(FILTER_BITS - 1)
    return (bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 > 0


def _read(batch: pa.RecordBatch, before: int | None, bits: np.ndarray | None) -> Iterator[tuple[int, _Terms]]:
    """Terms by slice of a batch (lang, source, text), only those whose prefix of ``before`` bytes is left."""
    data, offsets = buffers(batch.column(2))
    salts = _salts(batch.column(0))
    for a, b in slices(offsets, SLICE):
        terms = _Terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], salts[a:b])
        if bits is not None:
            terms.keep(_left(bits, terms.hashes(before)))
        yield a, terms


def prefix_counts(rows: DataFrame, length: int, before: int | None = None, left: Broadcast | None = None) -> DataFrame:
    """h, docs: documents of ``rows`` (lang, source, text) by hash of (lang, prefix of ``length`` bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []

        def out() -> pa.RecordBatch:
            h, docs = _merged(found)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(docs)], names=["h", "docs"])

        for batch in batches:
            for _, terms in _read(batch, before, left and left.value):
                h = terms.hashes(length)
                one, docs, _, _ = _runs(h, terms.text)
                found.append((h[one], docs))
                if sum(len(x) for x, _ in found) > HELD:
                    found[:] = [_merged(found)]
                    if len(found[0][0]) > HELD // 2:
                        yield out()
        if found:
            yield out()

    return rows.mapInArrow(run, "h long, docs long").groupBy("h").agg(F.sum("docs").alias("docs"))


def prefix_filter(counts: DataFrame, least: int) -> Broadcast:
    """The hashes of ``counts`` (h, docs) with ``least`` documents, as bits; each piece of them is made by one group."""

    def bits(part: pa.Table) -> pa.Table:
        h = part["h"].to_numpy().view(_U) & _U(FILTER_BITS - 1)
        made = np.zeros(_PIECE, dtype=bool)
        made[(h & _U(_PIECE - 1)).astype(np.int64)] = True
        return pa.table({"piece": [int(h[0] // _U(_PIECE))], "bits": [np.packbits(made, bitorder="little").tobytes()]})

    piece = F.shiftright(F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1)), _PIECE.bit_length() - 1)
    pieces = counts.where(F.col("docs") >= least).select("h", piece.alias("piece")).groupBy("piece").applyInArrow(bits, "piece long, bits binary")
    whole = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in pieces.collect():  # FILTER_BITS / _PIECE rows at most
        whole[row["piece"] * (_PIECE // 8) :][: _PIECE // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return counts.sparkSession.sparkContext.broadcast(whole)


def term_counts(rows: DataFrame, before: int, left: Broadcast) -> DataFrame:
    """lang, source, term, docs, n: complete terms whose prefix of ``before`` bytes is left.

    Tasks add up what they found, as far as it fits; rows are dealt by (lang,
    term), so that what is told of a term over its sources needs no further shuffle.
    """
    names = ["lang", "source", "term", "docs", "n"]

    def added(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by(names[:3]).aggregate([("docs", "sum"), ("n", "sum")]).rename_columns(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            sources = _salts(batch.column(1))
            for a, terms in _read(batch, before, left.value):
                h = mix(terms.hashes(None) + sources[a + terms.text] * _U(0x9E3779B97F4A7C15))
                one, docs, n, _ = _runs(h, terms.text)
                at = pa.array(a + terms.text[one])
                held.append(pa.table([batch.column(0).take(at), batch.column(1).take(at), _strings(terms, one), pa.array(docs), pa.array(n)], names=names))
                size += len(one)
                if size > 2 * ADDED:
                    held = [added(held)]
                    size = len(held[0])
                    if size > ADDED:
                        yield from held.pop().to_batches()
                        size = 0
        if held:
            yield from added(held).to_batches()

    found = rows.mapInArrow(run, "lang string, source string, term string, docs long, n long")
    return found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def _strings(terms: _Terms, at: np.ndarray) -> pa.Array:
    """The terms at these places, A-Z lower-cased."""
    starts, lengths = terms.starts[at], (terms.ends - terms.starts)[at]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    raw = _LOWER[terms.data[flat]].tobytes()
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(raw))


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """lang, source, term, n, lang_n, leads: occurrences of kept terms in each
    source that has them and in the language; ``leads`` marks one row a term.

    ``docs``: lang, source, text."""
    rows = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    before, left = None, None
    for length in levels:
        left, before = prefix_filter(prefix_counts(rows, length, before, left), least), length
    term = Window.partitionBy("lang", "term")
    out = term_counts(rows, before, left)
    out = out.withColumns({"_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term), "leads": F.row_number().over(term.orderBy("source")) == 1})
    return out.where(F.col("_docs") >= least).select("lang", "source", "term", "n", "lang_n", "leads")


def _share(count: str, total: str) -> Column:
    """1 + floor(10^9 (count + 1) / total), exact."""
    return F.expr(f"1 + ((CAST({count} + 1 AS DECIMAL(20, 0)) * {ONE}) div CAST({total} AS DECIMAL(20, 0)))")


def _gap(p: str, q: str) -> Column:
    """floor((p - q)^2 / q); p and q are at most about 10^9, so the square fits."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _shared_sums(counted: DataFrame) -> DataFrame:
    """lang, source, item, shared: what pairs of sources owe to the terms that both have, over what
    the sums with a count of 0 give for these.  A block holds all rows of some terms of one language."""

    def run(part: pa.Table) -> pa.Table:
        terms = part["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        coded = part["source"].combine_chunks().dictionary_encode()
        names, source = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        order = np.argsort(terms, kind="stable")
        terms, source = terms[order], source[order]
        p, p0 = part["p"].to_numpy()[order], part["p0"].to_numpy()[order]
        heads = np.flatnonzero(np.append(True, terms[1:] != terms[:-1]))
        sizes = np.diff(np.append(heads, len(terms)))
        own = np.repeat(sizes, sizes)  # rows of the same term
        first = np.repeat(heads, sizes)
        keys, sums = [], []
        for a, b in slices(np.concatenate([[0], np.cumsum(own)]), 1 << 20):  # pairs at a time
            g = np.repeat(np.arange(a, b), own[a:b])
            h = np.arange(len(g)) - np.repeat(np.cumsum(own[a:b]) - own[a:b], own[a:b]) + first[g]
            g, h = g[g != h], h[g != h]
            value = (p[g] - p[h]) ** 2 // p[h] - (p[g] - p0[h]) ** 2 // p0[h] - (p0[g] - p[h]) ** 2 // p[h] + (p0[g] - p0[h]) ** 2 // p0[h]
            key = source[g] * len(names) + source[h]
            at = np.argsort(key, kind="stable")
            key, value = key[at], value[at]
            edge = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            keys.append(key[edge])
            sums.append(np.add.reduceat(value, edge) if len(edge) else value)
        key, total = _merged(list(zip(keys, sums, strict=True)))
        return pa.table({"lang": part["lang"].combine_chunks()[:1].take(pa.array(np.zeros(len(key), np.int64))), "source": names.take(pa.array(key // len(names))), "item": names.take(pa.array(key % len(names))), "shared": pa.array(total)})

    blocks = -(-counted.count() // BLOCK)
    block = F.pmod(F.xxhash64("term"), F.lit(max(blocks, 1)))
    rows = counted.select("lang", "source", "term", "p", "p0", block.alias("block")).groupBy("lang", "block")
    return rows.applyInArrow(run, "lang string, source string, item string, shared long").groupBy("lang", "source", "item").agg(F.sum(F.col("shared").cast("decimal(38,0)")).alias("shared"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """lang, source, part, item, value, rank of ``docs`` (lang, source, text): part
    ``pair`` has the divergence of a source from each other source of its language,
    part ``term`` the terms, ``top`` at most, that it has oftener than the language."""
    counted = stored(kept_terms(docs, least, levels), "kept_terms")
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = counted.groupBy("lang", "source").agg(F.sum("n").alias("own_total"), F.count("*").alias("terms"))
    langs = counted.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("leads").alias("V"))
    zero = {"own_total": 0, "terms": 0, "lang_total": 0, "V": 0}
    groups = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(zero)
    groups = stored(groups.withColumn("p0", F.when(F.col("V") > 0, _share("0", "own_total + V"))), "groups")

    counted = counted.join(groups, ["lang", "source"]).withColumns({"p": _share("n", "own_total + V"), "q": _share("lang_n", "lang_total + V")})
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = counted.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    other = groups.select("lang", F.col("source").alias("item"), F.col("terms").alias("item_terms"), F.col("p0").alias("q0"))
    pairs = groups.join(other, "lang").where("source <> item")
    levels_of = counted.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))  # a source's terms by how often it has them
    weighed = lambda value: F.sum(F.col("times").cast("decimal(20,0)") * value)
    mine = levels_of.join(other, "lang").groupBy("lang", "source", "item").agg(weighed(_gap("p", "q0")).alias("mine"))
    theirs = levels_of.withColumnsRenamed({"source": "item", "p": "q"}).join(groups.select("lang", "source", "p0"), "lang").groupBy("lang", "source", "item").agg(weighed(_gap("p0", "q")).alias("theirs"))
    pairs = pairs.join(mine, ["lang", "source", "item"], "left").join(theirs, ["lang", "source", "item"], "left").join(_shared_sums(counted), ["lang", "source", "item"], "left")
    nothing = F.lit(0).cast("decimal(38,0)")
    neither = (F.col("V") - F.col("terms") - F.col("item_terms")).cast("decimal(20,0)") * F.coalesce(_gap("p0", "q0"), F.lit(0))
    value = neither + sum((F.coalesce(c, nothing) for c in ("mine", "theirs", "shared")), nothing)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(terms)


#: The rows of op12 as DuckDB SQL.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
occ AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
own AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM occ o JOIN kept k ON o.lang = k.lang AND o.term = k.term GROUP BY ALL),
tot AS (SELECT g.lang, g.source, coalesce(sum(o.n), 0)::HUGEINT AS total FROM grp g LEFT JOIN own o ON g.lang = o.lang AND g.source = o.source GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 1)) // (t.total + l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
  FROM grp g JOIN tot t ON g.lang = t.lang AND g.source = t.source JOIN langs l ON g.lang = l.lang JOIN kept k ON g.lang = k.lang
  LEFT JOIN own o ON g.lang = o.lang AND g.source = o.source AND k.term = o.term),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON a.lang = s.lang AND a.source = s.source AND b.source = s.item),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM terms UNION ALL SELECT * FROM pairs) x)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
