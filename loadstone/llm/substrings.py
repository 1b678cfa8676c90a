"""Substring deduplication by content-defined chunking.

A gear rolling hash over the last ``WINDOW`` bytes cuts a text where it falls
under a threshold, so cuts depend on content alone: text inserted before a
passage moves its chunks but does not change them, and the same passage in two
documents has the same chunks from its first cut on.  What is compared is not
the chunk but the *group*: consecutive chunks with ``min_words`` whole words
between them, the shortest from each chunk on and the shortest up to each
chunk.  A word is whole in a group if white space or an end of the text bounds
it there, so groups too depend on content alone.  Groups are compared by a
64-bit digest of their chunks; the occurrence at the least (doc_id, position)
stays, and groups in other documents are cut out, at the white space inside.

Every group that is cut is a passage of one earlier document, unless two
digests collide.  A group carries its position in the holder: groups that
follow each other there as they do here are one span, others are spans of their
own, so that one earlier place, as it was given, holds the whole of each span:
an earlier document, or an earlier part of the same document that the group
does not overlap (a longer span of a text that repeats itself without a break
may overlap the place that holds it).  A passage that two documents share is cut wherever it
holds a group, which a passage of ``2 * min_words`` words nearly always does (0.9 or more
of them, of 50 words all: ``test_recall_by_length``).  A shorter one may have no group
between its cuts and stay: of 20 to 30 words less than two thirds are found.

A group goes to a hash bucket of its digest once per Arrow batch, for the least
document of the batch that has it, so a group that a third of all documents
share is one entry per batch.  The bucket answers that document with the owner;
the other documents of the batch are packed into a *chain* row of the least one
and take its answers by one join.  So every document learns the owner of all
the corpus, whatever the partitions, and results do not depend on the layout.

Defined results: null and empty texts, and documents without a repeated group,
stay as they are; rows with one doc_id are one document; rows without doc_id
are neither compared nor changed; among equal texts the least doc_id keeps its
text; other columns are passed on whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.llm._io import n_buckets, stored
from loadstone.llm.near import _columns, _from_columns
from loadstone.llm.textnum import _WS, buffers, mix, slices, word_hashes, words

MEAN = 20  # bytes of a chunk, on average
WINDOW = 16  # bytes that decide a cut
LONGEST = 256  # bytes of a chunk, at most
MIN_WORDS = 20  # whole words of a group; passages of twice as many are found

_GEAR = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)).astype(np.uint32)
_ENTRY = np.dtype([("digest", "<u8"), ("doc", "<i8"), ("at", "<i4")])
_FOUND = np.dtype([("digest", "<u8"), ("owner", "<i8"), ("place", "<i4")])
_LINK = np.dtype([("digest", "<u8"), ("doc", "<i8"), ("place", "<i4")])
_BASE = 0x9E3779B97F4A7C1B  # 3 modulo 8: powers of it differ in all but a few low bits


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): chunks of each text; text i has first[i]:first[i + 1]."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    gear = _GEAR[data]
    span = 1
    while span < WINDOW:  # doubling: the hash of 2k bytes from two hashes of k bytes
        gear[span:] += gear[:-span] << np.uint32(span)
        span *= 2
    cut = np.flatnonzero(gear < np.uint32((1 << 32) // MEAN)) + 1
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    # a hash whose window reaches into the text before is no cut
    owner = np.searchsorted(begin, cut - 1, side="right") - 1
    cut = cut[cut - begin[owner] >= WINDOW]
    edges = np.unique(np.concatenate([begin, cut, [len(data)]]))
    gaps = np.diff(edges)
    long = np.flatnonzero(gaps > LONGEST)
    if len(long):
        extra = [np.arange(edges[k] + LONGEST, edges[k + 1], LONGEST) for k in long]
        edges = np.unique(np.concatenate([edges, *extra]))
    starts, ends = edges[:-1], edges[1:]
    return starts, ends, np.searchsorted(starts, offsets)


def groups(data: np.ndarray, offsets: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """(starts, ends, first, head, tail, digest, at): chunks as of :func:`chunks`;
    group k is chunks head[k] to tail[k], and text i has at[i]:at[i + 1]."""
    starts, ends, first = chunks(data, offsets)
    begin, end, word_first = words(data, offsets)
    n = len(starts)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    left, right = offsets[:-1][text], offsets[1:][text]
    # the shortest from each chunk on
    k = np.searchsorted(begin, starts + (starts > left)) + min_words - 1
    head = np.flatnonzero(k < word_first[1:][text])
    tail = np.searchsorted(ends, np.minimum(end[k[head]] + 1, right[head]))
    # the shortest up to each chunk
    k = np.searchsorted(end, ends - (ends < right), side="right") - min_words
    last = np.flatnonzero(k >= word_first[:-1][text])
    back = np.searchsorted(starts, np.maximum(begin[k[last]] - 1, left[last]), side="right") - 1
    both = np.unique(np.concatenate([head * n + tail, back * n + last]))
    head, tail = both // max(n, 1), both % max(n, 1)
    up, down = (np.cumprod(np.full(n + 1, x, dtype=np.uint64)) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word_hashes(data, starts, ends, fold=False, long=LONGEST) * up[:n], dtype=np.uint64)])
    digest = mix((sums[tail + 1] - sums[head]) * down[head] + (tail - head).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    return starts, ends, first, head, tail, digest, np.searchsorted(head, first)


def _firsts(keys: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Mask of entries that differ from the one before in any of the columns."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    for column in more:
        new[1:] |= column[1:] != column[:-1]
    return new


def _rows(kind: int, keys: np.ndarray, entries: np.ndarray, home: np.ndarray | None = None, buckets: int = 1) -> pa.RecordBatch:
    """One row (bucket, kind, doc_id, packed) per key with its entries; rows
    without a home are spread over the buckets by their key."""
    order = np.argsort(keys, kind="stable")
    keys, entries = keys[order], entries[order]
    cuts = np.append(np.flatnonzero(_firsts(keys)), len(keys)) if len(keys) else np.zeros(1, np.int64)
    keys = keys[cuts[:-1]]
    packed = [_columns(entries[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    buckets_of = keys if home is not None else (mix(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(buckets_of, pa.int64()), pa.array(np.full(len(keys), kind), pa.int32()), pa.array(keys, pa.int64()), pa.array(packed, pa.binary())], names=["bucket", "kind", "doc_id", "packed"])


_GROUPS, _ANSWER, _CHAIN = 0, 1, 2  # kinds of rows
_SENT = "bucket long, kind int, doc_id long, packed binary"


def _send(buckets: int, min_words: int):
    """mapInArrow function over (doc_id, text): rows of groups for the buckets;
    groups that repeat inside a document, as answers; chains of later documents."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            parts, spans = [], []
            for a, b in slices(offsets):
                _, _, first, head, tail, digest, at = groups(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], min_words)
                one = np.zeros(len(head), dtype=_ENTRY)
                one["digest"] = digest
                counts = np.diff(at)
                one["doc"] = np.repeat(ids[a:b], counts)
                one["at"] = head - np.repeat(first[:-1], counts)
                parts.append(one)
                spans.append(tail - head)
            entries = np.concatenate(parts) if parts else np.zeros(0, _ENTRY)
            if not len(entries):
                continue
            order = np.lexsort((entries["at"], entries["doc"], entries["digest"]))
            entries, span = entries[order], np.concatenate(spans)[order]
            new = _firsts(entries["digest"], entries["doc"])
            mine = np.cumsum(new) - 1
            own = entries[new]  # the first of each group in each document
            again = np.unique(mine[entries["at"] > own["at"][mine] + span])
            if len(again):
                yield _rows(_ANSWER, own["doc"][again], _found(own[again], own[again]), buckets=buckets)
            lead = _firsts(own["digest"])
            heads = own[lead]
            later, holder = own[~lead], heads[np.cumsum(lead) - 1][~lead]
            if len(later):
                chain = np.empty(len(later), dtype=_LINK)
                chain["digest"], chain["doc"], chain["place"] = later["digest"], later["doc"], holder["at"]
                yield _rows(_CHAIN, holder["doc"], chain, buckets=buckets)
            home = ((heads["digest"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            yield _rows(_GROUPS, home, heads, home)

    return send


def _found(entries: np.ndarray, holders: np.ndarray) -> np.ndarray:
    out = np.empty(len(entries), dtype=_FOUND)
    out["digest"], out["owner"], out["place"] = entries["digest"], holders["doc"], holders["at"]
    return out


def _settle(table: pa.Table) -> pa.Table:
    """Answers to all documents of a bucket but the owner of each group; answers and chains are passed on."""
    table = table.combine_chunks()
    is_group = pa.compute.equal(table.column("kind"), _GROUPS)
    out = [table.filter(pa.compute.invert(is_group)).select(["kind", "doc_id", "packed"])]
    packed = table.filter(is_group).column("packed")
    if len(packed):
        entries = np.concatenate([_from_columns(x.as_py(), _ENTRY) for x in packed])
        entries = entries[np.lexsort((entries["at"], entries["doc"], entries["digest"]))]
        lead = _firsts(entries["digest"])
        owners = entries[lead][np.cumsum(lead) - 1]
        # a document that has a group in several batches needs one answer
        ask = _firsts(entries["digest"], entries["doc"]) & (entries["doc"] != owners["doc"])
        answers = _rows(_ANSWER, entries["doc"][ask], _found(entries[ask], owners[ask]))
        out.append(pa.Table.from_batches([answers.select(["kind", "doc_id", "packed"])]))
    return pa.concat_tables(t.cast(pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("packed", pa.binary())])) for t in out)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over (holder, chain, answers to the holder): answers to the documents of the chain."""
    for batch in batches:
        for holder, chain, answers in zip(*batch.columns, strict=True):
            links = _from_columns(chain.as_py(), _LINK)
            known = np.concatenate([_from_columns(x.as_py(), _FOUND) for x in answers]) if answers.is_valid else np.zeros(0, _FOUND)
            known = known[known["owner"] != holder.as_py()]
            known = known[np.lexsort((known["owner"], known["digest"]))]
            out = np.empty(len(links), dtype=_FOUND)
            out["digest"], out["owner"], out["place"] = links["digest"], holder.as_py(), links["place"]
            if len(known):
                where = np.minimum(np.searchsorted(known["digest"], links["digest"]), len(known) - 1)
                hit = known["digest"][where] == links["digest"]
                out["owner"][hit], out["place"][hit] = known["owner"][where[hit]], known["place"][where[hit]]
            yield _rows(_ANSWER, links["doc"], out).select(["doc_id", "packed"])


def repeated_groups(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, packed list): groups of each document with their owner in the corpus, where that is
    another document or an earlier place of the document itself."""
    buckets = n_buckets(docs)
    named = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    settled = named.mapInArrow(_send(buckets, min_words), _SENT).groupBy("bucket").applyInArrow(_settle, "kind int, doc_id long, packed binary")
    settled = stored(settled, "groups")
    answers = settled.where(F.col("kind") == _ANSWER).select("doc_id", "packed")
    listed = answers.groupBy("doc_id").agg(F.collect_list("packed").alias("answers"))
    chains = settled.where(F.col("kind") == _CHAIN).select("doc_id", F.col("packed").alias("chain"))
    chained = chains.join(listed, "doc_id", "left").select("doc_id", "chain", "answers").mapInArrow(_resolve, "doc_id long, packed binary")
    return answers.union(chained).groupBy("doc_id").agg(F.collect_list("packed").alias("packed"))


def held_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, found: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, holder) of spans to cut out of one text, in order and apart.

    Groups that an earlier place holds are chunks begin[k] to end[k] of
    ``found`` with their bytes in ``data``: one row (head, tail, owner, place) each.
    """
    head, tail, owner, place = found
    order = np.lexsort((tail, head, place - head, owner))
    head, tail, owner, place = (x[order] for x in (head, tail, owner, place))
    # in the holder too the next group follows or overlaps: same distance, no chunk between
    apart = (np.diff(owner) != 0) | (np.diff(place - head) != 0) | (head[1:] > tail[:-1] + 1)
    cuts = np.concatenate([[0], np.flatnonzero(apart) + 1, [len(head)]])
    blank = _WS[data]
    spans = []
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        a, b = int(begin[head[i]]), int(end[tail[j - 1]])
        if a > 0 and not blank[a - 1]:  # whole words only
            a += int(np.argmax(blank[a:b])) if blank[a:b].any() else b - a
        if b < len(data) and not blank[b] and b > a:
            b -= int(np.argmax(blank[a:b][::-1])) if blank[a:b].any() else b - a
        spans.append((a, -b, int(owner[i])))
    out, done = [], 0
    for a, b, holder in sorted(spans):
        if -b > max(a, done):
            out.append((max(a, done), -b, holder))
            done = -b
    # the words around what goes stay two words: one blank of it is kept
    first = 0
    for k, (a, b, holder) in enumerate(out):
        first = a if not k or out[k - 1][1] != a else first
        ends = k + 1 == len(out) or out[k + 1][0] != b
        if ends and 0 < first and b < len(data) and not blank[first - 1] and not blank[b] and blank[b - 1]:
            out[k] = (a, b - 1, holder)
    return [x for x in out if x[0] < x[1]]


def _spans(ids: pa.Array, texts: pa.Array, packed: pa.Array, min_words: int) -> Iterator[list[tuple[int, int, int]]]:
    """:func:`held_spans` of each text, given the packed answers to its document."""
    data, offsets = buffers(texts)
    for a, b in slices(offsets):
        part, edge = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, first, head, tail, digest, at = groups(part, edge, min_words)
        for i in range(b - a):
            found = np.concatenate([_from_columns(x.as_py(), _FOUND) for x in packed[a + i]])
            found = found[np.lexsort((found["owner"], found["digest"]))]  # the least owner first
            mine = slice(at[i], at[i + 1])
            where = np.minimum(np.searchsorted(found["digest"], digest[mine]), len(found) - 1)
            hit = found["digest"][where] == digest[mine]
            # of a group of its own a document keeps the first, and what overlaps it
            inside = (found["owner"][where] == ids[a + i].as_py()) & (head[mine] - first[i] <= found["place"][where] + (tail - head)[mine])
            hit = np.flatnonzero(hit & ~inside)
            if not len(hit):
                yield []
                continue
            held = found[where[hit]]
            chunk = slice(first[i], first[i + 1])
            yield held_spans(part[edge[i] : edge[i + 1]], starts[chunk] - edge[i], ends[chunk] - edge[i], (head[mine][hit] - first[i], tail[mine][hit] - first[i], held["owner"], held["place"].astype(np.int64)))


def _with_numbers(docs: DataFrame, min_words: int) -> DataFrame:
    """:func:`dedup_substrings` for ids that are no integers: hashes stand for them, so which of two
    documents is the earlier one is told by hash, and ``held_by`` is turned back."""
    numbered = docs.select(F.xxhash64("doc_id").alias("doc_id"), "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    numbered = numbered.withColumn("doc_id", F.when(F.col("row.doc_id").isNotNull(), F.col("doc_id")))
    out = stored(dedup_substrings(numbered, min_words).withColumn("place", F.monotonically_increasing_id()), "numbered")
    names = docs.where(F.col("doc_id").isNotNull()).select(F.xxhash64("doc_id").alias("number"), F.col("doc_id").alias("name")).distinct()
    held = out.select("place", F.explode("held_by").alias("number")).join(names, "number").groupBy("place").agg(F.array_sort(F.collect_set("name")).alias("names"))
    kind = f"array<{docs.schema['doc_id'].dataType.simpleString()}>"
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("removed_spans", "removed_bytes", "held_by")]
    return out.join(held, "place", "left").select(*columns, "removed_spans", "removed_bytes", F.coalesce("names", F.array().cast(kind)).alias("held_by"))


def dedup_substrings(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with text cut, and removed_spans (byte offsets in the old text, each
    span held whole by one document of held_by), removed_bytes and held_by
    (doc_ids of the earlier documents, or the document itself) appended."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return _with_numbers(docs, min_words)
    columns = [c for c in docs.columns if c not in ("removed_spans", "removed_bytes", "held_by")]
    free = max(map(len, columns)) * "_"  # longer than any name of docs once a name is added
    key, packed_as = f"{free}id", f"{free}packed"
    found = repeated_groups(docs, min_words).select(F.col("doc_id").alias(key), F.col("packed").alias(packed_as))
    joined = docs.select(*(F.col(f"`{c}`") for c in columns)).join(found, F.col("doc_id") == F.col(key), "left").drop(key)
    place, named = columns.index("text"), columns.index("doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                old, packed = part.column(place), part.column(len(columns))
                some = pa.array(np.flatnonzero(np.array([t.is_valid and p.is_valid for t, p in zip(old, packed, strict=True)], dtype=bool)))
                removed = dict(zip(some.to_pylist(), _spans(part.column(named).take(some), old.take(some), packed.take(some), min_words), strict=True))
                texts, spans, sizes, holders = [], [], [], []
                for i, text in enumerate(old.to_pylist()):
                    out = removed.get(i, [])
                    if out:
                        raw = text.encode()
                        edges = [0, *(x for a, b, _ in out for x in (a, b)), len(raw)]
                        text = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode()
                    texts.append(text)
                    spans.append([{"start": a, "end": b} for a, b, _ in out])
                    sizes.append(sum(b - a for a, b, _ in out))
                    holders.append(sorted({x for _, _, x in out}))
                arrays = list(part.columns[: len(columns)])
                arrays[place] = pa.array(texts, pa.string())
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(spans, span), pa.array(sizes, pa.int64()), pa.array(holders, pa.list_(pa.int64()))], names=[*columns, "removed_spans", "removed_bytes", "held_by"])

    extra = T._parse_datatype_string("removed_spans array<struct<start: bigint, end: bigint>>, removed_bytes bigint, held_by array<bigint>")
    return joined.mapInArrow(cut, T.StructType([*(docs.schema[c] for c in columns), *extra.fields]))
