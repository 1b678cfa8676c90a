"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct five-word shingles (64-bit hashes).  Two
sets link when ``100 * |A & B| >= 75 * |A | B|``.  Equal sets are one *node*
from the start.  The tokens of a set are taken in one global order, a fixed
scramble of the hash.  If A and B link, prefixes of ``n - ceil(0.75 n) + l``
tokens (n the set's own size) share at least ``l`` tokens, for any ``l``; with
different ``l`` for A and B they share the smaller number.

1. *Cost pass.*  Every node sends a prefix with ``l = 0.1 n`` to hash buckets
   of tokens.  A bucket tells each node how many of its tokens another node
   has, and how many are *heavy* (in more than ``HEAVY`` nodes).  A node with
   fewer shared tokens than any link needs is alone, and done.
2. *Adaptive prefixes.*  What is left chooses ``l`` from 10, 25, 50 or 75 % of
   its size by the cost that the first pass estimates: heavy tokens make
   candidates that mean nothing, so the prefix grows until the matches needed
   exceed the heavy tokens expected in it.  Heavy tokens then need no pairs at
   all: a pair must share ``min(l) - min(heavy)`` other tokens.
3. *Verification.*  First each node against its best partners, and each heavy
   list against one pivot; links found are joined into components; then only
   candidates whose ends are in different components are verified.
4. *Dense nodes*, whose prefix has ``l`` or more heavy tokens even so, are not
   found by (2).  Each shared token is owned by the least node that has it; a
   node goes to the few owners that own most of its tokens, so a large group of
   near copies meets at one owner.  A group that is one component already is
   done; of another only the members outside its largest component are compared,
   with blocks of all members.  There shared tokens are counted in memory, by
   all 64 bits, and only pairs that join components are told, never the pairs
   of a group.

Tokens that are common inside one Arrow batch are counted there, and against a
pivot of the batch, and only one entry goes on, so in passes 1 and 2 a bucket
never gets all entries of a token that a third of all documents share.

Defined results: null, empty and blank texts have an empty set, link with
nothing and are their own component; repeated rows give repeated output rows;
rows of one doc_id with different texts are one component only if links join
them, and each has the least doc_id it reaches; a row without doc_id is kept,
with null as its component, and is linked with nothing; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.llm._io import Scratch, n_buckets, stored
from loadstone.llm.components import components
from loadstone.llm.textnum import mix, shingle_sets

HEAVY = 48  # a token of more nodes makes no pairs by itself
LOCAL = 64  # a token of more nodes of one batch is heavy, and is thinned there
TIERS = (0.10, 0.25, 0.50, 0.75)
LEFT = 0.37  # of a set's size, at most, outside the families a dense node is sent to
FAMILY = 512  # members of a block: a family is compared block by block


def at_least(n):
    """ceil(0.75 n): shared tokens that a set of n needs for any link."""
    return (3 * n + 3) // 4


def matches(n, tier: float):
    """l of a tier for a set of n."""
    return np.ceil(np.asarray(n) * tier - 1e-9).astype(np.int64).clip(1)


def prefix_length(n, l):
    return np.minimum(n, n - at_least(n) + l)


def fewest_shared(n: np.ndarray) -> np.ndarray:
    """Shared prefix tokens below which a set of n has no partner, whatever its size."""
    return np.minimum(matches(n, TIERS[0]), matches(at_least(n), TIERS[0]))


def node_id(values: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(values.tobytes()) - (1 << 63) if len(values) else 0


def document_nodes(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node) of each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes = [], []
            for values in shingle_sets(batch.column(2), width):
                sizes.append(len(values))
                nodes.append(node_id(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())], names=["doc_id", "text_hash", "n_shingles", "node"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text"), "text").mapInArrow(run, f"doc_id {kind}, text_hash long, n_shingles long, node long")


_ENTRY = np.dtype([("token", "<u4"), ("node", "<i8"), ("n", "<i4"), ("l", "<i4"), ("heat", "<u2"), ("hot", "<u1"), ("dense", "<u1"), ("part", "<i8")])
_SHORT = np.dtype([("token", "<u4"), ("node", "<i8"), ("hot", "<u1")])
_FULL = np.dtype([("token", "<u8"), ("node", "<i8")])


def _columns(entries: np.ndarray) -> bytes:
    """Field after field: compresses better than row after row."""
    return b"".join(np.ascontiguousarray(entries[f]).tobytes() for f in entries.dtype.names)


def _from_columns(raw: bytes, kind: np.dtype) -> np.ndarray:
    n = len(raw) // kind.itemsize
    out, at = np.empty(n, dtype=kind), 0
    for f in kind.names:
        out[f] = np.frombuffer(raw, dtype=kind[f], count=n, offset=at)
        at += n * kind[f].itemsize
    return out


def _prefix(values: np.ndarray, k: int) -> np.ndarray:
    """The first k tokens of a set in the global order."""
    if k >= len(values):
        return values
    order = mix(values ^ np.uint64(0xA0761D6478BD642F))
    return values[np.argpartition(order, k - 1)[:k]]


def _deal(tokens: np.ndarray, entries: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket with its packed entries."""
    home = ((tokens >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(home, kind="stable")
    home, entries = home[order], entries[order]
    cuts = np.flatnonzero(np.diff(home)) + 1
    parts = np.split(entries, cuts)
    keys = home[np.concatenate([[0], cuts])] if len(home) else home
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([_columns(p) for p in parts if len(p)], pa.binary())], names=["bucket", "entries"])


def _runs(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(tokens)))


def _sum_by(nodes: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    keys, where = np.unique(nodes, return_inverse=True)
    return keys, *(np.bincount(where, weights=c, minlength=len(keys)).astype(np.int64) for c in columns)


def _credit_batch(nodes, shared, heavy) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(shared, pa.int64()), pa.array(heavy, pa.int64())], names=["node", "shared", "heavy"])


def shared_tokens(docs: DataFrame, buckets: int, width: int = 5) -> DataFrame:
    """(node, shared, heavy): prefix tokens that other nodes have, and those
    that more than HEAVY nodes have.  Nodes that share none are left out."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, tokens, nodes = set(), [], []
            for values in shingle_sets(batch.column(0), width):
                n = len(values)
                if n and (node := node_id(values)) not in seen:
                    seen.add(node)
                    tokens.append(_prefix(values, int(prefix_length(n, matches(n, TIERS[0])))))
                    nodes.append((node, len(tokens[-1])))
            if not tokens:
                continue
            flat = np.concatenate(tokens)
            entries = np.zeros(len(flat), dtype=_SHORT)
            entries["token"] = flat.astype(np.uint32)
            entries["node"] = np.repeat(np.array([x for x, _ in nodes]), [k for _, k in nodes])
            order = np.argsort(flat, kind="stable")
            starts, sizes = _runs(flat[order])
            hot = np.repeat(sizes > LOCAL, sizes)
            first = np.zeros(len(flat), dtype=bool)
            first[starts] = True
            entries["hot"][order] = hot
            keep = np.empty(len(flat), dtype=bool)
            keep[order] = ~hot | first
            credits = entries["node"][~keep]
            out = _deal(flat[keep], entries[keep], buckets)
            spread = np.arange(out.num_rows) == (int(nodes[0][0]) % out.num_rows)
            packed = [np.ascontiguousarray(np.stack(_sum_by(credits, np.ones(len(credits))))).tobytes() if s and len(credits) else b"" for s in spread]
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(packed, pa.binary())], names=["bucket", "entries", "credits"])

    def count(table: pa.Table) -> pa.Table:
        entries = np.concatenate([_from_columns(x.as_py(), _SHORT) for x in table.column("entries")])
        entries = entries[np.lexsort((entries["node"], entries["token"]))]
        same = np.zeros(len(entries), dtype=bool)
        same[1:] = (entries["token"][1:] == entries["token"][:-1]) & (entries["node"][1:] == entries["node"][:-1])
        entries = entries[~same]
        starts, sizes = _runs(entries["token"])
        hot = np.maximum.reduceat(entries["hot"], starts) > 0
        df, hot = np.repeat(sizes, sizes), np.repeat(hot, sizes)
        is_shared, is_heavy = hot | (df > 1), hot | (df > HEAVY)
        nodes, shared, heavy = entries["node"][is_shared], None, is_heavy[is_shared].astype(np.int64)
        shared = np.ones(len(nodes), dtype=np.int64)
        for raw in (x.as_py() for x in table.column("credits")):
            if raw:
                more = np.frombuffer(raw, dtype=np.int64).reshape(2, -1)
                nodes, shared, heavy = np.append(nodes, more[0]), np.append(shared, more[1]), np.append(heavy, more[1])
        return pa.Table.from_batches([_credit_batch(*_sum_by(nodes, shared, heavy))])

    sent = docs.select("text").mapInArrow(send, "bucket int, entries binary, credits binary")
    return sent.groupBy("bucket").applyInArrow(count, "node long, shared long, heavy long").groupBy("node").agg(F.sum("shared").alias("shared"), F.sum("heavy").alias("heavy"))


def _choose(n: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(l, heat): the shortest prefix in which heavy tokens are expected to be
    fewer than half the matches needed; the longest if none is."""
    base = prefix_length(n, matches(n, TIERS[0]))
    share = np.minimum(heavy / base, 1.0)
    out = matches(n, TIERS[-1])
    for tier in TIERS[-2::-1]:
        l = matches(n, tier)
        out = np.where(share * prefix_length(n, l) < l / 2, l, out)
    return out, (share * 65535).astype(np.uint16)


def _send_prefixes(buckets: int, width: int):
    """mapInArrow function over (node, text, n, heavy, part, dense).

    A token of more than LOCAL nodes of the batch is heavy for certain: its
    pairs with a pivot are made here, and only the pivot's entry goes on.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, n, heavy, part, dense = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4, 5))
            l, heat = _choose(n, heavy)
            tokens = [_prefix(values, int(k)) for values, k in zip(shingle_sets(batch.column(1), width), prefix_length(n, l), strict=True)]
            sizes = [len(t) for t in tokens]
            flat = np.concatenate(tokens)
            entries = np.zeros(len(flat), dtype=_ENTRY)
            entries["token"] = flat.astype(np.uint32)
            for name, column in (("node", node), ("n", n), ("l", l), ("heat", heat), ("part", part), ("dense", dense)):
                entries[name] = np.repeat(column, sizes)
            order = np.argsort(flat, kind="stable")
            flat, entries = flat[order], entries[order]
            starts, sizes = _runs(flat)
            hot = sizes > LOCAL
            keep, local = np.repeat(~hot, sizes), []
            for at, size in zip(starts[hot], sizes[hot], strict=True):
                pivot = at + int(np.lexsort((entries["node"][at : at + size], -entries["heat"][at : at + size].astype(np.int32)))[0])
                keep[pivot] = True
                entries["hot"][pivot] = 1
                mine = entries[at : at + size]
                others = mine[_close_in_size(mine, entries[pivot]) & (mine["node"] != entries["node"][pivot])]
                local += [_pairs(np.repeat(entries[pivot : pivot + 1], len(others)), others, 1), _heavy_counts(mine["node"][mine["node"] != entries["node"][pivot]])]
            out = _deal(flat[keep], entries[keep], buckets)
            held = _pack_pairs(local)
            packed = [held if k == int(node[0]) % out.num_rows else b"" for k in range(out.num_rows)]
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(packed, pa.binary())], names=["bucket", "entries", "pairs"])

    return send


def _heavy_counts(nodes: np.ndarray) -> dict[str, np.ndarray]:
    """Pairs of kind 2: (node, node) with its number of heavy tokens."""
    keys, count = _sum_by(nodes, np.ones(len(nodes)))
    return {"a": keys, "b": keys, "hits": count, "need": np.zeros(len(keys), np.int64), "kind": np.full(len(keys), 2, np.int32)}


_PAIR_FIELDS = (("a", pa.int64()), ("b", pa.int64()), ("hits", pa.int64()), ("need", pa.int64()), ("kind", pa.int32()))


def _summed(found: list[dict[str, np.ndarray]]) -> np.ndarray:
    """Pairs as rows (a, b, hits, need, kind), one for each (a, b, kind)."""
    rows = np.stack([np.concatenate([f[c] for f in found]).astype(np.int64) for c, _ in _PAIR_FIELDS]) if found else np.zeros((5, 0), np.int64)
    rows = rows[:, np.lexsort((rows[4], rows[1], rows[0]))]
    new = np.ones(rows.shape[1], dtype=bool)
    new[1:] = (rows[[0, 1, 4], 1:] != rows[[0, 1, 4], :-1]).any(axis=0)
    at = np.flatnonzero(new)
    if len(at):
        hits = np.add.reduceat(rows[2], at)
        rows = rows[:, at]
        rows[2] = hits
    return rows


def _pack_pairs(found: list[dict[str, np.ndarray]]) -> bytes:
    return _summed(found).tobytes()


def _open(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    entries = np.concatenate([_from_columns(x.as_py(), _ENTRY) for x in table.column("entries")])
    entries = entries[np.argsort(entries["token"], kind="stable")]
    starts, sizes = _runs(entries["token"])
    return entries, starts, sizes


def _close_in_size(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 4 * np.minimum(a["n"], b["n"]).astype(np.int64) >= 3 * np.maximum(a["n"], b["n"])


def _pairs(a: np.ndarray, b: np.ndarray, kind: int) -> dict[str, np.ndarray]:
    """Distinct pairs of entries with the number of lists that have them."""
    low, high = np.minimum(a["node"], b["node"]), np.maximum(a["node"], b["node"])
    need = np.minimum(a["l"], b["l"])
    order = np.lexsort((high, low))
    low, high, need = low[order], high[order], need[order]
    new = np.ones(len(low), dtype=bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    at = np.flatnonzero(new)
    return {"a": low[at], "b": high[at], "hits": np.diff(np.append(at, len(low))), "need": need[at].astype(np.int64), "kind": np.full(len(at), kind, dtype=np.int32)}


_PAIRS = "a long, b long, hits long, need long, kind int"


def _candidates(table: pa.Table) -> pa.Table:
    """kind 0: pairs of light lists; 1: heavy lists against their pivot;
    2: (node, node) with the heavy tokens of the node as hits."""
    entries, starts, sizes = _open(table)
    hot = np.maximum.reduceat(entries["hot"], starts) > 0 if len(starts) else np.zeros(0, dtype=bool)
    found = []
    light = (sizes > 1) & (sizes <= HEAVY) & ~hot
    for size in np.unique(sizes[light]):
        at = starts[light & (sizes == size)]
        i, j = np.triu_indices(size, 1)
        step = max(1, (1 << 20) // len(i))
        for k in range(0, len(at), step):
            a, b = entries[(at[k : k + step, None] + i).ravel()], entries[(at[k : k + step, None] + j).ravel()]
            ok = _close_in_size(a, b)
            found.append(_pairs(a[ok], b[ok], 0))
    for k in np.flatnonzero((sizes > HEAVY) | hot):
        part = entries[starts[k] : starts[k] + sizes[k]]
        pivot = part[np.lexsort((part["node"], -part["heat"].astype(np.int32)))[:1]]
        others = part[_close_in_size(part, pivot) & (part["node"] != pivot["node"])]
        found.append(_pairs(np.repeat(pivot, len(others)), others, 1))
        found.append(_heavy_counts(part["node"]))
    for raw in (x.as_py() for x in table.column("pairs")):
        if raw:
            rows = np.frombuffer(raw, dtype=np.int64).reshape(5, -1)
            found.append({c: rows[i] for i, (c, _) in enumerate(_PAIR_FIELDS)})
    rows = _summed(found)
    return pa.table({c: pa.array(rows[i], t) if t == pa.int64() else pa.array(rows[i].astype(np.int32), t) for i, (c, t) in enumerate(_PAIR_FIELDS)})


def _send_all(buckets: int, width: int):
    """mapInArrow function over (node, text): all tokens to their buckets."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                tokens = list(shingle_sets(part.column(1), width))
                flat = np.concatenate(tokens)
                entries = np.zeros(len(flat), dtype=_FULL)
                entries["token"] = flat
                entries["node"] = np.repeat(part.column(0).to_numpy(zero_copy_only=False), [len(t) for t in tokens])
                yield _deal(flat, entries, buckets)

    return send


_OWNED = np.dtype([("token", "<u8"), ("owner", "<i8")])


def _owners(table: pa.Table) -> pa.Table:
    """Per node of a bucket: its tokens that other nodes have, each with its
    owner, the least node that has it."""
    entries = np.concatenate([_from_columns(x.as_py(), _FULL) for x in table.column("entries")])
    entries = entries[np.lexsort((entries["node"], entries["token"]))]
    starts, sizes = _runs(entries["token"])
    keep = np.repeat(sizes, sizes) > 1
    nodes, out = entries["node"][keep], np.empty(int(keep.sum()), dtype=_OWNED)
    out["token"], out["owner"] = entries["token"][keep], np.repeat(entries["node"][starts], sizes)[keep]
    order = np.argsort(nodes, kind="stable")
    nodes, out = nodes[order], out[order]
    cuts = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1], [True]])) if len(nodes) else np.zeros(1, np.int64)
    packed = [_columns(out[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"node": pa.array(nodes[cuts[:-1]], pa.int64()), "owned": pa.array(packed, pa.binary())})


def _to_families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over (node, n, part, dense, owned): the node, with
    its shared tokens, for each of the owners that it needs.

    Owners are taken by their number of tokens until at most ``LEFT`` of the
    set's size is outside.  A pair that links shares three quarters of the
    larger set; less than that is outside for the two together, so they meet.
    """
    for batch in batches:
        rows = []
        for node, n, part, dense, owned in zip(*batch.columns, strict=True):
            parts = [_from_columns(x.as_py(), _OWNED) for x in owned] if owned.is_valid else []
            if not parts:
                continue
            own = np.concatenate(parts)
            owners, counts = np.unique(own["owner"], return_counts=True)
            order = np.argsort(-counts, kind="stable")
            outside = len(own) - np.cumsum(counts[order])
            need = int(np.argmax(outside <= LEFT * n.as_py())) + 1
            tokens = np.sort(own["token"]).tobytes()
            rows += [(int(f), node.as_py(), n.as_py(), part.as_py(), dense.as_py(), tokens) for f in owners[order[:need]]]
        for first in range(0, len(rows), 4096):
            columns = zip(*rows[first : first + 4096], strict=True)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["family", "node", "n", "part", "dense", "tokens"])


def _link_family(table: pa.Table) -> pa.Table:
    """Pairs (member, other) of a block, one dense and in different components, that
    link by their shared tokens: as many as join the components, and no more.

    Rows with ``other`` are what is compared with the rest.  Shared tokens are
    counted exactly, so a merge here is a link and hides none.
    """
    node, n, part, dense, other = (table.column(c).to_numpy() for c in ("node", "n", "part", "dense", "other"))
    _, part = np.unique(part, return_inverse=True)
    found: list[tuple[int, int]] = []
    rest, ask = np.flatnonzero(other == 0), np.flatnonzero(other == 1)
    if len(rest) and len(ask) and part.max() > 0 and dense.any():
        sets = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("tokens")]
        flat, owner = np.concatenate([sets[i] for i in rest]), np.repeat(rest, [len(sets[i]) for i in rest])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        for z in ask:
            if (part[rest] == part[z]).all():
                continue
            begin, end = np.searchsorted(flat, sets[z], "left"), np.searchsorted(flat, sets[z], "right")
            reps = end - begin
            at = np.repeat(begin, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            shared = np.bincount(owner[at], minlength=len(sets))
            links = (other == 0) & ((dense > 0) | (dense[z] > 0)) & (100 * shared >= 75 * (n + n[z] - shared)) & (part != part[z])
            for y in np.flatnonzero(links):
                if part[y] != part[z]:
                    found.append((int(node[z]), int(node[y])))
                    part[part == part[y]] = part[z]
    a, b = np.array(found, dtype=np.int64).reshape(-1, 2).T
    return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


def dealt_families(members: DataFrame) -> DataFrame:
    """Members of families in blocks: columns of members, ``other`` and ``block``.

    Every pair of which one member is outside the family's largest component
    meets in one block.  A family of one component is left out; where few
    members are outside, every other member is in one block only.
    """
    parts = members.groupBy("family", "part").agg(F.count("*").alias("_size"), F.max("dense").alias("_dense"))
    families = parts.groupBy("family").agg(F.sum("_size").alias("_all"), F.max(F.struct("_size", "part")).alias("_top"), F.max("_dense").alias("_dense"), F.count("*").alias("_parts"))
    families = families.where("_parts > 1 and _dense = 1").select(
        "family", F.col("_top.part").alias("_main"), F.ceil(F.col("_all") / FAMILY).cast("int").alias("_blocks"),
        F.ceil((F.col("_all") - F.col("_top._size")) / FAMILY).cast("int").alias("_asks"),
    )
    joined = members.join(families, "family")
    own = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    each = lambda count, f: F.transform(F.sequence(F.lit(0), F.col(count) - 1), f)
    place = lambda other, i, j: F.struct(F.lit(other).alias("other"), F.xxhash64("family", i, j).alias("block"))
    asked = F.when(F.col("part") != F.col("_main"), each("_blocks", lambda j: place(1, own("_asks"), j)))
    held = each("_asks", lambda i: place(0, i, own("_blocks")))
    places = F.concat(held, F.coalesce(asked, F.slice(held, 1, 0)))
    return joined.withColumn("_at", F.explode(places)).select("node", "n", "part", "dense", "tokens", "_at.other", "_at.block")


def verified(pairs: DataFrame, texts: DataFrame, width: int = 5) -> DataFrame:
    """The pairs (a, b) whose sets link, by their exact shared and joint sizes."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(shingle_sets(batch.column(2), width), shingle_sets(batch.column(3), width), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(test, "a long, b long")


def _best(pairs: DataFrame) -> DataFrame:
    """Each node's partner with the most shared tokens."""
    both = pairs.select("a", "b", "hits").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "hits"))
    best = both.groupBy("a").agg(F.max_by("b", F.struct("hits", "b")).alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _different(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    left = parts.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
    right = parts.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
    joined = pairs.join(left, "a", "left").join(right, "b", "left")
    return joined.where(~F.coalesce(F.col("_ra"), F.col("a")).eqNullSafe(F.coalesce(F.col("_rb"), F.col("b")))).drop("_ra", "_rb")


def merged_parts(parts: DataFrame, more: DataFrame, scratch: Scratch) -> DataFrame:
    """Components (node, root) with further links: only the roots that these join are worked on."""
    ends = more.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = parts.union(ends.join(parts, "node", "left_anti").select("node", F.col("node").alias("root")))
    left, right = (known.select(F.col("node").alias(c), F.col("root").alias(f"_r{c}")) for c in ("a", "b"))
    tops = components(more.join(left, "a").join(right, "b").select(F.col("_ra").alias("a"), F.col("_rb").alias("b")), scratch=scratch)
    tops = tops.select(F.col("node").alias("root"), F.col("root").alias("_top"))
    return known.join(tops, "root", "left").select("node", F.coalesce("_top", "root").alias("root"))


def jaccard_components(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id per row of docs (doc_id, text).

    component_id is the least doc_id reachable by links; class_id the least
    doc_id of documents with the same set.
    """
    docs = docs.select("doc_id", "text")
    buckets, scratch = n_buckets(docs), Scratch(docs.sparkSession)
    nodes = stored(document_nodes(docs, width), "nodes")
    classes = nodes.where("n_shingles > 0 and doc_id is not null").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("_least"), F.first("n_shingles").alias("n"))
    classes = classes.select("node", F.col("_least.doc_id").alias("class_id"), F.col("_least.text_hash").alias("text_hash"), "n")

    # 1: what can have a partner at all
    n = F.col("n")
    first_l = lambda x: F.greatest(F.ceil(x * TIERS[0] - 1e-9), F.lit(1))
    fewest = F.least(first_l(n), first_l(F.floor((3 * n + 3) / 4)))
    named = docs.where(F.col("doc_id").isNotNull())
    alive = shared_tokens(named, buckets, width).join(classes, "node").where(F.col("shared") >= fewest)
    texts = named.withColumn("text_hash", F.xxhash64("text")).join(alive.withColumnRenamed("class_id", "doc_id"), ["doc_id", "text_hash"])
    texts = scratch.stored(texts.select("node", "text", "n", "heavy").dropDuplicates(["node"]), "texts")

    # 2: candidates
    plain = texts.select("node", "text", "n", "heavy", F.lit(0).cast("long").alias("part"), F.lit(0).alias("dense"))
    sent = plain.mapInArrow(_send_prefixes(buckets, width), "bucket int, entries binary, pairs binary")
    raw = sent.groupBy("bucket").applyInArrow(_candidates, _PAIRS).groupBy("a", "b", "kind").agg(F.sum("hits").alias("hits"), F.first("need").alias("need"))
    raw = scratch.stored(raw, "candidates")
    heavy = raw.where("kind = 2").select(F.col("a").alias("_node"), F.col("hits").alias("_heavy"))
    light = raw.where("kind = 0").drop("kind")
    for side in ("a", "b"):
        light = light.join(heavy.select(F.col("_node").alias(side), F.col("_heavy").alias(f"_h{side}")), side, "left")
    light = light.where(F.col("hits") >= F.greatest(F.lit(1), F.col("need") - F.least(F.coalesce("_ha", F.lit(0)), F.coalesce("_hb", F.lit(0))))).select("a", "b", "hits")
    pivots = raw.where("kind = 1").select("a", "b", "hits")

    # 3: verification, best partners first
    first = _best(light).union(_best(pivots)).distinct()
    links = scratch.stored(verified(first, texts, width), "links")
    parts = scratch.stored(components(links, scratch=scratch), "parts")
    rest = _different(light.select("a", "b").union(pivots.select("a", "b")).distinct().join(first, ["a", "b"], "left_anti"), parts)
    more = scratch.stored(verified(rest, texts, width), "links")
    if not more.isEmpty():
        parts = scratch.stored(merged_parts(parts, more, scratch), "parts")

    # 4: dense nodes, with the nodes that could be their partners: those with as
    # many heavy tokens as the fewest matches asked of any size near theirs
    lengths = texts.select("node", "n", F.col("heavy").alias("_est"))
    known = heavy.join(lengths, F.col("_node") == F.col("node"))
    fewest_any = F.least(first_l(F.col("n")), first_l(F.floor((3 * F.col("n") + 3) / 4)))
    dense = known.where(F.col("_heavy") >= fewest_any).select("node", (F.col("_heavy") >= _l_column(F.col("n"), F.col("_est"))).cast("int").alias("dense"))
    dense = scratch.stored(dense, "dense")
    if not dense.where("dense = 1").isEmpty():
        near = texts.join(dense, "node").join(parts, "node", "left").select("node", "text", "n", F.coalesce("root", "node").alias("part"), "dense")
        owned = near.select("node", "text").mapInArrow(_send_all(max(16, buckets // 16), width), "bucket int, entries binary").groupBy("bucket").applyInArrow(_owners, "node long, owned binary")
        owned = owned.groupBy("node").agg(F.collect_list("owned").alias("owned"))
        members = near.drop("text").join(owned, "node").select("node", "n", "part", "dense", "owned").mapInArrow(_to_families, "family long, node long, n long, part long, dense int, tokens binary")
        members = scratch.stored(members, "members")
        left = dealt_families(members).groupBy("block").applyInArrow(_link_family, "a long, b long").distinct()
        more = scratch.stored(verified(left, texts, width), "links")
        if not more.isEmpty():
            parts = scratch.stored(merged_parts(parts, more, scratch), "parts")

    parts = stored(parts, "parts")
    scratch.clear()  # what follows reads nodes and parts alone

    least = parts.join(classes.select("node", "class_id"), "node").groupBy("root").agg(F.min("class_id").alias("_least"))
    named = parts.join(least, "root").select("node", "_least")
    out = nodes.join(classes.select("node", "class_id"), "node", "left").join(named, "node", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return out.select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.coalesce("_least", "class_id", "doc_id")).alias("component_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.coalesce("class_id", "doc_id")).alias("class_id"),
    )


def _l_column(n, heavy):
    """The l of :func:`_choose` as a column."""
    l_of = lambda tier: F.greatest(F.ceil(n * tier - 1e-9), F.lit(1))
    length = lambda l: F.least(n, n - F.floor((3 * n + 3) / 4) + l)
    share = F.least(heavy / length(l_of(TIERS[0])), F.lit(1.0))
    out = l_of(TIERS[-1])
    for tier in TIERS[-2::-1]:
        out = F.when(share * length(l_of(tier)) < l_of(tier) / 2, l_of(tier)).otherwise(out)
    return out


#: The rows of op1 as DuckDB SQL, by comparing all pairs that share a shingle: for small tables.
ORACLE = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s FROM cut),
sized AS (SELECT doc_id, s, len(s)::BIGINT AS n, md5(array_to_string(s, chr(10))) AS k FROM sets),
one AS (SELECT doc_id, n, unnest(s) AS x FROM sized),
linked AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id, doc_id AS root FROM sized
  UNION
  SELECT l.b, r.root FROM reached r JOIN linked l ON l.a = r.doc_id)
SELECT s.doc_id, s.n AS n_shingles, r.component_id, CASE WHEN s.n = 0 THEN s.doc_id ELSE min(s.doc_id) OVER (PARTITION BY s.k) END AS class_id
FROM sized s JOIN (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id) r USING (doc_id)
"""
