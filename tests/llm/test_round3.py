"""Encoding, alignment and divergence against the libraries and plain loops."""

import collections
import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadstone.llm import align, bpe, divergence, queries, substrings
from loadstone.llm.tokens import byte_letters

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS, BYTES, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
PARTS = [" ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "e", "́", "É", "İ", "Σ", "ΑΣ", "ß", "'s", "'S", "'ll", "1", "23", "½", "Ⅷ", "<|endoftext|>", "<|startoftext|>", "<s>", "<0x41>", "hello", "THE", "the", "😀", "👍🏽",
         "한국", "각", "ᄀ", "ᅡ", "—", "!!", ".", "\u0000", "�", "ﬁ", "ǅ", "क", "ि", "\U0001f1e9", "‍", "\U00010400", "aaaaaaa", "ababab", "Ⴘ", "²", "ʰ", "ｆ", "Ａ", "a b", "word "]


def strange_texts(n, seed, extra=()):
    rng = random.Random(seed)
    return ["".join(rng.choice([*PARTS, *extra]) for _ in range(rng.randrange(1, 25))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("special", [True, False])
def test_encoding_equals_the_library(path, special):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = not special
    texts = [*strange_texts(4000, 1), "", " ", "a" * 3000, "ab" * 3000 + " " + "x'" * 500]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    one, decoder = bpe.Encoder(path, special), bpe.Decoder(path)
    for _ in range(2):  # the second time from what is remembered
        assert [np.frombuffer(x, "<i4").tolist() for x in one(texts)] == want
    assert [decoder(ids) for ids in want] == [library.decode(ids, skip_special_tokens=False) for ids in want]


def test_small_dictionaries_and_blocks_give_the_same(monkeypatch):
    texts = strange_texts(600, 2)
    want = bpe.Encoder(WORDS)(texts)
    for name, value in (("SYMBOLS", 64), ("LONGEST", 3), ("MANY", 2)):
        monkeypatch.setattr(bpe, name, value)
    one = bpe.Encoder(WORDS, remembered=20)
    assert [x for k in range(0, 600, 50) for x in one(texts[k : k + 50])] == want


def test_other_vocabularies_are_refused(tmp_path):
    spec = json.load(open(WORDS, encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="follow"):
        bpe.Encoder(str(tmp_path / "v.json"))
    spec["model"]["dropout"] = 0.1
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="dropout"):
        bpe.Encoder(str(tmp_path / "v.json"))


def test_op13_rows(spark, sf):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    rows = [(i, t, 1, 2) for i, t in enumerate([None, "", *strange_texts(300, 3)])] + [(None, "null id", 1, 2), (5, "again", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, _range int")
    got = bpe.decode(bpe.encode(docs, WORDS), WORDS).collect()
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(repr, [(r.doc_id, r.ids, r.text) for r in got])) == sorted(map(repr, want))
    assert bpe.encode(docs.limit(0), WORDS).isEmpty()
    told = {r.doc_id: r for r in queries.op13_bpe(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert told[r.doc_id].n_tokens == len(ids) and told[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert told[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# --- alignment ---------------------------------------------------------------------


def plain_alignment(rows):
    """Rows of (doc_id, text) aligned byte by byte."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib, b_lib, letters = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES), byte_letters()
    a_lib.encode_special_tokens = True
    docs, held = [], collections.Counter()
    for i, text in rows:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a_lib.id_to_token(x)) for x in a]
        b_bytes = [bytes([int(b_lib.id_to_piece(x)[3:5], 16)]) if b_lib.is_byte(x) else b_lib.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            docs.append((i, 0, 0, 0, [], ""))
            continue
        of_a, of_b = ([k for k, x in enumerate(side) for _ in x] for side in (a_bytes, b_bytes))
        links = [(a[x], b[y]) for x, y in dict.fromkeys(zip(of_a, of_b, strict=True))]
        n = len(of_a)
        cuts = [k for k in range(1, n + 1) if k == n or (of_a[k] != of_a[k - 1] and of_b[k] != of_b[k - 1])]
        side = lambda ids, of, p, q: ",".join(str(ids[k]) for k in dict.fromkeys(of[p:q]))
        groups = ";".join(side(a, of_a, p, q) + "|" + side(b, of_b, p, q) for p, q in zip([0, *cuts], cuts, strict=False))
        docs.append((i, len(a), len(b), len(cuts), links, groups))
        held.update(set(links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    return [(i, n_a, n_b, n_groups, len(links), groups, sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links)) for i, n_a, n_b, n_groups, links, groups in docs]


def test_alignment_equals_byte_by_byte(spark):
    rows = [(i, t) for i, t in enumerate([None, "", " ", "a▁b", "x" * 500, "one  two", *strange_texts(400, 4)])] + [(None, "null id"), (3, "the the the"), (3, "the the the")]
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, part int, pairs int").repartition(5, F.xxhash64("text"))
    size_b = align.vocabulary_sizes(BYTES, PIECES)[1]
    table = queries.stored(align.align_tokens(docs, BYTES, PIECES), "aligned")
    assert table.select("part").distinct().count() >= 4
    got = align.with_link_counts(table, size_b).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_alignment(rows)))
    assert align.with_link_counts(table.limit(0), size_b).isEmpty()


def test_op11_rows(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op11_align(spark, sf).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect()
    want = [(*x[:5], hashlib.sha256(x[5].encode()).hexdigest() if x[1] else "", *x[6:]) for x in plain_alignment(rows)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_gallop():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 4000):
        longer = np.cumsum(rng.integers(1, 5, n))
        ends = np.unique(rng.integers(0, longer[-1] + 1, max(1, n // 3)))
        low, top = np.zeros(len(ends), np.int64), np.full(len(ends), n - 1)
        assert (align.gallop(ends, longer, low, top) == np.searchsorted(longer, ends)).all()


# --- divergence ---------------------------------------------------------------------


def plain_audit(rows, least=3, top=200):
    find = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+").findall
    held, counts, sources = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = find(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sources[lang].add(source)
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        share = lambda of: {t: 1 + 10**9 * (of[t] + 1) // (sum(of[x] for x in kept) + len(kept)) for t in kept}
        whole = share(sum((counts[lang, s] for s in names), collections.Counter()))
        p = {s: share(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in names if o != s]
            told = [((p[s][t] - whole[t]) ** 2 // whole[t], t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, values, most in (("pair", pairs, len(pairs)), ("term", told, top)):
                ranked = sorted(values, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return out


def audited(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, n int, docs int")
    return sorted(map(tuple, divergence.audit(docs, **more).select("lang", "source", "part", "item", "value", "rank").collect()))


def test_audit_equals_plain_loops(spark):
    rng = random.Random(6)
    words = ["the", "The", "of", "é", "É", "straße", "a", "antidisestablishmentarianism", "antidisestablishmentarianisms", "pre", "prefix", "prefixes", "日本語", "x1y", "<|b|>", "\u0080", *(f"w{chr(97 + k)}" for k in range(26))]
    rows = [(rng.choice(["en", "en", "fr", None, ""]), rng.choice(["s0", "s0", "s1", "S", None, "é"]), rng.choice([None, "", "12 34", *(" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(8))])) for _ in range(150)]
    rows += [("de", "only", "selten"), ("xx", "a", "one two"), ("xx", "b", None), ("yy", "a", "same same"), ("yy", "a", "same"), ("yy", "b", "same")]
    want = sorted(plain_audit(rows))
    assert audited(spark, rows) == want
    assert audited(spark, rows, levels=(1, 2)) == want
    assert audited(spark, rows, top=3) == sorted(plain_audit(rows, top=3))
    assert audited(spark, [], levels=(3,)) == []


def test_audit_with_a_full_filter_and_small_blocks(spark, monkeypatch):
    """What the bits cannot tell apart goes on to the exact last level; sums in many blocks are the same."""
    rng = random.Random(8)
    rows = [("en", rng.choice(["a", "a", "b", "c"]), " ".join(f"{rng.choice('abcdef')}{rng.choice('uvwxyz')}{rng.choice('mnop')}" for _ in range(40))) for _ in range(60)]
    full = spark.sparkContext.broadcast(np.full(divergence.FILTER_BITS // 8, 255, dtype=np.uint8))
    monkeypatch.setattr(divergence, "prefix_filter", lambda counts, least: full)
    monkeypatch.setattr(divergence, "BLOCK", 50)
    assert audited(spark, rows) == sorted(plain_audit(rows))


def test_prefixes_under_the_threshold_are_discarded(spark):
    rows = spark.createDataFrame([("en", "s", "apple apply zebra"), ("en", "s", "apple apricot"), ("en", "s", "apple"), ("fr", "s", "zebra")], "lang string, source string, text string")
    counts = divergence.prefix_counts(rows, 2)
    assert sorted(r.docs for r in counts.collect()) == [1, 1, 3]  # ap in en; ze in en and in fr
    left = divergence.prefix_filter(counts, 3)
    assert int(np.unpackbits(left.value).sum()) == 1
    assert sorted(r.docs for r in divergence.prefix_counts(rows, 4, 2, left).collect()) == [1, 3]
    assert {r.term for r in divergence.term_counts(rows, 2, left).collect()} == {"apple", "apply", "apricot"}


def test_recall_by_length(spark):
    """Documents that share a passage of so many words: in how many pairs one of the two loses most of it."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 10)))
    text = lambda n: [word() for _ in range(n)]
    rows, lengths = [], [40, 45, 50, 55, 60]
    for k, n in enumerate(lengths * 60):
        passage = text(n)
        for side in range(2):
            rows.append((2 * k + side, " ".join([*text(rng.randrange(5, 60)), *passage, *text(rng.randrange(5, 60))]), " ".join(passage)))
    out = {r.doc_id: r for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string, passage string")).collect()}
    found = collections.Counter(lengths[k % len(lengths)] for k in range(len(rows) // 2) if out[2 * k + 1].removed_bytes >= 0.5 * len(out[2 * k + 1].passage))
    assert all(found[n] >= 54 for n in lengths) and all(found[n] == 60 for n in (50, 55, 60)), found
    assert all(not out[2 * k].removed_bytes for k in range(len(rows) // 2))
