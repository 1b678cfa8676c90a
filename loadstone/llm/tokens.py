"""Token counts with a whole-token shortcut.

A byte-level BPE text is cut by a fixed pattern into pre-tokens, each merged
on its own.  For many vocabulary strings it can be proved beforehand that the
string, as a pre-token, ends as exactly one token: :func:`whole_tokens` runs
the merges on every vocabulary string once, on the driver before the job, and
keeps those that do; executors get the proved set by broadcast (it is at most
the vocabulary).  Counting is then a table look-up per pre-token; only
pre-tokens outside the proved set are merged.

A blank before a word is always the start of a pre-token (:data:`UNSAFE` finds
the texts where two blanks meet, which are cut by the pattern as a whole), so a
text is taken piece by piece between blanks, and the count of each piece, a sum
over its pre-tokens, is remembered in a bounded table.

Defined results: a null or empty text has 0 bytes and 0 tokens; strings of
added tokens inside a text count as the library counts them by default (one
token each); texts are never cut; repeated rows are each counted.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pattern of byte-level pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 400_000  # pieces whose counts are kept
LONGEST = 256  # characters of a piece that is remembered
UNSAFE = re.compile(r"\s (?:\s|\Z)|^ (?:\s|\Z)")  # a blank in a run of white space; \s has all white space of the pattern, and more


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte:
    printable Latin-1 stands for itself, the others take letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """Counts tokens of texts for one ``.json`` byte-level BPE vocabulary."""

    def __init__(self, path: str, whole: list[str] | None = None):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without normalizer is counted here")
        letters = byte_letters()
        added = {x["content"] for x in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in word): n for word, n in spec["model"]["vocab"].items() if word not in added}
        if any(spec["model"]["vocab"]["".join(pair)] <= spec["model"]["vocab"][last] for pair, last in zip(spec["model"]["merges"][1:], map("".join, spec["model"]["merges"]), strict=False)):
            raise ValueError("ids do not follow the order of the merges")
        # ids follow the merges, so merging the pair of lowest id is the same procedure
        self.ranks = tiktoken.Encoding("loadstone", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        added = sorted(added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.find = regex.compile(PATTERN).findall
        self.whole = frozenset(whole_tokens(path) if whole is None else whole)
        self.pieces: dict[str, int] = {}  # by the text after a blank

    def pre_tokens(self, text: str) -> int:
        """Tokens of a text: those proved whole count one, only the rest is merged."""
        parts = self.find(text)
        rest = [p for p in parts if p not in self.whole]
        return len(parts) - len(rest) + sum(len(self.ranks._encode_single_piece(p.encode())) for p in rest)

    def _between_blanks(self, text: str) -> int:
        first, *pieces = text.split(" ")
        known = list(map(self.pieces.get, pieces))
        total = self.pre_tokens(first)
        if None not in known:
            return total + sum(known)
        for piece, n in zip(pieces, known, strict=True):
            if n is None:
                n = self.pieces.get(piece)  # it may have come before in this text
            if n is None:
                n = self.pre_tokens(" " + piece)
                if len(self.pieces) < REMEMBERED and len(piece) <= LONGEST:
                    self.pieces[piece] = n
            total += n
        return total

    def __call__(self, text: str) -> int:
        total, parts = 0, [text]
        if self.added and self.added.search(text):
            parts = self.added.split(text)
            total = len(parts) - 1
        return total + sum(self.pre_tokens(p) if UNSAFE.search(p) else self._between_blanks(p) for p in parts)


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that are one pre-token and merge to one token."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tokenizer = Tokenizer.from_file(path)
    letters = byte_letters()
    find = regex.compile(PATTERN).findall
    found = []
    for word in spec["model"]["vocab"]:
        try:
            text = bytes(letters[c] for c in word).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if find(text) == [text]:
            found.append(text)
    ids = tokenizer.encode_batch(found, add_special_tokens=False)
    return [t for t, x in zip(found, ids, strict=True) if len(x.ids) == 1]


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row of ``docs`` (doc_id, text).

    ``vocabulary`` is a path that every executor can read, as the library is
    installed on each.
    """
    proved = docs.sparkSession.sparkContext.broadcast(whole_tokens(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _COUNTERS:  # once a worker
            _COUNTERS[vocabulary] = Counter(vocabulary, proved.value)
        counter = _COUNTERS[vocabulary]
        for batch in batches:
            n = np.zeros(batch.num_rows, dtype=np.int64)
            for i, text in enumerate(batch.column(2)):
                if text.is_valid:
                    n[i] = counter(text.as_py())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
