"""WARC archives: writing captures, reading them back, assembling transactions.

A capture is three records: the request, the response (or a revisit record that
names the response with the same payload) and a metadata record.  Request and
metadata name the response or revisit through ``WARC-Concurrent-To``; reading
joins the three through that identifier and gives one nested row per capture.

Archives are written by Spark's text sink: one record is one value and the
line separator is the two CRLFs that end a record, so part files are valid
WARC files on any file system that Spark writes to, committed like any other
Spark output.  They are read with ``binaryFile`` and parsed by Content-Length,
so a payload may contain anything.  One file is one task's output: hold it to a
few hundred MB by ``archives``.

Defined results: a null html is an empty payload; of records with equal
payloads of at least ``min_bytes`` bytes the largest page_id is the response;
rows with equal page_id and payload are separate captures; null page_ids are
kept; an empty table gives no captures.  Rows are told apart by their place in
the plan, so pages must be a table of files, or be stored as one first: what is
dealt anew on each reading has no fixed places.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"

RECORD = "archive string, record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, payload_digest string, content_bytes long, content binary"


def base32_sha1(column: str) -> F.Column:
    """SHA-1 as bare upper-case base 32: five hex digits give four characters."""
    hexed = F.sha1(F.col(column))
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds payload, payload_bytes, payload_digest, record_type and refers_to.

    The response of each payload is found by a partial maximum per digest
    before any shuffle, so a payload shared by a third of all pages is one
    short row per task.
    """
    held = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    held = held.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1("payload"), "_row": F.monotonically_increasing_id()})
    top = held.where(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes")).agg(F.max(F.struct("page_id", "_row")).alias("_top"))
    held = held.join(top, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes")), "left")
    revisit = F.col("_top").isNotNull() & ~(F.col("_top.page_id").eqNullSafe(F.col("page_id")) & (F.col("_top._row") == F.col("_row")))
    held = held.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("_top.page_id")), "refers_row": F.when(revisit, F.col("_top._row"))})
    return held.drop("_digest", "_bytes", "_top")


def _uri(kind: str, page: F.Column, row: F.Column) -> F.Column:
    """Record identifiers: the page and the row that held it, so repeated rows differ."""
    return F.concat(F.lit(f"<urn:loadstone:{kind}:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), row.cast("string"), F.lit(">"))


def _record(kind: F.Column | str, record_id: F.Column, lines: list[tuple[str, F.Column]], block: F.Column) -> F.Column:
    """Header and block of one record; a header whose value is null is left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = [F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), record_id, F.lit(f"\r\nWARC-Date: {DATE}\r\n")]
    for name, value in lines:
        head.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    return F.concat(*head, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, archives: int | None = None) -> None:
    """Write all pages (page_id, url, html) as WARC files under ``path``."""
    held = with_roles(pages, min_bytes)
    if archives:
        held = held.repartition(archives)
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]+", " ")
    page, row = F.col("page_id"), F.col("_row")
    main = _uri("capture", page, row)
    is_revisit = F.col("record_type") == "revisit"
    host = F.regexp_extract(url, r"^[a-zA-Z]+://([^/]*)", 1)
    target = F.regexp_replace(url, r"^[a-zA-Z]+://[^/]*", "")
    request = _record("request", _uri("request", page, row), [("WARC-Concurrent-To", main), ("WARC-Target-URI", url), ("Content-Type", F.lit("application/http;msgtype=request"))],
                      F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    answer = _record(F.col("record_type"), main, [
        ("WARC-Target-URI", url), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Profile", F.when(is_revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("WARC-Refers-To", F.when(is_revisit, _uri("capture", F.col("refers_to"), F.col("refers_row")))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
    ], F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload"))))
    facts = _record("metadata", _uri("metadata", page, row), [("WARC-Concurrent-To", main), ("WARC-Target-URI", url), ("Content-Type", F.lit("application/warc-fields"))],
                    F.concat(F.lit("page-id: "), F.coalesce(page.cast("string"), F.lit("")), F.lit("\r\n")))
    held.select(F.concat(request, F.lit(END), answer, F.lit(END), facts).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; headers have lower-case names."""
    held, done = bytearray(), False
    source = iter(pieces)

    def fill(n: int) -> bool:
        nonlocal done
        while len(held) < n and not done:
            piece = next(source, None)
            if piece is None:
                done = True
            else:
                held.extend(piece)
        return len(held) >= n

    while True:
        while fill(1) and held[:2] == b"\r\n" or (held[:1] == b"\r" and fill(2) and held[:2] == b"\r\n"):
            del held[:2]
        if not fill(1):
            return
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not fill(len(held) + 1):
                raise ValueError("a WARC record ends inside its header")
        lines = bytes(held[:end]).decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        if not fill(end + 4 + size):
            raise ValueError("a WARC record is shorter than its Content-Length")
        yield headers, bytes(held[end + 4 : end + 4 + size])
        del held[: end + 4 + size]


def inflate(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a file that may be gzip, of one or many members, in pieces."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[i : i + step] for i in range(0, len(content), step))
        return
    rest = content
    while rest:
        reader = zlib.decompressobj(wbits=31)
        while not reader.eof and rest:
            yield reader.decompress(rest, step)
            rest = reader.unconsumed_tail
        rest = reader.unused_data


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``; see ``RECORD``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.col("length") > 0).select("path", "content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("content_bytes", pa.int64()), ("content", pa.binary())])
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, held = [], 0
                for head, block in parse_records(inflate(content.as_py())):
                    kind = head.get("warc-type", "")
                    body = block.partition(b"\r\n\r\n")[2] if kind in ("response", "revisit", "request") else block
                    rows.append((name.as_py(), head.get("warc-record-id"), kind, head.get("warc-concurrent-to"), head.get("warc-refers-to"), head.get("warc-target-uri"), head.get("warc-payload-digest"), len(body), body))
                    held += len(body)
                    if held > 8 << 20 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return files.mapInArrow(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """Join the records of each capture: one nested row per response or revisit.

    Columns: record_id, target_uri, record_type, refers_to, payload_digest,
    answer (payload_bytes, payload), request, metadata.
    """
    is_main = F.col("record_type").isin("response", "revisit")
    keyed = records.withColumn("_capture", F.when(is_main, F.col("record_id")).otherwise(F.col("concurrent_to")))
    keyed = keyed.where(F.col("_capture").isNotNull())
    part = lambda condition, *names: F.first(F.when(condition, F.struct(*names)), ignorenulls=True)
    out = keyed.groupBy("_capture").agg(
        part(is_main, "record_type", "target_uri", "refers_to", "payload_digest", F.col("content_bytes").alias("payload_bytes"), F.col("content").alias("payload")).alias("answer"),
        part(F.col("record_type") == "request", "record_id", "target_uri", "content").alias("request"),
        part(F.col("record_type") == "metadata", "record_id", "content").alias("metadata"),
    )
    return out.where(F.col("answer").isNotNull()).withColumnRenamed("_capture", "record_id")


def captured_pages(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each
    capture.  Digest and length are those of the bytes read back; a revisit,
    which has no bytes of its own, takes them from the response it names."""
    short = records.withColumn("content", F.when(F.col("record_type") == "metadata", F.col("content")).when(F.col("record_type") == "response", F.unhex(F.sha1("content"))))
    whole = assemble(short)
    page = lambda text: F.regexp_extract(text, r"^page-id: (-?\d+)\r\n", 1)
    rows = whole.select("record_id", "answer.*", page(F.col("metadata.content").cast("string")).alias("_page"))
    own = rows.where(F.col("record_type") == "response").select("record_id", "_page", "payload_bytes", "payload")
    named = own.select(F.col("record_id").alias("_named"), F.col("_page").alias("_of"), F.col("payload_bytes").alias("_bytes"), F.col("payload").alias("_sha"))
    is_revisit = F.col("record_type") == "revisit"
    # a response names itself, so that no key stands for all of them
    rows = rows.join(named, F.when(is_revisit, F.col("refers_to")).otherwise(F.col("record_id")) == F.col("_named"), "left")
    sha = F.lower(F.hex(F.when(is_revisit, F.col("_sha")).otherwise(F.col("payload"))))
    parts = [F.lpad(F.conv(F.substring(sha, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    number = lambda c: F.when(F.col(c) != "", F.col(c).cast("long"))
    return rows.select(number("_page").alias("page_id"), F.when(is_revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"), F.translate(F.concat(*parts), _DIGITS, _BASE32).alias("payload_digest"), "record_type", F.when(is_revisit, number("_of")).alias("refers_to"))


def round_trip(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives at ``path``, read them back, assemble."""
    write_archives(pages, path, min_bytes)
    return captured_pages(read_records(pages.sparkSession, path))


#: The rows of op7 as DuckDB SQL.
ORACLE = r"""
WITH held AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digested AS (SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, sha1(payload) AS h FROM held),
parts AS (SELECT *, list_transform(range(0, 8), lambda k: ('0x' || substr(h, (5 * k + 1)::INT, 5))::BIGINT) AS words FROM digested),
told AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(words, lambda n:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n // 32768 + 1)::INT, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n // 1024 % 32 + 1)::INT, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n // 32 % 32 + 1)::INT, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n % 32 + 1)::INT, 1)), '') AS payload_digest FROM parts),
topped AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM told)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM topped
"""
