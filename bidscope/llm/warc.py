"""WARC archives of captures, and the transactions read back from them.

Writing: each page is a request, a response or revisit, and a metadata record, which name the response by
WARC-Concurrent-To. Of pages with equal payloads the one with the largest id is stored, the others revisit it. Spark's
text writer puts the records into gzip files in the shared folder. Reading: a task walks the records of a file by
their Content-Length, and the three records of a capture are joined by the identifiers. Archives of other writers are
read as well: payloads are bytes, what a header does not say is null, and a record that cannot be read is one row that
says why.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm.common import table
from bidscope.session import scratch_path, stage_table

#: Payloads of fewer bytes are always stored.
MIN_BYTES = 0
#: Captures in one archive, and their bytes by the table's average, at most: a task that reads an archive holds it
#: compressed, and one record and 16 MB of rows besides.
PER_FILE = 5_000
FILE_BYTES = 256 << 20
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DATE = "2024-01-01T00:00:00Z"
_RECORD = (
    "type string, record_id string, concurrent_to string, target string, refers_to string, page_id long, "
    "status int, payload_bytes long, payload_digest string, intact boolean, payload binary, broken string"
)


def sha1_base32(text: Column) -> Column:
    """The SHA-1 of a text's UTF-8 bytes in upper-case base32."""
    digits = []
    for k in range(8):
        number = F.conv(F.substring(F.sha1(text), 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1
            digits.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*digits)


def _urn(*parts: Column) -> Column:
    """A name made of the md5 of the parts, so that a task that runs again gives the same one."""
    return F.concat(
        F.lit("<urn:uuid:"),
        F.regexp_replace(
            F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])),
            "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
            "$1-$2-$3-$4-$5",
        ),
        F.lit(">"),
    )


def _record(kind: str | Column, record_id: Column, media: str, block: Column, headers: list[tuple[str, Column]]) -> Column:
    line = [F.lit("WARC/1.1\r\nWARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind]
    line += [F.lit("\r\nWARC-Record-ID: "), record_id, F.lit(f"\r\nWARC-Date: {_DATE}\r\nContent-Type: {media}")]
    for name, value in headers:
        line.append(F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"\r\n{name}: "), value)))
    line += [F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n")]
    return F.concat(*line)


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = MIN_BYTES,
) -> None:
    """Write every row as a capture below ``path``. A null payload is an empty one; a null id or url is left out.

    Rows without an id revisit a page that has one. Of repeated rows with the largest id of their payload
    all are responses, under one identifier. Line breaks in a url are percent-encoded.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.replace(F.replace(F.col(url_col), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("body"),
    ).withColumn("digest", sha1_base32(F.col("body")))
    large = F.octet_length("body") >= min_bytes
    # Of equal payloads, the largest id and the url of one row with it; only groups of two or more are of interest.
    groups = rows.where(large).groupBy("digest").agg(
        F.count(F.lit(1)).alias("members"),
        F.max(F.struct("page_id", "url")).alias("kept"),
    )
    kept = stage_table(
        groups.where("members > 1 AND kept.page_id IS NOT NULL").select(
            F.col("digest").alias("same"), F.col("kept.page_id").alias("kept_id"), F.col("kept.url").alias("kept_url")
        ),
        "repeated_payloads",
    )
    joined = rows.join(kept, (F.col("digest") == F.col("same")) & large, "left")
    revisit = F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id"))
    # The stored copy is named by its id and payload alone, so that revisits can name it without seeing it.
    name = F.when(revisit, _urn(F.lit("revisit"), F.col("page_id"), F.col("url"), F.col("digest"))).otherwise(
        F.when(F.col("kept_id").isNotNull(), _urn(F.lit("response"), F.col("page_id"), F.col("digest"))).otherwise(
            _urn(F.lit("response"), F.col("page_id"), F.col("url"), F.col("digest"))
        )
    )
    named = joined.withColumns({"revisit": revisit, "name": name, "size": F.octet_length("body").cast("string")})
    row_name = F.concat_ws("|", F.col("name"), F.coalesce("url", F.lit("-")))
    target = ("WARC-Target-URI", F.col("url"))
    beside = ("WARC-Concurrent-To", F.col("name"))
    request = F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit("\r\n\r\n"))
    profile = F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    about = F.when(F.col("page_id").isNull(), "").otherwise(
        F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n"))
    )
    records = F.concat(
        _record("request", _urn(F.lit("request"), row_name), "application/http;msgtype=request", request, [target, beside]),
        _record(
            F.when(F.col("revisit"), "revisit").otherwise("response"),
            F.col("name"),
            "application/http;msgtype=response",
            F.when(F.col("revisit"), head).otherwise(F.concat(head, F.col("body"))),
            [
                target,
                ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                ("WARC-Profile", profile),
                ("WARC-Refers-To", F.when(F.col("revisit"), _urn(F.lit("response"), F.col("kept_id"), F.col("digest")))),
                ("WARC-Refers-To-Target-URI", F.when(F.col("revisit"), F.col("kept_url"))),
            ],
        ),
        _record("metadata", _urn(F.lit("metadata"), row_name), "application/warc-fields", about, [target, beside]),
    )
    average = rows.agg(F.avg(F.octet_length("body"))).first()[0] or 0.0
    per_file = max(1, min(PER_FILE, int(FILE_BYTES / max(average, 1.0))))
    # The writer's line separator is the last of the two line breaks that end a record.
    lines = named.select(F.regexp_replace(records, "\r\n\\z", "").alias("value"))
    lines.write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; of a repeated one the first, and folded lines are one."""
    found: dict[str, str] = {}
    for line in re.split(r"\r?\n", re.sub(r"\r?\n[ \t]+", " ", _text(head))):
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), value.strip())
    return found


def _opened(content: bytes) -> BinaryIO:
    """An archive, compressed or not."""
    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw


def records_of(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Headers and block of each record of an archive, one record at a time, and what is wrong with it.

    Where a record is not as long as it says or has no readable head, nothing tells where the next one begins: it is
    the archive's last.
    """
    fields: dict[str, str] = {}
    try:
        while line := archive.readline():
            if not line.strip():
                continue
            fields = {}
            if not line.startswith(b"WARC/"):
                yield fields, b"", "no WARC record"
                return
            head = []
            while (line := archive.readline()).strip():
                head.append(line)
            fields = _fields(b"".join(head))
            length = fields.get("content-length", "")
            if not (length.isascii() and length.isdigit()):
                yield fields, b"", "no length"
                return
            block = archive.read(int(length))
            yield fields, block, "truncated" if len(block) < int(length) else None
            fields = {}
    except (EOFError, OSError, zlib.error):
        yield fields, b"", "unreadable compression"


def _unchunked(body: bytes) -> bytes | None:
    """The body of a chunked message, or None where it is none."""
    out, at = [], 0
    while True:
        end = body.find(b"\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        n = int(size, 16)
        if n == 0:
            return b"".join(out)
        if end + 1 + n > len(body):
            return None
        out.append(body[end + 1 : end + 1 + n])
        at = end + 1 + n
        at += 2 if body[at : at + 2] == b"\r\n" else 1


def _digests(payload: bytes) -> set[str]:
    """The ways in which a SHA-1 is written."""
    raw = hashlib.sha1(payload).digest()  # noqa: S324
    return {base64.b32encode(raw).decode(), raw.hex().upper()}


def _parsed(fields: dict[str, str], block: bytes, broken: str | None, payloads: bool) -> tuple:
    kind = fields.get("warc-type", "").lower() or None
    page_id = status = size = digest = intact = payload = None
    if kind == "metadata":
        found = _fields(block).get("page-id", "")
        page_id = int(found) if re.fullmatch(r"-?[0-9]{1,18}", found) else None
    elif kind in ("response", "revisit", "resource"):
        head, body = b"", block
        if kind == "resource":
            body = block
        elif block.startswith(b"HTTP/"):
            parts = re.split(rb"\r?\n\r?\n", block, maxsplit=1)
            head, body = parts[0], parts[1] if len(parts) > 1 else b""
        http = _fields(head)
        if told := re.match(rb"HTTP/[0-9.]+ ([0-9]{3})", head):
            status = int(told[1])
        algorithm, _, told = fields.get("warc-payload-digest", "").rpartition(":")
        if kind == "revisit":
            length = http.get("content-length", "")
            size, digest = int(length) if re.fullmatch("[0-9]{1,18}", length) else None, told or None
        else:
            plain = _unchunked(body) if http.get("transfer-encoding", "").lower() == "chunked" else None
            payload = body if plain is None else plain
            made = _digests(payload)
            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324
            if algorithm.lower() in ("sha1", "sha-1") and told:
                # Some writers digest what went over the wire.
                intact = broken is None and told.upper() in made | _digests(body)
    target = fields.get("warc-target-uri", "").strip("<>") or None
    told = (fields.get(name) for name in ("warc-record-id", "warc-concurrent-to"))
    shown = payload if payloads else None
    return kind, *told, target, fields.get("warc-refers-to"), page_id, status, size, digest, intact, shown, broken


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives below ``path``, compressed or not.

    ``broken`` says why a record could not be read whole, which ends its archive; ``intact`` is whether a payload has the
    SHA-1 that its record tells, null where it tells none. Payloads are bytes, without transfer encoding; without
    ``payloads`` they are measured and digested only. A folder without archives gives no rows.
    """
    names = [c.split()[0] for c in _RECORD.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                for fields, block, broken in records_of(_opened(content)):
                    rows.append(_parsed(fields, block, broken, payloads))
                    held += len(block) if payloads else 256
                    if held > 1 << 24:
                        yield _frame(rows)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows)

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        whole = {"page_id": "Int64", "status": "Int32", "payload_bytes": "Int64"}
        return pd.DataFrame(rows, columns=names, dtype=object).astype(whole)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInPandas(parse, _RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response, revisit or resource with its request and metadata records.

    The records are joined on their identifiers: request and metadata, one per identifier and url, by
    WARC-Concurrent-To, whichever of the two names the other. A response without one of them has null there; records
    that name no response in the archives, and broken ones without an identifier, are left out. ``records`` is read
    several times: pass one that is written down, or one that is cheap.
    """
    main = records.where("type IN ('response', 'revisit', 'resource') AND record_id IS NOT NULL").drop("page_id")
    # Responses that name their request themselves are few or all, depending on the writer.
    naming = main.where("concurrent_to IS NOT NULL").select(
        F.col("record_id").alias("named_by"), F.col("concurrent_to").alias("names")
    ).distinct()

    def beside(kind: str, value: Column, name: str) -> DataFrame:
        own = records.where(F.col("type") == kind).select("record_id", "concurrent_to", "target", value.alias("value"))
        forth = own.where("concurrent_to IS NOT NULL").select(F.col("concurrent_to").alias("of"), F.col("target").alias("at"), "value")
        back = own.join(naming, F.col("record_id") == F.col("names")).select(
            F.col("named_by").alias("of"), F.col("target").alias("at"), "value"
        )
        return forth.union(back).groupBy("of", "at").agg(F.min("value").alias(name))

    key = [F.col("record_id") == F.col("of"), F.col("target").eqNullSafe(F.col("at"))]
    requests = beside("request", F.struct("record_id", "target"), "request")
    about = beside("metadata", F.struct("record_id", "page_id"), "metadata")
    whole = main.join(requests, key, "left").drop("of", "at").join(about, key, "left").drop("of", "at")
    return whole.select(
        F.col("metadata.page_id").alias("page_id"),
        F.col("record_id").alias("capture"),
        "refers_to",
        F.struct("type", "record_id", "target", "status", "payload_bytes", "payload_digest", "intact", "payload", "broken").alias("response"),
        "request",
        "metadata",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = captures(stage_table(read_records(spark, path, payloads=False), "records"))
    rows = stage_table(
        found.select(
            "page_id",
            "capture",
            "refers_to",
            F.col("response.type").alias("record_type"),
            F.col("response.payload_bytes").alias("payload_bytes"),
            F.col("response.payload_digest").alias("payload_digest"),
        ),
        "captures",
    )
    return with_referred_page(rows)


def with_referred_page(rows: DataFrame) -> DataFrame:
    """``refers_to`` as the page id of the response that a revisit names."""
    named = rows.where("refers_to IS NOT NULL").select(F.col("refers_to").alias("wanted")).distinct()
    responses = rows.where("record_type = 'response'").groupBy(F.col("capture").alias("stored")).agg(F.max("page_id").alias("stored_id"))
    found = named.join(responses, F.col("wanted") == F.col("stored")).select("wanted", "stored_id")
    return rows.join(found, F.col("refers_to") == F.col("wanted"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("stored_id").alias("refers_to")
    )
