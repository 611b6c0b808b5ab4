"""Web archives: ARC files of both versions, and their conversion to WARC.

An ARC file begins with a ``filedesc`` record whose block tells the version and
names the fields of all header lines: five in version 1, ten in version 2. Each
record is one such line, a block of the declared length and a line feed. The
converter reads lines and lengths, and makes of each record a WARC/1.1 record:
an identifier derived from its content, the date in ISO form, a type, and
digests of payload and block. Of equal payloads one becomes a response, the
others revisits that refer to it.

Files are written by Spark's text writer (a record is a row, its last line feed
the line separator) and read whole, one task per file; the writers keep files
small. What decides on revisits is one narrow row per record, so hot payloads
shuffle digests only.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import written

# The field names of both versions, as a file states them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_BYTES = 1_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "19700101000000"
CRLF = "\r\n"
# Bytes of records that a reader hands over together.
BATCH_BYTES = 8 << 20

ARC_SCHEMA = (
    "file string, version int, url string, ip string, archive_date string, mime string, status int, "
    "declared bigint, complete boolean, page_id bigint, payload_bytes bigint, payload_digest string, "
    "head binary, payload binary"
)
WARC_SCHEMA = (
    "record_id string, record_type string, warc_date string, target_uri string, refers_to_id string, "
    "page_id bigint, payload_bytes bigint, payload_digest string, digest_ok boolean"
)


def _first_row() -> Column:
    """Whether a row is the first of its task, and so of the file it writes."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0


def _bytes(text: Column) -> Column:
    return text.cast("binary")


def _http_head(page_id: Column, size: Column) -> Column:
    return F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}X-Page-Id: "),
        F.coalesce(page_id.cast("string"), F.lit("-")),
        F.lit(f"{CRLF}Content-Length: "),
        size.cast("string"),
        F.lit(CRLF * 2),
    )


def _write(records: DataFrame, path: str) -> None:
    """One gzip file per task; a row is a record without its last line feed."""
    rows = records.select(F.col("record").cast("string").alias("value"))
    options = {"compression": "gzip", "lineSep": "\n", "zlib.compress.level": "BEST_SPEED"}
    rows.write.options(**options).text(path)


def write_arc(pages: DataFrame, path: str, date: str = "20240229235959") -> None:
    """Pages ``page_id, url, html`` as ARC files, half of them of each version.

    A NULL html is empty. Blanks and control characters of a url are
    percent-encoded, a NULL or empty url stands as ``urn:page``.
    """
    version = F.spark_partition_id() % 2 + 1
    payload = _bytes(F.coalesce("html", F.lit("")))
    head = _http_head(F.col("page_id"), F.octet_length(payload))
    url = F.transform(
        F.split(F.coalesce("url", F.lit("")), ""),
        lambda c: F.when(c.rlike(r"^[\s\p{Cntrl}]$"), F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))).otherwise(c),
    )
    url = F.when(F.coalesce("url", F.lit("")).rlike(r"[\s\p{Cntrl}]"), F.array_join(url, "")).otherwise(F.col("url"))
    url = F.coalesce(F.nullif(url, F.lit("")), F.lit("urn:page"))
    rows = pages.select(version.alias("version"), url.alias("url"), head.alias("head"), payload.alias("payload"))
    size = (F.octet_length("head") + F.octet_length("payload")).cast("string")
    mark = F.when(F.col("version") == 2, F.concat(F.lit(" 200 "), F.md5("payload"), F.lit(" - 0 -"))).otherwise("")
    line = F.concat("url", F.lit(f" 192.0.2.1 {date} text/html"), mark, F.lit(" "), size, F.lit("\n"))

    def opening(number: int) -> Column:
        block = f"{number} 0 clickloom\n{ARC_FIELDS[number]}\n"
        extra = " 200 - - 0 -" if number == 2 else ""
        return F.lit(f"filedesc://pages.arc 0.0.0.0 {date} text/plain{extra} {len(block)}\n{block}\n")

    opened = F.when(_first_row(), F.when(F.col("version") == 2, opening(2)).otherwise(opening(1))).otherwise("")
    record = F.concat(_bytes(opened), _bytes(line), _bytes(F.col("head")), F.col("payload"))
    _write(rows.select(record.alias("record")), path)


def _opened(content: bytes) -> io.BufferedReader:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw, 1 << 16)


def _number(text: bytes | str | None) -> int | None:
    try:
        return int(text) if text is not None else None
    except ValueError:
        return None


def http_parts(block: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """Head with its empty line, payload and header fields; no head if it is no HTTP message."""
    if not block.startswith(b"HTTP/"):
        return b"", block, {}
    end = block.find(b"\r\n\r\n")
    head = block if end < 0 else block[: end + 4]
    fields = {}
    for line in head.decode("utf-8", "replace").split(CRLF)[1:]:
        name, found, value = line.partition(":")
        if found:
            fields[name.strip().lower()] = value.strip()
    return head, block[len(head) :], fields


def arc_records(stream: io.BufferedReader) -> Iterator[tuple[int, dict[str, str], bytes, bool]]:
    """``version, fields, block, complete`` of each record behind the file's opening one.

    Lengths are believed, not searched for: a block may hold anything. A url may
    hold blanks, so the other fields are taken from the right. A line that is no
    header ends the file, as does a block shorter than declared, which is given
    as far as it goes.
    """
    names = ARC_FIELDS[1].split()
    version = 1
    while line := stream.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        opening = line.startswith(b"filedesc:")
        parts = line.decode("utf-8", "replace").rsplit(" ", 9 if opening else len(names) - 1)
        size = _number(parts[-1])
        if size is None or size < 0 or (not opening and len(parts) != len(names)):
            return
        block = stream.read(size)
        if opening:
            lines = block.decode("utf-8", "replace").split("\n")
            version = _number(lines[0].split(" ")[0]) or 1
            names = lines[1].split() if len(lines) > 1 and lines[1].startswith("URL ") else ARC_FIELDS[min(version, 2)].split()
            continue
        yield version, dict(zip(names, parts)), block, len(block) == size


def _parsed(files: DataFrame, parse: Callable[[str, bytes], Iterator[tuple]], schema: str, weigh: int | None) -> DataFrame:
    """Rows that ``parse`` finds in each file; ``weigh`` is the column that counts for a batch."""
    spark = files.sparkSession
    fields = spark.createDataFrame([], schema).schema
    names = fields.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names
            )

        rows, held = [], 0
        for found in batches:
            for path, content in zip(found.column(0), found.column(1)):
                for row in parse(path.as_py(), content.as_py()):
                    rows.append(row)
                    held += 300 + (len(row[weigh] or b"") if weigh is not None else 0)
                    if held >= BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)

    return files.select("path", "content").mapInArrow(run, schema)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of ARC files, without their opening ones; ``payloads=False`` leaves blocks out."""

    def parse(file: str, content: bytes) -> Iterator[tuple]:
        for version, fields, block, complete in arc_records(_opened(content)):
            head, payload, http = http_parts(block)
            yield (
                file, version, fields["URL"], fields["IP-address"], fields["Archive-date"],
                fields["Content-type"], _number(fields.get("Result-code")),
                _number(fields["Archive-length"]), complete, _number(http.get("x-page-id")),
                len(payload), hashlib.sha1(payload).hexdigest(),
                head if payloads else None, payload if payloads else None,
            )

    return _parsed(_files(spark, path), parse, ARC_SCHEMA, ARC_SCHEMA.count(","))


def iso_date(arc_date: Column) -> Column:
    """``YYYYMMDDhhmmss`` as an ISO date; a wrong one as the epoch."""
    parsed = F.try_to_timestamp(arc_date, F.lit("yyyyMMddHHmmss"))
    parsed = F.coalesce(parsed, F.to_timestamp(F.lit(NO_DATE), "yyyyMMddHHmmss"))
    return F.concat(F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))


def record_id(*parts: Column) -> Column:
    """A name-based UUID of the parts."""
    digest = F.sha1(_bytes(F.concat_ws("\n", *parts)))
    pieces = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    a, b, c, d, e = pieces
    return F.concat(F.lit("<urn:uuid:"), a, F.lit("-"), b, F.lit("-5"), c, F.lit("-8"), d, F.lit("-"), e, F.lit(">"))


def _identified(records: DataFrame) -> DataFrame:
    name = record_id(F.col("page_id").cast("string"), F.col("url"), F.col("archive_date"), F.col("payload_digest"))
    return records.withColumn("record_id", name)


def revisits(records: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``revisit_page, revisit_id, refers_to_id``: records whose payload another one keeps.

    Of equal payloads of at least ``least_bytes`` the largest page id keeps it.
    """
    narrow = written(
        _identified(records).filter(F.col("payload_bytes") >= least_bytes).select(
            "page_id", "record_id", "payload_bytes", "payload_digest"
        )
    )
    kept = (
        narrow.groupBy("payload_digest", "payload_bytes")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("page_id").alias("kept_page"),
            F.max_by("record_id", "page_id").alias("refers_to_id"),
        )
        .filter((F.col("n") > 1) & F.col("kept_page").isNotNull())
    )
    # Written, so that the join can split a payload that very many records have.
    kept = written(kept.drop("n"))
    return (
        narrow.join(kept, ["payload_digest", "payload_bytes"])
        .filter(F.coalesce(F.col("page_id") < F.col("kept_page"), F.lit(True)))
        .select(F.col("record_id").alias("revisit_id"), "refers_to_id")
        .distinct()
    )


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """ARC files to WARC files, one record each."""
    pointers = written(revisits(read_arc(spark, arc_path, payloads=False)))
    records = _identified(read_arc(spark, arc_path))
    joined = records.join(pointers, F.col("record_id") == F.col("revisit_id"), "left")
    revisit = F.col("refers_to_id").isNotNull()
    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))
    http = F.octet_length("head") > 0

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    lines = [
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").when(http, "response").otherwise("resource")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", iso_date(F.col("archive_date"))),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1("block"))),
        F.when(revisit, line("WARC-Refers-To", F.col("refers_to_id"))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(~F.col("complete"), F.lit("WARC-Truncated: unspecified")),
        line("Content-Type", F.when(http, F.lit("application/http; msgtype=response")).otherwise(F.col("mime"))),
        line("Content-Length", F.octet_length("block").cast("string")),
    ]
    info = f"software: clickloom{CRLF}format: WARC File Format 1.1{CRLF}"
    opening = CRLF.join(
        ["WARC/1.1", "WARC-Type: warcinfo", "WARC-Record-ID: <urn:uuid:{}>", "WARC-Date: 1970-01-01T00:00:00Z",
         "Content-Type: application/warc-fields", f"Content-Length: {len(info)}", "", info + CRLF, ""]
    ).split("{}")
    opened = F.when(_first_row(), F.concat(F.lit(opening[0]), F.expr("uuid()"), F.lit(opening[1]))).otherwise("")
    made = joined.withColumn("block", block).select(
        F.concat(
            _bytes(F.concat(opened, F.concat_ws(CRLF, *lines), F.lit(CRLF * 2))),
            F.col("block"),
            _bytes(F.lit(CRLF + "\r")),
        ).alias("record")
    )
    _write(made, warc_path)


def warc_records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """``fields, block`` of each record, by declared length."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            if line.strip():
                return
            continue
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.read(_number(fields.get("content-length")) or 0)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record but ``warcinfo``; a response's digest is checked against its payload.

    A revisit has no payload: its length and digest are those of its headers.
    """

    def parse(file: str, content: bytes) -> Iterator[tuple]:
        for fields, block in warc_records(_opened(content)):
            kind = fields.get("warc-type")
            if kind == "warcinfo":
                continue
            _, payload, http = http_parts(block)
            stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
            if kind == "revisit":
                size, digest = _number(http.get("content-length")), stated
            else:
                size, digest = len(payload), hashlib.sha1(payload).hexdigest()
            yield (
                fields.get("warc-record-id"), kind, fields.get("warc-date"), fields.get("warc-target-uri"),
                fields.get("warc-refers-to"), _number(http.get("x-page-id")), size, digest, digest == stated,
            )

    return _parsed(_files(spark, path), parse, WARC_SCHEMA, None)


def page_archive(pages: DataFrame, folder: str) -> DataFrame:
    """Pages through ARC and WARC files in ``folder`` and back: one row per page row.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri,
    warc_date, digest_ok``. Rows repeated with one id and payload keep one type;
    a row without an id is never the one that is referred to. An empty table
    gives an empty result.
    """
    spark = pages.sparkSession
    if pages.isEmpty():
        return spark.createDataFrame([], WARC_SCHEMA).select(*_archive_columns(F.lit(None).cast("bigint")))
    write_arc(pages, f"{folder}/arc")
    convert(spark, f"{folder}/arc", f"{folder}/warc")
    index = written(read_warc(spark, f"{folder}/warc"))
    targets = written(
        index.join(
            index.select(F.col("refers_to_id").alias("record_id")).distinct(), "record_id", "left_semi"
        ).select(F.col("record_id").alias("target_id"), F.col("page_id").alias("target_page")).distinct()
    )
    joined = index.join(targets, F.col("refers_to_id") == F.col("target_id"), "left")
    return joined.select(*_archive_columns(F.col("target_page")))


def _archive_columns(refers_to: Column) -> list[Column]:
    return [
        F.col("page_id"), F.col("payload_bytes"), F.col("payload_digest"), F.col("record_type"),
        refers_to.alias("refers_to"), F.col("target_uri"), F.col("warc_date"), F.col("digest_ok"),
    ]
