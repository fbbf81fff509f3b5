"""WARC archives with revisit resolution.

Headers (digest, length, id) are shuffled by payload digest: the record of the largest
id among equal payloads is the response, the others become revisit records that refer
to it. Only headers are aggregated; records then meet the resolved headers by digest
and salt, so a payload that a third of all pages share is spread over many tasks.
Archives are written with fresh headers by Spark's own text sink, so commits, retries
and any Hadoop file system work as for other tables, and read back by
``Content-Length`` from whole files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.llm.common import salt

LEAST_BYTES = 1000
RECORDS_A_FILE = 4000
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(column: Column) -> Column:
    """The record id of a page: its id in the place of a name."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("")), F.lit(">"))


def resolve(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``pages`` with ``__payload``, ``__bytes``, ``__digest`` and ``__refers_to`` (null for responses).

    Payloads below ``least_bytes`` are never revisits. Rows that repeat the largest id
    with its payload are responses each. Null ids refer to the largest id, and are
    responses where no equal payload has an id.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    whole = pages.withColumns({"__payload": payload}).withColumns(
        {"__bytes": F.octet_length("__payload").cast("long"), "__digest": F.sha1(F.col("__payload").cast("binary"))}
    )
    parts = salt([id_col])
    headers = pages.select(F.col(id_col).alias("__id"), payload.alias("__payload")).select(
        "__id",
        F.sha1(F.col("__payload").cast("binary")).alias("__digest"),
        F.octet_length("__payload").alias("__size"),
    )
    first = (
        headers.filter(F.col("__size") >= least_bytes)
        .groupBy("__digest", salt(["__id"]).alias("__salt"))
        .agg(F.max("__id").alias("__largest"))
        # at most 64 rows of a digest meet here
        .withColumn("__largest", F.max("__largest").over(Window.partitionBy("__digest")))
    )
    small = F.col("__bytes") < least_bytes
    joined = (
        whole.withColumn("__salt", parts)
        .join(first.hint("merge"), ["__digest", "__salt"], "left")
        .withColumn(
            "__refers_to",
            F.when(~small & (F.col("__largest").isNotNull()) & ~F.col(id_col).eqNullSafe(F.col("__largest")), F.col("__largest")),
        )
    )
    return joined.drop("__salt", "__largest")


def _one_line(column: Column) -> Column:
    """A header value: control characters as %XX, so that it stays on its line."""
    return F.regexp_replace(
        F.regexp_replace(F.coalesce(column, F.lit("")), "\r", "%0D"), "\n", "%0A"
    )


def records(resolved: DataFrame, id_col: str = "page_id", url_col: str = "url", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``record``: the text of each record up to, and without, its closing line ends."""
    again = F.col("__refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    nothing = F.lit("")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col(id_col))),
        line("WARC-Date", F.lit(date)),
        F.when(F.col(url_col).isNotNull(), line("WARC-Target-URI", _one_line(F.col(url_col)))).otherwise(nothing),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("__digest"))),
        line("WARC-Identified-Payload-Type", F.lit("text/html")),
        line("X-Payload-Length", F.col("__bytes").cast("string")),
        F.when(again, line("WARC-Refers-To", record_id(F.col("__refers_to")))).otherwise(nothing),
        F.when(again, line("WARC-Profile", F.lit(PROFILE))).otherwise(nothing),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(again, F.lit("0")).otherwise(F.col("__bytes").cast("string"))),
        F.lit("\r\n"),
    )
    return resolved.select(F.concat(head, F.when(again, nothing).otherwise(F.col("__payload"))).alias("record"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = LEAST_BYTES, records_a_file: int = RECORDS_A_FILE) -> None:
    """Write deduplicated, compressed archives of ``pages`` to the new folder ``path``.

    A null payload is empty; an empty table makes an empty folder.
    """
    resolved = resolve(pages, id_col, html_col, least_bytes)
    (
        records(resolved, id_col, url_col)
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_a_file)
        .text(path)
    )


RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


class _Stream:
    """The bytes of one compressed archive, unpacked as they are needed."""

    def __init__(self, packed: memoryview) -> None:
        self.packed, self.at = packed, 0
        self.unpack = zlib.decompressobj(31)
        self.held = bytearray()

    def more(self) -> bool:
        if self.at >= len(self.packed):
            return False
        self.held += self.unpack.decompress(self.packed[self.at : self.at + 65536])
        self.at += 65536
        while self.unpack.eof and self.unpack.unused_data:  # further members of the file
            rest, self.unpack = self.unpack.unused_data, zlib.decompressobj(31)
            self.held += self.unpack.decompress(rest)
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (found := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self.more():
                return None
        return self.take(found + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("an archive ends inside a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def parse(packed: memoryview) -> Iterator[tuple]:
    """The records of one gzip archive, one by one."""
    stream = _Stream(packed)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        version, *lines = head.decode("utf-8", "replace").rstrip().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]}")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        payload = stream.take(int(fields["content-length"]))
        stream.take(4)
        yield (
            fields["warc-record-id"],
            fields["warc-type"],
            fields.get("warc-target-uri"),
            fields["warc-payload-digest"].removeprefix("sha1:"),
            int(fields["x-payload-length"]),
            fields.get("warc-refers-to"),
            payload,
        )


def read(spark: SparkSession, path: str, batch_bytes: int = 4 << 20) -> DataFrame:
    """The records of all archives of a folder, with the columns of ``RECORD``."""
    arrow = to_arrow_schema(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for row in parse(memoryview(batch.column(0)[i].as_buffer())):
                    rows.append(row)
                    size += len(row[-1])
                    if size >= batch_bytes:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def page_number(column: str) -> Column:
    """The page id in a record id (null where the page had none)."""
    return F.nullif(F.regexp_extract(column, "<urn:page:(.*)>", 1), F.lit("")).cast("long")
