"""WARC archives: written by Spark's own writers, read by a Python data source.

The reader plans one partition per archive file, takes predicates on the record
type and on headers from the planner, parses the header of a record first and
seeks over the payload of every record that is not wanted.
"""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from tabloom.llm.common import shared_folder, table
from tabloom.llm.heavy import group_winners
from tabloom.session import cut_lineage

END = "\r\n"
RECORDS_PER_FILE = 50_000
BATCH_BYTES = 8 << 20
RECORD_ID = "urn:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAYLOAD_LENGTH = "X-Payload-Length"

#: column of the reader: header it comes from
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "payload_length": PAYLOAD_LENGTH.lower(),
}
SCHEMA = ", ".join(f"{name} string" for name in HEADERS) + ", payload binary"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a hexadecimal digest whose length is a multiple of five."""
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = [F.lpad(F.upper(F.conv(F.substring(digest, k, 5), 16, 32)), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*parts), digits, letters)


def _header(name: str, value: Column) -> Column:
    """One header line; a null value gives none."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(END)), F.lit(""))


def warc_records(pages: DataFrame) -> DataFrame:
    """(value): one WARC/1.1 record per row of (page_id, url, html, refers_to); a row with refers_to is a revisit."""
    revisit = F.col("refers_to").isNotNull()
    number = F.octet_length("html")
    urn = lambda c: F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), number.cast("string"), F.lit(END + END)
    )
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, F.col("html")))
    head = F.concat(
        F.lit("WARC/1.1" + END),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", urn("page_id")),
        _header("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "%0A")),
        _header("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.sha1(F.col("html").cast("binary"))))),
        _header(PAYLOAD_LENGTH, number.cast("string")),
        _header("WARC-Refers-To", F.when(revisit, urn("refers_to"))),
        _header("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        _header("Content-Type", F.when(~revisit, "application/http; msgtype=response")),
    )
    whole = F.element_at(
        F.transform(F.array(block), lambda b: F.concat(head, _header("Content-Length", F.octet_length(b).cast("string")), F.lit(END), b)), 1
    )
    return pages.select(whole.alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Write records through Spark's text writer: distributed, committed at the end, on any file system Spark knows."""
    records.write.option("lineSep", END + END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


class WarcFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _open(path: str):
    scheme, mark, rest = path.partition(":")
    if not mark or scheme == "file":
        return open("/" + (rest if mark else path).lstrip("/"), "rb", buffering=1 << 20)
    from pyarrow import fs

    found, inner = fs.FileSystem.from_uri(path)
    return found.open_input_file(inner)


def plain(file):
    """`file` itself, or its content when it is compressed member by member with gzip, as public crawls are."""
    magic = file.read(2)
    file.seek(0)
    return gzip.GzipFile(fileobj=file) if magic == b"\x1f\x8b" else file


def _skip(file, length: int, size: int | None) -> None:
    to = file.tell() + length
    at = file.seek(length, 1)
    if at < to or (size is not None and at > size):
        raise ValueError("the archive ends inside a record")


def scan(file, wanted=lambda headers: True, payload: bool = True) -> Iterator[tuple[dict, bytes | None]]:
    """(headers, payload) of the wanted records of an open archive; other blocks are skipped unread.

    A block of type application/http loses its HTTP head. Blank lines between
    records are skipped; a file that ends inside a record raises, also inside
    one that is skipped. Compressed files are unpacked as they are read.
    """
    size = None
    if not isinstance(file, gzip.GzipFile):
        here = file.tell()
        size = file.seek(0, 2)
        file.seek(here)
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {file.tell() - len(line)}")
        headers: dict[str, str] = {}
        while (line := file.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers.get("content-length", 0))
        if not wanted(headers):
            _skip(file, length, size)
            continue
        if not payload:
            _skip(file, length, size)
            yield headers, None
            continue
        block = file.read(length)
        if len(block) < length:
            raise ValueError("the archive ends inside a record")
        if headers.get("content-type", "").startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        yield headers, block


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = json.loads(options["files"])
        self.payload = options.get("payload", "true") == "true"
        self.equal: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        """Take equalities on the type and other headers; what remains is left to Spark."""
        for one in filters:
            values = {one.value} if isinstance(one, EqualTo) else set(one.value) if isinstance(one, In) else None
            if values is None or len(one.attribute) != 1 or one.attribute[0] not in HEADERS:
                yield one
                continue
            name = HEADERS[one.attribute[0]]
            self.equal[name] = self.equal[name] & values if name in self.equal else values

    def partitions(self) -> list[InputPartition]:
        return [WarcFile(path) for path in self.files]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        schema = pa.schema([*[(name, pa.string()) for name in HEADERS], ("payload", pa.binary())])
        equal = self.equal

        def wanted(headers: dict) -> bool:
            return all(headers.get(name) in values for name, values in equal.items())

        rows: list[dict] = []
        held = 0
        with _open(partition.path) as file:
            for headers, payload in scan(plain(file), wanted, self.payload):
                rows.append({name: headers.get(header) for name, header in HEADERS.items()} | {"payload": payload})
                held += len(payload or b"") + 500
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    """Format `warc`; options: files (JSON list of paths), payload (false: no payload is read)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives in a folder; the files are listed by Spark, so any of its file systems will do."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    listed = spark.read.format("binaryFile").load(path).filter("length > 0").select("path").collect()
    options = {"files": json.dumps([row.path for row in listed]), "payload": str(payload).lower()}
    return spark.read.format("warc").options(**options).load()


def archive_pages(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write one record per row of pages (page_id, url, html), read the archives back and tell what they hold.

    (page_id, payload_bytes, payload_digest, record_type, refers_to) per row.
    Of equal payloads of at least `least_bytes` bytes the largest page_id is a
    response, the others are revisits that refer to it; smaller payloads are
    all responses. A null html is an empty payload, a null url gives no
    Target-URI, a null page_id an empty one (it is a response only when its
    payload has no other page). Rows that repeat page_id and payload have the
    same type. Other columns are not looked at; an empty table gives no rows.
    """
    spark = pages.sparkSession
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    wanted = pages.select(pages["page_id"], pages["url"].cast("string").alias("url"), html.alias("html"))
    digest = F.unhex(F.sha2(F.col("html").cast("binary"), 256))
    keyed = cut_lineage(wanted.filter(F.octet_length("html") >= least_bytes).select(F.col("page_id").alias("id"), digest.alias("key")))
    again = group_winners(keyed, F.max).filter(~F.col("id").eqNullSafe(F.col("keep_id")) & F.col("keep_id").isNotNull())
    revisits = again.select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("keep_id").alias("refers_to")).distinct()
    revisits.write.parquet(f"{folder}/revisits")  # a file has a known size: the planner broadcasts it only below its limit
    revisits = spark.read.parquet(f"{folder}/revisits")
    marked = wanted.join(revisits, wanted["page_id"].eqNullSafe(F.col("__id")) & (digest == F.col("__key")), "left")
    write_warc(warc_records(marked), f"{folder}/archives")

    def number(column: str) -> Column:
        return F.nullif(F.regexp_extract(column, rf"<{RECORD_ID}(.*)>", 1), F.lit("")).cast(wanted.schema["page_id"].dataType)

    full = read_warc(spark, f"{folder}/archives").filter(F.col("record_type") == "response")
    responses = full.select(
        number("record_id").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
        "record_type",
        F.lit(None).cast(wanted.schema["page_id"].dataType).alias("refers_to"),
    )
    bare = read_warc(spark, f"{folder}/archives", payload=False).filter(F.col("record_type") == "revisit")
    references = bare.select(
        number("record_id").alias("page_id"),
        F.col("payload_length").cast("bigint").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
    return responses.unionByName(references)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_pages(table(spark, folder, "pages"), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")


QUERIES = {"op9_warc": op9_warc}

SQL = {
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        b AS (SELECT page_id, strlen(h) AS n, unhex(sha1(h))::BIT::VARCHAR AS bits, max(page_id) OVER (PARTITION BY h) AS top FROM p)
        SELECT page_id, n AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + list_sum(list_transform(range(0, 5), lambda j: CASE WHEN substr(bits, 5 * i + j + 1, 1) = '1' THEN 1 << (4 - j) ELSE 0 END))::INT, 1)), '') AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM b"""
}
