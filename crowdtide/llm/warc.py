"""WARC archives as a PySpark data source, ``spark.read.format("warc")`` and ``df.write``.

Records are WARC/1.1, each in a gzip member of its own. A member's extra field ``sl`` says
how long it is (the skip-lengths of the standard's annex), so a reader that has seen a
record's headers goes on to the next record without inflating, or even reading, the rest.

Writing: each task writes files of its own, and the commit publishes a manifest that names
them and places at which they can be cut. What a lost task leaves is in no manifest.

Reading: partitions are ranges of files, cut at those places, small files together.
Predicates on record type and other header fields are pushed into the scan and decided on
the parsed headers; payloads of other records, and all payloads if the schema has no ``payload``, are
not decoded. Files are reached by ``pyarrow.fs`` (local, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from crowdtide.llm.common import plain_text, shared_folder, stored, table

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, "
    "content_type string, content_length long, payload_length long, headers map<string,string>, payload binary"
)
COLUMNS = {column.split()[0] for column in SCHEMA.split(", ")}
#: Columns and the named fields they come from.
FIELDS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type",
    "content_length": "content-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WINDOW = 4 << 20  # bytes that are read at once
HEAD = 1 << 14  # bytes of a record that are inflated at first
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000  # of what goes to Spark at once
BLANK = b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str):
    """The file system of a path or URI, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


# writing

def field_value(text) -> str:
    """Without line ends and other controls, which would end or forge a field: they are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(text))


def record(kind: str, record_id: str, payload: bytes, target=None, date=None, refers_to=None, extra=None) -> bytes:
    """A response with its payload, or a revisit with the payload's length and digest alone."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    named = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": date or "1970-01-01T00:00:00Z"}
    named |= {"WARC-Target-URI": target} if target is not None else {}
    named |= {"WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}", "Content-Type": "application/http;msgtype=response"}
    if kind == "revisit":
        named |= {"WARC-Profile": REVISIT, "WARC-Refers-To": refers_to}
    else:
        block += payload
    named |= {k: v for k, v in (extra or {}).items() if v is not None} | {"Content-Length": len(block)}
    head = "".join(f"{k}: {field_value(v)}\r\n" for k, v in named.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + BLANK


def member(data: bytes, level: int = 6) -> bytes:
    """One gzip member with its length in the extra field, if 32 bits hold that."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    whole = 24 + len(body) + 8
    if max(whole, len(data)) >> 32:
        return b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff" + body + tail
    return b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, whole, len(data)) + body + tail


@dataclass
class Written(WriterCommitMessage):
    files: list = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    """Rows of ``record_type, record_id, payload`` and, as far as there, ``target_uri, date, refers_to, headers``."""

    def __init__(self, path: str, schema: StructType, file_bytes: int, cut_bytes: int):
        self.path, self.columns, self.file_bytes, self.cut_bytes = path, schema.names, file_bytes, cut_bytes
        missing = {"record_type", "record_id", "payload"} - set(self.columns)
        if missing:
            raise ValueError(f"an archive needs the columns {sorted(missing)}")

    def write(self, iterator):
        files, top = file_system(self.path)
        files.create_dir(top, recursive=True)
        done, out = Written(), None
        for batch in iterator:
            columns = {c: batch.column(c) for c in self.columns}
            for i in range(batch.num_rows):
                row = {c: v[i].as_py() for c, v in columns.items()}
                data = member(record(
                    row["record_type"], row["record_id"], bytes(row["payload"] or b""), row.get("target_uri"), row.get("date"),
                    row.get("refers_to"), dict(row.get("headers") or {})))
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    at = {"name": name, "bytes": 0, "records": 0, "cuts": [0]}
                    out = files.open_output_stream(f"{top}/{name}", compression=None)  # members are zipped here
                if at["bytes"] - at["cuts"][-1] >= self.cut_bytes:
                    at["cuts"].append(at["bytes"])
                out.write(data)
                at["bytes"] += len(data)
                at["records"] += 1
                if at["bytes"] >= self.file_bytes:
                    out.close()
                    done.files.append(at)
                    out = None
        if out is not None:
            out.close()
            done.files.append(at)
        return done

    def commit(self, messages):
        files, top = file_system(self.path)
        files.create_dir(top, recursive=True)
        with files.open_output_stream(f"{top}/_manifest-{uuid.uuid4().hex}.jsonl") as out:
            out.write("".join(json.dumps(f) + "\n" for m in messages if m for f in m.files).encode())

    def abort(self, messages):
        files, top = file_system(self.path)
        for name in (f["name"] for m in messages if m for f in m.files):
            files.delete_file(f"{top}/{name}")


# reading

@dataclass
class Ranges(InputPartition):
    """Ranges ``(path, start, end)`` that one task reads; records begin at both."""

    ranges: list


class Window:
    """Reads a range of a file in large pieces; what is skipped over is not read."""

    def __init__(self, file, end: int):
        self.file, self.end, self.start, self.data = file, end, 0, b""

    def get(self, at: int, n: int) -> memoryview:
        n = max(0, min(n, self.end - at))
        if not self.start <= at or at + n > self.start + len(self.data):
            self.start, self.data = at, self.file.read_at(min(max(n, WINDOW), self.end - at), at)
        return memoryview(self.data)[at - self.start:at - self.start + n]


def parse_fields(head: bytes) -> dict[str, str]:
    """Named fields, names in lower case; a line that begins with white space goes on with the one before."""
    lines = re.sub(r"\r?\n[ \t]+", " ", head.decode("utf-8", "replace")).split("\n")[1:]
    out: dict[str, str] = {}
    for name, colon, value in (line.partition(":") for line in lines):
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


class Stored:
    """A record at a place of a file: its first bytes, all its bytes, and where the next begins."""

    def __init__(self, window: Window, at: int):
        self.window, self.at, self.next = window, at, None
        self.zipped = bytes(window.get(at, 2)) == b"\x1f\x8b"
        if self.zipped:
            start = bytes(window.get(at, 24))
            if len(start) == 24 and start[3] & 4 and start[12:16] == b"sl\x08\x00":
                self.next = at + struct.unpack("<I", start[16:20])[0]

    def pieces(self):
        """What the record holds, in pieces; of a member without a length the end is then known."""
        if not self.zipped:
            at = self.at
            while piece := self.window.get(at, HEAD if at == self.at else WINDOW):
                at += len(piece)
                yield bytes(piece)
            return
        inflate, at, size = zlib.decompressobj(31), self.at, HEAD
        while not inflate.eof:
            piece = self.window.get(at, size if self.next is None else min(size, self.next - at))
            if not piece:
                raise ValueError("a member of the archive is cut short")
            at, size, rest = at + len(piece), WINDOW, bytes(piece)
            while rest and not inflate.eof:
                yield inflate.decompress(rest, WINDOW)
                rest = inflate.unconsumed_tail
        self.next = at - len(inflate.unused_data)


class Scan:
    """Goes over the records of a range; ``wanted`` decides on the parsed headers."""

    def __init__(self, wanted, payload: bool, verify: bool):
        self.wanted, self.payload, self.verify = wanted, payload, verify

    def records(self, file, path: str, start: int, end: int):
        window, at = Window(file, end), start
        while at < end:
            try:
                stored_here = Stored(window, at)
                row = self.read(stored_here)
                at, before = stored_here.next, at
                if at <= before:
                    raise ValueError("a record without length")
            except (ValueError, zlib.error, KeyError) as error:
                raise ValueError(f"{path} at {at}: {error}") from error
            if row:
                yield row

    def read(self, here: Stored):
        pieces, data = here.pieces(), bytearray()

        def until(mark: bytes, begin: int) -> int:
            while (found := data.find(mark, begin)) < 0:
                piece = next(pieces, None)
                if piece is None:
                    raise ValueError("headers have no end")
                data.extend(piece)
            return found + len(mark)

        head = until(BLANK, 0)
        if not data.startswith(b"WARC/"):
            raise ValueError("no record begins here")
        fields = parse_fields(bytes(data[:head]))
        row = {c: fields.get(n) for c, n in FIELDS.items()}
        length = int(row["content_length"])
        row |= {"content_length": length, "headers": fields, "payload": None, "payload_length": length}
        if (digest := row["payload_digest"]) and digest.lower().startswith("sha1:"):
            row["payload_digest"] = digest[5:]
        if not here.zipped:
            here.next = here.at + head + length + len(BLANK)
        row = row if self.wanted(row) else None
        if row:
            body = head
            if (row["content_type"] or "").startswith("application/http") and length:
                body = until(BLANK, head)
                http = parse_fields(bytes(data[head:body]))
                row["payload_length"] = int(http.get("content-length", 0)) if row["record_type"] == "revisit" else head + length - body
            if self.payload and row["record_type"] != "revisit":
                while len(data) < head + length:
                    data.extend(next(pieces, None) or self.short())
                row["payload"] = bytes(data[body:head + length])
                if self.verify and row["payload_digest"] and base32_sha1(row["payload"]) != row["payload_digest"]:
                    raise ValueError("the payload has another digest")
        while here.next is None:  # a member without its length: inflate to its end
            next(pieces, None)
        return row

    @staticmethod
    def short():
        raise ValueError("a record is cut short")


#: What a predicate ``(column, name, value)`` asks of a header, for the scan and as a filter of Spark.
PREDICATES = {
    "=": (lambda x, v: x == v, lambda c, v: c == v),
    "!=": (lambda x, v: x != v, lambda c, v: c != v),
    "<": (lambda x, v: x < v, lambda c, v: c < v),
    "<=": (lambda x, v: x <= v, lambda c, v: c <= v),
    ">": (lambda x, v: x > v, lambda c, v: c > v),
    ">=": (lambda x, v: x >= v, lambda c, v: c >= v),
    "in": (lambda x, v: x in v, lambda c, v: c.isin(list(v))),
    "starts": (lambda x, v: x.startswith(v), lambda c, v: c.startswith(v)),
    "ends": (lambda x, v: x.endswith(v), lambda c, v: c.endswith(v)),
    "contains": (lambda x, v: v in x, lambda c, v: c.contains(v)),
    "is null": (None, lambda c, v: c.isNull()),
    "is not null": (None, lambda c, v: c.isNotNull()),
}
NAMES = {
    EqualTo: "=", LessThan: "<", LessThanOrEqual: "<=", GreaterThan: ">", GreaterThanOrEqual: ">=", In: "in",
    StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "contains", IsNull: "is null", IsNotNull: "is not null",
}


def holds(row: dict, column: str, name: str, value) -> bool:
    """As a filter of SQL: an absent field meets no comparison."""
    x = row[column]
    if name in ("is null", "is not null"):
        return (x is None) == (name == "is null")
    return x is not None and PREDICATES[name][0](x, value)


def checked(where) -> list:
    """Predicates as given, each on a header's column and with a value that is not null."""
    for column, name, value in where:
        if column not in FIELDS or name not in PREDICATES or (value is None and not name.startswith("is ")):
            raise ValueError(f"no predicate on headers: {(column, name, value)}")
    return [[c, n, sorted(v) if n == "in" else v] for c, n, v in where]


def predicate(f: Filter):
    """A filter of Spark as ``[column, name, value]``; None for others."""
    if isinstance(f, Not):
        inner = predicate(f.child)
        return [inner[0], "!=", inner[2]] if inner and inner[1] == "=" else None
    if type(f) not in NAMES or len(f.attribute) != 1:
        return None
    value = getattr(f, "value", None)
    if isinstance(f, In):
        value = sorted(v for v in value if v is not None)
    return [f.attribute[0], NAMES[type(f)], value]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, split_bytes: int, verify: bool, where: list):
        self.path, self.schema, self.split_bytes, self.verify, self.where = path, schema, split_bytes, verify, where
        unknown = set(schema.names) - COLUMNS
        if unknown:
            raise ValueError(f"an archive has no columns {sorted(unknown)}")

    def pushFilters(self, filters):
        """Takes over the filters that the frame was loaded with, and no others.

        Spark keeps a reader that took a filter for later plans of the same frame, with other
        filters or none; so what the reader drops must depend on how it was loaded alone.
        """
        present = {column for column, name, _ in self.where if name != "is null"}
        for f in filters:
            if not (predicate(f) in self.where or isinstance(f, IsNotNull) and f.attribute[0] in present):
                yield f

    def pieces(self):
        """``(path, start, end)`` of all archives, as fine as they can be cut.

        In a folder with manifests only what they name is read. Else a file is one range,
        since a record's begin can't be told from a payload that looks like one.
        """
        from pyarrow import fs

        files, top = file_system(self.path)
        info = files.get_file_info(top)
        if info.type == fs.FileType.File:
            return [(top, 0, info.size)]
        inside = sorted(files.get_file_info(fs.FileSelector(top, recursive=True)), key=lambda f: f.path)
        manifests = [f.path for f in inside if f.base_name.startswith("_manifest-")]
        out = []
        for path in manifests:
            with files.open_input_stream(path) as lines:
                for f in map(json.loads, lines.read().decode().splitlines()):
                    out += [(f"{path.rpartition('/')[0]}/{f['name']}", a, b) for a, b in zip(f["cuts"], [*f["cuts"][1:], f["bytes"]])]
        if not manifests:
            out = [(f.path, 0, f.size) for f in inside if f.is_file and re.search(r"\.warc(\.gz)?$", f.path) and f.base_name[0] not in "_."]
        return out

    def partitions(self):
        out, size = [], self.split_bytes
        for path, start, end in self.pieces():
            if start == end:
                continue
            if size + end - start > self.split_bytes:
                out.append(Ranges([]))
                size = 0
            out[-1].ranges.append((path, start, end))
            size += end - start
        return out or [Ranges([])]

    def read(self, partition):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(self.schema)
        scan = Scan(lambda row: all(holds(row, *p) for p in self.where), "payload" in self.schema.names, self.verify)
        files, _ = file_system(self.path)

        def batch(rows):
            columns = {c: [r[c] if c != "headers" else list(r[c].items()) for r in rows] for c in self.schema.names}
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

        rows, size = [], 0
        for path, start, end in partition.ranges:
            with files.open_input_file(path) as file:
                for row in scan.records(file, path, start, end):
                    rows.append(row)
                    size += 500 + len(row["payload"] or b"")
                    if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)


class WarcDataSource(DataSource):
    """Options: ``path``; reading ``splitBytes`` (32 MB), ``verify`` (payloads against their digest) and
    ``where``, see :func:`records`; writing ``fileBytes`` (1 GB) and ``cutBytes`` (8 MB between places to cut). Writing only appends."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        where = checked(json.loads(self.options.get("where", "[]")))
        return WarcReader(self.options["path"], schema, int(self.options.get("splitbytes", 32 << 20)), self.options.get("verify", "false").lower() == "true", where)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only appended to; choose another folder")
        return WarcWriter(self.options["path"], schema, int(self.options.get("filebytes", 1 << 30)), int(self.options.get("cutbytes", 8 << 20)))


def use_warc(spark: SparkSession) -> SparkSession:
    """Makes the format known to the session and turns filter pushdown for Python sources on."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def records(spark: SparkSession, path: str, where=(), columns: str = SCHEMA, **options) -> DataFrame:
    """Records of an archive that meet all predicates ``(column, name, value)``, with the columns named.

    Predicates are on columns that come from headers (``FIELDS``), with the names in
    ``PREDICATES``; a record that lacks the field meets none but ``is null``. They are decided
    in the scan, before a payload is decoded. Other filters on the frame are Spark's. Without
    ``payload`` among the columns none is decoded.
    """
    where = checked(where)
    rows = use_warc(spark).read.format("warc").schema(columns).options(where=json.dumps(where), **options).load(path)
    for column, name, value in where:
        if column in rows.columns:  # Spark knows then that the scan has seen to it
            rows = rows.filter(PREDICATES[name][1](F.col(column), value))
    return rows


# pages

def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def urn_page(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Records for the writer: of equal payloads of ``least_bytes`` or more that of the largest id is
    the response, the others revisit it; smaller payloads are all responses.

    Null html is the empty payload. A null id is smaller than any other. Rows that repeat the
    largest id are all responses, with one record id. Payloads with no copy don't wait for a
    join: the groups of copies are a written table of narrow rows, sent to the pages if small;
    else both sides are shuffled, where adaptive execution splits a payload that many pages have.
    """
    payload = F.encode(plain_text(F.col(html_col)), "UTF-8")
    page = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("target_uri"), payload.alias("payload"))
    page = page.withColumn("key", F.when(F.octet_length("payload") >= least_bytes, F.unhex(F.sha2("payload", 256))))
    groups = page.filter(F.col("key").isNotNull()).groupBy("key").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies"))
    groups = stored(groups.filter("copies > 1").select("key", "last"), "copies")
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return page.join(groups, "key", "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), page_urn(F.col("page_id")).alias("record_id"),
        "target_uri", F.when(again, page_urn(F.col("last"))).alias("refers_to"), "payload")


def archived(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the pages in an archive.

    Responses are decoded and held against their digest; of revisits the headers are read alone.
    """
    narrow = "record_id string, record_type string, refers_to string, payload_digest string, payload_length long"
    responses = records(spark, path, [("record_type", "=", "response")], narrow + ", payload binary", verify="true")
    responses = responses.withColumn("payload_length", F.octet_length("payload").cast("long")).drop("payload")
    rows = responses.unionByName(records(spark, path, [("record_type", "=", "revisit")], narrow))
    return rows.select(
        urn_page(F.col("record_id")).alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
        urn_page(F.col("refers_to")).alias("refers_to"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(use_warc(spark))}/warc-{uuid.uuid4().hex}"
    page_records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    return archived(spark, path)


# base32 of the 160 bits: eight times 20 bits, of each four digits
OP13_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
g AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS x, max(page_id) OVER (PARTITION BY payload) AS last FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(x, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM g
"""
