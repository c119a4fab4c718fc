"""WARC records in ZIP archives: a writer, and a reader by central directory and range reads.

An archive holds two stored (uncompressed) members: `data.warc`, the records, and `index.cdxj`, a line for each
record with its place. The reader takes the end-of-central-directory record (and its ZIP64 counterpart) from the
archive's tail, walks the central directory, finds where each member's bytes begin, reads the index, and then
reads records by their ranges; nothing is extracted. Archives are written to the shared folder through a file
system chosen by its URI, under a temporary name and then moved, so a task that runs again leaves one file.

A response's block is an HTTP message whose body is the payload; a revisit has none. A response that others can revisit
has the record id `urn:page:<page_id>:<digest>`; other records add their place, so that all ids differ.

Defined results: a null html is an empty payload; of records with equal payloads of at least LEAST bytes the one
with the largest page_id is the response and the others revisit it; rows that repeat a page_id with equal payloads
give one response and revisits of it; rows with null page_id are written as responses; a null url is empty; a payload
is written and read whole, however long; an empty table gives no archive; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm import scratch
from rasterloom.operators.graph import joined

LEAST = 0
#: An archive is closed once it holds so many bytes.
ARCHIVE_BYTES = 64 << 20
#: Records that lie together are fetched by one read of about so many bytes.
READ_BYTES = 4 << 20
#: Payloads with copies that may be broadcast, about 50 MB.
TOP_ROWS = 500_000
#: Up to so many archives, a task reads one; of more, each task reads its share of at most ARCHIVES_A_TASK.
READ_TASKS, ARCHIVES_A_TASK = 10_000, 16
DATA, INDEX = "data.warc", "index.cdxj"

# Signatures and layouts of the ZIP format.
_LOCAL = struct.Struct("<4s5H3L2H")
_CENTRAL = struct.Struct("<4s6H3L5H2L")
_END = struct.Struct("<4s4H2LH")
_END64 = struct.Struct("<4sQ2H2L4Q")
_LOCATOR = struct.Struct("<4sLQL")
_TOP16, _TOP32 = 0xFFFF, 0xFFFFFFFF


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(fields: dict[str, str], body: bytes) -> bytes:
    """One WARC/1.1 record."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\n{head}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """The fields and the body of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size : size + 4] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return fields, rest[:size]


_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def http(payload: bytes) -> bytes:
    """The HTTP message that carries a page."""
    return _HTTP.format(len(payload)).encode() + payload


def body_of(message: bytes) -> bytes:
    """The body of an HTTP message."""
    return message.partition(b"\r\n\r\n")[2]


class ZipWriter:
    """A ZIP of stored members, written in one pass; sizes follow the data in the central directory (ZIP64 if needed)."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at, self.members = out, zip64, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        # bit 3: sizes and checksum follow the data
        raw = name.encode()
        self.members.append({"name": raw, "header": self.at, "size": 0, "crc": 0})
        self._put(_LOCAL.pack(b"PK\3\4", 45, 8, 0, 0, 0x21, 0, 0, 0, len(raw), 0) + raw)

    def write(self, data: bytes) -> None:
        m = self.members[-1]
        m["crc"] = zlib.crc32(data, m["crc"])
        m["size"] += len(data)
        self._put(data)

    def end(self) -> None:
        m = self.members[-1]
        wide = self.zip64 or m["size"] >= _TOP32
        self._put(struct.pack("<4sL2Q" if wide else "<4sL2L", b"PK\7\x08", m["crc"], m["size"], m["size"]))

    def close(self) -> None:
        start = self.at
        for m in self.members:
            wide = self.zip64 or m["size"] >= _TOP32 or m["header"] >= _TOP32
            extra = struct.pack("<2H3Q", 1, 24, m["size"], m["size"], m["header"]) if wide else b""
            size, header = (_TOP32, _TOP32) if wide else (m["size"], m["header"])
            self._put(_CENTRAL.pack(b"PK\1\2", 45, 45, 8, 0, 0, 0x21, m["crc"], size, size, len(m["name"]), len(extra), 0, 0, 0, 0, header) + m["name"] + extra)
        length, n = self.at - start, len(self.members)
        wide = self.zip64 or start >= _TOP32 or n >= _TOP16
        if wide:
            here = self.at
            self._put(_END64.pack(b"PK\6\6", _END64.size - 12, 45, 45, 0, 0, n, n, length, start))
            self._put(_LOCATOR.pack(b"PK\6\7", 0, here, 1))
        n16, n32 = (_TOP16, _TOP32) if wide else (n, start)
        self._put(_END.pack(b"PK\5\6", 0, 0, n16, n16, _TOP32 if wide else length, n32, 0))


class ZipReader:
    """The stored members of an archive, by range reads. read(at, n) gives n bytes; size: of the archive."""

    def __init__(self, read, size: int):
        self.read = read
        tail_at = max(0, size - (_END.size + _TOP16 + _LOCATOR.size))
        tail = read(tail_at, size - tail_at)
        k = tail.rfind(b"PK\5\6")
        while k >= 0 and (len(tail) - k < _END.size or _END.unpack_from(tail, k)[-1] != len(tail) - k - _END.size):
            k = tail.rfind(b"PK\5\6", 0, k)  # the signature can stand in a comment
        if k < 0:
            raise ValueError("no end of a central directory")
        _, _, _, _, n, length, start, _ = _END.unpack_from(tail, k)
        if (n == _TOP16 or length == _TOP32 or start == _TOP32) and k >= _LOCATOR.size and tail[k - _LOCATOR.size : k - _LOCATOR.size + 4] == b"PK\6\7":
            where = _LOCATOR.unpack_from(tail, k - _LOCATOR.size)[2]
            end64 = _END64.unpack(read(where, _END64.size))
            if end64[0] != b"PK\6\6":
                raise ValueError("no ZIP64 end of a central directory")
            n, length, start = end64[7], end64[8], end64[9]
        self.members: dict[str, tuple[int, int, int]] = {}  # place of the header, size, checksum
        directory, at = read(start, length), 0
        for _ in range(n):
            f = _CENTRAL.unpack_from(directory, at)
            if f[0] != b"PK\1\2":
                raise ValueError("a damaged central directory")
            at += _CENTRAL.size
            name, extra = directory[at : at + f[10]], directory[at + f[10] : at + f[10] + f[11]]
            at += f[10] + f[11] + f[12]
            packed, whole, header = f[8], f[9], f[16]
            while len(extra) >= 4:
                kind, size_ = struct.unpack_from("<2H", extra)
                if kind == 1:
                    values = list(struct.unpack(f"<{size_ // 8}Q", extra[4 : 4 + size_ // 8 * 8]))
                    whole = values.pop(0) if whole == _TOP32 else whole
                    packed = values.pop(0) if packed == _TOP32 else packed
                    header = values.pop(0) if header == _TOP32 else header
                extra = extra[4 + size_ :]
            if f[4] != 0 or packed != whole:
                continue  # only stored members can be read by range
            self.members[name.decode()] = (header, whole, f[7])

    def begin(self, name: str) -> int:
        """Where a member's bytes begin."""
        header = self.members[name][0]
        f = _LOCAL.unpack(self.read(header, _LOCAL.size))
        if f[0] != b"PK\3\4":
            raise ValueError("a damaged local header")
        return header + _LOCAL.size + f[9] + f[10]

    def member(self, name: str) -> bytes:
        header, size, crc = self.members[name]
        data = self.read(self.begin(name), size)
        if zlib.crc32(data) != crc:
            raise ValueError(f"{name}: wrong checksum")
        return data


def _opened(uri: str):
    """The file system and path of a URI."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def _write(batches: Iterator[pa.RecordBatch], folder: str, most: int, zip64: bool, captured: str) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    ctx = TaskContext.get()
    task, attempt = ctx.partitionId(), ctx.taskAttemptId()
    fs, base = _opened(folder)
    state: dict = {"n": 0, "out": None, "made": []}

    def close() -> None:
        z = state["zip"]
        z.end()
        z.begin(INDEX)
        z.write("".join(state["lines"]).encode())
        z.end()
        z.close()
        state["out"].close()
        fs.move(state["temp"], state["path"])
        state["made"].append((state["path"].rsplit("/", 1)[-1], len(state["lines"])))
        state["out"] = None

    for batch in batches:
        for row in batch.to_pylist():
            if state["out"] is None:
                name = f"part-{task:06d}-{state['n']:05d}.wacz"
                state["n"] += 1
                state["path"], state["temp"] = f"{base}/{name}", f"{base}/.{name}.{attempt}"
                state["out"] = fs.open_output_stream(state["temp"])
                state["zip"], state["lines"], state["at"] = ZipWriter(state["out"], zip64), [], 0
                state["zip"].begin(DATA)
            payload = (row["html"] or "").encode()
            digest = payload_digest(payload)
            key = "null" if row["page_id"] is None else quote(str(row["page_id"]), safe="")
            revisit = row["of"] is not None
            name = f"{key}:{digest}" if row["first"] and not revisit and row["page_id"] is not None else f"{key}:{digest}:{task}.{state['n']}.{len(state['lines'])}"
            fields = {
                "WARC-Type": "revisit" if revisit else "response",
                "WARC-Record-ID": f"<urn:page:{name}>",
                "WARC-Date": captured,
                "WARC-Target-URI": (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A"),
                "Content-Type": "application/http; msgtype=response",
                "WARC-Payload-Digest": f"sha1:{digest}",
                "WARC-Payload-Length": str(len(payload)),
            }
            if revisit:
                fields |= {"WARC-Refers-To": f"<urn:page:{quote(str(row['of']), safe='')}:{digest}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
            data = record(fields, b"" if revisit else http(payload))
            state["zip"].write(data)
            state["lines"].append(json.dumps({"page_id": row["page_id"], "offset": state["at"], "length": len(data)}) + "\n")
            state["at"] += len(data)
            if state["at"] >= most:
                close()
    if state["out"] is not None:
        close()
    if state["made"]:
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in state["made"]]), pa.array([m[1] for m in state["made"]], pa.int64())], ["archive", "n_records"])


def packed(pages: DataFrame, folder: str, least: int = LEAST, most: int = ARCHIVE_BYTES, zip64: bool = False, captured: str | None = None) -> DataFrame:
    """Writes all pages to archives in the folder; returns the table of archives (archive, n_records).

    captured: the records' date in UTC, else the present one.
    """
    rows = pages.select("page_id", "url", "html")
    spark = pages.sparkSession
    scratch.bounded(spark)
    captured = captured or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    # of each payload the largest page_id; the hash is of the whole payload, and small sums meet, not pages
    html = F.coalesce("html", F.lit(""))
    keyed = rows.withColumn("digest", F.when((F.octet_length(html) >= least) & F.col("page_id").isNotNull(), F.sha1(html.cast("binary"))))
    top = keyed.where("digest IS NOT NULL").groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("copies")).where("copies > 1").withColumnRenamed("digest", "d")
    top, _ = scratch.written(top, "tops")
    if top.count() <= TOP_ROWS:  # small: the pages need not move
        known = keyed.join(F.broadcast(top), F.col("digest") == F.col("d"), "left")
    else:  # pages are shuffled, but for payloads with very many copies
        known = joined(keyed, "digest", top, "d", "copies", rows.count(), "left")
    # a page_id that repeats: one row is the response
    repeats = rows.where("page_id IS NOT NULL").groupBy("page_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    first = F.row_number().over(Window.partitionBy("page_id", F.sha1(html.cast("binary"))).orderBy("url")) == 1 if repeats else F.lit(True)
    known = known.withColumn("first", first)
    of = F.when(F.col("top").isNotNull() & ((F.col("page_id") != F.col("top")) | ~F.col("first")), F.col("top"))
    final = known.select("page_id", "url", "html", "first", of.alias("of"))
    fs, path = _opened(folder)
    fs.create_dir(path, recursive=True)
    made = final.mapInArrow(lambda batches: _write(batches, folder, most, zip64, captured), "archive string, n_records long")
    return scratch.written(made, "archives")[0]


def _read(batches: Iterator[pa.RecordBatch], folder: str, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    fs, base = _opened(folder)
    for batch in batches:
        for name in batch.column("archive").to_pylist():
            info = fs.get_file_info(f"{base}/{name}")
            with fs.open_input_file(f"{base}/{name}") as f:

                def at(start: int, n: int, f=f) -> bytes:
                    f.seek(start)
                    return f.read(n)

                z = ZipReader(at, info.size)
                begin = z.begin(DATA)
                entries = [json.loads(x) for x in z.member(INDEX).decode().splitlines()]
                k = 0
                while k < len(entries):
                    first, size, upto = entries[k]["offset"], 0, k
                    while upto < len(entries) and (size == 0 or size + entries[upto]["length"] <= READ_BYTES):
                        size += entries[upto]["length"]
                        upto += 1
                    data = at(begin + first, size)
                    rows = []
                    for e in entries[k:upto]:
                        fields, block = parse(data[e["offset"] - first : e["offset"] - first + e["length"]])
                        body = body_of(block)
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        response = fields["WARC-Type"] == "response"
                        if response and (payload_digest(body) != digest or len(body) != int(fields["WARC-Payload-Length"])):
                            raise ValueError(f"{name}: the payload of page {e['page_id']} does not match its digest")
                        refers = None if response else unquote(fields["WARC-Refers-To"].removeprefix("<urn:page:").partition(":")[0])
                        rows.append((e["page_id"], fields["WARC-Target-URI"], int(fields["WARC-Payload-Length"]), digest, fields["WARC-Type"], refers, body if response else None))
                    cols = list(zip(*rows))
                    kinds = [kind, pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
                    k = upto


def unpacked(archives: DataFrame, folder: str, page_id: str = "bigint") -> DataFrame:
    """All records of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits)."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_type(_parse_datatype_string(page_id))
    n = archives.count()
    spread = archives.select("archive").repartition(max(1, n if n <= READ_TASKS else max(READ_TASKS, -(-n // ARCHIVES_A_TASK))))
    out = spread.mapInArrow(lambda batches: _read(batches, folder, kind), f"page_id {page_id}, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")
    return out.withColumn("refers_to", F.col("refers_to").cast(page_id))


def op9_zip_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = scratch.folder(spark, "wacz")
    archives = packed(pages, folder)
    return unpacked(archives, folder, pages.schema["page_id"].dataType.simpleString()).drop("payload", "url")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST(('0b' || substr(bits, 1 + 5 * i, 5)) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM (SELECT *, list_aggregate(list_transform(generate_series(1, 40), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
    1 + 4 * CAST(('0x' || substr(h, i, 1)) AS INTEGER), 4)), 'string_agg', '') AS bits FROM m)
"""
