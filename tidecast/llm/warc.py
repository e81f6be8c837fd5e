"""WARC archives, written from and read into a chunked record table.

A payload is never handled as a whole behind the row it comes in: it becomes rows of record number and chunk number with at most ``CHUNK`` bytes each.  Every row
carries the length and the digests of the payload up to its own end, so the last row of a record has those of the whole, and a reader that stops early knows
what it has checked.  The table is written once; the rows of equal payloads are found from its last rows, which are narrow, and of each
group the record with the smallest key is kept in full, the others become revisits of it.

To write archives, the chunks of a record and one row with what was decided about it are brought together by record number and sorted, and pass through
each task as a stream.  A payload of one chunk is a plain HTTP response; a longer one has the transfer coding ``chunked``, a frame per
row.  Frames end in a line break, so the archive can be written by Spark's text writer, on any store that Spark writes and with its commit protocol,
and read by its text reader line by line.  The reader goes through the lines as they come, checks every
length and digest, and gives the same table of chunks again.  An archive is compressed as one gzip file and so read by one task; their number follows the
shuffle's partitions.

Equal payloads are those with equal SHA-256 and length.  A key's copies are a skewed join of narrow rows.

Defined cases: a NULL payload is empty.  A NULL key comes after all others and is read back as NULL; of rows with one key and one payload, one is the response
and the others revisit it.  A NULL address has no target line.  Control characters and percent signs of keys and addresses are percent-encoded.  Payloads shorter
than ``least_bytes`` are always responses.  An empty table gives an archive without records, and no rows.  Other columns are ignored.  An archive of others
must be compressed too; its lines have to fit into rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.llm.common import saved
from tidecast.workspace import new_folder, remove_folder

CHUNK = 1 << 16
#: Rows and bytes of the batches that go back to Spark.
ROWS_OUT, BYTES_OUT = 5000, 8 << 20
VERSION, DATE = "WARC/1.0", "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
KEY, REFERS_TO_KEY = "X-Row-Key", "X-Refers-To-Row-Key"
CHUNKS = "record long, chunk int, data binary, bytes long, sha1 binary, last boolean, sha256 binary, key string, uri string"
READ = "record_id string, chunk int, data binary, bytes long, sha1 binary, last boolean, headers map<string,string>, http map<string,string>"
CHUNK_ARROW = pa.schema([("record", pa.int64()), ("chunk", pa.int32()), ("data", pa.binary()), ("bytes", pa.int64()), ("sha1", pa.binary()), ("last", pa.bool_()),
                         ("sha256", pa.binary()), ("key", pa.string()), ("uri", pa.string())])
NAMES = pa.map_(pa.string(), pa.string())
READ_ARROW = pa.schema([("record_id", pa.string()), ("chunk", pa.int32()), ("data", pa.binary()), ("bytes", pa.int64()), ("sha1", pa.binary()), ("last", pa.bool_()),
                        ("headers", NAMES), ("http", NAMES)])


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size_of: int | None) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size; ``size_of``: the column whose lengths count."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[size_of] or b"") if size_of is not None else 0
        if len(held) >= ROWS_OUT or size >= BYTES_OUT:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def pieces_of(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple]:
    """The rows of `CHUNKS` of payloads that come as ``record, key, uri, payload``."""
    for batch in batches:
        payloads = batch.column(3)
        for i, (record, key, uri) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)))):
            payload = memoryview(payloads[i].as_buffer() or b"") if payloads[i].is_valid else memoryview(b"")
            short, long, at = hashlib.sha1(usedforsecurity=False), hashlib.sha256(), 0
            while True:
                piece = payload[at:at + chunk_bytes]
                short.update(piece)
                long.update(piece)
                last = at + len(piece) == len(payload)
                extra = (long.digest(), key, uri) if last else (None, None, None)
                yield (record, at // chunk_bytes, piece.tobytes(), at + len(piece), short.digest(), last, *extra)
                at += len(piece)
                if last:
                    break


def chunk_table(rows: DataFrame, key: str, uri: str, payload: str, chunk_bytes: int = CHUNK) -> DataFrame:
    """The chunked record table of a payload column.  Record numbers hold only for this reading of ``rows``, so write the table before it is read twice."""
    given = rows.select(F.monotonically_increasing_id(), F.col(key).cast("string"), F.col(uri).cast("string"), F.col(payload).cast("binary"))
    return given.toDF("record", "key", "uri", "payload").mapInArrow(lambda b: in_batches(pieces_of(b, chunk_bytes), CHUNK_ARROW, 2), CHUNKS)


def decisions(chunks: DataFrame, key_type: str, least_bytes: int) -> DataFrame:
    """For each record: ``record, uri, key, bytes, sha1`` and, of a revisit, ``first, first_key``: the record with the smallest key and this payload."""
    heads = chunks.where("last").select("record", "uri", "key", "bytes", "sha1", "sha256")
    place = F.struct(F.col("key").isNull().alias("none"), F.col("key").cast(key_type).alias("order"), "record", "key")
    groups = heads.where(F.col("bytes") >= least_bytes).groupBy("sha256", "bytes").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = saved(groups.select("sha256", "bytes", F.col("least.record").alias("first"), F.col("least.key").alias("first_key")), "copies")  # an aggregate below it would keep the join from being split
    again = F.col("first") != F.col("record")
    return heads.join(groups, ["sha256", "bytes"], "left").select("record", "uri", "key", "bytes", "sha1", F.when(again, F.col("first")).alias("first"),
                                                                  F.when(again, F.col("first_key")).alias("first_key"))


def coded(value: str) -> str:
    return "".join(c if c.isprintable() and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record_id(record: int) -> str:
    h = f"{record:032x}"
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def record_head(record: int, key: str | None, uri: str | None, size: int, sha1: bytes, first: int | None, first_key: str | None, chunk_bytes: int) -> bytes:
    """Everything before the payload: the record's own header, and the response's."""
    response = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    length = size if first is None else 0
    if first is None and size > chunk_bytes:
        response += "Transfer-Encoding: chunked\r\n\r\n"
        full, rest = divmod(size, chunk_bytes)
        length = sum(n * (len(f"{x:x}") + 4 + x) for n, x in ((full, chunk_bytes), (1, rest)) if x) + 5
    else:
        response += f"Content-Length: {size}\r\n\r\n"
    fields = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", record_id(record)), ("WARC-Date", DATE),
              ("WARC-Target-URI", None if uri is None else coded(uri)), ("WARC-Payload-Digest", f"sha1:{base32(sha1)}"), (KEY, None if key is None else coded(key))]
    if first is not None:
        fields += [("WARC-Refers-To", record_id(first)), ("WARC-Profile", PROFILE), (REFERS_TO_KEY, None if first_key is None else coded(first_key))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(response.encode()) + length))]
    return f"{VERSION}\r\n{''.join(f'{a}: {b}\r\n' for a, b in fields if b is not None)}\r\n{response}".encode()


def archive_rows(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple]:
    """Rows of an archive, without the line break behind each, from decisions and chunks sorted by record; a decision is chunk -1."""
    head, size, revisit = b"", 0, False
    for batch in batches:
        for record, chunk, data, uri, key, total, sha1, first, first_key in zip(*(c.to_pylist() for c in batch.columns)):
            if chunk < 0:
                size, revisit = total, first is not None
                head = record_head(record, key, uri, total, sha1, first, first_key, chunk_bytes)
                if revisit:
                    yield (head + b"\r\n\r",)
                elif size > chunk_bytes:
                    yield (head[:-1],)
            elif revisit:
                continue
            elif size <= chunk_bytes:
                yield (head + data + b"\r\n\r",)
            else:
                yield (b"%x\r\n" % len(data) + data + b"\r",)
                if (chunk + 1) * chunk_bytes >= size:
                    yield (b"0\r\n\r\n\r\n\r",)


def write_archives(rows: DataFrame, path: str, key: str, uri: str, payload: str, least_bytes: int = 0, chunk_bytes: int = CHUNK) -> str:
    """Write one record per row below ``path``.  One shuffle carries the payloads, by record number, so no key is hot."""
    spark, scratch = rows.sparkSession, new_folder(rows.sparkSession, "chunks")
    chunk_table(rows, key, uri, payload, chunk_bytes).write.option("compression", "zstd").parquet(scratch)
    chunks = spark.read.schema(CHUNKS).parquet(scratch)
    found = saved(decisions(chunks, rows.select(key).schema[0].dataType.simpleString(), least_bytes), "decisions")
    heads = found.select("record", F.lit(-1).alias("chunk"), F.lit(None).cast("binary").alias("data"), "uri", "key", "bytes", "sha1", "first", "first_key")
    bodies = chunks.select("record", "chunk", "data", *(F.lit(None).cast(t).alias(c) for c, t in (
        ("uri", "string"), ("key", "string"), ("bytes", "long"), ("sha1", "binary"), ("first", "long"), ("first_key", "string"))))
    together = heads.unionByName(bodies).repartition("record").sortWithinPartitions("record", "chunk")
    lines = together.mapInArrow(lambda b: in_batches(archive_rows(b, chunk_bytes), pa.schema([("line", pa.binary())]), 0), "line binary")
    lines.select(F.col("line").cast("string").alias("line")).write.option("compression", "gzip").option("lineSep", "\n").text(path)
    remove_folder(spark, scratch)
    return path


class ArchiveReader:
    """Takes an archive line by line and makes the rows of `READ`; see `line`."""

    def __init__(self, chunk_bytes: int, with_data: bool) -> None:
        self.chunk_bytes, self.with_data, self.step = chunk_bytes, with_data, self.between

    def line(self, data: bytes) -> list[tuple]:
        """Rows that are complete with this line (its break included)."""
        self.rows = []
        self.step(data)
        return self.rows

    def end(self) -> None:
        """An archive must not end within a record."""
        if self.step != self.between:
            raise ValueError("an archive ends within a record")

    def between(self, data: bytes) -> None:
        if data.startswith(b"WARC/"):
            self.headers, self.http, self.chunk, self.bytes, self.sha1 = {}, {}, 0, 0, hashlib.sha1(usedforsecurity=False)
            self.held, self.held_bytes, self.step = [], 0, self.head
        elif data.strip(b"\r\n"):
            raise ValueError("no record begins here")

    @staticmethod
    def field(data: bytes, into: dict[str, str]) -> bool:
        """Keep a header line; whether it was one (an empty line ends a header)."""
        text = data.rstrip(b"\r\n").decode("utf-8", "replace")
        name, colon, value = text.partition(":")
        if colon:
            into[name.strip().lower()] = value.strip()
        return bool(text)

    def head(self, data: bytes) -> None:
        if self.field(data, self.headers):
            return
        self.left = int(self.headers["content-length"])
        self.inner = self.http_head if self.headers.get("content-type", "").startswith("application/http") else self.payload
        self.step = self.block
        if not self.left:
            self.finish()

    def block(self, data: bytes) -> None:
        own = data[:self.left]
        self.left -= len(own)
        self.inner(own)
        if not self.left:
            self.finish()
            if data[len(own):].strip(b"\r\n"):
                raise ValueError("a record is longer than its header says")

    def http_head(self, data: bytes) -> None:
        if not self.field(data, self.http):
            self.inner = self.frame if self.http.get("transfer-encoding", "").lower() == "chunked" else self.payload

    def frame(self, data: bytes) -> None:
        if data.strip(b"\r\n"):
            self.frame_left = int(data.split(b";")[0], 16)
            self.inner = self.framed if self.frame_left else self.trailer

    def framed(self, data: bytes) -> None:
        own = data[:self.frame_left]
        self.frame_left -= len(own)
        self.payload(own)
        if not self.frame_left:
            self.inner = self.frame

    def trailer(self, data: bytes) -> None:
        pass

    def payload(self, data: bytes) -> None:
        self.held.append(data)
        self.held_bytes += len(data)
        if self.held_bytes > self.chunk_bytes:
            whole, at = b"".join(self.held), 0
            while len(whole) - at > self.chunk_bytes:
                self.row(whole[at:at + self.chunk_bytes], False)
                at += self.chunk_bytes
            self.held, self.held_bytes = [whole[at:]], len(whole) - at

    def row(self, data: bytes, last: bool) -> None:
        self.sha1.update(data)
        self.bytes += len(data)
        if last or self.with_data:
            self.rows.append((self.headers.get("warc-record-id"), self.chunk, data if self.with_data else None, self.bytes, self.sha1.digest(), last,
                              list(self.headers.items()) if last else None, list(self.http.items()) if last else None))
        self.chunk += 1

    def finish(self) -> None:
        self.row(b"".join(self.held), True)
        self.step = self.between
        declared = self.headers.get("warc-payload-digest")
        if self.headers.get("warc-type") == "response" and declared and declared.startswith("sha1:") and declared[5:] != base32(self.sha1.digest()):
            raise ValueError(f"record {self.headers.get('warc-record-id')}: the payload's digest is not the one in its header")


def read_rows(batches: Iterator[pa.RecordBatch], chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    archive, reader = None, ArchiveReader(chunk_bytes, with_data)
    for batch in batches:
        for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name is None:
                raise ValueError("an archive was split: compress it, or raise spark.sql.files.maxPartitionBytes above its size")
            if name != archive:
                reader.end()
                archive = name
            yield from reader.line(line + b"\n")
    reader.end()


def read_archives(spark: SparkSession, path: str, chunk_bytes: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of archives: the rows of `READ`.

    A record's last row holds its headers (names in lower case), length and digest.  Without data only the last rows are given; the payloads are read and checked all the same.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    whole = F.col("_metadata.file_block_length") == F.col("_metadata.file_size")
    lines = lines.select(F.when(whole, F.hash("_metadata.file_path")).alias("archive"), F.col("value").cast("binary").alias("line"))
    return lines.mapInArrow(lambda b: in_batches(read_rows(b, chunk_bytes, with_data), READ_ARROW, 2), READ)


def records(chunks: DataFrame) -> DataFrame:
    """A row per record: ``key, record_type, payload_bytes, payload_digest`` (of the whole payload, also of a revisit's), ``uri, refers_to``."""
    revisit = F.col("headers")["warc-type"] == "revisit"
    digest = F.regexp_replace(F.col("headers")["warc-payload-digest"], "^sha1:", "")
    bytes_ = F.when(revisit, F.col("http")["content-length"].cast("long")).otherwise(F.col("bytes"))
    plain = [F.url_decode(F.replace(F.col("headers")[name.lower()], F.lit("+"), F.lit("%2B"))) for name in (KEY, "WARC-Target-URI", REFERS_TO_KEY)]
    return chunks.where("last").select(
        plain[0].alias("key"), F.col("headers")["warc-type"].alias("record_type"), bytes_.alias("payload_bytes"), digest.alias("payload_digest"),
        plain[1].alias("uri"), plain[2].alias("refers_to"))
