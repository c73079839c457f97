"""Deterministic WARC 1.1 archives: a sharded writer and a reader.

The files are a pure function of the rows and the parameters, whatever the
partitions of the input or the cluster:

1. Records have one total order: id (nulls last), payload digest, digest of the
   URL.  Their sizes are added up in that order (over narrow rows, range-sorted),
   and every ``shard_bytes`` of them begin a new shard.  Rows equal in id, URL and
   payload are counted first and follow in runs of at most COPIES, so no number of
   them is one task's.
2. Whole records shuffle once, by shard, and are sorted inside it.  A shard's task
   writes them one after another, each a gzip member of its own with regenerated
   headers and digests, and begins a new file once one has ``file_bytes`` compressed.
3. A task writes under a name of its own attempt in ``_temporary``.  Spark's result
   holds one manifest row a file, of successful attempts only; these files are then
   renamed, and the manifest's own rename makes the archive exist.  Readers take the
   files that the manifest names, so a lost executor or driver leaves nothing half
   written in sight.

Of records with equal payloads of at least ``min_revisit`` bytes the one with the
largest id is a response and the others are revisits that refer to it; their
payloads don't shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType

from routekpi.llm.scratch import save, ship

#: Bytes of uncompressed records in a shard, and most shards (they grow past that).
SHARD_BYTES = 16 << 20
MAX_SHARDS = 16_384
#: Compressed bytes after which a shard goes on in a new file.
FILE_BYTES = 256 << 20
#: Least payload that is stored once.
MIN_REVISIT = 1000
#: Equal rows that are one unit of the sort.
COPIES = 1 << 16
#: Bytes that a record's headers take, about.
HEADERS = 700
DATE = "2000-01-01T00:00:00Z"
_URN = "urn:x-page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "shard int, seq int, file string, temp string, records long, bytes long, sha256 string"


# ----------------------------------------------------------------- records

def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_urn(page_id: int | None, digest: str, mark: str, copy: int) -> str:
    """A record's name: its id, its content and its number among equal rows."""
    content = hashlib.sha1(f"{digest}:{mark}".encode()).hexdigest()[:20]
    return f"{_URN}{'' if page_id is None else page_id}:{content}:{copy}"


def page_of(urn: str) -> int | None:
    held = urn[len(_URN) :].split(":")[0]
    return int(held) if held else None


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    return b"".join([b"WARC/1.1\r\n", *[f"{k}: {v}\r\n".encode() for k, v in lines], b"\r\n", block, b"\r\n\r\n"])


def _http(length: int, content_type: str) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {length}\r\n\r\n".encode()


def page_record(urn: str, url: str | None, digest: str, length: int, body: bytes | None, refers_to: str | None, date: str, content_type: str) -> bytes:
    """A response (with its payload) or, with ``refers_to``, a revisit.

    A URL is written with blanks, controls and non-ASCII characters percent-encoded; a null one is left out.
    """
    headers = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{urn}>"), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")))
    headers.append(("Content-Type", "application/http; msgtype=response"))
    headers.append(("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"))
    if refers_to:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    return _record(headers, _http(length, content_type) + (b"" if refers_to else body))


def info_record(name: str, date: str) -> bytes:
    urn = f"urn:x-file:{hashlib.sha1(name.encode()).hexdigest()}"
    headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{urn}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return _record(headers, b"software: routekpi\r\nformat: WARC File Format 1.1\r\n")


def gzip_member(data: bytes, level: int) -> bytes:
    """One gzip member without a time, so that equal data give equal bytes."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# ----------------------------------------------------------------- writing

def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


class _Files:
    """The files of one shard, one after another."""

    def __init__(self, root: str, shard: int, attempt: str, prefix: str, file_bytes: int, level: int, date: str):
        self.fs, self.root = _file_system(root)
        self.shard, self.attempt, self.prefix = shard, attempt, prefix
        self.file_bytes, self.level, self.date = file_bytes, level, date
        self.seq, self.out, self.done = 0, None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.name = f"{self.prefix}-{self.shard:05d}-{self.seq:05d}.warc.gz"
            self.temp = f"_temporary/{self.name}.{self.attempt}"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.root}/{self.temp}", compression=None)
            self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
            self._put(info_record(self.name, self.date))
        self._put(record)
        self.records += 1
        if self.bytes >= self.file_bytes:
            self.close()

    def _put(self, record: bytes) -> None:
        member = gzip_member(record, self.level)
        self.out.write(member)
        self.bytes += len(member)
        self.sha.update(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.seq, self.name, self.temp, self.records, self.bytes, self.sha.hexdigest()))
            self.out, self.seq = None, self.seq + 1


def _writer(root: str, prefix: str, file_bytes: int, level: int, date: str, content_type: str, min_revisit: int):
    """Shards in order -> files; one manifest row for each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        files, done = None, []
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("shard", "id", "url", "digest", "mark", "bytes", "chunk", "n", "body", "lead_id", "lead_mark")]
            for i in range(batch.num_rows):
                shard, page, url, digest, mark, length, chunk, n, body, lead_id, lead_mark = (c[i].as_py() for c in columns)
                if files is None or files.shard != shard:
                    if files is not None:
                        files.close()
                        done += files.done
                    files = _Files(root, shard, attempt, prefix, file_bytes, level, date)
                own = record_urn(page, digest, mark, 0)
                for copy in range(chunk * COPIES, min(n, (chunk + 1) * COPIES)):
                    refers = None
                    if lead_mark is not None:
                        refers = record_urn(lead_id, digest, lead_mark, 0)
                    elif copy and length >= min_revisit:
                        refers = own
                    urn = record_urn(page, digest, mark, copy) if copy else own
                    files.add(page_record(urn, url, digest, length, body, refers, date, content_type))
        if files is not None:
            files.close()
            done += files.done
        if done:
            names = ("shard", "seq", "file", "temp", "records", "bytes", "sha256")
            types = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), types)], names=list(names))

    return write


def _renamer(root: str):
    """Give finished files their names.  Done again after a lost task it finds them named."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(root)
        for batch in batches:
            for row in batch.to_pylist():
                final, temp = f"{base}/{row['file']}", f"{base}/{row['temp']}"
                if fs.get_file_info(temp).type != pafs.FileType.NotFound:
                    fs.move(temp, final)
                if fs.get_file_info(final).size != row["bytes"]:
                    raise OSError(f"{final} isn't the file that was written")
            yield batch

    return rename


def _order() -> list:
    return [F.col("id").asc_nulls_last(), F.col("digest"), F.col("mark"), F.col("chunk")]


def _bounds(units: DataFrame, shard_bytes: int, max_shards: int) -> list[tuple]:
    """The first sort key of every shard but the first: at most ``max_shards`` rows."""
    total = units.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    size = max(shard_bytes, -(-total // max_shards))
    if total <= size:
        return []
    order = _order()
    placed = units.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = save(placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "placed")
    held = placed.groupBy("part").agg(F.sum("weight").alias("held"))
    before = F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row a partition
    offsets = held.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    running = F.sum("weight").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    at = F.col("offset") + F.coalesce(running, F.lit(0))
    key = F.struct("id", "digest", "mark", "chunk")
    firsts = placed.join(offsets, "part").withColumn("shard", F.floor(at / size)).groupBy("shard").agg(F.min_by(key, "place").alias("key"))
    rows = sorted((r.shard, _sort_key(*r.key)) for r in firsts.collect())
    return [k for _, k in rows[1:]]


def _sort_key(page: int | None, digest: str, mark: str, chunk: int) -> tuple:
    return (page is None, page or 0, digest, mark, chunk)


def _shard_of(bounds: list[tuple]):
    """Column function: the shard of a sort key."""
    named = sum(not b[0] for b in bounds)
    ids = np.array([b[1] for b in bounds[:named]], np.int64)

    @F.pandas_udf(IntegerType())
    def shard(none: pd.Series, page: pd.Series, digest: pd.Series, mark: pd.Series, chunk: pd.Series) -> pd.Series:
        none, page = none.to_numpy(bool), page.to_numpy(np.int64)
        low = np.where(none, named, np.searchsorted(ids, page, "left"))
        high = np.where(none, len(bounds), np.searchsorted(ids, page, "right"))
        for i in np.flatnonzero(low < high):  # ids that a shard begins with
            key = (bool(none[i]), 0 if none[i] else int(page[i]), digest.iat[i], mark.iat[i], int(chunk.iat[i]))
            low[i] = bisect_right(bounds, key)
        return pd.Series(low.astype(np.int32))

    return shard(F.col("id").isNull(), F.coalesce("id", F.lit(0)), F.col("digest"), F.col("mark"), F.col("chunk"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", *, prefix: str = "pages",
                   min_revisit: int = MIN_REVISIT, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, max_shards: int = MAX_SHARDS,
                   level: int = 6, date: str = DATE, content_type: str = "text/html; charset=utf-8") -> DataFrame:
    """Write one record per row below ``path`` and return the committed manifest.

    Payloads are the column's bytes (text in UTF-8); null ones are empty.  Null
    ids come last and count as smaller than any other, so a payload's response
    has one only if all of its rows have.  Of rows with a payload's largest id the
    one with the largest MD5 of its URL is the response; of rows equal in all
    three the first copy.  No rows give a manifest without files.  Other columns
    of ``pages`` don't matter.  A record is held whole in its task, as is its row.
    """
    spark = pages.sparkSession
    ship(spark)
    path = path.rstrip("/")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hadoop(f"{path}/manifest")):
        raise FileExistsError(f"{path} holds an archive")
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    rows = rows.select("*", F.sha1("body").alias("digest"), F.coalesce(F.md5("url"), F.lit("")).alias("mark"), F.octet_length("body").cast("long").alias("bytes"))
    names = ["id", "digest", "mark"]
    keys = save(rows.groupBy(*names, "bytes").agg(F.count(F.lit(1)).alias("n")), "keys")

    # the response of every payload that is stored once
    shared = keys.where(F.col("bytes") >= min_revisit).groupBy("digest").agg(F.sum("n").alias("n"), F.max(F.struct("id", "mark")).alias("lead"))
    leads = save(shared.where("n > 1").select(F.col("digest").alias("of"), F.col("lead.id").alias("lead_id"), F.col("lead.mark").alias("lead_mark")), "leads")
    copies = save(keys.where("n > 1").select(F.col("id").alias("c_id"), F.col("digest").alias("c_digest"), F.col("mark").alias("c_mark"), "n"), "copies")

    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}")))
    held = F.least(F.col("n") - F.col("chunk") * COPIES, F.lit(COPIES))
    stored = F.when(F.col("bytes") < min_revisit, held).otherwise((F.col("chunk") == 0).cast("long"))
    units = keys.withColumn("chunk", chunks).select(*names, "chunk", (held * HEADERS + stored * F.col("bytes")).alias("weight"))
    bounds = _bounds(units, shard_bytes, max_shards)

    typed = rows.join(leads, (F.col("digest") == F.col("of")) & (F.col("bytes") >= min_revisit), "left").drop("of")
    first = F.col("lead_mark").isNull() | (F.col("id").eqNullSafe(F.col("lead_id")) & (F.col("mark") == F.col("lead_mark")))
    typed = typed.select("id", "url", "digest", "mark", "bytes", F.when(first, F.col("body")).alias("body"),
                         F.when(~first, F.col("lead_id")).alias("lead_id"), F.when(~first, F.col("lead_mark")).alias("lead_mark"))
    out = typed.select("*", F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("chunk"))
    if copies.limit(1).count():
        same = F.col("id").eqNullSafe(F.col("c_id")) & (F.col("digest") == F.col("c_digest")) & (F.col("mark") == F.col("c_mark"))
        rest = [c for c in typed.columns if c not in names]
        # equal rows: each map task ships one of them
        again = typed.join(copies, same).groupBy(*names).agg(*[F.first(c).alias(c) for c in [*rest, "n"]]).withColumn("chunk", chunks)
        out = out.join(copies.drop("n"), same, "left_anti").unionByName(again)
    dealt = out.withColumn("shard", _shard_of(bounds)).repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", *_order())
    written = save(dealt.mapInArrow(_writer(path, prefix, file_bytes, level, date, content_type, min_revisit), _MANIFEST), "written")

    save(written.mapInArrow(_renamer(path), _MANIFEST), "renamed")
    staged = f"{path}/_manifest-{uuid.uuid4().hex}"
    written.select("shard", "seq", "file", "records", "bytes", "sha256").write.parquet(staged)
    if not fs.rename(hadoop(staged), hadoop(f"{path}/manifest")):
        raise OSError(f"{path}/manifest could not be named")
    fs.delete(hadoop(f"{path}/_temporary"), True)
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed file: shard, seq, file, records, bytes, sha256."""
    return spark.read.parquet(f"{path.rstrip('/')}/manifest")


# ----------------------------------------------------------------- reading

_BLOCK = 1 << 16


def members(stream) -> Iterator[bytes]:
    """The records of a file: its gzip members, one after another."""
    data = stream.read(_BLOCK)
    while data:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if not data:
                raise ValueError("the file ends within a record")
            parts.append(z.decompress(data))
            data = z.unused_data if z.eof else stream.read(_BLOCK)
        yield b"".join(parts)
        data = data or stream.read(_BLOCK)


def parse(record: bytes) -> tuple[dict, bytes]:
    """Headers by lower-case name, and the block; its length and digest are checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    length = int(headers["content-length"])
    block = rest[:length]
    if version != "WARC/1.1" or rest[length:] != b"\r\n\r\n" or headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"damaged record {headers.get('warc-record-id')}")
    return headers, block


def _page(headers: dict, block: bytes) -> tuple:
    """page_id, record id, target URI, type, payload bytes and digest, refers_to, refers_to id, payload."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(line for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")).split(b":")[1])
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:"))
    urn, refers = headers["warc-record-id"][1:-1], headers.get("warc-refers-to", "<>")[1:-1]
    if not refers and (len(payload) != length or hashlib.sha1(payload).digest() != digest):
        raise ValueError(f"damaged payload {urn}")
    return (page_of(urn), urn, headers.get("warc-target-uri"), headers["warc-type"], length, digest.hex(),
            page_of(refers) if refers else None, refers or None, None if refers else payload)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per page record: page_id, record_id, target_uri, record_type, payload_bytes, payload_digest, refers_to, refers_to_record.

    With ``with_payload`` also payload, which is null for revisits (``restore``
    fills it in).  Length and digest are the full payload's: counted anew for
    responses, from the regenerated headers for revisits.  Damaged records are
    errors.  One file is read by one task, record by record.
    """
    ship(spark)
    path = path.rstrip("/")
    files = manifest(spark, path)
    fields = [("page_id", pa.int64()), ("record_id", pa.string()), ("target_uri", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("refers_to_record", pa.string()), ("payload", pa.binary())]
    fields = fields if with_payload else fields[:-1]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(list(columns[i]), t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(path)
        for batch in batches:
            for row in batch.to_pylist():
                rows, held, count = [], 0, 0
                with fs.open_input_stream(f"{base}/{row['file']}", compression=None) as stream:
                    for record in members(stream):
                        headers, block = parse(record)
                        if headers["warc-type"] == "warcinfo":
                            continue
                        rows.append(_page(headers, block))
                        held += len(block) if with_payload else 0
                        count += 1
                        if len(rows) == 4096 or held > 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if count != row["records"]:
                    raise ValueError(f"{row['file']} holds {count} of {row['records']} records")
                if rows:
                    yield batch_of(rows)

    tasks = min(max(files.count(), 1), MAX_SHARDS)
    place = F.pmod(F.xxhash64("file"), F.lit(tasks)) if tasks == MAX_SHARDS else F.row_number().over(Window.orderBy("file")) - 1
    schema = "page_id long, record_id string, target_uri string, record_type string, payload_bytes long, payload_digest string, refers_to long, refers_to_record string"
    dealt = files.select("file", "records", place.cast("int").alias("place")).repartitionById(tasks, F.col("place"))
    return dealt.select("file", "records").mapInArrow(read, schema + (", payload binary" if with_payload else ""))


def restore(records: DataFrame) -> DataFrame:
    """Records of ``read_archives(..., with_payload=True)`` with the payloads of revisits, too."""
    whole = records.where("refers_to_record IS NULL")
    held = whole.select(F.col("record_id").alias("of"), F.col("payload").alias("held"))
    back = records.where("refers_to_record IS NOT NULL").join(held, F.col("refers_to_record") == F.col("of"), "left")
    lost = F.raise_error(F.concat(F.lit("a revisit refers to no response: "), F.col("record_id"))).cast("binary")
    return whole.unionByName(back.withColumn("payload", F.coalesce("held", lost)).select(records.columns))
