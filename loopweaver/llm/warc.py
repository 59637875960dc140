"""WARC archives: writing with revisit records, and a splittable reader.

`write` puts one record per page into gzip archives, each record a member of its own. Of pages with equal payloads of at
least REVISIT_BYTES, that with the largest page_id is a response and the others revisit it; which pages those are comes
from counting digests, so only digests are shuffled as long as the table of repeated ones is small enough to broadcast.
Beyond that payloads are shuffled once, to their digest and a salt, so that no digest's copies meet in one task. Each task
writes whole archives under names of its own, and only tasks that Spark accepts are in the manifest, so retried tasks leave
nothing that is read.

`read` splits archives into byte ranges. A task scans its ranges for gzip magic, takes a place for a member if it inflates
to a WARC header and a block of the length stated there, and owns the records that start inside a range, reading past its
end where the last one does. No index is needed, and an archive's size doesn't bound the parallelism. Bytes are inflated
once and in steps, in time linear in a record's length; memory holds one record and what is handed on.

A null html counts as empty; a null url gives a record without a target; a null page_id gives a record that nothing
refers to. Repeated rows give one record each: of equal payloads under the largest page_id, all rows with that page_id are
responses. An empty table gives no archives and an empty result. Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweaver.llm.chunks import BROADCAST_GROUPS
from loopweaver.llm.common import new_path, remove, stash, table

REVISIT_BYTES = 1000
#: Bytes of an archive after which a task starts another, of a range, and of the ranges that a task reads at most, about.
ARCHIVE_BYTES, RANGE_BYTES, TASK_BYTES = 256 << 20, 8 << 20, 256 << 20
#: Tasks among which the copies of one payload are dealt where payloads are shuffled.
SALTS = 32
#: Arrow's names for stores that Spark's file systems call otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"


def page_uri(page_id: int | None) -> str:
    return f"{_ID}{'none' if page_id is None else page_id}"


def page_of(uri: str | None) -> int | None:
    tail = (uri or "").strip("<>").removeprefix(_ID)
    return int(tail) if tail.lstrip("-").isdigit() else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One gzip member with the page's record."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{page_uri(page_id)}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    if refers_to is None:
        block += payload
    else:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{page_uri(refers_to)}>")]
    fields += [("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def arrow_uri(uri: str) -> str:
    """A path of Spark's as Arrow spells it."""
    scheme, colon, rest = uri.partition("://")
    return SCHEMES.get(scheme, scheme) + colon + rest


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(arrow_uri(uri))


def write(pages: DataFrame) -> DataFrame:
    """Write the archives to the shared folder; their manifest: path and bytes."""
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha1("payload"))
    copies = stash(p.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n")).where("n > 1 and newest is not null").select("digest", "newest"), "copies")
    to = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("newest")), F.col("newest"))
    if copies.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        joined = p.join(F.broadcast(copies), "digest", "left")
    else:
        salted = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = p.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"], "left")
    records = joined.select("page_id", "url", "payload", to.alias("refers_to"))
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    # Made on the driver through Spark, as executors may not be allowed to create folders in some stores.
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _file_system(folder)
        out, size, name = None, 0, ""
        done: list[tuple[str, int]] = []
        for b in batches:
            for page_id, url, payload, refers_to in zip(*(b.column(i).to_pylist() for i in (0, 1)), b.column(2), b.column(3).to_pylist(), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, size = where.open_output_stream(f"{root}/{name}", compression=None), 0
                data = record(page_id, url, payload.as_py(), refers_to)
                out.write(data)
                size += len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{folder}/{name}", size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], names=["path", "bytes"])

    return stash(records.mapInArrow(run, "path string, bytes bigint"), "manifest")


def _fields(head: bytes) -> dict[str, str]:
    pairs = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k}


class Source:
    """Bytes of an archive from some place on, read in steps as they are asked for."""

    def __init__(self, file, start: int, size: int, step: int = 64 << 10):
        self.file, self.start, self.size, self.step = file, start, size, step
        self.parts: dict[int, bytes] = {}

    def part(self, k: int) -> bytes:
        """The k-th step."""
        if k not in self.parts:
            at = self.start + k * self.step
            self.file.seek(min(at, self.size))
            self.parts[k] = self.file.read(max(0, min(self.step, self.size - at)))
        return self.parts[k]

    def rest(self, at: int) -> memoryview:
        """What the step that holds a place has from there on."""
        k, skip = divmod(at - self.start, self.step)
        return memoryview(self.part(k))[skip:]

    def find(self, what: bytes, at: int, end: int) -> int:
        """The first place from at on, and before end, where what stands; -1 if there is none."""
        while at < end:
            k, skip = divmod(at - self.start, self.step)
            low = self.start + k * self.step
            data = self.part(k)
            found = data.find(what, skip)
            if found < 0:  # it may reach into the next step
                tail = max(skip, len(data) - len(what) + 1)
                edge = (data[tail:] + self.part(k + 1)[: len(what) - 1]).find(what)
                found = tail + edge if edge >= 0 else -1
            if found >= 0:
                return low + found if low + found < end else -1
            at = low + self.step
        return -1

    def drop(self, at: int) -> None:
        """Forget the steps that end before a place."""
        for k in [k for k in self.parts if self.start + (k + 1) * self.step <= at]:
            del self.parts[k]


def member(source: Source, at: int) -> tuple[bytes, int] | None:
    """The inflated record of the member at a place, and where it ends; None if no whole record starts there."""
    z = zlib.decompressobj(31)
    out, place, need = [], at, None
    have, head = 0, bytearray()
    try:
        while not z.eof:
            data = source.rest(place)
            if not data:
                return None
            out.append(z.decompress(data))
            place += len(data)
            have += len(out[-1])
            if need is None:
                # A header may be of any length once it starts as one.
                seen = max(0, len(head) - 3)
                head += out[-1]
                if not head.startswith(b"WARC/1."[: len(head)]):
                    return None
                stop = head.find(b"\r\n\r\n", seen)
                if stop >= 0:
                    length = _fields(bytes(head[:stop])).get("content-length", "")
                    if not length.isdigit():
                        return None
                    need = stop + 4 + int(length) + 4
            if need is not None and have > need:
                return None
    except zlib.error:
        return None
    return (b"".join(out), place - len(z.unused_data)) if have == need else None


def owned(file, start: int, end: int, size: int) -> Iterator[bytes]:
    """The inflated records that start in a byte range of an archive."""
    source = Source(file, start, size)
    at = start
    while (at := source.find(MAGIC, at, end)) >= 0:
        found = member(source, at)
        if found is None:
            at += 1
            continue
        yield found[0]
        at = found[1]
        source.drop(at)


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """A record's fields, its HTTP fields and its payload."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = block[: int(fields["content-length"])].partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def read(manifest: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """Every record of the archives: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload.

    A revisit's size and digest are those of the payload it stands for; its payload is null.
    """
    ranges_, bytes_ = manifest.agg(F.sum(F.ceil(F.col("bytes") / range_bytes)), F.sum("bytes")).first()
    # Small archives give every core a range; of large ones a task reads several.
    tasks = max(1, min(ranges_ or 1, max(4 * manifest.sparkSession.sparkContext.defaultParallelism, (bytes_ or 0) // TASK_BYTES)))
    ranges = manifest.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint"))).alias("start")).repartition(int(tasks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, size, start in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                where, name = _file_system(path)
                rows: list[tuple] = []
                held = 0
                with where.open_input_file(name) as file:
                    for raw in owned(file, start, min(size, start + range_bytes), size):
                        fields, http, payload = parse(raw)
                        kind = fields["warc-type"]
                        if kind == "response":
                            n, digest = len(payload), hashlib.sha1(payload).hexdigest()
                        else:
                            n, digest = int(http.get("content-length", 0)), base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                            payload = None
                        rows.append((page_of(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind, n, digest, page_of(fields.get("warc-refers-to")), payload if with_payload else None))
                        held += len(payload or b"") if with_payload else 0
                        if len(rows) >= 5000 or held > 32 << 20:
                            yield _rows(rows)
                            rows, held = [], 0
                yield _rows(rows)

    return ranges.mapInArrow(run, "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
    cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds.values(), strict=True)], names=list(kinds))


def op10_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write(table(spark, sf_dir, "pages"))
    records = read(manifest, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    out = stash(records, "records")
    for folder in {r[0].rsplit("/", 1)[0] for r in manifest.select("path").limit(1).collect()}:
        remove(spark, folder)  # a round trip's archives are not its result
    return out
