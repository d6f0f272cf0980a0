"""Web archives written in deterministic shards, and read back.

A record's place is its order text: page_id, then a digest of the rest. A narrow row
per record (no html) decides which record of equal payloads is the response and which
shard a record goes to: the order texts are cut where the bytes before them pass a
multiple of the shard's size, found digit by digit over sums of bytes, so a page_id with
very many records is cut as well. Then narrow rows and payloads are shuffled once, by
shard, and sorted; a task streams its shards into files of one gzip member per record,
closes a file when its compressed size reaches ``roll_bytes``, and makes headers,
digests and record ids anew. Equal tables give equal files, byte for byte.

Files are written under names of the task attempt in ``pending/``. What the attempts
that succeeded wrote is listed, moved to its final name by a job that can be repeated,
and the list becomes ``manifest/`` last of all. A reader follows the manifest alone, so
a lost executor, a repeated task or a driver that dies leaves no half archive.

The folder is reached through ``pyarrow.fs`` from driver and executors: a shared
folder, or a store pyarrow knows.

Defined cases: null html is an empty payload; a null page_id comes last and stays null;
rows with equal page_id are records of their own, ordered by a digest of url and
payload, and of rows equal in all three one is the response; a null url has no target
header; control characters and spaces around a url are percent-encoded in the archive;
a payload longer than a file is a file with one record; an empty table gives a manifest
without files; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import arrow_rows, settle
from millrace.operators.scale import join_per_key
from millrace.session import scratch_path

DATE = "2000-01-01T00:00:00Z"
#: A shard's uncompressed bytes: a 64th of the table, between these bounds.
SHARD_LEAST, SHARD_MOST = 1 << 20, 1 << 28
ROLL_BYTES = 1 << 26
#: Equal records in one narrow row, and bytes a record takes beside its payload.
CHUNK, HEAD_BYTES = 10_000, 512
#: Payload digests a task remembers, to send a payload that it has met before only once.
REMEMBERED = 65_536

# Names of the archive format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"

IDENTITY = ("page_id", "url", "sha", "n_bytes", "mark")
MANIFEST = "shard int, number int, file string, pending string, n_records bigint, n_bytes bigint, crc32 bigint"
RECORDS = (
    "page_id bigint, url string, record_type string, record_id string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to bigint, file string, place bigint"
)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    shape = _arrow(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(shape), shape)], schema=shape)


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder, and the folder's name in it."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


# --- what goes where -------------------------------------------------------------------


def order_text(page_id: Column, url: Column, sha: Column) -> Column:
    """Text that sorts like (page_id, digest of url and payload), null page_id last."""
    number = F.lpad(F.hex(page_id.bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    rest = F.upper(F.substring(F.sha1(F.concat(F.when(url.isNull(), "0").otherwise("1"), F.coalesce(url, F.lit("")), F.lit("\n"), sha)), 1, 16))
    return F.concat(F.when(page_id.isNull(), "1").otherwise("0"), F.coalesce(number, F.lit("0" * 16)), rest)


def _payloads(pages: DataFrame) -> DataFrame:
    """Rows with their payload, its digests and their place in the order."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("n_bytes", F.octet_length("payload").cast("bigint"))
    rows = rows.withColumn("mark", F.xxhash64("payload"))
    return rows.withColumn("place", order_text(F.col("page_id"), F.col("url"), F.col("sha")))


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A narrow row per distinct record (a row per ``CHUNK`` of equal ones).

    ``first_*`` name the response of the record's payload; ``whole`` rows are responses
    whatever their payload, and carry it, as it is shorter than ``least_bytes``.
    """
    short = F.when(F.col("n_bytes") < least_bytes, F.col("payload"))
    rows = _payloads(pages).withColumn("small", short)
    records = rows.groupBy(*IDENTITY, "place", "small").agg(F.count("*").alias("copies"))
    payload = ["sha", "n_bytes", "mark"]
    first = records.groupBy(*payload).agg(F.min(F.struct("place", "page_id", "url")).alias("first"))
    known = join_per_key(records, first, payload, "inner")
    known = known.withColumn("whole", F.col("n_bytes") < least_bytes)
    own = (F.col("place") == F.col("first.place")) & F.col("url").eqNullSafe(F.col("first.url"))
    known = known.withColumn("leads", own & ~F.col("whole"))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / CHUNK))
    known = known.withColumn("chunk", F.explode(chunks))
    known = known.withColumn("n", F.least(F.lit(CHUNK), F.col("copies") - F.col("chunk") * CHUNK).cast("bigint"))
    full = F.when(F.col("whole"), F.col("n")).when(F.col("leads") & (F.col("chunk") == 0), 1).otherwise(0) * F.col("n_bytes")
    return known.select(
        *IDENTITY, "place", "small", "chunk", "n", "whole", "leads",
        F.col("first.place").alias("first_place"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
        F.concat("place", F.lpad(F.hex("chunk"), 8, "0")).alias("at"), (F.col("n") * HEAD_BYTES + full).alias("weight"),
    )


def cut_places(records: DataFrame, bytes_each: int) -> list[str]:
    """Beginnings of the order text ``at`` where a new shard starts.

    Bytes are summed by the text's beginning; a beginning that holds more than a
    shard is looked at one digit further. The driver sees sixteen sums for each of these,
    so their number follows that of the shards.
    """
    ends = records.agg(F.min("at"), F.max("at")).first()
    if ends[0] is None:
        return []
    length = next((i for i, (a, b) in enumerate(zip(*ends)) if a != b), len(ends[0])) + 1
    spark, found, inside = records.sparkSession, [], records
    while True:
        sums = inside.groupBy(F.substring("at", 1, length).alias("start")).agg(F.sum("weight").alias("weight")).collect()
        wide = [r["start"] for r in sums if r["weight"] > bytes_each and length < len(ends[0])]
        found += [(r["start"], r["weight"]) for r in sums if r["start"] not in set(wide)]
        if not wide:
            break
        heavy = spark.createDataFrame([(w,) for w in wide], "start string")
        inside = records.withColumn("start", F.substring("at", 1, length)).join(heavy, "start", "left_semi").drop("start")
        length += 1
    cuts, held = [], 0
    for start, weight in sorted(found):
        if held and held + weight > bytes_each:
            cuts.append(start)
            held = 0
        held += weight
    return cuts


def shard_of(cuts: list[str]):
    """Column function: number of the shard of an order text."""
    edges = np.array(cuts, dtype="S")

    @F.pandas_udf("int")
    def place(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, at.to_numpy().astype("S"), side="right") if len(edges) else np.zeros(len(at), int))

    return place


def _first_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leave out payloads that this task has sent before, under an earlier place."""
    met: OrderedDict[tuple, tuple] = OrderedDict()
    for batch in batches:
        keep = []
        for sha, mark, place, url in zip(*(batch.column(c).to_pylist() for c in ("sha", "mark", "place", "url"))):
            here, known = (place, url or ""), met.get((sha, mark))
            keep.append(known is None or here < known)
            if keep[-1]:
                met[(sha, mark)] = here
                if len(met) > REMEMBERED:
                    met.popitem(last=False)
        yield batch.filter(pa.array(keep, pa.bool_()))


# --- records ---------------------------------------------------------------------------


def base32(sha: str) -> str:
    """A hex SHA-1 in bare upper-case base32."""
    return base64.b32encode(bytes.fromhex(sha)).decode()


def _id(place: str, sha: str, url: str | None, number: int) -> str:
    """A record's id: the same for the same record in every run."""
    told = hashlib.sha1(f"{place}\n{sha}\n{number}\n{'' if url is None else '=' + url}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=told[:16], version=5)}>"


def header_text(url: str) -> str:
    """A url on one header line: control characters and blanks at its ends as percent codes."""
    body = re.sub(r"[\x00-\x1f\x7f\x85\u2028\u2029]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)
    return re.sub(r"^\s+|\s+$", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), body)


def _record(kind: str, ident: str, date: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record; fields without a value are left out."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
    named = [("WARC-Type", kind), ("WARC-Record-ID", ident), ("WARC-Date", date), *fields, ("WARC-Block-Digest", digest), ("Content-Length", len(block))]
    head = "".join(f"{name}: {value}\r\n" for name, value in named if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _http(n_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()


def response(row: dict, number: int, payload: bytes, date: str = DATE) -> bytes:
    """A record with the whole payload; its digest is taken anew and must be the planned one."""
    if hashlib.sha1(payload).hexdigest() != row["sha"]:
        raise ValueError(f"payload of page {row['page_id']} is not the one that was planned")
    fields = [
        ("WARC-Target-URI", None if row["url"] is None else header_text(row["url"])), ("Page-ID", row["page_id"]),
        ("Content-Type", HTTP), ("WARC-Payload-Digest", "sha1:" + base32(row["sha"])),
    ]
    return _record("response", _id(row["place"], row["sha"], row["url"], number), date, fields, _http(len(payload)) + payload)


def revisit(row: dict, number: int, date: str = DATE) -> bytes:
    """A record that points at the response of the same payload."""
    to = row["first_url"]
    fields = [
        ("WARC-Target-URI", None if row["url"] is None else header_text(row["url"])), ("Page-ID", row["page_id"]), ("Content-Type", HTTP),
        ("WARC-Payload-Digest", "sha1:" + base32(row["sha"])), ("WARC-Profile", PROFILE),
        ("WARC-Refers-To", _id(row["first_place"], row["sha"], to, 0)), ("WARC-Refers-To-Date", date),
        ("WARC-Refers-To-Target-URI", None if to is None else header_text(to)), ("Refers-To-Page-ID", row["first_id"]),
    ]
    return _record("revisit", _id(row["place"], row["sha"], row["url"], number), date, fields, _http(row["n_bytes"]))


class _Files:
    """Files of one shard, under names of the task attempt."""

    def __init__(self, path: str, shard: int, attempt: str, roll_bytes: int, date: str):
        self.fs, self.root = store(path)
        self.shard, self.attempt, self.roll_bytes, self.date = shard, attempt, roll_bytes, date
        self.number, self.out, self.listed = 0, None, []

    def add(self, record: bytes) -> None:
        """Append a record as a gzip member; close the file when it is full."""
        if self.out is None:
            self.name = f"part-{self.shard:07d}-{self.number:05d}.warc.gz"
            self.pending = f"pending/{self.attempt}-{self.name}"
            self.out, self.size, self.crc, self.records = self.fs.open_output_stream(f"{self.root}/{self.pending}", compression=None), 0, 0, 0
            about = f"software: millrace\r\nformat: WARC File Format 1.1\r\nshard: {self.shard}\r\n".encode()
            ident = _id(self.name, "", None, 0)
            fields = [("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
            self._write(_record("warcinfo", ident, self.date, fields, about))
        self._write(record)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _write(self, record: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        for member in (packer.compress(record), packer.flush()):
            self.out.write(member)
            self.size, self.crc = self.size + len(member), zlib.crc32(member, self.crc)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.listed.append((self.shard, self.number, self.name, self.pending, self.records, self.size, self.crc))
            self.out, self.number = None, self.number + 1


def _writer(path: str, roll_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of whole shards to files; holds one payload at a time."""
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        files, held, payload = None, None, None
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in names}
                key = (row["place"], row["sha"], row["mark"], row["url"])
                if row["narrow"] == 0:
                    held, payload = key, row["payload"]
                    continue
                if files is None or files.shard != row["shard"]:
                    if files is not None:
                        files.close()
                        yield _rows(MANIFEST, files.listed)
                    files = _Files(path, row["shard"], attempt, roll_bytes, date)
                for number in range(row["chunk"] * CHUNK, row["chunk"] * CHUNK + row["n"]):
                    if row["whole"]:
                        files.add(response(row, number, row["payload"], date))
                    elif row["leads"] and number == 0:
                        if key != held:
                            raise RuntimeError(f"no payload for page {row['page_id']}")
                        files.add(response(row, number, payload, date))
                    else:
                        files.add(revisit(row, number, date))
        if files is not None:
            files.close()
            yield _rows(MANIFEST, files.listed)

    return write


# --- writing and reading ---------------------------------------------------------------


def write_archive(
    pages: DataFrame, path: str, least_bytes: int = 0, shard_bytes: int | None = None, roll_bytes: int = ROLL_BYTES, date: str = DATE
) -> None:
    """Write (page_id, url, html) as archives below ``path``.

    Of records with equal payloads of at least ``least_bytes`` the first in order is the
    response and the others revisit it. ``shard_bytes`` is a 64th of the table unless named.
    """
    spark = pages.sparkSession
    place, root = store(path)
    if place.get_file_info(f"{root}/manifest").type != pafs.FileType.NotFound:
        raise FileExistsError(path)
    place.create_dir(f"{root}/pending")
    records = settle(plan_records(pages, least_bytes), "warc-plan")
    total = records.agg(F.sum("weight")).first()[0] or 0
    cuts = cut_places(records, shard_bytes or min(max(total // 64, SHARD_LEAST), SHARD_MOST))
    shard = shard_of(cuts)
    narrow = records.select("*", shard("at").alias("shard"), F.lit(1).alias("narrow"), F.col("small").alias("payload"))
    keys = ["page_id", "url", "payload", "sha", "n_bytes", "mark", "place"]
    with arrow_rows(spark, 256):
        rows = _payloads(pages).select(*keys)
        heavy = rows.filter(F.col("n_bytes") >= least_bytes).mapInArrow(_first_met, rows.schema)
        heavy = heavy.withColumn("at", F.concat("place", F.lit("0" * 8)))
        heavy = heavy.select(*keys, shard("at").alias("shard"), F.lit(0).alias("narrow"))
        both = narrow.drop("at", "weight", "small").unionByName(heavy, allowMissingColumns=True)
        count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(cuts) + 1)
        sorted_rows = both.repartition(count, "shard").sortWithinPartitions("shard", "place", "sha", "url", "mark", "narrow", "chunk")
        manifest = settle(sorted_rows.mapInArrow(_writer(path, roll_bytes, date), MANIFEST), "warc-manifest")
    publish(manifest, path)


def publish(manifest: DataFrame, path: str) -> None:
    """Move the listed files to their names, then the list; may be repeated after a failure."""
    place, root = store(path)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, folder = store(path)
        for batch in batches:
            for row in batch.to_pylist():
                final = f"{folder}/{row['file']}"
                if here.get_file_info(f"{folder}/{row['pending']}").type == pafs.FileType.File:
                    here.move(f"{folder}/{row['pending']}", final)
                if here.get_file_info(final).size != row["n_bytes"]:
                    raise RuntimeError(f"{final} is not the file that was written")
            yield batch

    listed = f"pending/manifest-{uuid.uuid4().hex}"
    manifest.repartition("file").mapInArrow(move, MANIFEST).write.json(f"{path.rstrip('/')}/{listed}")
    place.move(f"{root}/{listed}", f"{root}/manifest")
    # What is left belongs to attempts that did not count.
    place.delete_dir(f"{root}/pending")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of a finished archive: (shard, number, file, pending, n_records, n_bytes, crc32)."""
    return spark.read.schema(MANIFEST).json(f"{path.rstrip('/')}/manifest")


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """Records of a file, unpacked one gzip member at a time."""
    unpack, parts = zlib.decompressobj(31), []
    while raw := stream.read(size):
        while raw:
            parts.append(unpack.decompress(raw))
            raw = b""
            if unpack.eof:
                raw = unpack.unused_data
                yield b"".join(parts)
                unpack, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("file ends inside a record")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; its block digest is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a record")
    if fields["WARC-Block-Digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise ValueError(f"block of {fields['WARC-Record-ID']} does not match its digest")
    return fields, block


def _told(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    """A row of ``RECORDS`` but for file and place."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number, to = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
    return (
        None if number is None else int(number), fields.get("WARC-Target-URI"), kind, fields["WARC-Record-ID"],
        payload if payloads and kind == "response" else None, length, digest, None if to is None else int(to),
    )


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of a finished archive: the columns of ``RECORDS``, digests checked.

    A revisit's payload is null; ``payload_bytes`` and ``payload_digest`` are of the full
    payload in both kinds. Files are streamed, a record at a time.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, folder = store(path)
        for batch in batches:
            for name, wanted in zip(batch.column("file").to_pylist(), batch.column("n_records").to_pylist()):
                rows, held, number = [], 0, 0
                with here.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        fields, block = parse_record(raw)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append((*_told(fields, block, payloads), name, number))
                        number, held = number + 1, held + (len(block) if payloads else 0)
                        if len(rows) == 1000 or held > 1 << 24:
                            yield _rows(RECORDS, rows)
                            rows, held = [], 0
                if number != wanted:
                    raise ValueError(f"{name} holds {number} records, its manifest says {wanted}")
                yield _rows(RECORDS, rows)

    files = read_manifest(spark, path).select("file", "n_records")
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return files.repartition(count, "file").mapInArrow(parse, RECORDS)


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to the shared folder and read the archives back, digests only."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path, **options)
    return read_archive(pages.sparkSession, path, payloads=False)
