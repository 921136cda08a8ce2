"""WARC archives: an index first, then sorted byte-range reads of the selected records.

Every task writes archives of its own and returns one index row per record: file, offset, length, URL
and digest.  Files of attempts that failed are never named by the index.  Reads take the index rows
they want, sort them by place and join neighbouring records into one read.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import scratch
from mercato.llm import tasks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_BYTES = 1 << 30
# Records closer than this are fetched by one read, which ends at so many bytes.
GAP = 64 << 10
READ_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    name: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None
) -> bytes:
    """One record as a gzip member; a revisit keeps the headers of the response alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{name}>" if name is not None else f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        if refers_url is not None:
            fields.append(("WARC-Refers-To-Target-URI", quote(refers_url, safe="!#$%&'()*+,/:;=?@[]~")))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(fields, HTTP head, payload) of one record."""
    plain = zlib.decompress(member, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, http, payload


INDEX = (
    "page_id bigint, url string, payload_digest string, record_type string, file string, offset bigint, length bigint"
)


def with_referrals(df: DataFrame, key: str, url: str, payload: str, least: int) -> DataFrame:
    """(key, url, payload, refers_to, refers_url): rows of a group of equal payloads refer to its largest key.

    Groups are found from digests, combined before the shuffle.  Only rows that a filter of fixed size
    takes for members of a group are shuffled with their payload, and a large group can be split.
    """
    rows = df.select(
        F.col(key).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"),
    ).withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    groups = (
        rows.filter(F.octet_length("payload") >= least)
        .groupBy("sha")
        .agg(F.max(F.struct("page_id", "url")).alias("last"), F.count("*").alias("n"))
        .filter("n > 1 AND last.page_id IS NOT NULL")
        .select("sha", F.col("last.page_id").alias("last_id"), F.col("last.url").alias("last_url"))
    )
    groups = scratch.materialize(groups, "groups")
    seen = tasks.membership(groups.select(F.xxhash64("sha")))
    shared = df.sparkSession.sparkContext.broadcast(seen)
    named = ["page_id", "url", "payload", "sha"]

    def split(flagged: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = batch.column(4).to_numpy(zero_copy_only=False)
                maybe = shared.value[tasks.filter_bits(hashes)]
                part = batch.filter(pa.array(maybe == flagged))
                yield pa.RecordBatch.from_arrays(part.columns[:4], names=named)

        return run

    hashed = rows.withColumn("hash", F.xxhash64("sha"))
    shape = "page_id bigint, url string, payload string, sha string"
    alone = hashed.mapInArrow(split(False), shape).withColumns(
        {"refers_to": F.lit(None).cast("bigint"), "refers_url": F.lit(None).cast("string")}
    )
    member = ~F.col("page_id").eqNullSafe(F.col("last_id")) & (F.octet_length("payload") >= least)
    joined = hashed.mapInArrow(split(True), shape).join(groups, "sha", "left").withColumns(
        {"refers_to": F.when(member, F.col("last_id")), "refers_url": F.when(member, F.col("last_url"))}
    )
    columns = ["page_id", "url", "payload", "refers_to", "refers_url"]
    return alone.select(*columns).unionByName(joined.select(*columns))


def write_archives(
    df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0
) -> DataFrame:
    """Writes one record per row below ``folder`` and returns the stored index.

    ``folder`` must be a place that pyarrow's file systems reach from every executor.
    """
    rows = with_referrals(df, key, url, payload, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        task = TaskContext.get()
        stream, name, at = None, "", 0
        for batch in batches:
            for part in tasks.slices(batch, 2):
                out: list[list] = [[] for _ in range(7)]
                for page, address, text, refers_to, refers_url in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if stream is None or at >= FILE_BYTES:
                        if stream is not None:
                            stream.close()
                        name, at = f"{task.partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                        stream = system.open_output_stream(f"{root}/{name}", compression=None)
                    whole = text.encode()
                    digest = payload_digest(whole)
                    member = record(page, address, whole, digest, refers_to, refers_url)
                    stream.write(member)
                    kind = "response" if refers_to is None else "revisit"
                    for column, value in zip(out, (page, address, digest, kind, name, at, len(member)), strict=True):
                        column.append(value)
                    at += len(member)
                kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[x.split(" ")[0] for x in INDEX.split(", ")])
        if stream is not None:
            stream.close()

    return scratch.materialize(rows.mapInArrow(run, INDEX), "index")


def read_records(selected: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of index rows.

    Rows are dealt by file and stretch of it, sorted by offset, and neighbours are fetched by one read.
    A payload that does not fit its digest raises.
    """
    dealt = (
        selected.select("file", "offset", "length", "page_id", "url")
        .withColumn("stretch", F.floor(F.col("offset") / READ_BYTES))
        .repartition("file", "stretch")
        .sortWithinPartitions("file", "offset")
    )

    def fetch(system: fs.FileSystem, root: str, run_: list[dict]) -> Iterator[tuple[dict, bytes]]:
        first, last = run_[0]["offset"], run_[-1]["offset"] + run_[-1]["length"]
        with system.open_input_file(f"{root}/{run_[0]['file']}") as file:
            data = file.read_at(last - first, first)
        for row in run_:
            yield row, data[row["offset"] - first : row["offset"] - first + row["length"]]

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                end = held[-1]["offset"] + held[-1]["length"] if held else 0
                near = held and held[-1]["file"] == row["file"] and row["offset"] - end <= GAP
                if held and (not near or end - held[0]["offset"] >= READ_BYTES):
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for rows in together(batches):
            out: list[list] = [[] for _ in range(7)]
            for row, member in fetch(system, root, rows):
                fields, http, payload = parse(member)
                sizes = [int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: ")]
                digest, refers_to = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields.get("WARC-Refers-To")
                if refers_to is None and payload_digest(payload) != digest:
                    raise ValueError(f"{row['file']} at {row['offset']}: payload and digest differ")
                values = (
                    row["page_id"],
                    row["url"],
                    fields["WARC-Type"],
                    sizes[0],
                    digest,
                    int(refers_to.removeprefix("<urn:page:").rstrip(">")) if refers_to else None,
                    payload if refers_to is None else None,
                )
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    shape = (
        "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
        "refers_to bigint, payload binary"
    )
    return dealt.mapInArrow(run, shape)


def archived(
    df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0
) -> DataFrame:
    """Every row written as a WARC record below the shared folder and read back through the index.

    Of rows with equal payloads of at least ``least`` bytes the one with the largest key is a response,
    the others revisit it; all smaller ones are responses.  A null payload is empty, a null URL is left
    out of the record, a null key never is a group's response unless the group has no other; repeated
    rows get records of their own; an empty table gives no rows; other columns are not read.
    """
    folder = scratch.new_path(df.sparkSession, "warc")
    index = write_archives(df, folder, key, url, payload, least)
    return read_records(index, folder)
