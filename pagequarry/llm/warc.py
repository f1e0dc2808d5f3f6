"""Content-addressed web archive.

``store_pages`` keeps each payload's bytes once, under a verified SHA-256 of
them, in ``payloads``; the exact bytes of every record header stay apart in
``headers``. ``rebuild_records`` joins the two into the original records;
``write_archives`` writes them as gzip members of WARC 1.1 files, and
``read_archives`` parses such files again.

One record of each group of equal payloads of at least ``min_bytes`` bytes is
the response, that with the largest page_id; the others are revisits that name
it and carry no payload. Which one is settled on digests alone, so a payload
that a third of all pages share moves once and no task gathers its group.

Cases: a null html is an empty payload, a null url an empty target; of rows with
equal payload and the same largest page_id one is the response (the last by url,
any of identical ones) and the others revisit that page_id; a null page_id sorts
below all others and reads back as null; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm.common import batches, shared_files, stage, write_file
from pagequarry.session import drop_scratch, scratch_path

DATE = "1970-01-01T00:00:00Z"  # the pages carry no date of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload binary"
_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    value = name.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def record_header(page_id: int | None, url: str, digest: str, size: int, refers_to: int | None, revisit: bool) -> bytes:
    """The header of a record, up to and with the empty line before its block."""
    url = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    lines += ["Content-Type: text/html;charset=utf-8", f"Content-Length: {0 if revisit else size}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass")


def store_pages(pages: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(headers, payloads)``, both written to the shared folder.

    headers: page_id, row, sha256, size, revisit, header (exact bytes);
    payloads: sha256, size, packed (the payload, deflated).
    """
    spark = pages.sparkSession
    chosen = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    packed = chosen.mapInArrow(_digests, "page_id long, url string, sha1 string, sha256 string, size long, packed binary")
    held = scratch_path(spark, "pages")
    packed.withColumn("row", F.monotonically_increasing_id()).write.parquet(held)
    packed = spark.read.parquet(held)
    key = F.struct("page_id", "url", "row")
    narrow = packed.select("page_id", "url", "row", "sha1", "sha256", "size")
    first = narrow.where(F.col("size") >= min_bytes).groupBy("sha256").agg(F.max(key).alias("first"))
    settled = narrow.join(first.hint("merge"), "sha256", "left").withColumn("revisit", F.coalesce(F.col("first.row") != F.col("row"), F.lit(False)))
    headers = stage(settled.mapInArrow(_headers, _HEADERS), "headers")
    # Kept bytes: those of the responses' rows, so copies are dropped where they lie.
    kept = headers.where("not revisit").select("row")
    own = packed.join(kept.hint("merge"), "row", "left_semi").select("sha256", "size", "packed")
    # Records too small for revisits may repeat a payload.
    payloads = stage(own.dropDuplicates(["sha256"]) if min_bytes > 0 else own, "payloads")
    drop_scratch(spark, held)
    return headers, payloads


_HEADERS = "page_id long, row long, sha256 string, size long, revisit boolean, header binary"


def _digests(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("sha1", pa.string()), ("sha256", pa.string()), ("size", pa.int64()), ("packed", pa.binary())])

    def rows() -> Iterator[tuple]:
        for batch in stream:
            for page, url, payload in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["payload"]):
                raw = payload.as_py()
                yield page, url, base32_sha1(raw), hashlib.sha256(raw).hexdigest(), len(raw), zlib.compress(raw, 3)

    return batches(rows(), schema, weight=lambda r: len(r[5]))


def _headers(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("row", pa.int64()), ("sha256", pa.string()), ("size", pa.int64()), ("revisit", pa.bool_()), ("header", pa.binary())])
    for batch in stream:
        rows = [
            (r["page_id"], r["row"], r["sha256"], r["size"], r["revisit"],
             record_header(r["page_id"], r["url"], r["sha1"], r["size"], (r["first"] or {}).get("page_id"), r["revisit"]))
            for r in batch.to_pylist()
        ]
        yield from batches(iter(rows), schema)


def rebuild_records(headers: DataFrame, payloads: DataFrame, whole: bool = True) -> DataFrame:
    """``(page_id, header, payload)``: headers joined to the bytes they stand for.

    ``whole`` gives every record its payload; without it revisits get none, as
    in an archive, and only one header of each digest takes part in the join.
    The bytes are checked against their digest as they are unpacked.
    """
    bodies = headers if whole else headers.where("not revisit")
    joined = bodies.join(payloads.select("sha256", "packed").hint("merge"), "sha256").select("page_id", "sha256", "header", "packed")
    if not whole:
        bare = headers.where("revisit").select("page_id", "sha256", "header", F.lit(None).cast("binary").alias("packed"))
        joined = joined.unionByName(bare)
    return joined.mapInArrow(_unpack, "page_id long, header binary, payload binary")


def _verified(packed: bytes | None, sha256: str) -> bytes:
    if packed is None:
        return b""
    raw = zlib.decompress(packed)
    if hashlib.sha256(raw).hexdigest() != sha256:
        raise ValueError(f"payload {sha256} is damaged")
    return raw


def _unpack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("header", pa.binary()), ("payload", pa.binary())])

    def rows() -> Iterator[tuple]:
        for batch in stream:
            for page, sha, header, packed in zip(*(batch[n].to_pylist() for n in ("page_id", "sha256", "header", "packed"))):
                yield page, header, _verified(packed, sha)

    return batches(rows(), schema, weight=lambda r: len(r[2]))


def write_archives(records: DataFrame, folder: str) -> list[str]:
    """One ``.warc.gz`` file for each partition; returns their names."""

    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = shared_files(folder)
        files.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}.warc.gz"

        def members() -> Iterator[bytes]:
            for batch in stream:
                for header, payload in zip(batch["header"].to_pylist(), batch["payload"].to_pylist()):
                    yield gzip.compress(header + payload + b"\r\n\r\n", 3, mtime=0)

        if write_file(files, f"{root}/{name}", members()):
            yield pa.RecordBatch.from_pydict({"name": [name]})

    return sorted(r["name"] for r in records.mapInArrow(write, "name string").collect())  # a row for each file


def parse_records(raw) -> Iterator[tuple]:
    """Rows of :data:`RECORDS` of an uncompressed stream of WARC records."""
    while line := raw.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields: dict[str, str] = {}
        while (line := raw.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            fields[name.strip().lower()] = value.strip()
        payload = raw.read(int(fields["content-length"]))
        refers = fields.get("warc-refers-to")
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        revisit = fields["warc-type"] == "revisit"
        if not revisit and base32_sha1(payload) != digest:
            raise ValueError(f"record {fields['warc-record-id']} is damaged")
        yield (
            _page(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"],
            _page(refers) if refers else None, digest, None if revisit else payload,
        )


def read_archives(spark: SparkSession, folder: str, names: list[str], payloads: bool = True) -> DataFrame:
    """Records of the files ``names`` below ``folder``, a task for each file."""

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = shared_files(folder)

        def rows() -> Iterator[tuple]:
            for batch in stream:
                for n in batch["id"].to_pylist():
                    with files.open_input_stream(f"{root}/{names[n]}", compression=None) as packed:
                        for row in parse_records(io.BufferedReader(gzip.GzipFile(fileobj=packed), 1 << 20)):
                            yield (*row, 0 if row[5] is None else len(row[5])) if payloads else (*row[:5], None, 0 if row[5] is None else len(row[5]))

        yield from batches(rows(), _RECORDS.append(pa.field("size", pa.int64())), weight=lambda r: len(r[5] or b""))

    numbers = spark.range(0, len(names), 1, max(1, len(names)))
    return numbers.mapInArrow(read, RECORDS + ", size long")


def archive_report(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages to an archive, read it back, one row per page: payload
    size and digest, response or revisit, and the response a revisit names."""
    spark = pages.sparkSession
    headers, payloads = store_pages(pages, min_bytes)
    folder = scratch_path(spark, "archive")
    names = write_archives(rebuild_records(headers, payloads, whole=False), folder)
    read = read_archives(spark, folder, names, payloads=False).drop("payload")
    sizes = read.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("size").alias("payload_bytes"))
    return read.join(sizes.hint("merge"), "payload_digest").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
