"""Web archives as seekable Zstandard bundles: independent frames, a seek table at the end, and an index of the records."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelight.llm.common import stored, table

LEAST_BYTES = 1000  # of a payload that may be stored as a reference to an equal one
FRAME_BYTES, ARCHIVE_BYTES, LEVEL = 1 << 18, 4 << 20, 3
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the seekable format: magic numbers of a skippable frame and of the seek table's footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
INDEX = "array<struct<page_id: bigint, record_id: string, frame: int, start: bigint, length: bigint>>"


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit holds the HTTP header, the digest and the length of the payload, not the payload."""
    target = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or record_id(page_id))
    block = HTTP + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id(page_id)}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{record_id(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(start, length, header, block) of each record from ``at`` on; raises if the bytes are not records."""
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:head].decode("utf-8", "surrogatepass").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        header = dict(line.split(": ", 1) for line in lines)
        end = head + 4 + int(header["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut off")
        yield at, end + 4 - at, header, data[head + 4 : end]
        at = end + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """A skippable frame with the compressed and the plain size of every frame, and the footer that tells where it begins."""
    body = b"".join(struct.pack("<II", *pair) for pair in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames(content: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of every frame, read from the end of an archive."""
    count, descriptor, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE:
        raise ValueError("the archive has no seek table")
    step = 12 if descriptor & 0x80 else 8  # with a checksum for each frame
    at = len(content) - 9 - count * step
    out, offset = [], 0
    for k in range(count):
        packed, plain = struct.unpack_from("<II", content, at + k * step)
        out.append((offset, packed, plain))
        offset += packed
    return out


def frame(content: bytes, number: int) -> bytes:
    """One frame, unpacked without touching the others."""
    import zstandard

    offset, packed, plain = frames(content)[number]
    return zstandard.ZstdDecompressor().decompress(content[offset : offset + packed], max_output_size=plain)


def _write(schema: T.StructType, frame_bytes: int, archive_bytes: int):
    def run(batches):
        import zstandard
        from pyspark import TaskContext

        task, packer = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=LEVEL)
        done, sizes, index, open_, number = [], [], [], bytearray(), 0

        def close_frame():
            nonlocal open_
            if open_:
                done.append(packer.compress(bytes(open_)))
                sizes.append((len(done[-1]), len(open_)))
                open_ = bytearray()

        def archive():
            nonlocal done, sizes, index, number
            close_frame()
            row = pa.RecordBatch.from_arrays([
                pa.array([f"pages-{task:06d}-{number:04d}.warc.zst"]), pa.array([b"".join(done) + seek_table(sizes)], pa.binary()),
                pa.array([index], pa.list_(pa.struct([("page_id", pa.int64()), ("record_id", pa.string()), ("frame", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))),
            ], schema.names)
            done, sizes, index, number = [], [], [], number + 1
            return row

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]
            for page_id, url, html, digest, refers_to in zip(*columns, strict=True):
                made = record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers_to)
                index.append({"page_id": page_id, "record_id": record_id(page_id), "frame": len(done), "start": len(open_), "length": len(made)})
                open_ += made
                if len(open_) >= frame_bytes:
                    close_frame()
                    if sum(size for size, _ in sizes) >= archive_bytes:
                        yield archive()
        if index:
            yield archive()

    return run


def digests(pages: DataFrame) -> DataFrame:
    html = F.coalesce("html", F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("digest"))


def write_archives(pages: DataFrame, least: int = LEAST_BYTES, frame_bytes: int = FRAME_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, content, index), stored: every archive's name and bytes, and where each of its records lies.

    ``content`` is a complete ``.warc.zst`` file of about ``archive_bytes``. Records go into independent frames of about
    ``frame_bytes`` and are never split; the table behind the last frame gives the size of each. Of equal payloads of at
    least ``least`` bytes the one with the largest page_id is stored (all rows of that id, if it repeats; a null id never is,
    unless all are null), the others refer to it. A null html is an empty payload. Columns other than page_id, url and html
    are not read. Archives are rows of a table, so a task that is tried again leaves no half file; ``save_files`` writes them out.
    """
    full = digests(pages)
    small = full.select("page_id", "digest", F.octet_length("html").alias("bytes")).where(F.col("bytes") >= least)
    repeated = small.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("largest")).where("n > 1 AND largest IS NOT NULL")
    repeated = stored(repeated.select("digest", "largest"), "repeated")
    marked = full.join(repeated, "digest", "left")
    other = F.col("largest").isNotNull() & (F.octet_length("html") >= least) & ~F.coalesce(F.col("page_id") == F.col("largest"), F.lit(False))
    rows = marked.select("page_id", "url", "html", "digest", F.when(other, F.col("largest")).alias("refers_to"))
    schema = T._parse_datatype_string(f"archive string, content binary, index {INDEX}")
    return stored(rows.mapInArrow(_write(schema, frame_bytes, archive_bytes), schema), "archives")


def _read(schema: T.StructType):
    def run(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = []
                for k in range(len(frames(content))):
                    for _, _, header, block in parse(frame(content, k)):
                        rows.append(_row(header, block))
                yield pa.RecordBatch.from_pylist(rows, pa.schema([(f, t) for f, t in zip(schema.names, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)]))

    return run


def _row(header: dict[str, str], block: bytes) -> dict:
    """A record as the query tells it; the payload of a response is measured anew and must fit its header."""
    number = lambda name: None if name == record_id(None) else int(name.rpartition(":")[2])
    digest, length = header["WARC-Payload-Digest"].removeprefix("sha1:"), int(header["WARC-Payload-Length"])
    if header["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, length):
            raise ValueError(f"{header['WARC-Record-ID']}: the payload is not what its header says")
    refers_to = header.get("WARC-Refers-To")
    return {"page_id": number(header["WARC-Record-ID"][1:-1]), "payload_bytes": length, "payload_digest": digest,
            "record_type": header["WARC-Type"], "refers_to": None if refers_to is None else number(refers_to[1:-1])}


def read_archives(archives: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of every archive, frame by frame."""
    schema = T._parse_datatype_string("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
    return archives.select("content").mapInArrow(_read(schema), schema)


def index_of(archives: DataFrame) -> DataFrame:
    """(archive, page_id, record_id, frame, start, length) of every record."""
    return archives.select("archive", F.explode("index").alias("at")).select("archive", "at.*")


def fetch(archives: DataFrame, wanted: DataFrame) -> DataFrame:
    """(page_id, record) of the wanted page_ids: each archive unpacks only the frames that hold one."""
    places = index_of(archives).join(wanted.select("page_id").distinct(), "page_id", "left_semi")
    by_archive = places.groupBy("archive").agg(F.collect_list(F.struct("page_id", "frame", "start", "length")).alias("at"))  # within one archive
    schema = T._parse_datatype_string("page_id bigint, record binary")

    def run(batches):
        for batch in batches:
            for content, at in zip(batch.column("content").to_pylist(), batch.column("at").to_pylist(), strict=True):
                open_ = {k: frame(content, k) for k in {x["frame"] for x in at}}
                cut = [open_[x["frame"]][x["start"] : x["start"] + x["length"]] for x in at]
                yield pa.RecordBatch.from_arrays([pa.array([x["page_id"] for x in at], pa.int64()), pa.array(cut, pa.binary())], schema.names)

    return archives.select("archive", "content").join(by_archive, "archive").select("content", "at").mapInArrow(run, schema)


def save_files(archives: DataFrame, folder: str) -> int:
    """Writes every archive as a file of ``folder``, a URI that pyarrow knows, and returns their number. A file is complete
    before it gets its name, so a repeated task does no harm."""

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with store.open_output_stream(f"{root}/.{name}.part") as out:
                    out.write(content)
                store.move(f"{root}/.{name}.part", f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["files"])

    return archives.select("archive", "content").mapInArrow(run, "files long").agg(F.sum("files")).first()[0] or 0


def op9_seekable_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page, written to archives and read back."""
    return read_archives(write_archives(table(spark, folder, "pages").select("page_id", "url", "html")))


OP9_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    d AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS last_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to FROM d"""
