"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: pages with equal payloads of at least `LEAST_REVISIT` bytes are one response and revisits to it
(that of the largest id); each task writes its records, sorted, into archives of about `archive_bytes`
under hidden names and renames them when they are complete, so a task that runs again leaves the same
files. Reading: archives are read whole by Spark, the dictionary is loaded from the first frame, every
frame is decoded by itself, and version, headers and lengths are checked; a bad record raises, or is
returned with its error.

Archives go through pyarrow's file systems, so the folder can be any that the executors share. One
archive, and one record, has to fit a task's memory.

Defined results: a null html is an empty payload; a null page id is written without an id and never
referred to; repeated rows are records like any other; an empty table writes nothing and reads as no
rows. A null url is an empty one; control characters in it are percent-encoded. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import salted_lookup
from tabloom.storage import materialize, new_path

LEAST_REVISIT = 1000
ARCHIVE_BYTES = 16 << 20
# Frame numbers, versions and the profile of the formats.
DICTIONARY_FRAME, SKIPPABLE, FRAME, DICTIONARY = 0x184D2A5D, 0x184D2A50, 0xFD2FB528, 0xEC30A437
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
FIELDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
          "payload binary, error string")


def marked(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")) \
        .withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    heads = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest") \
        .agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("copies")) \
        .where("copies > 1 AND head IS NOT NULL").drop("copies")
    heads = materialize(heads, "heads")  # its size is known to the join: few repeats move no payloads
    found = salted_lookup(rows, heads, "payload_digest", F.col("page_id"))
    other = F.col("head").isNotNull() & ~F.col("head").eqNullSafe(F.col("page_id"))
    return found.select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                        F.when(other, "revisit").otherwise("response").alias("record_type"),
                        F.when(other, F.col("head")).alias("refers_to"))


def _id(page: int) -> str:
    return f"<urn:page:{page}>"


def _header(pairs: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in pairs).encode() + b"\r\n"


def record(page, url: str, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One record; a revisit holds the response's HTTP header and no payload."""
    url = "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    pairs = [("WARC-Type", kind), ("WARC-Date", DATE), ("WARC-Target-URI", url)]
    pairs += [("WARC-Record-ID", _id(page))] if page is not None else []
    pairs += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(refers_to))] if kind == "revisit" else []
    pairs += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"),
              ("Content-Length", str(len(block)))]
    return _header(pairs) + block + b"\r\n\r\n"


def dictionary_of(records: list[bytes]) -> bytes:
    """A trained dictionary, or raw content where there is too little to train on."""
    samples = [r[:8192] for r in records[:400]]
    try:
        return zstandard.train_dictionary(32 << 10, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:32 << 10]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    if not data:
        return None
    full = len(data) >= 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY
    return zstandard.ZstdCompressionDict(
        data, dict_type=zstandard.DICT_TYPE_FULLDICT if full else zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes], level: int = 3) -> bytes:
    data = dictionary_of(records)
    packer = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(data), write_content_size=True, write_checksum=True)
    return struct.pack("<II", DICTIONARY_FRAME, len(data)) + data + b"".join(packer.compress(r) for r in records)


def write(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Write marked pages into archives under `folder`; the number of records written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        held, size, part, written = [], 0, 0, 0

        def flush() -> None:
            nonlocal held, size, part, written
            name = f"part-{task.partitionId():06d}-{part:04d}.warc.zst"
            hidden = f"{root}/_{name}.{task.taskAttemptId()}"
            with system.open_output_stream(hidden) as out:
                out.write(archive(held))
            system.move(hidden, f"{root}/{name}")
            written += len(held)
            held, size, part = [], 0, part + 1

        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                held.append(record(*r))
                size += len(held[-1])
                if size >= archive_bytes:
                    flush()
        if held:
            flush()
        yield pa.RecordBatch.from_pydict({"records": pa.array([written], pa.int64())})

    order = ["page_id", "payload_digest", "url"]
    sorted_rows = rows.select("page_id", "url", "payload", "payload_digest", "record_type", "refers_to") \
        .sortWithinPartitions(*order)
    return sorted_rows.mapInArrow(run, "records long").agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]


def frames(data: bytes) -> Iterator[tuple[int, int, int]]:
    """Magic number, first and past-the-end position of every frame, from the block headers alone."""
    at = 0
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError(f"cut off at byte {at}")
        magic, start = struct.unpack_from("<I", data, at)[0], at
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
        elif magic == FRAME:
            flags = data[at + 4]
            single = flags >> 5 & 1
            content = (1 if single else 0, 2, 4, 8)[flags >> 6]
            at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + content
            last = False
            while not last:
                if at + 3 > len(data):
                    raise ValueError(f"cut off at byte {at}")
                head = int.from_bytes(data[at:at + 3], "little")
                last = bool(head & 1)
                at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
            at += 4 * (flags >> 2 & 1)
        else:
            raise ValueError(f"no frame at byte {at}")
        if at > len(data):
            raise ValueError(f"cut off in the frame at byte {start}")
        yield magic, start, at


def parse(data: bytes) -> dict:
    """A record's fields; raises ValueError for a bad version, header, length or digest."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0] not in VERSIONS:
        raise ValueError("bad version line")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError("bad header line")
        fields[name.strip().lower().decode()] = value.strip().decode()
    for needed in ("warc-type", "content-length", "warc-date", "warc-payload-digest"):
        if needed not in fields:
            raise ValueError(f"no {needed}")
    if not fields["content-length"].isdigit():
        raise ValueError("bad Content-Length")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {size} does not fit a block of {len(rest) - 4}")
    http, sep, payload = rest[:size].partition(b"\r\n\r\n")
    length = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if not sep or length is None or kind not in ("response", "revisit"):
        raise ValueError("bad HTTP header or record type")
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload does not fit its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("a revisit has a payload or refers to nothing")

    def page(name: str) -> int | None:
        return int(fields[name].removeprefix("<urn:page:").removesuffix(">")) if name in fields else None

    return {"page_id": page("warc-record-id"), "url": fields.get("warc-target-uri", ""), "record_type": kind,
            "refers_to": page("warc-refers-to"), "payload_bytes": length, "payload_digest": digest,
            "payload": payload, "error": None}


def records(data: bytes, most: int = 1 << 30, strict: bool = True) -> Iterator[dict]:
    """Records of one archive. `most` bounds a record's size in memory."""
    reader, first = zstandard.ZstdDecompressor(), True
    empty = dict.fromkeys(x.split()[0] for x in FIELDS.split(", "))
    try:
        for magic, start, end in frames(data):
            if magic != FRAME:
                if first and magic == DICTIONARY_FRAME:
                    body = data[start + 8:end]
                    if len(body) >= 4 and struct.unpack("<I", body[:4])[0] == FRAME:  # itself compressed
                        body = zstandard.ZstdDecompressor().decompress(body, max_output_size=most)
                    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(body)) if body else reader
                first = False
                continue
            first = False
            try:
                size = zstandard.frame_content_size(data[start:start + 18])
                if size > most:
                    raise ValueError(f"a record of {size} bytes")
                yield parse(reader.decompress(data[start:end], max_output_size=most if size < 0 else 0))
            except (ValueError, zstandard.ZstdError) as e:
                if strict:
                    raise ValueError(f"frame at byte {start}: {e}") from e
                yield empty | {"error": f"frame at byte {start}: {e}"}
    except ValueError as e:
        if strict:
            raise
        yield empty | {"error": str(e)}


def read(spark: SparkSession, folder: str, strict: bool = True, payload: bool = True) -> DataFrame:
    """Records of all archives of a folder; without `payload` that column is null."""
    schema = FIELDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in FIELDS.split(", ")]
        types = dict(zip(names, [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]))
        for batch in batches:
            for data in batch.column(0):
                rows, size = [], 0
                for r in records(data.as_py(), strict=strict):
                    rows.append(r if payload else r | {"payload": None})
                    size += r["payload_bytes"] or 0
                    if size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pydict({k: pa.array([x[k] for x in rows], types[k]) for k in names})
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pydict({k: pa.array([x[k] for x in rows], types[k]) for k in names})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives for all pages into the shared folder and read them back."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    rows = marked(pages)
    _make_folder(spark, folder)
    write(rows, folder)
    return read(spark, folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _make_folder(spark: SparkSession, folder: str) -> None:
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
