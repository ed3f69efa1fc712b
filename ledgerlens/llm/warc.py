"""WARC archives with a Zstandard dictionary.

A file starts with a skippable frame that holds the dictionary of its records;
every record follows as a frame of its own, so a record can be read alone from
its offset. The dictionary is trained on records of the same file.

Records with equal payloads of at least ``REVISIT_BYTES`` bytes are written
once: the one with the smallest page id as response, the others as revisits that
refer to it. The payload hash is grouped with sums before the shuffle, and rows
meet their group's first row in a join that Spark can split.

Each task writes files under names of its own and returns them as rows; the
manifest, a table that Spark commits, lists only the files of tasks that
succeeded. A repeated task leaves at most files that no manifest names.

Defined cases: a null payload is empty; a null page id is written without an id
and ranks last; a null url is written as ``about:blank``; of rows that agree in
payload and page id, one (smallest url) is the response; an empty table gives an
empty manifest.
"""

from __future__ import annotations

import hashlib
import re
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_frames, stored
from ledgerlens.session import work_dir

REVISIT_BYTES = 100
ARCHIVE_BYTES = 32_000_000
DICTIONARY_BYTES = 64_000
SAMPLE_BYTES = 4_000_000
READ_TASKS = 20_000
LEVEL = 3
# Fixed values of the format.
SKIPPABLE_MAGIC = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
DICTIONARY_MAGIC = 0xEC30A437
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def response_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _uri(url: str | None) -> str:
    return urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%~-._") if url else "about:blank"


def record(row, date: str) -> bytes:
    """One WARC record. ``row``: page_id, url, payload, payload_bytes, digest, first_id, first_url, revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.payload_bytes}\r\n\r\n".encode()
    block = http if row.revisit else http + row.payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if row.revisit else 'response'}",
        f"WARC-Record-ID: {response_id(row.page_id, row.digest) if row.deduplicated and not row.revisit else f'<urn:uuid:{uuid.uuid4()}>'}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(row.url)}",
        f"WARC-Payload-Digest: sha256:{row.digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if row.page_id is not None:
        head.append(f"X-Page-ID: {row.page_id}")
    if row.revisit:
        head += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {response_id(row.first_id, row.digest)}",
            f"WARC-Refers-To-Target-URI: {_uri(row.first_url)}",
            f"WARC-Refers-To-Date: {date}",
        ]
        if row.first_id is not None:
            head.append(f"X-Refers-To-Page-ID: {row.first_id}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES, sample_bytes: int = SAMPLE_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from records spread over the archive; None when there is too little to train on."""
    step = max(1, -(-sum(map(len, records)) // sample_bytes))
    samples = [r[: 1 << 16] for r in records[::step]]
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples, k=512, d=8)
    except (zstandard.ZstdError, ValueError):
        return None


def archive_bytes(records: list[bytes], level: int = LEVEL) -> bytes:
    """A whole archive: the dictionary in a skippable frame, then a frame per record."""
    trained = train_dictionary(records)
    frames = []
    if trained is not None:
        body = trained.as_bytes()
        packed = zstandard.ZstdCompressor(level=19).compress(body)
        body = min(body, packed, key=len)
        frames = [struct.pack("<II", SKIPPABLE_MAGIC, len(body)), body]
    compressor = zstandard.ZstdCompressor(level=level, dict_data=trained, write_content_size=True, write_checksum=True)
    return b"".join([*frames, *map(compressor.compress, records)])


def archive_records(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of every record in an archive, the dictionary taken from its first frame."""
    at, trained = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        body, at = data[8 : 8 + size], 8 + size
        if struct.unpack_from("<I", body)[0] == ZSTD_MAGIC:
            body = zstandard.ZstdDecompressor().decompress(body)
        trained = zstandard.ZstdCompressionDict(body)
    reader = zstandard.ZstdDecompressor(dict_data=trained)
    view = memoryview(data)
    while at < len(data):
        one = reader.decompressobj()
        parts, begin = [], at
        while not one.eof:
            chunk = view[at : at + (1 << 16)]
            if not len(chunk):
                raise ValueError(f"the record at {begin} is cut off")
            parts.append(one.decompress(chunk))
            at += len(chunk)
        at -= len(one.unused_data)
        yield begin, b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC headers, HTTP head, HTTP body) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    return headers, http, body


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def with_revisits(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, payload_bytes, digest, first_id, first_url, deduplicated, revisit); a revisit has no payload."""
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    last = F.lit((1 << 63) - 1)
    large = rows.filter(F.col("payload_bytes") >= revisit_bytes).withColumn("rank", F.coalesce("page_id", last))
    firsts = large.groupBy("digest").agg(F.min("rank").alias("rank"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # The first row of a digest by (page id, url), and how many rows agree with it in all three.
    narrow = large.join(firsts, ["digest", "rank"]).groupBy("digest", "rank", F.coalesce("url", F.lit("")).alias("u"))
    urls = narrow.agg(F.count(F.lit(1)).alias("copies")).groupBy("digest", "rank").agg(F.min(F.struct("u", "copies")).alias("first"))
    urls = stored(urls.select("digest", "rank", F.col("first.u").alias("first_url"), F.col("first.copies").alias("copies")), "warc-firsts")
    joined = rows.join(urls, "digest", "left")
    first = (F.coalesce("page_id", last) == F.col("rank")) & (F.coalesce("url", F.lit("")) == F.col("first_url"))
    repeated = F.col("rank").isNotNull()
    if urls.filter("copies > 1").head(1):
        # Repeated rows: one of them is the response. Payloads are moved a second time only for this.
        ties = Window.partitionBy("digest", "url").orderBy(F.lit(1))
        leaders = joined.filter(repeated & first).withColumn("tie", F.row_number().over(ties))
        joined = leaders.unionByName(joined.filter(~repeated | ~first).withColumn("tie", F.lit(2)))
        first = F.col("tie") == 1
    revisit = repeated & ~first
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "digest",
        F.when(F.col("rank") != last, F.col("rank")).alias("first_id"), "first_url",
        repeated.alias("deduplicated"), revisit.alias("revisit"),
    )


def write_archives(
    pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", limit: int = ARCHIVE_BYTES, revisit_bytes: int = REVISIT_BYTES
) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) into ``folder``; returns the manifest (file, records, bytes).

    ``limit`` bounds the uncompressed bytes of a file, and so a task's memory.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)

        def flush(records: list[bytes]) -> pd.DataFrame:
            name, data = f"{uuid.uuid4().hex}.warc.zst", archive_bytes(records)
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            return pd.DataFrame({"file": [name], "records": [len(records)], "bytes": [len(data)]})

        held, size = [], 0
        for frame in frames:
            frame = frame.astype({"page_id": object, "first_id": object, "url": object, "payload": object})
            frame = frame.where(frame.notna(), None)
            for row in frame.itertuples(index=False):
                row = row._replace(
                    page_id=None if row.page_id is None else int(row.page_id), first_id=None if row.first_id is None else int(row.first_id)
                )
                held.append(record(row, date))
                size += len(held[-1])
                if size >= limit:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return stored(map_frames(with_revisits(pages, revisit_bytes), write, "file string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the files a manifest names: file, offset, type, ids, uri, payload, payload_bytes, digest, refers_to."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        for frame in frames:
            for name in frame["file"]:
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    data = source.read()
                rows = []
                for offset, raw in archive_records(data):
                    headers, http, body = parse_record(raw)
                    revisit = headers["WARC-Type"] == "revisit"
                    stated = int(re.search(rb"(?m)^Content-Length: (\d+)", http)[1])
                    digest = headers["WARC-Payload-Digest"].partition(":")[2]
                    if not revisit and (hashlib.sha256(body).hexdigest() != digest or len(body) != stated):
                        raise ValueError(f"{name}: the payload at {offset} does not match its digest")
                    page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
                    rows.append((name, offset, headers["WARC-Type"], headers["WARC-Record-ID"], headers["WARC-Target-URI"],
                                 None if page is None else int(page), None if revisit else body, stated, digest,
                                 None if refers is None else int(refers)))
                for start in range(0, len(rows), 1000):
                    out = pd.DataFrame(rows[start : start + 1000], columns=[c.split()[0] for c in columns])
                    yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    columns = ["file string", "offset long", "record_type string", "record_id string", "target_uri string", "page_id long",
               "payload binary", "payload_bytes long", "payload_digest string", "refers_to long"]
    # A stated number: by the manifest's size alone, Spark would read all archives in one task.
    files = manifest.repartition(max(1, min(manifest.count(), READ_TASKS)), "file")
    return map_frames(files, read, ", ".join(columns))


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write archives to the shared work folder and read them back."""
    folder = work_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
