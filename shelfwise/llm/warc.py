"""WARC archives compressed by Zstandard with a dictionary (operator 6).

Every task writes its rows as archives in the shared folder: a leading skippable frame holds the
dictionary (fitted to at most ``SAMPLES`` payloads of the task), then each record is one frame. The
first page (least id) of equal payloads of at least ``least`` bytes is a response; the others are
revisits that refer to it and carry no payload. Only archives that a finished task names are read, so
a lost task's files don't count.

The reader loads the dictionary from the leading frame, decodes one frame per record in a stream (one
record in memory at a time), and checks version, headers, block length, the end mark, and the payload's
length and digest; a broken archive fails with its path and the record's number.

Cases: null html is an empty payload; a null url has no target header; pages without an id are
responses; rows with the same id and payload are one page, all responses; control characters in a url are
percent-encoded; extra columns are ignored; an empty table gives no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import bounded_batches, hand_off, shuffle_partitions
from shelfwise.session import checkpoint_dir

# Fixed values of the format.
SKIPPABLE = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 64 << 20
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 1 << 20, 16 << 10
READ_BYTES = 1 << 20
RECORD_ID = "urn:page:"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """The bytes of one record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    safe = None if url is None else "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{RECORD_ID}{'' if page_id is None else page_id}>"), ("WARC-Date", date), ("WARC-Target-URI", safe),
              ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
              *([] if refers_to is None else [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>")]), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Checks a record's form and returns its fields; raises ValueError if anything is off."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION or not gap:
        raise ValueError("not a record")
    fields = {}
    for line in lines:
        name, colon, value = line.decode().partition(": ")
        if not colon or name.lower() in fields:
            raise ValueError(f"bad header {line[:80]!r}")
        fields[name.lower()] = value
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise ValueError(f"no {name}")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, {size} announced")
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    length = dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:]).get(b"Content-Length")
    if not gap or length is None:
        raise ValueError("no http length")
    fields["payload"], fields["payload_bytes"] = payload, int(length)
    fields["payload_digest"] = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response":
        if len(payload) != int(length) or payload_digest(payload) != fields["payload_digest"]:
            raise ValueError("payload differs from its length or digest")
    elif fields["warc-type"] != "revisit" or payload or "warc-refers-to" not in fields:
        raise ValueError("bad revisit")
    return fields


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary fitted to some payloads; too few of them serve as they stand."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def read_archive(stream) -> Iterator[bytes]:
    """The records of an open archive, each decoded from its own frame."""
    head = stream.read(8)
    shared, pending = None, head
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", head[4:])[0]
        content = stream.read(size)
        if len(content) != size:
            raise ValueError("dictionary cut short")
        if content[:4] == b"\x28\xb5\x2f\xfd":  # may itself be compressed
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        shared, pending = zstandard.ZstdCompressionDict(content), b""
    decoder = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()
    while True:
        pending = pending or stream.read(READ_BYTES)
        if not pending:
            return
        frame, out = decoder.decompressobj(), []
        while not frame.eof:
            if not pending and not (pending := stream.read(READ_BYTES)):
                raise ValueError("frame cut short")
            out.append(frame.decompress(pending))
            pending = frame.unused_data if frame.eof else b""
        yield b"".join(out)


class _Writer:
    def __init__(self, folder: str, date: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.uri, self.date, self.out, self.done = folder, date, None, []

    def begin(self, samples: list[bytes]) -> None:
        name = f"pages-{uuid.uuid4().hex}.warc.zst"
        self.out, self.records = self.fs.open_output_stream(f"{self.folder}/{name}", compression=None), 0
        content = dictionary(samples)
        self.path, self.encoder = f"{self.uri}/{name}", zstandard.ZstdCompressor(3, dict_data=zstandard.ZstdCompressionDict(content)) if content else zstandard.ZstdCompressor(3)
        if content:
            self.out.write(struct.pack("<II", SKIPPABLE, len(content)) + content)

    def end(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.path, self.records))
            self.out = None

    def write(self, rows: list) -> None:
        for page_id, url, payload, refers_to in rows:
            if self.out is None:
                self.begin(self.samples(rows))
            self.out.write(self.encoder.compress(record(page_id, url, payload, refers_to, self.date)))
            self.records += 1
            if self.out.tell() >= ARCHIVE_BYTES:
                self.end()

    @staticmethod
    def samples(rows: list) -> list[bytes]:
        out, size = [], 0
        for _, _, payload, _ in rows[:SAMPLES]:
            size += len(payload)
            if payload and size <= SAMPLE_BYTES:
                out.append(payload)
        return out


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            if batch.num_rows:
                writer = writer or _Writer(folder, date)
                ids, urls, html, refers = (c.to_pylist() for c in batch.columns)
                writer.write([(i, u, (h or "").encode(), r) for i, u, h, r in zip(ids, urls, html, refers, strict=True)])
        if writer:
            writer.end()
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in writer.done]), pa.array([n for _, n in writer.done], pa.int64())], ["path", "records"])
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the pages as archives below ``folder``; returns ``path, records`` of each."""
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    payload = F.coalesce("html", F.lit(""))
    digests = rows.where(F.col("page_id").isNotNull() & (F.octet_length(payload) >= least)).select("page_id", F.sha1(payload).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last").drop("last")
    revisits = hand_off(digests.join(first, "digest").where("page_id > refers_to").distinct(), "revisits")
    roles = revisits.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to")
    joined = rows.join(roles, (F.col("page_id") == F.col("_page")) & (F.sha1(payload) == F.col("_digest")), "left").select("page_id", "url", "html", "refers_to")
    return hand_off(joined.mapInArrow(_write(folder, date), "path string, records long"), "archives")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    number = lambda v: int(v[len(RECORD_ID) + 1 : -1]) if v and v != f"<{RECORD_ID}>" else None

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    for batch in batches:
        for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, inner = pafs.FileSystem.from_uri(path)
            rows, held, seen = [], 0, 0
            with fs.open_input_stream(inner, compression=None) as stream:
                try:
                    for data in read_archive(stream):
                        f = parse_record(data)
                        seen += 1
                        rows.append((number(f["warc-record-id"]), f.get("warc-target-uri"), f["payload_bytes"], f["payload_digest"], f["warc-type"], number(f.get("warc-refers-to")), f["payload"]))
                        held += len(data)
                        if held > READ_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                except (ValueError, zstandard.ZstdError) as e:
                    raise ValueError(f"{path}, record {seen}: {e}") from e
            if seen != records:
                raise ValueError(f"{path}: {seen} records, {records} written")
            yield batch_of(rows)


def read_archives(archives: DataFrame) -> DataFrame:
    """Records of the archives (``path, records``): ``page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload``."""
    dealt = archives.repartition(shuffle_partitions(archives.sparkSession), "path")
    return dealt.mapInArrow(_read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive_folder(spark) -> str:
    """A new folder in the shared one."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/warc-{uuid.uuid4().hex}"
