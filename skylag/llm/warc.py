"""WARC archives: written as one gzip stream, normalised to a member per record, read by index.

A whole-file gzip stream can only be read from its start. The normaliser inflates such
a file once, writes every record as a gzip member of its own, and leaves a sidecar
index of offsets beside it. Records then can be read from any offset, so one archive
is read by many tasks.

All three steps are ``mapInArrow`` over rows that Spark deals out. Files are named by
attempt and written by the task itself through ``pyarrow.fs``; only files named in the
rows of a finished task count, so a lost executor costs its tasks and nothing else.
"""

import base64
import hashlib
import re
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import open_store, shared_uri, spread, stored

# Fixed values of the format.
VERSION = b"WARC/1.1"
GZIP = 16 + zlib.MAX_WBITS
# Payloads from this size on are stored once.
REVISIT_BYTES = 1000
# Uncompressed size at which a task starts its next archive.
ROLL_BYTES = 64 << 20
# Records that one row of the index covers.
BLOCK_RECORDS = 200
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"

RECORD_SCHEMA = (
    "record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string"
)


def mark_revisits(pages: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, n_bytes, keep`` for every page.

    ``keep`` is the largest page_id among the pages with the same payload, for payloads
    of at least ``min_bytes`` that occur more than once, else null. A null html is an
    empty payload, a null page_id is smaller than any other, and rows that repeat a
    page_id are separate records with one decision. Further columns are ignored.
    """
    rows = pages.select(
        "page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")
    ).withColumns({"digest": F.sha1("payload"), "n_bytes": F.octet_length("payload").cast("long")})
    # Grouped by digest and size, joined by digest: the join deals both sides anew and can split a hot digest.
    keep = (
        rows.where(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes")
        .agg(F.max("page_id").alias("keep"), F.count("*").alias("copies"))
        .where("copies > 1").select(F.col("digest").alias("kept_digest"), "keep")
    )
    return rows.join(keep, F.col("digest") == F.col("kept_digest"), "left").drop("kept_digest")


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _record(row: dict) -> tuple[bytes, bytes]:
    """Head and payload of one record; a revisit holds the HTTP head only."""
    revisit = row["keep"] is not None and row["keep"] != row["page_id"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['n_bytes']}\r\n\r\n"
    ).encode()
    payload = b"" if revisit else row["payload"]
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row["page_id"])),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + len(payload))),
    ]
    if row["url"] is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\r\n]+", "%0A", row["url"])))
    if revisit:
        head.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        head.append(("WARC-Refers-To", record_id(row["keep"])))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + http, payload


def write_archives(marked: DataFrame, uri: str, roll_bytes: int = ROLL_BYTES, level: int = 6) -> DataFrame:
    """Write the records as monolithic gzip archives; one row ``archive`` for each file."""

    def write(batches):
        import pyarrow as pa

        store, root = open_store(uri)
        store.create_dir(root)
        out = pack = None
        size, names = 0, []
        for batch in batches:
            for k in range(batch.num_rows):
                # One page at a time as Python values: payloads may be large.
                row = {name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns)}
                if out is None:
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, pack, size = store.open_output_stream(f"{root}/{names[-1]}", compression=None), zlib.compressobj(level, 8, GZIP), 0
                for piece in (*_record(row), b"\r\n\r\n"):
                    size += len(piece)
                    out.write(pack.compress(piece))
                if size >= roll_bytes:
                    out.write(pack.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(pack.flush())
            out.close()
        yield pa.RecordBatch.from_pydict({"archive": pa.array(names, pa.string())})

    columns = marked.select("page_id", "url", "payload", "digest", "n_bytes", "keep")
    return columns.mapInArrow(write, "archive string")


class _Inflated:
    """Lines and byte ranges of an inflating gzip file, members joined."""

    def __init__(self, source, limit: int | None = None):
        self.source, self.left = source, limit
        self.inflate, self.buffer, self.pos = zlib.decompressobj(GZIP), b"", 0

    def _more(self) -> bool:
        while True:
            raw = self.inflate.unused_data if self.inflate.eof else b""
            if not raw:
                want = CHUNK if self.left is None else min(CHUNK, self.left)
                raw = self.source.read(want) if want else b""
                if self.left is not None:
                    self.left -= len(raw)
            if self.inflate.eof:
                if not raw:
                    return False
                self.inflate = zlib.decompressobj(GZIP)
            elif not raw:
                if self.inflate.unconsumed_tail or self.buffer[self.pos:]:
                    raise ValueError("the gzip stream ends inside a record")
                return False
            piece = self.inflate.decompress(raw)
            if piece:
                self.buffer, self.pos = self.buffer[self.pos:] + piece, 0
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end."""
        while (at := self.buffer.find(mark, self.pos)) < 0:
            if not self._more():
                return None
        piece, self.pos = self.buffer[self.pos:at + len(mark)], at + len(mark)
        return piece

    def pieces(self, n: int):
        """The next n bytes, in pieces."""
        while n:
            if self.pos == len(self.buffer) and not self._more():
                raise ValueError("the gzip stream ends inside a record")
            piece = self.buffer[self.pos:self.pos + n]
            self.pos += len(piece)
            n -= len(piece)
            yield piece


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines if line)}


def normalise(archives: DataFrame, uri: str, level: int = 6, block_records: int = BLOCK_RECORDS) -> DataFrame:
    """Rewrite monolithic archives with a member per record and a sidecar index.

    Each archive is inflated once, in pieces; a record is never whole in memory. The
    sidecar ``<archive>.idx`` has a line ``offset length record-id`` per record. The
    rows give the index in blocks: ``archive, start, size, records``.
    """

    def rewrite(batches):
        import pyarrow as pa

        store, root = open_store(uri)
        store.create_dir(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                made = f"{name.rpartition('/')[2].removesuffix('.warc.gz')}-{uuid.uuid4().hex}.warc.gz"
                blocks, at, in_block, start = [], 0, 0, 0
                with (
                    store.open_input_stream(f"{root}/{name}", compression=None) as raw,
                    store.open_output_stream(f"{root}/{made}", compression=None) as out,
                    store.open_output_stream(f"{root}/{made}.idx") as index,
                ):
                    source = _Inflated(raw)
                    while (head := source.until(b"\r\n\r\n")) is not None:
                        fields = _fields(head)
                        pack, begin = zlib.compressobj(level, 8, GZIP), at
                        at += out.write(pack.compress(head))
                        for piece in source.pieces(int(fields["content-length"]) + 4):
                            at += out.write(pack.compress(piece))
                        at += out.write(pack.flush())
                        index.write(f"{begin} {at - begin} {fields['warc-record-id']}\n".encode())
                        in_block += 1
                        if in_block == block_records:
                            blocks.append((made, start, at - start, in_block))
                            in_block, start = 0, at
                if in_block:
                    blocks.append((made, start, at - start, in_block))
                columns = list(zip(*blocks)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                    ["archive", "start", "size", "records"],
                )

    return archives.select("archive").mapInArrow(rewrite, "archive string, start long, size long, records long")


def read_records(blocks: DataFrame, uri: str) -> DataFrame:
    """Read the records of index blocks, each from its own offset."""

    def read(batches):
        import pyarrow as pa

        store, root = open_store(uri)
        for batch in batches:
            for block in batch.to_pylist():
                rows = []
                with store.open_input_file(f"{root}/{block['archive']}") as raw:
                    raw.seek(block["start"])
                    source = _Inflated(raw, block["size"])
                    while (head := source.until(b"\r\n\r\n")) is not None:
                        fields = _fields(head)
                        http = source.until(b"\r\n\r\n")
                        left = int(fields["content-length"]) - len(http)
                        digest = hashlib.sha1()
                        for piece in source.pieces(left):
                            digest.update(piece)
                        for _ in source.pieces(4):
                            pass
                        stated = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        kind = fields["warc-type"]
                        if kind == "response" and digest.hexdigest() != stated:
                            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                        size = left if kind == "response" else int(_fields(http)["content-length"])
                        rows.append((fields["warc-record-id"], kind, fields.get("warc-refers-to"), size, stated))
                columns = list(zip(*rows)) or [[]] * 5
                types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string())
                names = ["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return blocks.mapInArrow(read, RECORD_SCHEMA)


def archive_pages(pages: DataFrame, min_bytes: int = REVISIT_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write pages to archives, normalise these, read them back: one row per page.

    Columns ``page_id, payload_bytes, payload_digest, record_type, refers_to``. An empty
    table gives no rows.
    """
    spark = pages.sparkSession
    uri = shared_uri(spark, "warc")
    archives = stored(write_archives(mark_revisits(pages, min_bytes), uri, roll_bytes), "warc-archives")
    blocks = stored(normalise(spread(archives), uri), "warc-blocks")
    number = lambda c: F.expr(f"cast(nullif(regexp_extract({c}, '^<urn:page:(-?[0-9]*)>$', 1), '') AS bigint)")
    return read_records(spread(blocks), uri).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )
