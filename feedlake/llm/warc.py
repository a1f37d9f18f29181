"""WARC archives: writing, normalising monolithic gzip, reading by index.

``write_archives`` writes archives as some crawlers leave them: one gzip stream
over the whole file, so no record can be reached without inflating all before
it. ``normalise`` inflates each such stream once, in chunks, rewrites every
record as a gzip member of its own and writes a sidecar index (one JSON line
with offset, length, id and type per record). ``read_records`` reads records by
offset through that index, each member alone, and checks payload digests.

Files go to a folder of the shared store by URI (``pyarrow.fs``: file, hdfs, s3,
gs). Every attempt of a task writes under a name of its own, and only files
listed in the written manifest are read, so lost executors and repeated tasks
leave no half archives behind in any result.

Records: ``response`` (HTTP header and payload) or, for a payload that another
record of larger ``page_id`` also has, ``revisit`` (HTTP header only, with the
full payload's length and digest, and the id of the response).

Defined results: null html is the empty payload; empty payloads are compared
like any other; null url gives no target URI, control
characters of a url are written percent-encoded; a null ``page_id`` is smaller than
any other; rows that share the largest ``page_id`` of their group of equal
payloads are all responses; repeated rows each give a record. No row, no
archive. Equal payloads are found by SHA-256; only the groups of more than one
are joined back, by a written table whose size the planner knows.
"""
from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import re
import uuid
import zlib
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import bounded_batches, materialise, split_join

#: Uncompressed bytes after which a new archive begins; bytes inflated at a time.
ARCHIVE, CHUNK = 32 << 20, 1 << 20
#: The tables carry no fetch time.
DATE = "1970-01-01T00:00:00Z"
# --- fixed values of the format ----------------------------------------------
VERSION, EOL, EOR = b"WARC/1.1\r\n", b"\r\n", b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31  # zlib window bits for a gzip wrapper
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
_ID = "<urn:page:{}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_roles(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, record_type, refers_to`` of rows ``page_id, url, html``."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    key = F.sha2("html", 256)
    groups = materialise(p.select("page_id", key.alias("k")).groupBy("k")
                         .agg(F.max("page_id").alias("best"), F.count("*").alias("c")).where("c > 1").drop("c"),
                         "payloads")
    own = F.col("best").isNull() | F.col("page_id").eqNullSafe(F.col("best"))
    return (split_join(p.withColumn("k", key), groups, ["k"], "left")
            .select("page_id", "url", "html", F.when(own, "response").otherwise("revisit").alias("record_type"),
                    F.when(~own, F.col("best")).alias("refers_to")))


def _header(fields: list) -> bytes:
    return VERSION + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + EOL


def record(page_id, url, payload: bytes, kind: str, refers_to) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if kind == "response" else http
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _ID.format("" if page_id is None else page_id)),
              ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _CONTROL.sub(lambda c: quote(c[0]), url)))
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _ID.format(refers_to))]
    fields += [("WARC-Payload-Digest", "sha1:" + digest(payload)),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return _header(fields) + block + EOR


def info_record(name: str) -> bytes:
    block = b"software: feedlake\r\nformat: WARC File Format 1.1\r\n"
    return _header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", DATE),
                    ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                    ("Content-Length", len(block))]) + block + EOR


def _store(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def write_archives(rows: DataFrame, folder: str, archive: int = ARCHIVE, level: int = 1) -> DataFrame:
    """Write rows (as ``with_roles`` gives them) as monolithic archives into
    ``folder``; returns the written manifest ``archive, records``."""
    import pyarrow as pa

    def run(batches):
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        names, counts = [], []
        out = deflate = None
        size = 0

        def close():
            if out is not None:
                out.write(deflate.flush())
                out.close()

        for batch in batches:
            for page_id, url, html, kind, refers_to in zip(*batch.columns):
                if out is None or size > archive:
                    close()
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(posixpath.join(root, name), compression=None)
                    deflate = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                    names.append(name)
                    counts.append(0)
                    out.write(deflate.compress(info_record(name)))
                data = record(page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(), kind.as_py(),
                              refers_to.as_py())
                out.write(deflate.compress(data))
                size += len(data)
                counts[-1] += 1
        close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())],
                                         names=["archive", "records"])

    return materialise(bounded_batches(rows).select("page_id", "url", "html", "record_type", "refers_to")
                       .mapInArrow(run, "archive string, records long"), "archives")


class Inflater:
    """Reads a gzip file of one or several members as one stream, a chunk at a time."""

    def __init__(self, source):
        self.source, self.inflate, self.buffer, self.ended = source, zlib.decompressobj(GZIP), bytearray(), False

    def fill(self) -> bool:
        """One more chunk into the buffer; False at the end of the file."""
        while not self.ended:
            rest = self.inflate.unconsumed_tail or self.inflate.unused_data
            if self.inflate.eof:
                if not rest:
                    rest = self.source.read(CHUNK)
                    if not rest:
                        self.ended = True
                        return False
                self.inflate = zlib.decompressobj(GZIP)
            else:
                rest = rest or self.source.read(CHUNK)
                if not rest:
                    raise ValueError("the gzip stream ends early")
            data = self.inflate.decompress(rest, CHUNK)
            if data:
                self.buffer += data
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the file."""
        begin = 0
        while (at := self.buffer.find(mark, begin)) < 0:
            begin = max(0, len(self.buffer) - len(mark))
            if not self.fill():
                if self.buffer:
                    raise ValueError("the file ends inside a record")
                return None
        at += len(mark)
        found = bytes(self.buffer[:at])
        del self.buffer[:at]
        return found

    def pieces(self, size: int):
        """The next ``size`` bytes, in pieces of a chunk at most."""
        while size:
            if not self.buffer and not self.fill():
                raise ValueError("the file ends inside a record")
            piece = bytes(self.buffer[:min(size, CHUNK)])
            del self.buffer[:len(piece)]
            size -= len(piece)
            yield piece


def fields(header: bytes) -> dict:
    lines = header.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record: " + lines[0][:80])
    return {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:] if x)}


def rewrite(source, target, level: int):
    """Rewrite a monolithic stream record by record; yields index entries."""
    stream, offset = Inflater(source), 0
    while (header := stream.until(EOR)) is not None:
        f = fields(header)
        deflate = zlib.compressobj(level, zlib.DEFLATED, GZIP)
        begin = offset
        offset += target.write(deflate.compress(header))
        for piece in stream.pieces(int(f["content-length"]) + len(EOR)):
            offset += target.write(deflate.compress(piece))
        offset += target.write(deflate.flush())
        yield {"offset": begin, "length": offset - begin, "id": f["warc-record-id"], "type": f["warc-type"]}


def _in_tasks(manifest: DataFrame, run, schema: str) -> DataFrame:
    """One task for each archive, at most as many tasks as archives."""
    n = max(1, manifest.count())
    return manifest.repartitionByRange(n, "archive").mapInArrow(run, schema)


def normalise(manifest: DataFrame, folder: str, target: str, level: int = 6) -> DataFrame:
    """Rewrite the listed archives of ``folder`` into ``target``, each with a
    sidecar ``.index``; returns the written manifest ``archive, records``."""
    import pyarrow as pa

    def run(batches):
        source_store, source_root = _store(folder)
        store, root = _store(target)
        store.create_dir(root, recursive=True)
        for batch in batches:
            names, counts = [], []
            for old in batch.column(0).to_pylist():
                name = f"{uuid.uuid4().hex}.warc.gz"
                path = posixpath.join(root, name)
                with (source_store.open_input_stream(posixpath.join(source_root, old), compression=None) as source,
                      store.open_output_stream(path, compression=None) as out,
                      store.open_output_stream(path + ".index") as index):
                    count = 0
                    for entry in rewrite(source, out, level):
                        index.write(json.dumps(entry).encode() + b"\n")
                        count += entry["type"] != "warcinfo"
                names.append(name)
                counts.append(count)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())],
                                             names=["archive", "records"])

    return materialise(_in_tasks(manifest, run, "archive string, records long"), "archives")


def parse(member: bytes) -> tuple:
    """``page_id, url, payload, payload_bytes, digest, type, refers_to`` of one
    member; the payload of a revisit is None."""
    data = zlib.decompress(member, GZIP)
    head = data.index(EOR) + len(EOR)
    f = fields(data[:head])
    block = data[head:head + int(f["content-length"])]
    http = block.index(EOR) + len(EOR)
    size = int(next(x.split(b":")[1] for x in block[:http].split(EOL) if x.lower().startswith(b"content-length:")))
    stated = f["warc-payload-digest"].removeprefix("sha1:")
    payload = None
    if f["warc-type"] == "response":
        payload = block[http:]
        if len(payload) != size or digest(payload) != stated:
            raise ValueError("payload differs from its digest: " + f["warc-record-id"])

    def page(x):
        number = x.removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    return (page(f["warc-record-id"]), f.get("warc-target-uri"), payload, size, stated, f["warc-type"],
            page(f["warc-refers-to"]) if "warc-refers-to" in f else None)


def read_records(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, record_type,
    refers_to`` of all page records, each read alone at its place in the index."""
    import pyarrow as pa
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)],
                                          names=[n for n, _ in kinds])

    def run(batches):
        store, root = _store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                path, rows, size = posixpath.join(root, name), [], 0
                with store.open_input_stream(path + ".index") as f:
                    index = [json.loads(x) for x in f.read().splitlines()]
                with store.open_input_file(path) as f:
                    for entry in index:
                        if entry["type"] == "warcinfo":
                            continue
                        f.seek(entry["offset"])
                        r = parse(f.read(entry["length"]))
                        rows.append(r if with_payload else (*r[:2], None, *r[3:]))
                        size += r[3] if with_payload else 1
                        if size > CHUNK * 8 or len(rows) == 10_000:
                            yield out(rows)
                            rows, size = [], 0
                if rows:
                    yield out(rows)

    return _in_tasks(manifest, run, "page_id long, url string, payload binary, payload_bytes long, "
                                    "payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, folder: str | None = None, with_payload: bool = True) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them, read them back.
    The normalised archives stay in ``folder``/warc; the monolithic ones go."""
    folder = folder or scratch_path(pages.sparkSession, "llm", "warc")
    written = write_archives(with_roles(pages), folder + "/monolithic")
    done = normalise(written, folder + "/monolithic", folder + "/warc")
    store, root = _store(folder + "/monolithic")
    if written.count():
        store.delete_dir(root)
    return read_records(done, folder + "/warc", with_payload)
