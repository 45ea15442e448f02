"""WARC archives: a normaliser for whole-file gzip, with a sidecar offset index.

A crawler's archive is often one gzip stream over the whole file, which
can't be read at an offset.  The normaliser inflates such a stream once,
from front to back with one record in memory, writes every record again as
a gzip member of its own, and writes ``<archive>.idx`` beside it: one line
``ordinal offset length`` a record.  Any record is then one seek and one
inflation away.

Records with equal payloads are written once.  Writing an archive yields a
narrow row a record (file, ordinal, digest); the record with the largest id
of a digest stays a response and the others become revisits of it, and the
normaliser applies this while it rewrites.  So payloads are never shuffled
and a payload that a third of all pages share costs narrow rows only.

Files go to the shared folder through ``pyarrow.fs`` under names that are
new for every task attempt; only files that finished tasks report are used,
and the reports are written as Parquet, so a lost executor costs no more
than its own unfinished files.  Archives are rolled at ``roll_bytes``.

Defined results: a null payload is empty; a null url leaves out the target
header; a null id never is what a revisit refers to (a payload with null
ids only has responses); rows that repeat both id and payload are all
responses if that id is the largest; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.plans.shared import materialize, new_path, remove

#: Raw bytes after which the writer starts a new archive.
ROLL_BYTES = 256 << 20
#: Partitions that archives are dealt to at most; a partition takes its archives one by one, so none holds more than one in memory.
PARTITIONS = 20_000
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the payload's SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, digest: str, size: int, body: bytes, refers_to: int | None = None) -> bytes:
    """One WARC record; ``body`` is the payload of a response and empty in a revisit."""
    block = _HTTP + body
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Bytes: {size}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an inflated stream; one record is in memory at a time."""
    while line := stream.readline():
        if not line.strip():
            continue
        fields = {}
        while (line := stream.readline()).strip():
            key, _, value = line.partition(b":")
            fields[key.decode().lower()] = value.strip().decode("utf-8", "surrogatepass")
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record is cut off")
        yield fields, block


def _id(value: str | None) -> int | None:
    name = (value or "").strip("<>").rpartition(":")[2]
    return None if name in ("", "none") else int(name)


def write_monolithic(pages: DataFrame, folder: str, id_col="page_id", url_col="url", payload_col="html", roll_bytes: int = ROLL_BYTES, level: int = 1) -> DataFrame:
    """Write all rows as response records into archives of one gzip stream each; a row (file, ordinal, page_id, digest) a record."""

    def run(batches):
        fs, root = _fs(folder)
        fs.create_dir(root)
        out = packer = None
        raw = ordinal = 0
        name = ""
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = []
                for page_id, url, html in zip(*(c.to_pylist() for c in batch.slice(at, 128).columns), strict=True):
                    if out is None or raw >= roll_bytes:
                        if out is not None:
                            out.write(packer.flush())
                            out.close()
                        name, raw, ordinal = f"{uuid.uuid4().hex}.mono.warc.gz", 0, 0
                        out = fs.open_output_stream(posixpath.join(root, name), compression=None)  # else the suffix makes it compress twice
                        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    body = (html or "").encode("utf-8", "surrogatepass")
                    sha = hashlib.sha1(body).digest()
                    whole = record("response", page_id, url, base64.b32encode(sha).decode(), len(body), body)
                    out.write(packer.compress(whole))
                    rows.append((name, ordinal, page_id, sha, len(body)))
                    raw, ordinal = raw + len(whole), ordinal + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64()), strict=True)],
                    ["file", "ordinal", "page_id", "digest", "size"],
                )
        if out is not None:
            out.write(packer.flush())
            out.close()

    narrow = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(payload_col).cast("string"))
    return materialize(narrow.mapInArrow(run, "file string, ordinal int, page_id long, digest binary, size long"), "warc-written")


def choose_revisits(written: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(file, ordinal, refers_to): what each record revisits, null for responses."""
    heads = written.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("head"), F.count("*").alias("n")).where("n > 1")
    other = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return written.join(heads.select("digest", "head"), "digest", "left").select("file", "ordinal", F.when(other, F.col("head")).alias("refers_to"))


def normalise(source: str, folder: str, roles: DataFrame, files: int, level: int = 3) -> DataFrame:
    """Rewrite archives of ``source`` (rows file, ordinal, refers_to in ``roles``) into ``folder`` with a member a record; a row (file, records) an archive.

    ``files`` is their number.  The new archive and its index are written
    under new names, the one reported last; the old archive is left.
    """

    def run(table: pa.Table) -> pa.Table:
        (fs, old), (_, root) = _fs(source), _fs(folder)
        fs.create_dir(root)
        name = table.column("file")[0].as_py()
        refers = dict(zip(table.column("ordinal").to_pylist(), table.column("refers_to").to_pylist(), strict=True))
        new = f"{uuid.uuid4().hex}.warc.gz"
        offset, lines = 0, []
        with fs.open_input_stream(posixpath.join(old, name), compression=None) as packed, fs.open_output_stream(posixpath.join(root, new), compression=None) as out:
            for ordinal, (fields, block) in enumerate(read_records(gzip.GzipFile(fileobj=packed))):
                target = refers.get(ordinal)
                payload = block.partition(b"\r\n\r\n")[2]
                whole = record(
                    "response" if target is None else "revisit", _id(fields["warc-record-id"]), fields.get("warc-target-uri"),
                    fields["warc-payload-digest"].partition(":")[2], int(fields["x-payload-bytes"]), payload if target is None else b"", target,
                )
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(whole) + packer.flush()
                out.write(member)
                lines.append(f"{ordinal} {offset} {len(member)}\n")
                offset += len(member)
        with fs.open_output_stream(posixpath.join(root, new + ".idx"), compression=None) as index:
            index.write("".join(lines).encode())
        return pa.table({"file": [new], "records": pa.array([len(lines)], pa.int64())})

    dealt = roles.repartition(max(1, min(files, PARTITIONS)), "file")
    return materialize(dealt.groupBy("file").applyInArrow(run, "file string, records long"), "warc-archives")


def read_archives(folder: str, archives: DataFrame, files: int) -> DataFrame:
    """A row a record of normalised archives, read through their indexes; the digest of a response is that of the payload read."""

    def run(batches):
        fs, root = _fs(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_stream(posixpath.join(root, name + ".idx"), compression=None) as index:
                    places = [tuple(map(int, x.split())) for x in index.read().decode().splitlines()]
                with fs.open_input_file(posixpath.join(root, name)) as archive:
                    for at in range(0, len(places), 512):
                        rows = []
                        for _, offset, length in places[at : at + 512]:
                            archive.seek(offset)
                            whole = zlib.decompress(archive.read(length), 31)
                            head, _, rest = whole.partition(b"\r\n\r\n")
                            fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])}
                            kind, digest, size = fields["warc-type"], fields["warc-payload-digest"].partition(":")[2], int(fields["x-payload-bytes"])
                            if kind == "response":
                                payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")[2]
                                if payload_digest(payload) != digest or len(payload) != size:
                                    raise ValueError(f"{name}: the payload at {offset} doesn't match its digest")
                            rows.append((_id(fields["warc-record-id"]), size, digest, kind, _id(fields.get("warc-refers-to"))))
                        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return archives.select("file").repartition(max(1, min(files, PARTITIONS))).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, id_col="page_id", url_col="url", payload_col="html") -> tuple[str, DataFrame, int]:
    """Write pages as normalised archives; (folder, archives, number of archives)."""
    spark = pages.sparkSession
    folder = (folder or new_path(spark, "warc")).rstrip("/")
    whole = f"{folder}/whole-file"
    written = write_monolithic(pages, whole, id_col, url_col, payload_col)
    files = written.select("file").distinct().count()
    archives = normalise(whole, folder, choose_revisits(written, min_bytes), files)
    remove(spark, whole)  # the whole-file streams aren't needed any more
    return folder, archives, files


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive pages, read the archives back, and return what they hold."""
    folder, archives, files = archive_pages(pages, min_bytes=min_bytes)
    found = materialize(read_archives(folder, archives, files), "warc-read")
    remove(pages.sparkSession, folder)
    return found
