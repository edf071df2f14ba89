"""Web archives: pages as WARC records, and a normaliser for archives compressed as one stream.

A WARC file is usable at random only if each record is a gzip member of its own. ``write_archives`` leaves each
archive as a single gzip stream, as crawlers do that compress whole files. ``normalise`` inflates such a stream
once, writes every record as its own member and an offset index beside it; ``read_records`` then opens
records by their place in the index, in ranges of bounded size.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import small
from tradewind.session import scratch_path, stage

CHUNK = 1 << 20
#: payloads below this many bytes are never revisits
LEAST_REVISIT = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LENGTH = re.compile(rb"\r\nContent-Length: *([0-9]+)", re.I)


def classified(pages: DataFrame, name: str = "warc") -> DataFrame:
    """``pages`` (page_id, url, html) with payload_bytes, payload_digest and refers_to.

    Of equal payloads of at least ``LEAST_REVISIT`` bytes the smallest page_id is the response, and refers_to
    of the others names it. Only page_ids and digests meet by digest, never the payloads. Rows that share a
    page_id are told apart by their digests, which also spreads rows without page_id over the join.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.select("page_id", "url", "html")
    small_rows = stage(pages.select("page_id", F.octet_length(body).cast("long").alias("payload_bytes"),
                                    F.sha2(body, 256).alias("payload_digest")), f"{name}_digests")
    first = stage(small_rows.where(f"payload_bytes >= {LEAST_REVISIT}").groupBy("payload_digest")
                  .agg(F.min("page_id").alias("first"), F.count("*").alias("held")).where("held > 1").drop("held"),
                  f"{name}_first")
    refers = (small_rows.where(f"payload_bytes >= {LEAST_REVISIT}").join(first, "payload_digest")
              .where("page_id <> first").select("page_id", "payload_digest", F.col("first").alias("refers_to")).distinct())
    return (pages.withColumn("payload_bytes", F.octet_length(body).cast("long"))
            .withColumn("payload_digest", F.sha2(body, 256))
            .join(refers, ["page_id", "payload_digest"], "left"))


def record(page_id: int | None, url: str | None, body: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the headers alone, with the length of what it stands for."""
    kind = "response" if refers_to is None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", _line(url or "")),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-Id", "" if page_id is None else str(page_id)),
            ("X-Payload-Length", str(len(body)))]
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To", str(refers_to))]
        body = b""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode() + block + b"\r\n\r\n"


def _line(url: str) -> str:
    """A URL on one header line."""
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def parse(raw: bytes) -> dict:
    """Headers of a record (lower-case names) and its HTTP body under ``payload``."""
    head, _, block = raw.partition(b"\r\n\r\n")
    out = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
    block = block[:int(out["content-length"])]
    out["payload"] = block.partition(b"\r\n\r\n")[2]
    out["warc-target-uri"] = out.get("warc-target-uri", "").replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return out


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """Any shared store that Arrow knows: a mounted folder, HDFS, S3."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_archives(pages: DataFrame, folder: str, monolithic: bool = True) -> DataFrame:
    """Write what ``classified`` returns as one archive a task; archive (path) and records of each.

    A task writes under a name of its own and renames at the end, so a lost or repeated task leaves no half archive
    in the list that is returned.
    """
    def run(batches):
        filesystem, base = _filesystem(folder)
        filesystem.create_dir(base, recursive=True)
        path, count = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
        pack = zlib.compressobj(1, zlib.DEFLATED, 31)
        with filesystem.open_output_stream(f"{path}.part", compression=None) as out:
            for batch in small(batches, "html"):
                for row in batch.to_pylist():
                    body = (row["html"] or "").encode()
                    out.write(pack.compress(record(row["page_id"], row["url"], body, row["payload_digest"], row["refers_to"])))
                    count += 1
            out.write(pack.flush())
        if count:
            filesystem.move(f"{path}.part", path)
            yield pa.RecordBatch.from_pydict({"archive": [path], "records": [count]})
        else:
            filesystem.delete_file(f"{path}.part")

    return pages.select("page_id", "url", "html", "payload_digest", "refers_to").mapInArrow(run, "archive string, records long")


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one or many members, chunk by chunk."""
    pack = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            yield pack.decompress(data)
            data = pack.unused_data
            if pack.eof:
                pack = zlib.decompressobj(31)
                data = data.lstrip(b"\0")


def split(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The records of an inflated archive; holds one record and one chunk at a time."""
    held, need, parts, size = b"", None, [], 0
    for chunk in chunks:
        parts.append(chunk)
        size += len(chunk)
        while need is None or size >= need:
            if len(parts) > 1:
                parts = [b"".join(parts)]
            held = parts[0] if parts else b""
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                found = _LENGTH.search(held, 0, end + 2)
                if not held.startswith(b"WARC/") or not found:
                    raise ValueError("not a WARC record")
                need = end + 4 + int(found[1]) + 4
            if size < need:
                break
            yield held[:need]
            parts, size, need = [held[need:]], size - need, None
    if size:
        raise ValueError("the archive ends within a record")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives (archive) with a gzip member for each record; archive, index, position, offset, length.

    The index is written beside the archive as tab-separated lines of offset, length, type, page and digest, and also
    comes back as rows. A task streams one archive after the other and holds one record at a time.
    """
    def run(batches):
        filesystem, base = _filesystem(folder)
        filesystem.create_dir(base, recursive=True)
        for batch in batches:
            for source in batch.column("archive").to_pylist():
                path, rows, offset = f"{base}/{uuid.uuid4().hex}.warc.gz", [], 0
                with (filesystem.open_input_stream(source, compression=None) as stream,
                      filesystem.open_output_stream(f"{path}.part", compression=None) as out,
                      filesystem.open_output_stream(f"{path}.idx", compression=None) as index):
                    for position, raw in enumerate(split(inflated(stream))):
                        member = gzip.compress(raw, 1, mtime=0)
                        out.write(member)
                        head = dict(x.partition(": ")[::2] for x in raw[:raw.find(b"\r\n\r\n")].decode().split("\r\n")[1:])
                        index.write("\t".join([str(offset), str(len(member)), head["WARC-Type"], head.get("X-Page-Id", ""),
                                               head.get("WARC-Payload-Digest", "")]).encode() + b"\n")
                        rows.append((path, f"{path}.idx", position, offset, len(member)))
                        offset += len(member)
                filesystem.move(f"{path}.part", path)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in zip(*rows, strict=True)], ["archive", "index", "position", "offset", "length"])

    return archives.select("archive").mapInArrow(run, "archive string, index string, position long, offset long, length long")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` (archive, offset, length) names: page_id, url, record_type, payload_bytes,
    payload_digest, refers_to and payload (null for revisits). The digest of a response is taken from its payload."""
    def run(batches):
        filesystem, _ = _filesystem(folder)
        name, file = None, None
        for batch in batches:
            rows, size = [], 0
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                if path != name:
                    name, file = path, filesystem.open_input_file(path)
                file.seek(offset)
                got = parse(zlib.decompress(file.read(length), 31))
                rows.append(_row(got))
                size += len(got["payload"])
                if size > 8 * CHUNK:
                    yield _records(rows)
                    rows, size = [], 0
            if rows:
                yield _records(rows)

    return index.select("archive", "offset", "length").mapInArrow(run, _SCHEMA)


_SCHEMA = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
           "payload binary")
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _row(got: dict) -> tuple:
    revisit = got["warc-type"] == "revisit"
    named = got["warc-payload-digest"].removeprefix("sha256:")
    digest = named if revisit else hashlib.sha256(got["payload"]).hexdigest()
    if digest != named or (not revisit and len(got["payload"]) != int(got["x-payload-length"])):
        raise ValueError(f"the payload of page {got['x-page-id']} is damaged")
    return (int(got["x-page-id"]) if got["x-page-id"] else None, got["warc-target-uri"], got["warc-type"],
            int(got["x-payload-length"]), digest, int(got["x-refers-to"]) if revisit else None,
            None if revisit else got["payload"])


def _records(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def archive_pages(pages: DataFrame, name: str = "warc") -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, normalise them and read every record back.

    Null html is an empty payload, a null url an empty one; rows without page_id are responses of their own, and so are rows that
    repeat the response's page_id. An empty table writes nothing. Archives go below ``spark.checkpoint.dir``. The lists of
    archives and offsets are staged, so a task that is run again reads the same files.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, f"{name}_archives")
    written = stage(write_archives(classified(pages, name), f"{folder}/whole"), f"{name}_written")
    many = max(1, written.count())
    index = stage(normalise(written.repartition(many), f"{folder}/members"), f"{name}_index")
    return read_records(index, folder)
