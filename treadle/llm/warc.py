"""WARC archives: written as one gzip stream per file, normalised to one member per record.

The writer marks payloads seen elsewhere as revisits, so each payload is stored once.  The normaliser
inflates a whole-file stream once, piece by piece, writes every record as a gzip member of its own
and puts a sidecar beside the archive with each member's offset, length and record id.  The reader
takes a record by seeking to its member.

Files go to a folder all executors reach, through pyarrow's file systems.  A task writes files of its
own attempt and returns their names; only names returned by tasks that ended well are in the manifest,
which Spark writes as a table, so a lost or repeated task leaves no file behind that counts.

Defined results: a null payload is empty; rows that share the largest id of a payload are all
responses; a row without an id is a response; repeated rows give repeated records; an empty table
gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from treadle.session import run_folder

#: Bytes of records (before compression) after which a writer begins its next file.
FILE_BYTES = 32 << 20
CHUNK = 1 << 20
LEVEL = 4
#: gzip wrapping for zlib.
GZIP = 31
ID_URN = "urn:x-row:"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_types(pages: DataFrame, least_bytes: int = 0, id_column: str = "page_id", uri_column: str = "url",
               payload_column: str = "html") -> DataFrame:
    """``id``, ``uri``, ``payload``, ``refers_to``: the id of the record that holds the payload, null for that itself."""
    rows = pages.select(F.col(id_column).cast("long").alias("id"), F.col(uri_column).cast("string").alias("uri"),
                        F.coalesce(F.col(payload_column), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    holders = rows.where(F.length("payload") >= least_bytes).groupBy("sha1").agg(
        F.max("id").alias("holder"), F.count("*").alias("n")).where("n > 1").select("sha1", "holder")
    other = F.when(F.col("holder") > F.col("id"), F.col("holder"))
    return rows.join(holders, "sha1", "left").select("id", "uri", "payload", other.alias("refers_to"))


def record(number: int | None, uri: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record: the block is an HTTP response, without its payload for a revisit."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    clean = "".join(c for c in uri or "" if c >= " ")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{ID_URN}{'' if number is None else number}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{ID_URN}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def _folder(path: str) -> str:
    system, own = _system(path)
    system.create_dir(own, recursive=True)
    return path


def write_streams(typed: DataFrame, folder: str, date: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write each task's records as monolithic gzip files; a row per file: path, records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, own = _system(folder)
        system.create_dir(own, recursive=True)
        task = TaskContext.get()
        out, names, counts, size, pack = None, [], [], 0, None
        for batch in batches:
            for number, uri, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    names.append(f"stream-{task.partitionId():05d}-{task.taskAttemptId()}-{len(names)}.warc.gz")
                    counts.append(0)
                    out, size = system.open_output_stream(f"{own}/{names[-1]}", compression=None), 0
                    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                data = record(number, uri, payload, refers_to, date)
                out.write(pack.compress(data))
                counts[-1] += 1
                size += len(data)
                if size >= file_bytes:
                    out.write(pack.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(pack.flush())
            out.close()
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{n}" for n in names], "records": pa.array(counts, pa.int64())},
                                         schema=pa.schema([("path", pa.string()), ("records", pa.int64())]))
    return typed.select("id", "uri", "payload", "refers_to").mapInArrow(run, "path string, records long")


def inflated(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, read and inflated once."""
    unpack, fresh = zlib.decompressobj(GZIP), True
    while data := stream.read(chunk):
        while data:
            piece = unpack.decompress(data, chunk)
            fresh = False
            if piece:
                yield piece
            data = unpack.unconsumed_tail
            if unpack.eof:
                data = unpack.unused_data
                unpack, fresh = zlib.decompressobj(GZIP), True
    if not fresh:
        raise ValueError("the gzip stream ends inside a member")


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and whole bytes of each record of a WARC stream."""
    held = bytearray()
    for piece in pieces:
        held += piece
        while True:
            while held[:2] == b"\r\n":  # blank lines between records
                del held[:2]
            end = held.find(b"\r\n\r\n")
            if end < 0:
                break
            fields = fields_of(bytes(held[:end]))
            size = end + 4 + int(fields["content-length"])
            if len(held) < size + 4:
                if len(held) < size:
                    need = size + 4
                    while len(held) < need and (more := next(pieces, None)) is not None:
                        held += more
                if len(held) < size + 4:
                    held += b"".join([m for m in [next(pieces, b"")] if m])
            if len(held) < size:
                raise ValueError("the archive ends inside a record")
            if held[size:size + 4] != b"\r\n\r\n":
                raise ValueError("a record's length does not meet its end")
            yield fields, bytes(held[:size + 4])
            del held[:size + 4]
    if held.strip(b"\r\n"):
        raise ValueError("the archive ends inside a header")


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite each file (column path), record by record; a row per archive: path, sidecar, records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, own = _system(folder)
        target.create_dir(own, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                source, name = _system(path)
                stem = f"{name.rsplit('/', 1)[-1].removesuffix('.gz').removesuffix('.warc')}-{attempt}"
                offset, count = 0, 0
                with source.open_input_stream(name, compression=None) as stream, \
                        target.open_output_stream(f"{own}/{stem}.warc.gz", compression=None) as out, \
                        target.open_output_stream(f"{own}/{stem}.index.jsonl", compression=None) as index:
                    for fields, data in split_records(inflated(stream)):
                        pack = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                        member = pack.compress(data) + pack.flush()
                        out.write(member)
                        index.write(json.dumps({"offset": offset, "length": len(member),
                                                "id": fields.get("warc-record-id"), "type": fields.get("warc-type")}).encode() + b"\n")
                        offset += len(member)
                        count += 1
                rows.append((f"{folder}/{stem}.warc.gz", f"{folder}/{stem}.index.jsonl", count))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.string(), pa.string(), pa.int64()))], names=["path", "sidecar", "records"])
    return files.select("path").mapInArrow(run, "path string, sidecar string, records long")


def _row_id(field: str | None) -> int | None:
    text = (field or "").strip("<>").removeprefix(ID_URN)
    return int(text) if text else None


def parse(data: bytes) -> tuple:
    """(id, uri, type, refers_to, payload or None, payload's length, payload digest) of one record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = fields_of(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.partition(b":")[2]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    refers_to = _row_id(fields.get("warc-refers-to"))
    if fields["warc-type"] == "response":
        if len(payload) != length or digest_of(payload) != digest:
            raise ValueError(f"the payload of {fields['warc-record-id']} differs from its digest")
    else:
        payload = None
    return _row_id(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"], refers_to, payload, length, digest


def read_records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives, each read by its sidecar's offset and checked against its digest."""
    out = StructType.fromDDL("id long, uri string, record_type string, refers_to long, payload binary, "
                             "payload_bytes long, payload_digest string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        for batch in batches:
            for path, sidecar in zip(batch.column("path").to_pylist(), batch.column("sidecar").to_pylist()):
                (system, name), (_, index) = _system(path), _system(sidecar)
                rows, size = [], 0
                with system.open_input_file(name) as archive, system.open_input_stream(index, compression=None) as lines:
                    for line in _lines(lines):
                        entry = json.loads(line)
                        archive.seek(entry["offset"])
                        got = parse(zlib.decompress(archive.read(entry["length"]), GZIP))
                        rows.append(got if payloads else (*got[:4], None, *got[5:]))
                        size += len(rows[-1][4] or b"") + 200
                        if size > 8 * CHUNK:
                            yield _batch(rows, schema)
                            rows, size = [], 0
                yield _batch(rows, schema)
    return archives.select("path", "sidecar").mapInArrow(run, out)


def _lines(stream) -> Iterator[bytes]:
    held = b""
    while data := stream.read(CHUNK):
        *whole, held = (held + data).split(b"\n")
        yield from whole
    if held:
        yield held


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _manifest(spark: SparkSession, files: DataFrame, name: str) -> DataFrame:
    """The files' table, stored, with each file in a partition of its own."""
    folder = run_folder(spark, name)
    files.write.parquet(folder)
    stored = spark.read.parquet(folder)
    return stored.repartition(max(1, stored.count()))


def archive(spark: SparkSession, pages: DataFrame, date: str = "1970-01-01T00:00:00Z", least_bytes: int = 0,
            file_bytes: int = FILE_BYTES, **columns: str) -> DataFrame:
    """Write ``pages`` as archives with sidecars; a row per archive: path, sidecar, records."""
    folder = run_folder(spark, "warc")
    if "://" not in folder and not folder.startswith("/"):
        folder = folder.replace("file:", "file://", 1)
    streams = _manifest(spark, write_streams(with_types(pages, least_bytes, **columns), f"{folder}/streams", date, file_bytes), "streams")
    return _manifest(spark, normalise(streams, f"{folder}/archives"), "archives")


def oracle() -> str:
    """The records' fields in DuckDB SQL; base32 from groups of twenty bits."""
    return """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) n, sha1(coalesce(html, '')) h from pages),
m as (select h, max(page_id) holder from p group by h)
select page_id, n::bigint payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(h, ((i // 4) * 5 + 1)::int, 5))::bigint)
      >> (5 * (3 - i % 4))::int) & 31)::int, 1)), '') payload_digest,
  case when page_id < holder then 'revisit' else 'response' end record_type,
  case when page_id < holder then holder end refers_to
from p join m using (h)"""
