"""WARC archives with revisit records (operator 9).

A digest's response is chosen from headers shuffled by payload digest; the
choice is joined back to the pages, which are then written with fresh headers as
gzip members, one a record.  That join leaves the payloads where they are while
the shared digests fit a size-checked broadcast, and moves them beyond.  Reading
turns every archive back into records and resolves revisits by a join to the
responses that they name; responses stay out of that join.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantwise.llm.common import Stages, shared_fs

#: Smaller payloads are always stored.
MIN_REVISIT_BYTES = 1000
#: Compressed bytes after which a task starts its next archive.
ARCHIVE_BYTES = 16 << 20
#: Bytes of an archive that the reader hands on at a time.
_PIECE = 16 << 10
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:plantwise:warc-record")
_END = b"\r\n\r\n"

_RECORD = "page_id long, record_id string, record_type string, refers_id string, payload_bytes long, payload_digest string, url string"


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def _line(value: str) -> str:
    return re.sub(r"[\r\n]+", lambda m: "".join(f"%{ord(c):02X}" for c in m[0]), value)


def make_record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record; ``refers_to``: page id of the response, None for a response."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
            f"WARC-Date: {date}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def parse_records(data: bytes):
    """Headers (names in lower case) and block of each gzip member."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, parts = zlib.decompressobj(31), []
        while not member.eof and at < len(view):  # in pieces: what is left over is copied
            piece = view[at:at + _PIECE]
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        if not member.eof:
            raise ValueError("an archive ends inside a record")
        record = b"".join(parts)
        head, _, rest = record.partition(_END)
        lines = head.decode().split("\r\n")
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        n = int(fields["content-length"])
        if lines[0] != "WARC/1.1" or rest[n:] != _END:
            raise ValueError("not a whole WARC record")
        yield fields, rest[:n]


def _sources(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    html = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("payload"),
                        F.sha1(html).alias("digest"), F.octet_length(html).cast("long").alias("size"))


def write_archives(pages: DataFrame, folder: str, stages: Stages, date: str = "2020-01-01T00:00:00Z", id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Lazy manifest ``name, n_records`` of the archives that evaluating it
    writes; only digests with a revisit enter the join that moves pages."""
    src = _sources(pages, id_col, url_col, payload_col)
    chosen = (src.filter(F.col("size") >= min_bytes).groupBy("digest", "size")
              .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    chosen = stages.write(chosen, "responses")
    named = (src.join(chosen, ["digest", "size"], "left")
             .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("refers_to")), F.col("refers_to")))
             .select("page_id", "url", "payload", "digest", "refers_to"))

    def write(batches):
        part, done, held, size, count = TaskContext.get().partitionId(), 0, [], 0, 0
        fs, root = shared_fs(folder)

        def flush():
            nonlocal done, held, size, count
            name = f"pages-{part:08d}-{done:05d}.warc.gz"
            fs.create_dir(root, recursive=True)
            temp = f"{root}/.{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(temp, compression=None) as f:
                for x in held:
                    f.write(x)
            fs.move(temp, f"{root}/{name}")
            row = pa.RecordBatch.from_pylist([{"name": name, "n_records": count}])
            done, held, size, count = done + 1, [], 0, 0
            return row

        for batch in batches:
            cols = batch.columns
            for k in range(batch.num_rows):
                record = make_record(cols[0][k].as_py(), cols[1][k].as_py(), cols[2][k].as_py(), cols[3][k].as_py(), cols[4][k].as_py(), date)
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                held.append(z.compress(record) + z.flush())
                size += len(held[-1])
                count += 1
                if size >= ARCHIVE_BYTES:
                    yield flush()
        if held:
            yield flush()

    return named.mapInArrow(write, "name string, n_records long")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Records of the archives that the manifest names; sizes and digests of
    responses are those of the payloads read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))

    def parse(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                rows = []
                for head, block in parse_records(batch.column(0)[k].as_py()):
                    payload = block.partition(_END)[2]
                    stored = head["warc-type"] == "response"
                    page = head.get("x-page-id")
                    rows.append({"page_id": None if page is None else int(page), "record_id": head["warc-record-id"],
                                 "record_type": head["warc-type"], "refers_id": head.get("warc-refers-to"),
                                 "payload_bytes": len(payload) if stored else None,
                                 "payload_digest": hashlib.sha1(payload).hexdigest() if stored else None, "url": head.get("warc-target-uri")})
                    if stored and head["warc-payload-digest"] != f"sha1:{rows[-1]['payload_digest']}":
                        raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return files.join(manifest.select("name").distinct(), "name", "left_semi").select("content").mapInArrow(parse, _RECORD)


_ARROW = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("refers_id", pa.string()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("url", pa.string())])


def resolve_revisits(records: DataFrame, stages: Stages) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``: a
    revisit takes size and digest of the response that it names, one that names
    none has neither.

    Responses pass by; the responses' own rows are written before the join, so
    that a response with any share of the revisits is split by adaptive
    execution.  ``records`` is a written table.
    """
    own = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    responses, revisits = records.filter("record_type = 'response'"), records.filter("record_type = 'revisit'")
    origin = (responses.groupBy(F.col("record_id").alias("refers_id"))
              .agg(F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("o_bytes"), F.first("payload_digest").alias("o_digest")))
    origin = stages.write(origin, "origin")
    found = revisits.join(origin, "refers_id", "left").select("page_id", F.col("o_bytes").alias("payload_bytes"), F.col("o_digest").alias("payload_digest"), "record_type", "refers_to")
    return responses.select(*own, F.lit(None).cast("long").alias("refers_to")).union(found)


def warc_round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record per page, read the archives back, resolve the revisits.

    Equal payloads of at least ``min_bytes`` bytes have one response, that with
    the largest page id; rows repeated with that very id are all responses, as
    are payloads all of whose ids are null.  A null payload is empty, a null
    url or id leaves its header out; an empty table writes nothing and gives no
    rows; other columns are ignored.  A digest shared by any number of pages
    costs a header a task in the choice, and the join back is an ordinary one
    that adaptive execution splits.
    """
    spark = pages.sparkSession
    stages = Stages(spark, "warc")
    folder = folder or stages.path("archives")
    manifest = stages.write(write_archives(pages, folder, stages, min_bytes=min_bytes), "manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return resolve_revisits(stages.write(read_archives(spark, folder, manifest), "records"), stages)


#: The same rows by DuckDB (payload digests by its sha1).
ORACLE = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
m AS (SELECT payload_digest, max(page_id) AS top FROM d WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest AS payload_digest,
       CASE WHEN page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d LEFT JOIN m ON d.payload_digest = m.payload_digest AND payload_bytes >= {MIN_REVISIT_BYTES}
"""
