"""WARC archives by way of a chunked record table.

A payload becomes rows (record, chunk number, bytes) of bounded size, and a
digest is carried along its chunks, so nothing holds a whole record beside the
input row.  Each chunk is written as a WARC segment (the first as response,
later ones as continuation), through Spark's own text writer with CR LF line
ends, so archives can lie in any store that Spark writes to.  Reading streams
the lines of each archive, again with an incremental digest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import scratch_path

from .common import durable

CHUNK = 1 << 20          # payload bytes in one row


def _base32(digest) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(pages: DataFrame, chunk: int = CHUNK, key: str = "page_id", payload: str = "html",
                uri: str = "url") -> DataFrame:
    """(rid, page_id, uri, chunk_no, n_chunks, data, payload_bytes, digest):
    the payload (null: empty) in rows of ``chunk`` bytes.  payload_bytes and
    digest (base32 SHA-1 of the whole payload) stand on the last chunk."""
    d = pages.select(F.monotonically_increasing_id().alias("rid"), F.col(key).cast("long").alias("page_id"),
                     (F.col(uri) if uri in pages.columns else F.lit(None)).cast("string").alias("uri"),
                     F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("p"))
    d = d.withColumn("n_chunks", F.greatest(F.lit(1), F.ceil(F.octet_length("p") / chunk).cast("int")))
    d = d.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    d = d.select("rid", "page_id", "uri", "chunk_no", "n_chunks",
                 F.substring("p", F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("data"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, size = hashlib.sha1(), 0          # of the record whose chunks go by
        for b in batches:
            sizes, digests = [], []
            for no, n, data in zip(b.column("chunk_no").to_pylist(), b.column("n_chunks").to_pylist(),
                                   b.column("data"), strict=True):
                if no == 0:
                    sha, size = hashlib.sha1(), 0
                piece = data.as_buffer()
                sha.update(piece)
                size += piece.size
                last = no == n - 1
                sizes.append(size if last else None)
                digests.append(_base32(sha.digest()) if last else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                             names=[*b.schema.names, "payload_bytes", "digest"])

    return d.mapInArrow(digest, "rid long, page_id long, uri string, chunk_no int, n_chunks int, data binary, "
                                "payload_bytes long, digest string")


def roles(chunks: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(rid, payload_bytes, digest, first_rid, first_page): of records with
    equal payloads of at least ``min_bytes`` the one with the largest page_id
    (null lowest, then the largest rid) is the response; first_rid is null
    where the record itself is a response."""
    last = chunks.where("digest IS NOT NULL").select("rid", "page_id", "payload_bytes", "digest")
    top = (last.where(F.col("payload_bytes") >= min_bytes).groupBy("digest")
           .agg(F.max(F.struct("page_id", "rid")).alias("t"), F.count("*").alias("n")).where("n > 1")
           .select("digest", F.col("t.rid").alias("t_rid"), F.col("t.page_id").alias("t_page")))
    other = (F.col("payload_bytes") >= min_bytes) & (F.col("t_rid") != F.col("rid"))
    return last.join(top, "digest", "left").select(
        "rid", "payload_bytes", "digest", F.when(other, F.col("t_rid")).alias("first_rid"),
        F.when(other, F.col("t_page")).alias("first_page"))


def write_archive(chunks: DataFrame, records: DataFrame, path: str) -> None:
    """Writes the records as gzip-compressed WARC files under ``path``."""
    archive = uuid.uuid4()
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = (chunks.drop("payload_bytes", "digest").join(records, "rid")
            .where("first_rid IS NULL OR chunk_no = 0")
            .withColumn("data", F.when(F.col("first_rid").isNull(), F.col("data"))))
    rows = rows.repartition("rid").sortWithinPartitions("rid", "chunk_no")

    def name(rid: int, no: int = 0) -> str:
        return f"<urn:uuid:{uuid.uuid5(archive, f'{rid}/{no}')}>"

    def fmt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                no, data = r["chunk_no"], r["data"] or b""
                head = ["WARC/1.1", f"WARC-Record-ID: {name(r['rid'], no)}", f"WARC-Date: {date}",
                        f"Content-Length: {len(data)}"]
                if no == 0:
                    uri = (r["uri"] or f"urn:page:{r['page_id']}").replace("\r", "%0D").replace("\n", "%0A")
                    head += [f"WARC-Type: {'response' if r['first_rid'] is None else 'revisit'}",
                             f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{r['digest']}",
                             f"X-Payload-Length: {r['payload_bytes']}"]
                    head += [f"X-Page-ID: {r['page_id']}"] if r["page_id"] is not None else []
                    if r["first_rid"] is not None:
                        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                                 f"WARC-Refers-To: {name(r['first_rid'])}"]
                        head += [f"X-Refers-To-Page-ID: {r['first_page']}"] if r["first_page"] is not None else []
                    head += ["WARC-Segment-Number: 1"] if r["n_chunks"] > 1 and r["first_rid"] is None else []
                else:
                    head += ["WARC-Type: continuation", f"WARC-Segment-Origin-ID: {name(r['rid'])}",
                             f"WARC-Segment-Number: {no + 1}"]
                    head += [f"WARC-Segment-Total-Length: {r['payload_bytes']}"] if no == r["n_chunks"] - 1 else []
                out.append("\r\n".join(head).encode() + b"\r\n\r\n" + data + b"\r\n")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    # The writer ends each row with CR LF, the second line end after a record's block.
    (rows.mapInArrow(fmt, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\r\n").option("compression", "gzip").text(path))


class _Reader:
    """Streams the lines of archives; keeps one record's headers and digest."""

    def __init__(self):
        self.state, self.head, self.left = "start", {}, 0
        self.current: dict | None = None
        self.done: list[tuple] = []

    def close(self) -> None:
        if (c := self.current) is not None:
            full = c["type"] == "response"
            self.done.append((c["page"], c["type"], c["size"] if full else c["length"],
                              _base32(c["sha"].digest()) if full else c["digest"], c["refers"],
                              not full or _base32(c["sha"].digest()) == c["digest"]))
        self.current = None

    def line(self, data: pa.Buffer) -> None:
        if self.state == "block":
            n = data.size
            if n >= self.left:
                self.feed(data.slice(0, self.left))
                self.state = "after"
            else:
                self.feed(data)
                self.feed(b"\r\n")
                self.left -= n + 2
        elif self.state == "after":
            self.state = "start"
        else:
            text = data.to_pybytes().decode()
            if self.state == "start":
                if text.startswith("WARC/"):
                    self.state, self.head = "head", {}
            elif text:
                k, _, v = text.partition(":")
                self.head[k.strip().lower()] = v.strip()
            else:
                self.begin()

    def begin(self) -> None:
        h = self.head
        self.left, self.state = int(h["content-length"]), "block"
        if h["warc-type"] == "continuation":
            if self.current is None or self.current["id"] != h["warc-segment-origin-id"]:
                raise ValueError("a continuation record that doesn't follow its first segment")
            return
        self.close()
        page, refers = h.get("x-page-id"), h.get("x-refers-to-page-id")
        length = h.get("x-payload-length")
        self.current = {"id": h.get("warc-record-id"), "type": h["warc-type"], "sha": hashlib.sha1(), "size": 0,
                        "page": int(page) if page else None, "refers": int(refers) if refers else None,
                        "length": int(length) if length else None,
                        "digest": h.get("warc-payload-digest", "").removeprefix("sha1:")}

    def feed(self, data) -> None:
        self.current["sha"].update(data)
        self.current["size"] += len(data) if isinstance(data, bytes) else data.size


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, payload_bytes, payload_digest, refers_to,
    digest_ok) of the archives under ``path``, one row per record.  A gzip
    file is read by one task from its start, so segments follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        names = ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "digest_ok"]

        def flush():
            rows, reader.done = reader.done, []
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for b in batches:
            for v in b.column("value"):
                reader.line(v.as_buffer())
            yield flush()
        reader.close()
        yield flush()

    lines = spark.read.option("lineSep", "\r\n").text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(run, "page_id long, record_type string, payload_bytes long, payload_digest string, "
                                 "refers_to long, digest_ok boolean")


def round_trip(pages: DataFrame, chunk: int = CHUNK, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Writes ``pages`` as archives (by default under the shared folder) and
    reads them back.  Other columns than page_id, url and html are not used;
    of repeated rows one is the response."""
    spark = pages.sparkSession
    chunks = durable(chunk_table(pages, chunk), "warc-chunks")
    path = path or scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    write_archive(chunks, roles(chunks, min_bytes), path)
    return read_archive(spark, path)
