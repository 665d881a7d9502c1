"""WARC archives with records compressed one by one against a shared Zstandard dictionary.

The dictionary is built from archived records and leads every archive in a skippable
frame; each record follows as a frame of its own. Of records with equal payloads of
``least_revisit`` bytes or more, the one with the largest page id is written in full
and the others refer to it.

Null html is an empty payload. A null url is left out of the record. Null page ids
are kept and count as smaller than all others; among payloads that only occur with
null ids, all are written in full, as are all rows that repeat the largest id. An
empty table gives no archive and an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import opened, shared_uri, stored

# Fixed values of the formats: frame magic of an embedded dictionary, record fields, profile.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

LEAST_REVISIT = 1000
#: The dictionary is built from so many records, and no more than this much of each.
DICTIONARY_RECORDS = 2000
DICTIONARY_RECORD_BYTES = 16_384
DICTIONARY_BYTES = 112_640
LEVEL = 3


def record(row: dict, date: str) -> bytes:
    """One WARC record of a page; the payload is left out of a revisit."""
    payload = row["payload"]
    head = HTTP_HEAD.format(row["payload_bytes"]).encode()
    revisit = row["record_type"] == "revisit"
    block = head if revisit else head + payload
    page = "" if row["page_id"] is None else row["page_id"]
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<urn:page:{page}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", row["url"]),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", f"<urn:page:{row['refers_to']}>" if revisit else None),
        ("Content-Length", str(len(block))),
    ]
    # A line break inside a value would end the field; it is percent-encoded.
    lines = [f"{k}: {v}".replace("\r", "%0D").replace("\n", "%0A") for k, v in fields if v is not None]
    return VERSION + "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of a record as a page row, its digest taken from the payload if it has one."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not data.startswith(VERSION):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload does not match its digest")
    number = lambda name: int(x) if (x := fields.get(name, "")[len("<urn:page:") : -1]) else None
    return {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
        "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"),
        "payload": payload,
    }


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary from records; empty if they are too few or too small for one."""
    import zstandard

    if len(samples) < 8 or sum(map(len, samples)) < 8 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little that repeats
        return b""


class ArchiveWriter:
    """An archive: the dictionary in a skippable frame, then one frame per record."""

    def __init__(self, out, dictionary: bytes, level: int = LEVEL) -> None:
        import zstandard

        self.out = out
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.coder = zstandard.ZstdCompressor(level=level, write_checksum=True, **shared)

    def add(self, data: bytes) -> None:
        self.out.write(self.coder.compress(data))


def read_archive(file) -> Iterator[dict]:
    """Records of an archive in turn; one is held at a time."""
    import zstandard

    magic, size = struct.unpack("<II", file.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not start with its dictionary")
    dictionary = file.read(size)
    shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    coder = zstandard.ZstdDecompressor(**shared)
    held = b""
    while held or (held := file.read(1 << 20)):
        one, parts = coder.decompressobj(), []
        while not one.eof:
            if not held and not (held := file.read(1 << 20)):
                raise ValueError("the archive is cut off")
            parts.append(one.decompress(held))
            held = one.unused_data if one.eof else b""
        yield parse(b"".join(parts))


def write_warc(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    least_revisit: int = LEAST_REVISIT, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write all pages into archives; one row per archive written.

    The largest id of each payload comes from a pre-aggregated table of the payloads
    that occur more than once. A task writes under a name of its own attempt, and only
    archives in the returned table count.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    digests = rows.withColumn("check", F.xxhash64("payload")).select("page_id", "digest", "payload_bytes", "check")
    again = stored(
        digests.where(F.col("payload_bytes") >= least_revisit)
        .groupBy("digest", "payload_bytes", "check")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first_id is not null")
        .select(F.col("digest").alias("d"), F.col("payload_bytes").alias("b"), F.col("check").alias("c"), "first_id"),
        "repeated",
    )
    same = (F.col("digest") == F.col("d")) & (F.col("payload_bytes") == F.col("b")) & (F.xxhash64("payload") == F.col("c"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    marked = rows.join(again, same, "left").select(
        F.spark_partition_id().alias("part"), "page_id", "url", "payload", "digest", "payload_bytes", refers.alias("refers_to"),
        F.when(refers.isNull(), "response").otherwise("revisit").alias("record_type"),
    )
    # A share that leaves about twice the sample goes to the sort, however many pages there are.
    share = min(1.0, 2 * DICTIONARY_RECORDS / max(1, pages.count()))
    sample = (
        rows.select(F.substring("payload", 1, DICTIONARY_RECORD_BYTES).alias("payload"), "page_id", "url", "digest", "payload_bytes")
        .withColumn("o", F.xxhash64("digest", "page_id"))
        .where(F.pmod("o", F.lit(1 << 30)) < int(share * (1 << 30)))
        .orderBy("o")
        .limit(DICTIONARY_RECORDS)
        .drop("o")
    )
    made = [
        record(r.asDict() | {"payload": bytes(r.payload), "record_type": "response", "refers_to": None}, date)
        for r in sample.toLocalIterator()
    ]
    dictionary = spark.sparkContext.broadcast(build_dictionary(made))
    uri = shared_uri(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, n, size = None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    fs, folder = opened(uri)
                    name = f"{row['part']:06d}-{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(fs.open_output_stream(f"{folder}/{name}"), dictionary.value)
                writer.add(record(row, date))
                n += 1
        if writer is not None:
            size = writer.out.tell()
            writer.out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [n], "bytes": [size]})

    return stored(marked.mapInArrow(write, "file string, n_records long, bytes long"), "archives").withColumn("uri", F.lit(uri))


def read_warc(archives: DataFrame) -> DataFrame:
    """Every record of the archives: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``."""
    spark = archives.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, folder = opened(row["uri"])
                with fs.open_input_stream(f"{folder}/{row['file']}") as file:
                    out: list[dict] = []
                    for one in read_archive(file):
                        del one["payload"]
                        out.append(one)
                        if len(out) == 5000:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out = []
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema)

    return archives.repartition(tasks).mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )
