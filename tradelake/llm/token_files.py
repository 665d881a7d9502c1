"""Token files: all ids of a shard in one array, document boundaries in Elias-Fano form.

A file holds the ids (16 bits each if the vocabulary allows it, else 32), then two
Elias-Fano lists - the boundaries of the documents and their ids - and a footer.
Shards follow each other in ascending order of the document id.

Null and empty texts hold the end id alone. Null ids come last. Repeated rows are
documents of their own, next to each other. An empty table gives no file and an
empty result. Extra columns of the input play no part.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradelake.llm.common import encoder, opened, shared_uri, stored
from tradelake.llm.elias_fano import EliasFano

MAGIC = b"TLTOKEN1"
# Bytes per id, rows without an id, smallest id, and the bytes of both lists.
_FOOTER = struct.Struct("<BQqQQ8s")
#: Ids that a reader holds at a time, unless one document has more.
READ_IDS = 1 << 20


class TokenFileWriter:
    """Appends documents to a token file; it keeps their lengths and not their ids."""

    def __init__(self, out, width: int) -> None:
        self.out, self.width = out, width
        self.lengths: list[int] = []
        self.doc_ids: list[int] = []
        self.without_id = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids`` as little-endian unsigned 32-bit numbers."""
        numbers = np.frombuffer(ids, "<u4")
        self.out.write(numbers.astype("<u2").tobytes() if self.width == 2 else ids)
        self.lengths.append(len(numbers))
        if doc_id is None:
            self.without_id += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> None:
        least = self.doc_ids[0] if self.doc_ids else 0
        bounds = EliasFano.encode(np.cumsum([0, *self.lengths])).to_bytes()
        names = EliasFano.encode(np.asarray(self.doc_ids, np.int64) - least).to_bytes()
        self.out.write(bounds + names)
        self.out.write(_FOOTER.pack(self.width, self.without_id, least, len(bounds), len(names), MAGIC))
        self.out.close()


class TokenFile:
    """Random and sequential access to the documents of a token file."""

    def __init__(self, file) -> None:
        self.file = file
        end = file.size()
        file.seek(end - _FOOTER.size)
        width, self.without_id, self.least, bounds, names, magic = _FOOTER.unpack(file.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        file.seek(end - _FOOTER.size - bounds - names)
        self.bounds = EliasFano.from_bytes(file.read(bounds))
        self.names = EliasFano.from_bytes(file.read(names))
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        self.documents = self.bounds.count - 1

    def doc_id(self, place: int) -> int | None:
        return self.names.select(place) + self.least if place < self.names.count else None

    def ids(self, place: int) -> np.ndarray:
        """Ids of one document, found through the select structure."""
        first, last = self.bounds.range(place, place + 2)
        return self._read(first, last)

    def _read(self, first: int, last: int) -> np.ndarray:
        self.file.seek(int(first) * self.kind.itemsize)
        return np.frombuffer(self.file.read(int(last - first) * self.kind.itemsize), self.kind).astype("<u4")

    def scan(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, first place and ids of every document in turn."""
        at = 0
        while at < self.documents:
            bounds = self.bounds.range(at, min(at + 1024, self.documents) + 1)
            held = max(1, int(np.searchsorted(bounds, bounds[0] + READ_IDS, "right")) - 1)
            ids = self._read(bounds[0], bounds[held])
            named = self.names.range(min(at, self.names.count), min(at + held, self.names.count)) + self.least
            for k in range(held):
                yield (
                    int(named[k]) if k < len(named) else None,
                    int(bounds[k]),
                    ids[bounds[k] - bounds[0] : bounds[k + 1] - bounds[0]],
                )
            at += held


def write_token_files(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = 1
) -> DataFrame:
    """Write the documents in ascending id order; one row per file written.

    A task writes under a name of its own attempt. Only files in the returned table
    count, so what a lost attempt leaves behind is never read.
    """
    spark = docs.sparkSession
    uri = shared_uri(spark, "tokens")
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    rows = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer  # noqa: F401  a worker without it fails before it writes

        coder, writer, n_ids = encoder(tokenizer), None, 0
        width = 2 if max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                shard = batch.column("shard")[0].as_py()
                fs, folder = opened(uri)
                name = f"{shard:06d}-{uuid.uuid4().hex}.tok"
                writer = TokenFileWriter(fs.open_output_stream(f"{folder}/{name}"), width)
            found = coder.encode(batch.column("text").to_pylist(), end_id)
            for one, ids in zip(batch.column("doc_id").to_pylist(), found):
                writer.add(one, ids)
                n_ids += len(ids) // 4
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "file": [name], "n_docs": [len(writer.lengths)], "n_ids": [n_ids]},
                schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )

    files = stored(rows.mapInArrow(write, "shard int, file string, n_docs long, n_ids long"), "token-files")
    return files.withColumn("uri", F.lit(uri))


def read_token_files(files: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files.

    ``start`` counts the ids of all documents before it, over all files; the running
    sum has one row per file.
    """
    spark = spark or files.sparkSession
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).repartition(tasks)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, folder = opened(row["uri"])
                with fs.open_input_file(f"{folder}/{row['file']}") as file:
                    out: list[tuple] = []
                    for one, start, ids in TokenFile(file).scan():
                        out.append((one, row["base"] + start, len(ids), zlib.crc32(ids.tobytes())))
                        if len(out) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                            out = []
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
