"""Helpers shared by the operators: working tables, Arrow passes, words, token ids and components."""

from __future__ import annotations

import gc
import os
import re
import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradelake.session import prepare, run_dir, ship_package
from tradelake.sources.files import delete_prefix, hadoop_path

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch; whole texts travel in it, so it stays small.
BATCH_ROWS = 1000


def session(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators rely on."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read from there.

    It cuts the lineage, so that a lost executor costs no more than one stage,
    and gives later plans true sizes. The folder stays until the cluster clears
    ``spark.checkpoint.dir``, since the returned frame reads it lazily.
    """
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def larger_batches(spark: SparkSession, rows: int = 50_000) -> Iterator[None]:
    """Arrow batches of many rows, for steps whose rows hold a few numbers each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def dropped(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing reads any more."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            delete_prefix(table.sparkSession, folder)


def swept(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps: it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_uri(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, with its scheme, as tasks open it."""
    where, fs = hadoop_path(spark, run_dir(spark, label))
    fs.mkdirs(where)
    return fs.makeQualified(where).toString()


def opened(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a qualified folder and the folder's path in it."""
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:") :].lstrip("/")
    return arrow_fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def by_batch(
    df: DataFrame, function: Callable[[pa.RecordBatch], dict[str, object] | None], schema: str
) -> DataFrame:
    """Apply a function of one Arrow batch, which returns columns by name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    names = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (columns := function(batch)) is not None:
                arrays = [
                    c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type)
                    for f in names
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=names)

    return df.mapInArrow(run, schema)


def apart(df: DataFrame, keep: list[str], results: list[str], **used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Columns under names of their own, so that an operator's names can't clash with them.

    Returns the columns ``keep`` as ``k0, k1, ...`` beside the columns ``used`` under their
    keys, and a function that gives a result with ``k0, k1, ...`` and ``results`` the names
    back. A kept column with the name of a result is called ``<name>_in`` from then on.
    """
    rows = df.select(
        *(F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(keep)),
        *(F.col(f"`{name}`").alias(key) for key, name in used.items()),
    )
    names: list[str] = []
    for name in keep:
        while name in results or name in names:
            name += "_in"
        names.append(name)

    def named(found: DataFrame) -> DataFrame:
        return found.select(*(F.col(f"k{i}").alias(name) for i, name in enumerate(names)), *results)

    return rows, named


def kept_schema(rows: DataFrame, *results: str) -> str:
    """The schema of the columns that :func:`apart` kept, followed by results."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if re.fullmatch(r"k\d+", f.name)]
    return ", ".join([*kept, *results])


#: Bits of a table of ids that every task is given: 2 MB.
TABLE_BITS = 1 << 24


def spot_of(key: Column) -> Column:
    """An id's place in a bit table."""
    return F.pmod(F.xxhash64(key), F.lit(TABLE_BITS)).cast("int")


def bit_table(ids: DataFrame) -> np.ndarray:
    """A table of fixed size with the bits of all ids set; ids are the only column."""
    each = ids.select(spot_of(F.col(ids.columns[0])).alias("spot"))
    bit = F.call_function("shiftright", F.lit(128), F.col("spot") % 8)
    octets = each.groupBy(F.floor(F.col("spot") / 8).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits"))
    table = np.zeros(TABLE_BITS // 8, np.uint8)
    for row in octets.toLocalIterator():
        table[row.at] = row.bits
    return table


def bits_set(table: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Which of the places are set."""
    return (table[spots // 8] >> (7 - spots % 8).astype(np.uint8) & 1).astype(bool)


def parted(rows: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is surely not among the ids, and those that may be.

    A join with the ids then has to exchange the second only. The look-up takes the key to
    Python and leaves the other columns where they are.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bit_table(ids))

    @F.pandas_udf("boolean")
    def held(spots: pd.Series) -> pd.Series:
        return pd.Series(bits_set(shared.value, spots.to_numpy()))

    asked = rows.withColumn("__held", held(spot_of(F.col(key))))
    return asked.where(~F.col("__held")).drop("__held"), asked.where("__held").drop("__held")


def placed(df: DataFrame, group: list[str], order: list[Column], label: str) -> DataFrame:
    """The rows with their ``place`` in their group, from 0 in the given order, and its ``total``.

    One sort by range deals a large group to many tasks. A row's place is what earlier
    ranges hold of its group and its place in its own range; it is written in the pass that
    sorts, so that later attempts read the same. A null in ``group`` is a group too.
    """
    keys = [*(F.col(g).asc_nulls_first() for g in group), *order]
    rows = stored(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at")),
        label,
    )
    whole = Window.partitionBy(*group)
    spans = (
        rows.groupBy("__part", *group).agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__from"))
        .withColumn("__base", F.coalesce(F.sum("__rows").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("__from"))
        .select(F.col("__part").alias("__p"), *(F.col(g).alias(f"__{g}") for g in group), "__base", F.sum("__rows").over(whole).alias("total"))
    )
    same = F.col("__part") == F.col("__p")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"__{g}"))
    # One row for each range and group; its true size decides whether it is broadcast.
    return (
        rows.join(stored(spans, f"{label}-spans"), same)
        .select(*df.columns, (F.col("__at") + F.col("__base")).alias("place"), "total")
    )


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the given text columns only."""
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(2.0**52)


#: Where a stop or comma stands beside another mark, the two are one token to the pre-tokenizer.
_MARKS = re.compile(r"[.,](?:[^\w\s]|[_\x1c-\x1f])|(?:[^\w\s]|[_\x1c-\x1f])[.,]")


class Encoder:
    """Token ids of whole texts, through a cache of their chunks.

    The pre-tokenizer of the given vocabulary never matches across a space or a line
    feed and its normalizer acts within a chunk, so the ids of a text are those of its
    chunks in a row. Texts of Latin-1 characters alone are lower-cased first and parted
    at stops and commas, as the normalizer and pre-tokenizer would do; the chunks are
    then fewer. Chunks that were met before cost a look-up, all others go through the
    library. The cache is emptied at ``limit`` chunks, which bounds its memory.
    """

    def __init__(self, path: str, limit: int = 1_000_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.cache: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, closed by ``end_id``."""
        end = int(end_id).to_bytes(4, "little")
        out: list[bytes] = []
        part: list[list[str]] = []
        size = 0
        for k, text in enumerate(texts):
            part.append(self._chunks(text))
            size += len(part[-1])
            if size > 50_000 or k == len(texts) - 1:
                self._learn(set().union(*part).difference(self.cache))
                out += [b"".join(map(self.cache.__getitem__, chunks)) + end for chunks in part]
                if len(self.cache) > self.limit:
                    self.cache.clear()
                part, size = [], 0
        return out

    @staticmethod
    def _chunks(text: str) -> list[str]:
        if "<|" not in text and _latin(text):
            text = text.lower()
            if not _MARKS.search(text):
                text = text.replace(".", " . ").replace(",", " , ")
        return text.replace("\n", " ").split(" ")

    def _learn(self, chunks: set[str]) -> None:
        """Add the ids of new chunks.

        Normalizer and pre-tokenizer leave lower-case ASCII words as they are, so these
        go to the model itself. Other words of letters are encoded many at a time and
        parted where a token closes a word.
        """
        tokenize = self.tokenizer.model.tokenize
        plain = {c for c in chunks if c.isascii() and c.isalpha() and c.islower()}
        for word in plain:
            self.cache[word] = _packed([token.id for token in tokenize(word)])
        rest = chunks.difference(plain)
        words = [c for c in rest if c.isalpha() and c.islower() and _latin(c)]
        parts = [words[k : k + 200] for k in range(0, len(words), 200)]
        lines = self.tokenizer.encode_batch([" ".join(part) for part in parts], add_special_tokens=False)
        for part, line in zip(parts, lines):
            ids = np.asarray(line.ids, "<u4")
            ends = (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()
            if len(ends) == len(part):
                data = ids.tobytes()
                for word, begin, end in zip(part, [0, *ends], ends):
                    self.cache[word] = data[begin:end]
                rest.difference_update(part)
        left = list(rest)
        for chunk, found in zip(left, self.tokenizer.encode_batch(left, add_special_tokens=False)):
            self.cache[chunk] = _packed(found.ids)


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def _latin(text: str) -> bool:
    """Whether all characters are Latin-1: none combines, and each lower-cases by itself."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None, limit: int = 1_000_000) -> Encoder:
    """The encoder of this worker for a vocabulary file; it outlives a task and remembers ``limit`` chunks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].limit = limit
    return _ENCODERS[path]


def components(edges: DataFrame, label: str = "components", most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of an edge list ``a, b``; the root is the smallest node.

    Alternates between linking the larger neighbours of each node and its smaller
    ones to the smallest neighbour, until no edge changes; each round is a shuffle
    of the edges and is written to the shared folder. Hot nodes are aggregated
    before the shuffle and rejoined, never gathered into a list.
    """

    def signed(df: DataFrame) -> tuple[DataFrame, tuple]:
        table = stored(df.distinct(), label)
        found = table.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return table, (found.n, found.h)

    now, mark = signed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours of a node go to the smallest node around it.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Smaller neighbours and the node itself go to the smallest of them.
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before = now
        now, after = signed(small.union(lower.select("a", F.col("m").alias("b"))))
        dropped(before)
        if after == mark:
            break
        mark = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
