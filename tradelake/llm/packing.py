"""Packing of token sequences by non-negative least squares over shallow length combinations.

Documents are cut at every 4096 tokens; full pieces stand alone and the rest of a
document is one piece. Piece lengths are counted in bins of 16 tokens. Combinations of
at most six pieces of at most three different bins that fill the window exactly are
enumerated, their repeat counts are solved against the histogram by non-negative least
squares and rounded down, and what the counts leave is packed greedily: laid end to end
and cut at the window. The last part of that is cut into powers of two.

Null and empty texts are one token, the end id. Repeated rows are packed each. An empty
table gives an empty result. Extra columns of the input play no part.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradelake.llm.common import by_batch, encoder, stored

LIMIT = 4096
GRAIN = 16
BINS = LIMIT // GRAIN
MOST_PIECES = 6

PIECES = "piece long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def combinations() -> list[tuple[int, ...]]:
    """Bins, largest first, whose sizes add up to the window: at most three different ones."""
    found = {(BINS,)}
    for a in range(1, BINS):
        for times in range(1, MOST_PIECES + 1):
            rest = BINS - a * times
            if rest < 0:
                break
            if rest == 0:
                found.add((a,) * times)
                continue
            for other in range(1, MOST_PIECES - times + 1):
                if rest % other == 0:
                    found.add(tuple(sorted((a,) * times + (rest // other,) * other, reverse=True)))
    for a in range(1, BINS // 3 + 1):
        for b in range(a, (BINS - a) // 2 + 1):
            found.add((BINS - a - b, b, a))
    return sorted(found, reverse=True)


def solve(histogram: np.ndarray, patterns: list[tuple[int, ...]], rounds: int = 1500) -> np.ndarray:
    """Whole repeat counts of the patterns that use no more pieces than there are.

    Accelerated projected gradient on the least squares of used against present pieces,
    each bin weighed by the square root of its count.
    """
    rows = np.concatenate([np.asarray(p) - 1 for p in patterns])
    columns = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    present = histogram.astype(np.float64)
    weigh = 1 / np.sqrt(present + 1)
    # Patterns with a bin that has no piece can't be used; leave them out.
    lacking = np.zeros(len(patterns), bool)
    lacking[columns[present[rows] == 0]] = True
    cell = weigh[rows] * ~lacking[columns]
    forward = lambda x: np.bincount(rows, cell * x[columns], BINS)
    backward = lambda y: np.bincount(columns, cell * y[rows], len(patterns))
    v = np.ones(len(patterns))
    for _ in range(30):
        v = backward(forward(v))
        size = float(np.linalg.norm(v))
        if not size:
            return np.zeros(len(patterns), np.int64)
        v /= size
    step, goal = 1 / (1.05 * size), weigh * present
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * backward(forward(y) - goal))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / after * (new - x)
        x, t = new, after
    counts = np.zeros(len(patterns), np.int64)
    left = histogram.astype(np.int64).copy()
    order = np.argsort(-x, kind="stable")
    for whole in (True, False):  # the rounded solution first, then what else still fits
        for k in order:
            bins, times = np.unique(np.asarray(patterns[k]) - 1, return_counts=True)
            most = int((left[bins] // times).min())
            more = min(int(x[k]), most) if whole else most
            if more > 0:
                counts[k] += more
                left[bins] -= more * times
    return counts


@dataclass
class Layout:
    """Where the pieces of a bin go: runs of slots and the sequences they fill."""

    keys: np.ndarray  # bin and first slot of a run
    first_sequence: np.ndarray
    part: np.ndarray
    used: np.ndarray  # slots of each bin that patterns use
    sequences: int


def layout(counts: np.ndarray, patterns: list[tuple[int, ...]]) -> Layout:
    """Deal the slots of each bin to the patterns, one run per pattern and part."""
    used = np.zeros(BINS + 1, np.int64)
    keys, first, part, sequences = [], [], [], 0
    for k in np.flatnonzero(counts):
        for place, size in enumerate(patterns[k]):
            keys.append((size << 44) | int(used[size]))
            first.append(sequences)
            part.append(place)
            used[size] += counts[k]
        sequences += int(counts[k])
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    pick = lambda x: np.array(x, np.int64)[order]
    return Layout(pick(keys), pick(first), pick(part), used, sequences)


def cut_points(tokens: int) -> np.ndarray:
    """Where the last, unfilled window is cut: its powers of two, largest first."""
    full, rest = tokens // LIMIT * LIMIT, tokens % LIMIT
    steps = [1 << k for k in range(LIMIT.bit_length(), -1, -1) if rest >> k & 1]
    return full + np.cumsum([0, *steps])


def pieces(docs: DataFrame, doc_id: str, text: str, tokenizer: str | None, end_id: int, remembered: int) -> DataFrame:
    """The pieces of all documents with their checksums; ids of pieces that may be cut are kept."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted: dict[int, int] = {}

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        coder = encoder(tokenizer, remembered)
        small = max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        context = TaskContext.get()
        number = counted.get(context.taskAttemptId(), 0)
        out: list[tuple] = []
        for one, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("text").to_pylist(), end_id)):
            total = len(ids) // 4
            for start in range(0, total, LIMIT):
                part = ids[4 * start : 4 * (start + LIMIT)]
                length = len(part) // 4
                kept = None
                if length <= LIMIT - GRAIN:
                    kept = np.frombuffer(part, "<u4").astype("<u2").tobytes() if small else part
                out.append(((context.partitionId() << 40) | number, one, start, length, zlib.crc32(part), total, kept))
                number += 1
        counted[context.taskAttemptId()] = number
        return dict(zip((p.split()[0] for p in PIECES.split(", ")), zip(*out)))

    return by_batch(rows, run, PIECES)


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = 2,
    remembered: int = 1_000_000,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece.

    Pieces get their slot within a bin from counts by bin and salt, so that a bin with a
    third of all pieces is spread over many tasks. Only the histogram reaches the driver.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = stored(pieces(docs, doc_id, text, tokenizer, end_id, remembered), "pieces")
    size = F.ceil(F.col("length") / GRAIN).cast("int")
    light = cut.drop("ids").withColumn("bin", size).withColumn("salt", F.pmod(F.xxhash64("piece"), F.lit(4 * tasks)).cast("int"))
    groups = stored(light.groupBy("bin", "salt").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = np.zeros(BINS, np.int64)
    for r in groups.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        histogram[r.bin - 1] = r.n
    patterns = combinations()
    plan = layout(solve(histogram, patterns), patterns)
    shared = spark.sparkContext.broadcast(plan)  # at most six runs for each of the enumerated patterns

    before = Window.partitionBy("bin").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("bin", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bin", "salt").orderBy("piece")
    slots = light.withColumn("k", F.row_number().over(inside)).join(offsets, ["bin", "salt"])
    slots = slots.select("*", (F.col("base") + F.col("k") - 1).alias("slot"))
    passed = ["piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "bin", "salt"]

    def place(batch: pa.RecordBatch) -> dict[str, object]:
        runs = shared.value
        bins, slot = batch.column("bin").to_numpy(), batch.column("slot").to_numpy()
        fits = slot < runs.used[bins]
        sequence, part = np.full(len(bins), -1, np.int64), np.zeros(len(bins), np.int64)
        if fits.any():
            run = np.searchsorted(runs.keys, (bins[fits].astype(np.int64) << 44) | slot[fits], "right") - 1
            sequence[fits] = runs.first_sequence[run] + slot[fits] - (runs.keys[run] & ((1 << 44) - 1))
            part[fits] = runs.part[run]
        return {name: batch.column(name) for name in passed} | {"sequence_id": sequence, "part": part}

    kinds = {f.name: f.dataType.simpleString() for f in slots.schema}
    placed = stored(
        by_batch(slots.select(*passed, "slot"), place, ", ".join(f"{n} {kinds[n]}" for n in passed) + ", sequence_id long, part long"),
        "placed",
    )
    earlier = Window.partitionBy("sequence_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    result = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    filled = placed.where("sequence_id >= 0").withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).select(*result)

    # The residual pieces in a row: sums by bin and salt give each its first token.
    rest = placed.where("sequence_id < 0")
    sums = stored(rest.groupBy("bin", "salt").agg(F.sum("length").alias("tokens")), "residual-sums")
    by_bin = {r.bin: r.tokens for r in sums.groupBy("bin").agg(F.sum("tokens").alias("tokens")).collect()}
    total = sum(by_bin.values())
    starts, at = {}, 0
    for b in sorted(by_bin):
        starts[b] = at
        at += by_bin[b]
    first = F.element_at(F.create_map(*[F.lit(x) for pair in (starts or {0: 0}).items() for x in pair]), F.col("bin")).cast("long")
    bases = sums.select("bin", "salt", (first + F.coalesce(F.sum("tokens").over(before), F.lit(0))).alias("base"))
    running = Window.partitionBy("bin", "salt").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    laid = rest.withColumn("k", F.coalesce(F.sum("length").over(running), F.lit(0))).join(bases, ["bin", "salt"])
    laid = laid.select("piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("k")).alias("at"))
    points, base = cut_points(total), plan.sequences

    def slice_up(batch: pa.RecordBatch) -> dict[str, object]:
        out: list[tuple] = []
        for row in batch.to_pylist():
            begin, end = row["at"], row["at"] + row["length"]
            marks = [*range(begin // LIMIT * LIMIT + LIMIT, min(end, int(points[0])), LIMIT)]
            marks += [int(p) for p in points if begin < p < end and p not in marks]
            edges = [begin, *marks, end]
            for a, b in zip(edges, edges[1:]):
                tail = int(np.searchsorted(points, a, "right")) - 1
                within = a // LIMIT if tail < 0 else int(points[0]) // LIMIT + tail
                opened = within * LIMIT if tail < 0 else int(points[tail])
                whole = len(edges) == 2
                out.append((row["piece"], row["doc_id"], row["start"] + a - begin, b - a, row["ids_crc32"] if whole else None, row["doc_tokens"], base + within, a - opened, a - begin))
        names = "piece doc_id start length ids_crc32 doc_tokens sequence_id offset skip".split()
        return dict(zip(names, zip(*out)))

    loose = stored(
        by_batch(laid, slice_up, "piece long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, skip long"),
        "residual",
    )
    ids = cut.where("ids is not null").select(F.col("piece").alias("p"), "ids")
    torn = loose.where("ids_crc32 is null").join(ids, F.col("piece") == F.col("p")).drop("p")

    def check(batch: pa.RecordBatch) -> dict[str, object]:
        sums = []
        for data, skip, length, start, total in zip(*(batch.column(n).to_pylist() for n in ("ids", "skip", "length", "start", "doc_tokens"))):
            held = min(total - (start - skip), LIMIT)
            kind = "<u2" if len(data) == 2 * held else "<u4"
            sums.append(zlib.crc32(np.frombuffer(data, kind)[skip : skip + length].astype("<u4").tobytes()))
        return {n: batch.column(n) for n in result if n != "ids_crc32"} | {"ids_crc32": sums}

    fixed = by_batch(torn, check, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return filled.unionByName(loose.where("ids_crc32 is not null").select(*result)).unionByName(fixed)
