"""Toxicity scores of a character n-gram linear classifier with naive Bayes feature scaling.

Features are the distinct character n-grams of a text, hashed into a table of fixed
size. Each is scaled by the log ratio of its smoothed counts in the two classes, and a
logistic regression is trained on the scaled features (both classes of a bounded
sample of labelled rows, weighted back to their true shares).

Null and empty texts have no features and get the score of the intercept, at most the
share of toxic labels. Rows whose id is null count as not held out and are never
learnt from. Repeated rows are scored each; labels that occur more than once count as
often. Without labels of both classes every score is 0. An empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import apart, by_batch, kept_schema, texts_of

SIZES = (3, 4, 5, 6)
TABLE_BITS = 20
#: Labelled rows learnt from, per class; the only bound on what is learnt from.
SAMPLE_PER_CLASS = 2000
#: Features learnt, those with the most evidence for a class, and documents that a feature needs.
FEATURES: int | None = 6000
LEAST_DOCUMENTS = 5
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def grams(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Document number per byte, and per n-gram size the hashed n-gram that begins there.

    Lower-cased texts are joined with a separator, which no counted n-gram spans.
    """
    parts = [b" " + t.lower().encode("utf-8", "surrogatepass").replace(b"\n", b" ") + b" \0\0\0\0\0\0" for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(parts), np.uint8)
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
    hashed, rolling = [], data.astype(np.uint64)
    shift = np.uint64(64 - TABLE_BITS)
    with np.errstate(over="ignore"):
        for step in range(1, max(SIZES)):
            following = data[step:].astype(np.uint64)
            rolling = rolling[: len(following)] * np.uint64(0x100000001B3) + following + np.uint64(1)
            if step + 1 in SIZES:
                mixed = ((rolling ^ (rolling >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> shift
                mixed = mixed.astype(np.int32)
                # Those that begin in a separator may end in the next text.
                mixed[(data[step:] == 0) | (owner[step:] != owner[: len(mixed)])] = -1
                hashed.append(mixed)
    return owner, hashed


def distinct_grams(texts: list[str]) -> list[np.ndarray]:
    """The distinct features of each text."""
    owner, hashed = grams(texts)
    keys = np.concatenate([(owner[: len(h)][h >= 0].astype(np.int64) << TABLE_BITS) | h[h >= 0] for h in hashed])
    keys = np.unique(keys)
    bounds = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.int64) << TABLE_BITS)
    low = (keys & ((1 << TABLE_BITS) - 1)).astype("<u4")
    return [low[a:b] for a, b in zip(bounds, bounds[1:])]


@dataclass
class Model:
    """Weights of the kept features, the intercept, and their place in the feature table."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def __post_init__(self) -> None:
        self.place = np.full(1 << TABLE_BITS, -1, np.int32)
        self.place[self.features] = np.arange(len(self.features))

    def scores(self, texts: list[str]) -> np.ndarray:
        if not len(self.features):
            return np.full(len(texts), self.intercept)
        owner, hashed = grams(texts)
        keys = []
        for h in hashed:
            place = self.place[h]
            kept = np.flatnonzero((place >= 0) & (h >= 0))
            keys.append(owner[kept].astype(np.int64) * len(self.features) + place[kept])
        keys = np.unique(np.concatenate(keys))
        sums = np.bincount(keys // len(self.features), self.weights[keys % len(self.features)], len(texts))
        return 1 / (1 + np.exp(-np.clip(sums + self.intercept, -35, 35)))


def fit(
    labels: np.ndarray, weights: np.ndarray, documents: list[np.ndarray], rounds: int = 400, decay: float = 2e-4,
    features: int | None = FEATURES, least: int = LEAST_DOCUMENTS,
) -> Model:
    """Scale features by their log-count ratios and train a logistic regression on them.

    Learnt are the ``features`` with the most evidence, or all if that is None, out of those
    that ``least`` documents have.
    """
    if not (labels == 1).any() or not (labels == 0).any():
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    size = 1 << TABLE_BITS
    counts = np.zeros((2, size))
    for label, found in zip(labels, documents):  # distinct features, so each counts once
        counts[label][found] += 1
    clean, toxic = counts
    # Smoothed chance of a feature in a document of each class, and the log of their ratio.
    ratio = np.log((toxic + 1) / ((labels == 1).sum() + 2)) - np.log((clean + 1) / ((labels == 0).sum() + 2))
    evidence = np.abs(ratio) * np.sqrt(toxic + clean)
    evidence[toxic + clean < least] = 0
    kept = np.sort(np.argsort(-evidence, kind="stable")[:features])
    kept = kept[evidence[kept] > 0]
    place = np.full(size, -1, np.int64)
    place[kept] = np.arange(len(kept))
    # Only what a document has of the kept features is held together.
    used = [place[found][place[found] >= 0] for found in documents]
    rows = np.repeat(np.arange(len(documents)), [len(u) for u in used])
    columns = np.concatenate(used)
    scale = ratio[kept][columns]
    w, b = np.zeros(len(kept)), float(np.log(weights[labels == 1].sum() / weights[labels == 0].sum()))
    share = weights / weights.sum()
    # Adam on the weighted log loss; full batches, so that every run gives the same model.
    first, second = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(rows, w[columns] * scale, len(labels)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - labels) * share
        slope = np.append(np.bincount(columns, error[rows] * scale, len(kept)) + decay * w, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        w -= move[:-1]
        b -= move[-1]
    return Model(kept, w * ratio[kept], b)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model learnt from labelled documents that are not held out.

    At most ``per_class`` rows of each class are learnt from, chosen by a hash of the
    id; the driver holds no more than the features of these.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = None
    for toxic in (0, 1):
        part = known.where(F.col("toxic") == toxic).select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    chosen = F.broadcast(picked.select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic")))  # 2 * per_class rows at most
    rows = docs.select(F.col(doc_id).alias("__doc"), F.col(text).alias("__text")).join(chosen, F.col("__doc") == F.col("__id"))
    rows = rows.select("__doc", "__toxic", "__text")

    def features(batch: pa.RecordBatch) -> dict[str, object]:
        found = distinct_grams(texts_of(batch, "__text"))
        return {"id": batch.column("__doc").cast(pa.int64()), "toxic": batch.column("__toxic").cast(pa.int32()), "f": [f.tobytes() for f in found]}

    got = sorted(
        ((r.id, r.toxic, bytes(r.f)) for r in by_batch(rows, features, "id long, toxic int, f binary").toLocalIterator())
    )
    y = np.array([g[1] for g in got], np.int64)
    each = np.array([counts[t] / max(1, (y == t).sum()) for t in y])
    return fit(y, each, [np.frombuffer(g[2], "<u4") for g in got])


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of each row with ``score``; the model has a fixed size and is broadcast.

    A kept column named ``score`` is called ``score_in`` in the result.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.intercept))
    rows, named = apart(docs, keep, ["score"], text=text)
    held: dict[str, Model] = {}

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        if "model" not in held:
            held["model"] = Model(*shared.value)
        texts, out, part, size = texts_of(batch), [], [], 0
        for one in [*texts, None]:  # about a megabyte at a time
            if part and (one is None or size > 1_000_000):
                out.append(held["model"].scores(part))
                part, size = [], 0
            if one is not None:
                part.append(one)
                size += len(one)
        return {name: batch.column(name) for name in batch.schema.names} | {"score": np.concatenate(out)}

    return named(by_batch(rows, run, kept_schema(rows, "score double")))
