"""Importance resampling towards a target by hashed word n-grams.

Words come from the tokenizers library: an untrained split by a regular expression over
the text, whose A-Z are lower-cased first, with their offsets. Written one after another
with a space between, the words of a text have offsets again, and each window of up to
``ORDER`` words is a pair of them: where its first word begins and its last one ends. The
checksum of the window's bytes follows from those of its words, by the rule for the CRC of
a concatenation, and names one of ``BUCKETS`` buckets. Bucket counts over all documents and
over all target texts give each bucket its gain; a document's weight is the sum of the
gains of its windows. Documents are drawn by weight plus Gumbel noise that depends on the
seed and the id alone, the highest scores first.

Null and empty texts have no words and weight 0; without target texts all targets count
none. Texts of any length are taken whole, their words a part at a time. Equal scores are
drawn by the smaller id, a null id after all others; its noise is that of an empty id.
Repeated rows take part each, ids that repeat have the same noise. An empty table gives an
empty result. Further columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import by_batch, placed, stored, texts_of

#: A word: anything but the ASCII characters that are neither letters nor digits.
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
ORDER = 3
LEAST_WORDS = 20
#: Characters that are parted into words at a time.
PART = 1 << 20
#: Chunks a worker remembers.
CACHE = 500_000

_LOW = np.uint32(255)


def _zero_byte(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (crc >> np.uint32(8)) ^ table[crc & _LOW]


class Shifts:
    """A checksum's change when the bytes of a following text are appended, for many at once.

    The change by a number of bytes is linear, so it is the sum of the changes of the four
    bytes of the checksum: four look-ups. Longer texts go by powers of two.
    """

    MOST = 64

    def __init__(self) -> None:
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            # The polynomial of the checksum, reflected.
            table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
        bytes_at = np.arange(256, dtype=np.uint32)[None, :] << (np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None])
        steps = [bytes_at]
        for _ in range(self.MOST):
            steps.append(_zero_byte(steps[-1], table))
        self.steps = np.stack(steps)
        self.powers = [steps[self.MOST]]  # powers[k]: MOST * 2**k bytes
        for _ in range(32):
            last = self.powers[-1]
            self.powers.append(self._through(last, last))

    @staticmethod
    def _through(step: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return step[0][crc & _LOW] ^ step[1][(crc >> np.uint32(8)) & _LOW] ^ step[2][(crc >> np.uint32(16)) & _LOW] ^ step[3][crc >> np.uint32(24)]

    def shift(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The checksums ``crc`` behind ``size`` further zero bytes each."""
        short = size % self.MOST
        flat, base = self.steps.reshape(-1), short.astype(np.int64) * 1024
        out = (
            flat[base + (crc & _LOW)] ^ flat[base + 256 + ((crc >> np.uint32(8)) & _LOW)]
            ^ flat[base + 512 + ((crc >> np.uint32(16)) & _LOW)] ^ flat[base + 768 + (crc >> np.uint32(24))]
        )
        left = size // self.MOST
        for power in self.powers:
            if not left.any():
                break
            odd = np.flatnonzero(left & 1)
            out[odd] = self._through(power, out[odd])
            left = left >> 1
        return out


class Words:
    """Checksums and byte lengths of the words of texts.

    The pattern never matches a space or a line feed, so the words of a text are those of
    the chunks between; chunks met before cost a look-up, all others go through the library.
    """

    def __init__(self) -> None:
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        self.split = Split(Regex(PATTERN), "removed", invert=True)
        self.shifts = Shifts()
        self.clear()

    def clear(self) -> None:
        self.chunks: dict[str, int] = {}
        #: Of every chunk: how many words it has, and the place of the first among all.
        self.counts = np.zeros((0, 2), np.int64)
        #: Of every word of the chunks: its checksum, that with a space before it, and its bytes.
        self.found = np.zeros((0, 3), np.int64)

    def _learn(self, chunks: set[str]) -> None:
        counts: list[tuple[int, int]] = []
        found: list[tuple[int, int, int]] = []
        known, at = len(self.chunks), len(self.found)
        for chunk in chunks.difference(self.chunks):
            words = self.split.pre_tokenize_str(chunk)
            self.chunks[chunk] = known + len(counts)
            counts.append((len(words), at + len(found)))
            for _, (begin, end) in words:
                word = chunk[begin:end].encode("utf-8")
                found.append((crc32(word), crc32(b" " + word), len(word)))
        self.counts = np.concatenate([self.counts, np.array(counts, np.int64).reshape(-1, 2)])
        self.found = np.concatenate([self.found, np.array(found, np.int64).reshape(-1, 3)])

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The found numbers of every word, a row each, and how many words each text has."""
        if len(self.chunks) > CACHE:
            self.clear()
        # Bytes of letters beyond ASCII are not changed.
        parted = [text.encode("utf-8").lower().decode("utf-8").replace("\n", " ").split(" ") for text in texts]
        self._learn(set().union(*parted))
        lengths = [len(chunks) for chunks in parted]
        chosen = np.fromiter(map(self.chunks.__getitem__, chain.from_iterable(parted)), np.int64, sum(lengths))
        many, first = self.counts[chosen].T
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        ends = np.r_[0, np.cumsum(many)][np.cumsum(lengths, dtype=np.int64)]
        return self.found[at], np.diff(np.r_[0, ends])

    def buckets(self, texts: list[str]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """For parts of the texts: their numbers of words, and the buckets of all windows by length.

        The buckets of a length stand at the word that begins the window; a window that
        would leave its text has -1.
        """
        waiting: list[str] = []
        size = 0
        for k, text in enumerate(texts):
            if len(text) > PART:  # its words a part at a time, its windows all together
                found, words = zip(*(self.of([piece]) for piece in _pieces(text)))
                if waiting:
                    yield self._part(*self.of(waiting))
                    waiting, size = [], 0
                yield self._part(np.concatenate(found), np.array([sum(w.sum() for w in words)]))
                continue
            waiting.append(text)
            size += len(text)
            if size > PART:
                yield self._part(*self.of(waiting))
                waiting, size = [], 0
        if waiting:
            yield self._part(*self.of(waiting))

    def _part(self, found: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        crc, spaced = found[:, 0].astype(np.uint32), found[:, 1].astype(np.uint32)
        # Offsets of the words with a space between them; a window is a pair of a begin and an end.
        begins = np.cumsum(found[:, 2] + 1) - (found[:, 2] + 1)
        ends = begins + found[:, 2]
        last = np.repeat(np.cumsum(words), words)  # the word behind each word's text
        out = [(crc % np.uint32(BUCKETS)).astype(np.int64)]
        now = crc
        for n in range(1, ORDER):
            count = max(0, len(crc) - n)
            # The window of n words and, behind it, a space and the next word.
            now = self.shifts.shift(now[:count], ends[n:] - ends[n - 1 : n - 1 + count]) ^ spaced[n:]
            bucket = np.full(len(crc), -1, np.int64)
            bucket[:count] = np.where(np.arange(count) + n < last[:count], (now % np.uint32(BUCKETS)).astype(np.int64), -1)
            out.append(bucket)
        return words, out


def _pieces(text: str) -> Iterator[str]:
    """A text in parts that end at a space or line feed, where there is one."""
    at = 0
    while at < len(text):
        end = at + PART
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end)) + 1
            if cut <= at:  # one chunk of more than a part
                cut = min((k for k in (text.find(" ", end), text.find("\n", end)) if k >= 0), default=len(text) - 1) + 1
            end = cut
        yield text[at:end]
        at = end


_WORDS: list[Words] = []


def _words() -> Words:
    """The words of this worker; they outlive a task."""
    if not _WORDS:
        _WORDS.append(Words())
    return _WORDS[0]


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many windows of all texts fall into each bucket; a task sends one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, found in _words().buckets(texts_of(batch)):
                for buckets in found:
                    counts += np.bincount(buckets[buckets >= 0], minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    each = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for row in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of each bucket's log ratio of its share in the target to that in the raw texts."""
    s, t = float(raw.sum() + len(raw)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((b + 1) * s / ((a + 1) * t))) for a, b in zip(raw.tolist(), target.tolist())], np.int64)


def noise(name: str, seed: int) -> int:
    """Whole thousandths of a Gumbel number that hangs on seed and id alone."""
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", seed: int = 42) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(np.r_[gain, 0])  # a table of fixed size; -1 gains nothing
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{doc_id}`").cast("string").alias("name"), F.col(f"`{text}`").alias("text"))

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        words, features, weights = [], [], []
        for count, found in _words().buckets(texts_of(batch)):
            gained = sum(shared.value[buckets] for buckets in found)
            ends = np.cumsum(count)
            weights.append(np.diff(np.r_[0, np.r_[0, np.cumsum(gained)][ends]]))
            features.append(sum(np.maximum(count - n, 0) for n in range(ORDER)))
            words.append(count)
        weight = np.concatenate(weights)
        score = [w + noise(name or "", seed) for w, name in zip(weight.tolist(), batch.column("name").to_pylist())]
        return {"doc_id": batch.column("doc_id"), "n_words": np.concatenate(words), "n_features": np.concatenate(features), "weight": weight, "score": score}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return by_batch(rows, run, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = 5, seed: int = 42, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``; ``rank`` is null for what is not drawn.

    Drawn are the ``percent`` of the documents of ``least_words`` or more with the highest
    scores. Only the bucket counts reach the driver; ranks come from one sort by range.
    """
    gain = gains(bucket_counts(docs, text), bucket_counts(targets, target_text))
    scored = stored(weighted(docs, gain, doc_id, text, seed), "scored")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    ranked = placed(scored.where(F.col("n_words") >= least_words), [], order, "ranked")
    drawn = F.floor(F.col("total") * percent / 100)
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).select(*others.columns).unionByName(others)
