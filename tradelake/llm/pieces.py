"""SentencePiece ids of whole texts by merge rounds over flat arrays, and their decoding.

The symbols of many words lie in one array. In each round every word finds its pair of
least rank, all words merge their pairs of that rank at once, the leftmost first where
pairs overlap, and the array is compacted; a word without a pair that is a piece is
done. The result is that of merging one pair at a time:

- A text is parted only between characters that are neighbours in no piece, so no merge
  can cross.
- Merging all pairs of a rank at once changes nothing, unless the new piece could be part
  of a pair of lower or equal rank. Such pieces are known from the vocabulary, and a word
  whose best pair makes one merges only its leftmost pair in that round.

Characters without a piece become the pieces of their UTF-8 bytes. Texts go through the
library's normalizer first and its decoder afterwards. Null and empty texts have the begin
and end ids alone. Texts of any length are taken whole, a part at a time. Words of
more than ``LONG`` symbols that no boundary parts are merged pair by pair from a heap,
whose cost does not grow with the number of rounds. Repeated rows are encoded each, an empty
table gives an empty result, and a kept column with the name of a result gets ``_in``.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradelake.llm.common import apart, by_batch, kept_schema, texts_of

#: Symbols of a word beyond which it leaves the rounds.
LONG = 4096
#: Characters that are parted into words at a time.
PART = 1 << 20
#: Symbols that go through the rounds together.
ROUND = 1 << 20

_NONE = np.iinfo(np.int32).max
_CODES = 0x110000


class Lookup:
    """Numbers by 64-bit keys, in an open hash table that is probed for many keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(8, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        left, slots = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = self.keys[slots[left]] == -1
            _, first = np.unique(slots[left][free], return_index=True)
            chosen = left[free][first]
            self.keys[slots[chosen]] = keys[chosen]
            self.values[slots[chosen]] = values[chosen]
            left = np.setdiff1d(left, chosen, assume_unique=True)
            taken = self.keys[slots[left]] != -1
            slots[left[taken]] = (slots[left[taken]] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], -1)
        left = np.flatnonzero((found != keys) & (found != -1))
        while len(left):
            slots[left] = (slots[left] + 1) & self.mask
            found = self.keys[slots[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[slots[left[hit]]]
            left = left[~hit & (found != -1)]
        return out


class PieceEncoder:
    """Ids of texts under a byte-fallback BPE model of the sentencepiece library.

    Words met before cost a look-up; the cache is emptied at ``limit`` words. ``long`` is
    the number of symbols beyond which a word is merged from a heap.
    """

    def __init__(self, path: str, limit: int = 300_000, long: int = LONG) -> None:
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto, TrainerSpec

        self.library = SentencePieceProcessor(model_file=path)
        model = ModelProto.FromString(self.library.serialized_model_proto())
        kind = ModelProto.SentencePiece
        if model.trainer_spec.model_type != TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("the model has to be BPE with byte fallback")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.size = len(model.pieces)
        self.bytes = np.array([self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        #: Piece of a character; a character without one is the symbol ``-1 - code``.
        self.chars = -1 - np.arange(_CODES, dtype=np.int32)
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        # Pieces of one score have one rank, and the leftmost of their pairs goes first.
        self.ranks = np.full(self.size, _NONE, np.int32)
        scores = np.array([-model.pieces[i].score for i in pieces.values()], np.float32)
        self.ranks[list(pieces.values())] = np.unique(scores, return_inverse=True)[1]
        keys, made, near = [], [], set()
        self.early = np.zeros(self.size, bool)
        for piece, i in pieces.items():
            near.update(zip(piece, piece[1:]))
            for cut in range(1, len(piece)):
                a, b = pieces.get(piece[:cut]), pieces.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    made.append(i)
                    for part in (a, b):
                        self.early[part] |= self.ranks[i] <= self.ranks[part]
        self.pairs = Lookup(np.array(keys, np.int64), np.array(made, np.int32))
        self._joins(near)
        self.limit, self.long = limit, long
        self.cache: dict[str, bytes] = {}

    def _joins(self, near: set[tuple[str, str]]) -> None:
        """Which characters are neighbours in some piece; ``kinds`` numbers those that have any neighbour."""
        codes = sorted({ord(c) for pair in near for c in pair})
        self.kinds = np.zeros(_CODES, np.int32)
        self.kinds[codes] = np.arange(1, len(codes) + 1)
        self.width = len(codes) + 1
        self.inside = np.zeros(self.width * self.width, bool)
        a, b = (np.array([ord(pair[k]) for pair in near], np.int64) for k in (0, 1))
        self.inside[self.kinds[a] * np.int64(self.width) + self.kinds[b]] = True

    def words(self, text: str) -> list[str]:
        """The parts of a normalized text that no piece crosses."""
        out: list[str] = []
        rest = ""
        for at in range(0, len(text), PART):
            part = rest + text[at : at + PART]
            kinds = self.kinds[np.frombuffer(part.encode("utf-32-le"), "<u4")]
            cuts = (np.flatnonzero(~self.inside[kinds[:-1] * np.int64(self.width) + kinds[1:]]) + 1).tolist()
            out += map(part.__getitem__, map(slice, [0, *cuts[:-1]], cuts))
            rest = part[cuts[-1] if cuts else 0 :]
        if rest:
            out.append(rest)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, with begin and end."""
        begin, end = (int(i).to_bytes(4, "little") for i in (self.begin, self.end))
        out, waiting, size = [], [], 0
        for k, text in enumerate(texts):
            waiting.append(self.words(self.library.normalize(text)))
            size += len(text)
            if size > PART or k == len(texts) - 1:
                self._learn(list(set().union(*waiting).difference(self.cache)))
                out += [b"".join([begin, *map(self.cache.__getitem__, words), end]) for words in waiting]
                if len(self.cache) > self.limit:
                    self.cache.clear()
                waiting, size = [], 0
        return out

    def _learn(self, words: list[str]) -> None:
        group: list[str] = []
        size = 0
        for k, word in enumerate(words):
            if len(word) > self.long:
                self.cache[word] = self._ids(self._one_by_one(self._symbols(word)))
            else:
                group.append(word)
                size += len(word)
            if group and (size > ROUND or k == len(words) - 1):
                symbols, owner = self.merged(self._symbols("".join(group)), np.repeat(np.arange(len(group)), [len(w) for w in group]))
                ends = np.cumsum(np.bincount(owner, minlength=len(group)))
                for word, found in zip(group, np.split(symbols, ends[:-1])):
                    self.cache[word] = self._ids(found)
                group, size = [], 0

    def _symbols(self, text: str) -> np.ndarray:
        return self.chars[np.frombuffer(text.encode("utf-32-le"), "<u4")]

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, or -1."""
        made = self.pairs.get(np.maximum(left, 0).astype(np.int64) * self.size + np.maximum(right, 0))
        made[(left < 0) | (right < 0)] = -1
        return made

    def merged(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols of each word, whose numbers ``owner`` ascend, until no pair is left."""
        # made[i]: what symbol i and its right neighbour in the word make.
        made = np.full(len(symbols), -1, np.int32)
        made[:-1] = self._made(symbols[:-1], symbols[1:])
        made[:-1][owner[:-1] != owner[1:]] = -1
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(owner)])
            rank = np.where(made >= 0, self.ranks[made], _NONE)
            best = np.minimum.reduceat(rank, starts)
            going = np.repeat(best < _NONE, lengths)
            if not going.all():
                done.append((symbols[~going], owner[~going]))
                symbols, owner, made, rank = symbols[going], owner[going], made[going], rank[going]
                best, lengths = best[best < _NONE], lengths[best < _NONE]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, lengths))
            whose = owner[at]
            first = np.r_[True, whose[1:] != whose[:-1]]
            # Of a run of overlapping pairs every second one goes, the leftmost first.
            heads = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
            within = np.arange(len(at)) - np.repeat(heads, np.diff(np.r_[heads, len(at)]))
            early = np.logical_or.reduceat(self.early[made[at]], np.flatnonzero(first))
            alone = np.repeat(early, np.diff(np.r_[np.flatnonzero(first), len(at)]))
            at = at[np.where(alone, first, within % 2 == 0)]
            symbols[at] = made[at]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            symbols, owner, made = symbols[kept], owner[kept], made[kept]
            now = at - np.arange(len(at))  # as many symbols went before each as merges
            for place in (now, now[now > 0] - 1):
                after = np.minimum(place + 1, len(symbols) - 1)
                found = self._made(symbols[place], symbols[after])
                made[place] = np.where((after > place) & (owner[place] == owner[after]), found, -1)
        symbols, owner = (np.concatenate(parts) if parts else np.zeros(0, np.int32) for parts in (list(zip(*done)) or [(), ()]))
        order = np.argsort(owner, kind="stable")
        return symbols[order], owner[order].astype(np.int64)

    def _one_by_one(self, symbols: np.ndarray) -> np.ndarray:
        """The same for one very long word, from a heap of its pairs."""
        n = len(symbols)
        symbol = symbols.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self._made(symbols[:-1], symbols[1:])
        heap = [(int(self.ranks[z]), i, int(z), symbol[i], symbol[i + 1]) for i, z in enumerate(first.tolist()) if z >= 0]
        heapq.heapify(heap)
        gone = bytearray(n)

        def push(i: int) -> None:
            j = after[i]
            if j < n:
                z = int(self._made(np.array([symbol[i]]), np.array([symbol[j]]))[0])
                if z >= 0:
                    heapq.heappush(heap, (int(self.ranks[z]), i, z, symbol[i], symbol[j]))

        while heap:
            _, i, z, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or symbol[i] != a or symbol[j] != b:
                continue
            symbol[i], gone[j], after[i] = z, 1, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([s for s, g in zip(symbol, gone) if not g], np.int32)

    def _ids(self, symbols: np.ndarray) -> bytes:
        if not len(symbols) or symbols.min() >= 0:
            return symbols.astype("<u4").tobytes()
        out: list[np.ndarray] = []
        for symbol in symbols.tolist():
            out.append(np.array([symbol]) if symbol >= 0 else self.bytes[list(chr(-1 - symbol).encode("utf-8"))])
        return np.concatenate(out).astype("<u4").tobytes()


_ENCODERS: dict[str, PieceEncoder] = {}


def piece_encoder(path: str | None) -> PieceEncoder:
    """The encoder of this worker for a model file; it outlives a task."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, keep: list[str], text: str = "text", model: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``ids``: little-endian unsigned 32-bit numbers."""
    rows, named = apart(docs, keep, ["ids"], text=text)

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        found = {name: batch.column(name) for name in batch.schema.names if name != "text"}
        return {**found, "ids": piece_encoder(model).encode(texts_of(batch))}

    return named(by_batch(rows, run, kept_schema(rows, "ids binary")))


def decode(encoded: DataFrame, keep: list[str], ids: str = "ids", model: str | None = None) -> DataFrame:
    """The columns ``keep`` and the ``decoded`` text of ids that :func:`encode` returns; null ids decode to null."""
    rows, named = apart(encoded, keep, ["decoded"], ids=ids)

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        found = {name: batch.column(name) for name in batch.schema.names if name != "ids"}
        library = piece_encoder(model).library
        texts = [None if x is None else library.decode(np.frombuffer(x, "<u4").tolist()) for x in batch.column("ids").to_pylist()]
        return {**found, "decoded": texts}

    return named(by_batch(rows, run, kept_schema(rows, "decoded string")))
