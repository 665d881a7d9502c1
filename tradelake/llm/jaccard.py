"""Join of documents whose shingle sets are similar, by T-occurrence search.

A set becomes its sorted 64-bit shingle hashes. Equal sets are one node from then on.

1. A sound filter drops nodes that cannot link. In the order of the hashes, neighbours of
   one set are neighbours in a similar set too, but for those next to a differing shingle;
   so linked sets share a known number of such pairs among their smallest hashes, and a
   node needs that many of its pairs to occur in another node. Unlike single shingles,
   pairs hardly ever agree by chance, however large the corpus is.
2. The remaining nodes order their shingles by how many nodes hold them. A linked pair
   shares a shingle among the rarest of both, at places that leave enough shingles behind.
   Nodes with such a counterpart form blocks, which hold every linked pair.
3. Within a block each set is searched among the others by DivideSkip: the longest
   inverted lists are put aside, the short ones are merged by a heap, and nodes that
   occur often enough are probed for in the long lists by binary search until they reach
   the overlap or cannot. A set is not probed for again once it is known to be in the
   same component. Blocks too large for a task are searched in tiles.

Null and empty texts and texts without words have no shingles and link with nothing.
Rows that repeat an id are nodes by their texts; the component takes the smallest id.
A null id is passed over in that minimum. Texts of any length are handled whole. An
empty table gives an empty result. Hashes are taken as the shingles they stand for
(a wrong match needs two equal 64-bit hashes in a pair), and sets are joined by the first
64 bits of their names: two unequal sets share one with a chance of 2^-64.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import bit_table, bits_set, by_batch, components, dropped, larger_batches, spot_of, stored, swept, texts_of

SHINGLE = 3
LEAST = 90  # per cent
#: Documents of a block that one task indexes; larger blocks are tiled.
TILE = 2000
#: Weight of a heap step against a binary probe in the choice of the long lists.
PROBE_COST = 0.0085

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTERS = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and how many words each text has; A-Z count as a-z."""
    parts = [t.encode("utf-8", "surrogatepass").lower() + b" " for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    if len(_POWERS) == 0 or len(_POWERS[0]) <= len(data):
        size = max(1 << 21, len(data) + 1)
        _POWERS[:] = [np.multiply.accumulate(np.r_[_U(1), np.full(size, x, _U)]) for x in (_BASE, _INVERSE)]
    space = _SPACE[data]
    edge = np.diff(np.r_[True, space].astype(np.int8))
    first = np.flatnonzero(edge == -1)
    last = np.flatnonzero(edge == 1)
    sums = np.cumsum(_LETTERS[data] * _POWERS[0][: len(data)], dtype=_U)
    before = np.where(first > 0, sums[first - 1], _U(0))
    # Sums of letter times power, brought back to the start of the word.
    hashes = _mix((sums[last - 1] - before) * _POWERS[1][first] + (last - first).astype(_U))
    ends = np.cumsum([len(p) for p in parts])
    return hashes, np.diff(np.r_[0, np.searchsorted(first, ends)])


def shingle_sets(texts: list[str], shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted hashes of each text's ``shingle`` words in a row; they are computed a megabyte at a time."""
    with np.errstate(over="ignore"):
        part: list[str] = []
        size = 0
        for k, text in enumerate(texts):
            part.append(text)
            size += len(text)
            if size > 1_000_000 or k == len(texts) - 1:
                hashes, counts = word_hashes(part)
                at = 0
                for n in counts.tolist():
                    w = hashes[at : at + n]
                    at += n
                    if n == 0:
                        yield np.zeros(0, _U)
                    elif n < shingle:
                        h = _U(n)
                        yield np.array([xxhash.xxh3_64_intdigest(bytes([n]) + w.tobytes())], _U)
                    else:
                        h = w[: n - shingle + 1]
                        for step in range(1, shingle):
                            h = _mix(h * _U(_BASE) + w[step : n - shingle + 1 + step])
                        yield np.unique(h)
                part, size = [], 0


def needed(n: int, least: int = LEAST) -> int:
    """Smallest overlap of a set of ``n`` with a set it links with."""
    return -(-least * n // 100)


def overlap(n: int, m: int, least: int = LEAST) -> int:
    """Smallest overlap of linked sets of ``n`` and ``m``."""
    return -(-least * (n + m) // (100 + least))


#: Neighbouring pairs that linked sets share at least, but for one. The more there are, the
#: fewer sets that share a passage only pass the filter, and the more pairs it has to count.
SPARE = 60


def neighbours(found: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Hashes of neighbouring pairs among the smallest shingle hashes of a set.

    With similarity L and m = (1 - L) / L, a set of n differs from a linked one by d of
    its own and e foreign shingles, where d (1 + m) + e <= m n. They break at most
    2 d + e pairs and shift places by at most e, which leaves ``SPARE - 1`` common pairs
    among the first 2 m n + SPARE hashes of both.
    """
    kept = found[: -(-2 * (100 - least) * len(found) // least) + SPARE]
    with np.errstate(over="ignore"):
        return _mix(kept[:-1] * _U(_BASE) + kept[1:]).view(np.int64)


def _node(found: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(found.astype("<u8").tobytes())
    return tuple(np.frombuffer(digest, "<i8").tolist())


#: Names of sets that a task remembers, so that copies send their pairs once a task.
REMEMBERED = 1_000_000


def nodes_of(docs: DataFrame, doc_id: str, text: str, least: int, shingle: int = SHINGLE) -> DataFrame:
    """Per row: ``doc_id, n, node, other`` (a 128-bit name of its set) and the set's ``pairs``.

    The pairs are null where a row of the same task had the set before.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            out = []
            for one, found in zip(batch.column("doc_id").to_pylist(), shingle_sets(texts_of(batch), shingle)):
                n = len(found)
                name = _node(found) if n else (None, None)
                fresh = n > 0 and name not in seen
                if fresh:
                    seen.add(name)
                out.append((one, n, *name, neighbours(found, least) if fresh else None))
            if len(seen) > REMEMBERED:
                seen.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _NODES)], schema=_NODES)

    return rows.mapInArrow(run, "doc_id long, n long, node long, other long, pairs array<long>")


_NODES = pa.schema([(name, pa.int64()) for name in ("doc_id", "n", "node", "other")] + [("pairs", pa.list_(pa.int64()))])


def may_link(rows: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """``node, other, n, doc_id`` of nodes of which enough pairs occur in another node.

    Sets of under ``least / (100 - least)`` shingles only link with equal ones. Pairs are
    exchanged once; sorted by their hash, those of other nodes follow each other, and a
    task remembers no more than the last hash, whether it was met twice, and its node.
    """
    large = F.col("n") * (100 - least) >= least
    each = rows.where(large & F.col("pairs").isNotNull()).select(F.explode("pairs").alias("h"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int, bool] | None = None  # hash, its latest node, whether it has an earlier one
        for batch in batches:
            h, node = (batch.column(k).to_numpy() for k in (0, 1))
            if not len(h):
                continue
            fresh = np.r_[last is None or (h[0], node[0]) != last[:2], (h[1:] != h[:-1]) | (node[1:] != node[:-1])]
            h, node = h[fresh], node[fresh]
            if not len(h):
                continue
            follows = np.r_[last is not None and h[0] == last[0], h[1:] == h[:-1]]
            # A node counts when one of its hash goes before or comes behind; that of the last row is yet open.
            counted = follows | np.r_[follows[1:], False]
            out = [node[counted]]
            if last is not None and follows[0] and not last[2]:
                out.append(np.array([last[1]], np.int64))
            last = (int(h[-1]), int(node[-1]), bool(counted[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], names=["node"])

    ordered = each.repartition("h").sortWithinPartitions("h", "node")
    with larger_batches(rows.sparkSession):
        found = stored(ordered.mapInArrow(run, "node long").groupBy("node").agg(F.count(F.lit(1)).alias("shared")), "shared")
    # Two pairs of slack cover the rounding; short sets keep all their pairs.
    enough = F.least(F.lit(SPARE - 2), F.floor((2 * least - 100) * F.col("n") / 100) - 2)
    return nodes.where(large).join(found, "node").where(F.col("shared") >= enough).drop("shared")


def full_sets(docs: DataFrame, active: DataFrame, doc_id: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``node, other, n, h`` with all hashes of the active nodes, from a second scan.

    A bit table of fixed size, set at the ids of the active nodes, lets the scan pass
    over most other texts; the join makes the choice exact.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(active.select("doc_id")))
    spot = spot_of(F.col("doc_id")).alias("spot")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).select("doc_id", spot, "text")

    def run(batch: pa.RecordBatch) -> dict[str, object] | None:
        hit = np.flatnonzero(bits_set(shared.value, batch.column("spot").to_numpy()))
        if not len(hit):
            return None
        chosen = batch.take(pa.array(hit))
        out = [
            (*_node(found), len(found), found.view(np.int64))
            for found in shingle_sets(texts_of(chosen), shingle) if len(found)
        ]
        return dict(zip(("node", "other", "n", "h"), zip(*out))) if out else None

    sets = by_batch(rows, run, "node long, other long, n long, h array<long>")
    return sets.join(active.select("node", "other"), ["node", "other"], "left_semi").dropDuplicates(["node", "other"])


def rare_places(sets: DataFrame, least: int) -> DataFrame:
    """``h, node, n, place``: the rarest shared shingles of each node, by their place in its order."""
    each = sets.select("node", F.explode("h").alias("h"))
    held = stored(each.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "held")
    ordered = (
        each.join(held, "h")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("c", "h"))).alias("s"))
        .join(sets.select("node", "n"), "node")
        .withColumn("spare", F.size("s") - F.ceil(F.col("n") * least / 100))
        .where("spare >= 0")
    )
    first = F.slice("s", F.lit(1), (F.col("spare") + 1).cast("int"))
    # Shingles that only this node holds come before all others.
    return ordered.select("node", "n", (F.col("n") - F.size("s")).alias("own"), F.posexplode(first).alias("k", "e")).select(
        F.col("e.h").alias("h"), "node", "n", (F.col("own") + F.col("k")).alias("place")
    )


def block_edges(places: DataFrame, least: int) -> DataFrame:
    """Edges ``a, b`` that join nodes with a counterpart under one of their rare shingles.

    Whether two nodes can be counterparts depends on size and place alone, so a shingle's
    nodes are first aggregated by these; no pairs of nodes are formed.
    """
    kinds = places.groupBy("h", "n", "place").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("hub"))
    lists = kinds.groupBy("h").agg(F.collect_list(F.struct("n", "place", "c", "hub")).alias("k"), F.sum("c").alias("c")).where("c > 1")

    def run(batch: pa.RecordBatch) -> dict[str, object] | None:
        out: list[tuple] = []
        for h, kinds in zip(batch.column("h").to_pylist(), batch.column("k").to_pylist()):
            n, place, c, hub = (np.array([k[f] for k in kinds], np.int64) for f in ("n", "place", "c", "hub"))
            root = np.arange(len(n))
            left, hit = n - place, np.zeros(len(n), bool)
            for i in range(len(n)):
                fits = (np.minimum(left[i], left) >= -(-least * (n[i] + n) // (100 + least))) & (100 * np.minimum(n[i], n) >= least * np.maximum(n[i], n))
                fits[i] &= c[i] > 1
                if fits.any():
                    hit[i] = True
                    fits[i] = True
                    together = np.unique(root[fits])
                    root[np.isin(root, together)] = together[0]
            out.extend((h, int(n[i]), int(place[i]), int(hub[root[i]])) for i in np.flatnonzero(hit))
        return dict(zip(("h", "n", "place", "hub"), zip(*out))) if out else None

    hubs = by_batch(lists.select("h", "k"), run, "h long, n long, place long, hub long")
    return places.join(hubs, ["h", "n", "place"]).select(F.col("node").alias("a"), F.col("hub").alias("b"))


def divide_skip(query: np.ndarray, lists: dict[int, list[int]], sizes: list[int], least: int, known) -> Iterator[int]:
    """Indexed sets that link with ``query``, from ascending lists; ``known`` tells which need no probe."""
    n = len(query)
    low = needed(n, least)
    mine = sorted((found for h in query.tolist() if (found := lists.get(h))), key=len)
    if len(mine) < low:
        return
    # The longer the lists, the dearer their merge and the more of them are only probed.
    aside = min(low - 1, int(low / (PROBE_COST * log2(len(mine[-1]) + 1) + 1)))
    short, long = mine[: len(mine) - aside], mine[len(mine) - aside :]
    for one, run in groupby(heapq.merge(*short)):
        count = sum(1 for _ in run)
        if count < low - aside or known(one):
            continue
        size = sizes[one]
        if 100 * min(n, size) < least * max(n, size):
            continue
        wanted = overlap(n, size, least)
        for k, found in enumerate(long):
            if count >= wanted or count + len(long) - k < wanted:
                break
            place = bisect_left(found, one)
            count += place < len(found) and found[place] == one
        if count >= wanted:
            yield one


def search(nodes: list[int], sets: list[np.ndarray], side: list[int], least: int) -> list[tuple[int, int]]:
    """Edges that connect all linked sets of a tile: a spanning forest of its links.

    Sets of side 0 are indexed; those of side 1 are searched for in the index, or, if
    there are none, the sets of side 0 among each other.
    """
    # Numbered in the order of their visits, so that inverted lists ascend as they grow.
    order = sorted(range(len(sets)), key=lambda k: (side[k], len(sets[k])))
    nodes, sets, side = [nodes[k] for k in order], [sets[k] for k in order], [side[k] for k in order]
    every, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.int64), np.zeros(0))
    common = every[counts > 1]
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges: list[tuple[int, int]] = []
    sizes = [len(s) for s in sets]
    lists: dict[int, list[int]] = {}

    def insert(k: int) -> None:
        for h in sets[k][np.isin(sets[k], common, assume_unique=True)].tolist():
            lists.setdefault(h, []).append(k)

    def ask(k: int) -> None:
        own = root(k)
        for one in divide_skip(sets[k], lists, sizes, least, lambda x: root(x) == root(own)):
            parent[root(one)] = root(own)
            edges.append((nodes[k], nodes[one]))

    split = 1 in side
    for k in range(len(sets)):
        if not split or side[k]:
            ask(k)
        if not side[k]:
            insert(k)
    return edges


def tiles(sets: DataFrame, blocks: DataFrame, tile: int) -> DataFrame:
    """The sets dealt to tasks: ``task, i, j, side``; small blocks share a task."""
    sizes = blocks.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    small = sizes.where(F.col("size") <= tile).agg(F.sum("size")).first()[0] or 0
    bundles = max(1, -(-int(small) // 500))
    chunks = F.ceil(F.col("size") / tile).cast("int")
    dealt = (
        sets.join(blocks.join(sizes, "root"), "node")
        .withColumn("chunks", chunks)
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    )
    task = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("root"), F.lit(bundles))).otherwise(F.col("root"))
    at = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    return (
        dealt.withColumn("task", task)
        .withColumn("met", at)
        .select(
            (F.col("chunks") > 1).alias("large"), "task", F.least("chunk", "met").alias("i"), F.greatest("chunk", "met").alias("j"),
            (F.col("chunk") > F.col("met")).cast("int").alias("side"), "node", "h",
        )
    )


def components_of(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, tile: int = TILE, shingle: int = SHINGLE
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row."""
    spark = docs.sparkSession
    made = stored(nodes_of(docs, doc_id, text, least, shingle), "sets")
    rows = stored(made.drop("pairs"), "names")
    nodes = stored(
        rows.where("node is not null").groupBy("node", "other").agg(F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n")), "nodes"
    )
    active = stored(may_link(made, nodes, least), "active")
    dropped(made)
    swept(spark)
    sets = stored(full_sets(docs, active, doc_id, text, shingle), "active-sets")
    places = stored(rare_places(sets, least), "places")
    swept(spark)
    edges = components(block_edges(places, least), "blocks")
    blocks = stored(edges, "blocks")
    dropped(edges, places, active)
    swept(spark)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        split = group.i.iloc[0] != group.j.iloc[0]
        found = search(group.node.tolist(), [np.asarray(h, np.int64) for h in group.h], group.side.tolist() if split else [0] * len(group), least)
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    links = stored(tiles(sets, blocks, tile).groupBy("large", "task", "i", "j").applyInPandas(run, "a long, b long"), "links")
    roots = components(links)
    named = (
        nodes.select("node", "other", "doc_id")
        .join(roots, "node", "left")
        .select("node", "other", "doc_id", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNull(), F.col("other")).alias("alone"))
    )
    least_id = stored(named.groupBy("root", "alone").agg(F.min("doc_id").alias("component_id")), "component-ids")
    by_node = stored(
        named.select("node", "other", "root", "alone")
        .join(least_id.select(F.col("root").alias("r"), F.col("alone").alias("x"), "component_id"), (F.col("root") == F.col("r")) & F.col("alone").eqNullSafe(F.col("x")))
        .select(F.col("node").alias("a"), F.col("other").alias("b"), "component_id"),
        "node-components",
    )
    dropped(sets, blocks, links, roots, least_id, nodes)
    swept(spark)
    return rows.join(by_node, (F.col("node") == F.col("a")) & (F.col("other") == F.col("b")), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
