"""Merkle manifest of a data set: a hash tree per source, proofs and their check by a recursive query.

A row's leaf is the hash of its fields. In each source the leaves, in the order of their
ids, are hashed in runs of ``fan`` until one node remains; the sources' nodes form a tree
in the same way, whose last node is the root. Every built level is stored as rows that
name their parent. The check is a recursive query over these rows: it ascends from node
to parent, appends the siblings it passes and folds the claimed hash of each leaf with
them. The leaves of a run pass the same nodes, so they ascend together in one row, which
holds the siblings above the run once and one folded hash for each leaf; leaves whose
hashes fold to the same in the first step, as all unchanged ones do, share theirs.

A null field counts as ``-``, which no value can equal. Leaves with equal ids are ordered
by their hash, null ids come last, a null source is a source and comes first; repeated
rows are leaves of their own. Texts of any length, empty ones too, are hashed whole. An
empty table has no root and gives an empty result. Further columns of the rows play no
part, whatever their names are.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import placed, stored

FAN = 16
#: Characters of a digest as text.
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

CLIMB = f"""
WITH RECURSIVE climb (run, up, pos, folded, above, subroot) AS (
  SELECT run, up, pos, folded, '', subroot FROM {{start}}
  UNION ALL
  SELECT /*+ MERGE(n) */ c.run, n.up, n.pos,
         transform(c.folded, h -> sha2(concat(left(n.children, {DIGEST} * c.pos), h, substr(n.children, {DIGEST} * c.pos + {DIGEST + 1})), 256)),
         concat(c.above, left(n.children, {DIGEST} * c.pos), substr(n.children, {DIGEST} * c.pos + {DIGEST + 1})),
         coalesce(c.subroot, n.subroot)
  FROM climb c JOIN {{nodes}} n ON c.up = n.node)
SELECT run, folded, above, subroot FROM climb WHERE up IS NULL
"""


@dataclass
class Manifest:
    """The stored rows of a tree.

    ``runs`` has a row for each run of leaves: ``run``, its ``leaves`` (struct of doc_id,
    leaf and claimed hash), ``children`` (their hashes as one text), ``alone`` (a source of
    one leaf, which is not hashed again), ``subroot`` where the run is its source's node, and
    its parent's name ``up`` with the place ``pos`` there. ``nodes`` has the nodes above:
    ``node, children, up, pos, subroot``. ``root`` is None for an empty table.
    """

    runs: DataFrame
    nodes: DataFrame
    root: str | None


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes, so that fields in a row cannot be parted in two ways."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _name(level: int, idx: Column, source: Column) -> Column:
    """A node's name; a null source and an empty one differ."""
    return F.concat(F.lit(f"s{level}/"), idx.cast("string"), F.coalesce(F.concat(F.lit("/"), source), F.lit("")))


def _top(level: int, idx: Column) -> Column:
    return F.concat(F.lit(f"t{level}/"), idx.cast("string"))


def _parents(rows: DataFrame, fan: int) -> DataFrame:
    """``source, idx, n, children`` of the runs of rows ``source, idx, n, hash``; ``n`` counts a level's nodes."""
    each = F.sort_array(F.collect_list(F.struct("idx", "hash")))
    return (
        rows.groupBy("source", F.floor(F.col("idx") / fan).alias("run"), F.ceil(F.col("n") / fan).alias("wide"))
        .agg(F.array_join(F.transform(each, lambda x: x["hash"]), "").alias("children"))
        .select("source", F.col("run").alias("idx"), F.col("wide").alias("n"), "children")
    )


def _levels(rows: DataFrame, widest: int, fan: int, label: str) -> list[DataFrame]:
    """The stored levels above rows ``source, idx, n, hash`` until every tree has one node."""
    found = []
    while widest > 1:
        widest = -(-widest // fan)
        above = _parents(rows.where("n > 1"), fan)
        rows = stored(above.withColumn("hash", F.sha2("children", 256)), f"{label}-{len(found) + 1}")
        found.append(rows)
    return found


def _linked(rows: DataFrame, level: int, fan: int, top: bool = False) -> DataFrame:
    """Rows below the last node of their tree with their parent's name and their place there."""
    above = F.floor(F.col("idx") / fan)
    up = _top(level + 1, above) if top else _name(level + 1, above, F.col("source"))
    return rows.select("*", up.alias("up"), F.pmod("idx", F.lit(fan)).cast("int").alias("pos"))


def build(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", fields: tuple[str, ...] = FIELDS,
    claims: dict[str, Column] | None = None, fan: int = FAN,
) -> Manifest:
    """The manifest of the rows, with the leaf that somebody claims for each.

    ``claims`` maps a field to the value it has in the copy that is checked; without it
    the copy equals the rows. A source of any size is dealt to many tasks by ranges.
    """
    held = [F.col(f"`{name}`") for name in fields]
    claimed = [(claims or {}).get(name, F.col(f"`{name}`")) for name in fields]
    hashed = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
        leaf_hash(held).alias("hash"), leaf_hash(claimed).alias("claim"),
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("hash")]
    leaves = placed(stored(hashed, "leaves"), ["source"], order, "leaves-in-order")
    each = F.sort_array(F.collect_list(F.struct("place", "doc_id", "hash", "claim")))
    grouped = leaves.groupBy("source", F.floor(F.col("place") / fan).alias("idx"), "total").agg(each.alias("leaves"))
    children = F.array_join(F.transform("leaves", lambda x: x["hash"]), "")
    runs = stored(
        grouped.select(
            "source", "idx", F.ceil(F.col("total") / fan).alias("n"), (F.col("total") == 1).alias("alone"), "leaves",
            children.alias("children"), F.when(F.col("total") == 1, children).otherwise(F.sha2(children, 256)).alias("hash"),
        ),
        "runs",
    )
    widest = runs.agg(F.max("n")).first()[0] or 0
    levels = _levels(runs.select("source", "idx", "n", "hash"), int(widest), fan, "level")
    # Each source's last node goes into the tree of the sources.
    lasts = runs.where("n = 1").select("source", "hash")
    for rows in levels:
        lasts = lasts.unionByName(rows.where("n = 1").select("source", "hash"))
    ranks = stored(
        placed(lasts, [], [F.col("source").asc_nulls_first()], "sources")
        .select(F.col("source").alias("s"), F.lit(None).cast("string").alias("source"), F.col("place").alias("idx"), F.col("total").alias("n"), "hash"),
        "ranks",
    )
    sources = int(ranks.agg(F.max("n")).first()[0] or 0)
    tops = _levels(ranks.select("source", "idx", "n", "hash"), sources, fan, "top")
    links = (_linked(ranks, 0, fan, True) if sources > 1 else ranks.withColumns({"up": F.lit(None).cast("string"), "pos": F.lit(0)})).select("s", "up", "pos")

    def joined(rows: DataFrame, level: int) -> DataFrame:
        """Rows of a level of the sources' trees with the name and place of their parents."""
        inner = _linked(rows.where("n > 1"), level, fan).withColumn("subroot", F.lit(None).cast("string"))
        last = rows.where("n = 1").join(links, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("subroot", F.col("hash"))
        return inner.unionByName(last).withColumn("node", _name(level, F.col("idx"), F.col("source")))

    kept = ["node", "children", "up", "pos", "subroot"]
    first = stored(joined(runs, 1).withColumnRenamed("node", "run").select("run", "alone", "leaves", "children", "up", "pos", "subroot"), "linked-runs")
    nodes = [joined(rows, k).select(kept) for k, rows in enumerate(levels, 2)]
    for k, rows in enumerate(tops, 1):
        linked = _linked(rows, k, fan, True).withColumn("up", F.when(F.col("n") > 1, F.col("up")))
        nodes.append(linked.select(_top(k, F.col("idx")).alias("node"), "children", "up", "pos", F.lit(None).cast("string").alias("subroot")))
    spark = docs.sparkSession
    whole = spark.createDataFrame([], "node string, children string, up string, pos int, subroot string")
    for rows in nodes:
        whole = whole.unionByName(rows)
    last = (tops[-1] if tops else ranks).select("hash").first()
    return Manifest(first, stored(whole, "nodes"), last[0] if last else None)


def siblings(children: Column, pos: Column) -> Column:
    """The digests of a run without the one at ``pos``."""
    return F.concat(F.left(children, DIGEST * pos), F.substr(children, DIGEST * pos + DIGEST + 1))


def check(manifest: Manifest) -> DataFrame:
    """Per leaf: ``doc_id, leaf, subroot, root, proof, folded_root, verified``.

    ``proof`` holds the digests of all siblings from leaf to root as one text, and
    ``folded_root`` is the root that the claimed leaf leads to with them.
    """
    spark = manifest.runs.sparkSession

    def folded(x: Column, i: Column) -> Column:
        own = DIGEST * i
        return F.when(F.col("alone"), x["claim"]).otherwise(
            F.sha2(F.concat(F.left("children", own), x["claim"], F.substr("children", own + DIGEST + 1)), 256)
        )

    runs = manifest.runs.select("*", F.transform("leaves", folded).alias("first"))
    start = runs.select("run", "up", "pos", F.array_distinct("first").alias("folded"), "subroot")
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # the number of rows is that of runs and levels
    try:
        climbed = stored(spark.sql(CLIMB, start=start, nodes=manifest.nodes), "climbed")
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)
    root = F.lit(manifest.root).cast("string")
    # Nodes and runs grow with the leaves: they are joined by sorting at every size.
    return (
        runs.select("run", "leaves", "children", "first", F.array_distinct("first").alias("kinds"))
        .join(climbed.hint("merge"), "run")
        .select("children", "first", "kinds", "folded", "above", "subroot", F.posexplode("leaves").alias("i", "x"))
        .withColumn("folded_root", F.get("folded", (F.array_position("kinds", F.get("first", "i")) - 1).cast("int")))
        .select(
            F.col("x.doc_id").alias("doc_id"), F.col("x.hash").alias("leaf"), "subroot", root.alias("root"),
            F.concat(siblings(F.col("children"), F.col("i")), "above").alias("proof"),
            "folded_root", (F.col("folded_root") == root).alias("verified"),
        )
    )
