"""From raw documents to packed sequences: toxicity, quality rules, near duplicates, mixing, packing.

Each stage takes what its predecessor kept. A stage's columns are renamed while an
operator works on them, so that further columns of the documents pass through whatever
their names are. Rows with a null id pass the stages like others; they are never learnt
from and never dropped as near duplicates. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import host_quality, jaccard, mixing, packing, toxicity
from tradelake.llm.common import parted, session, stored, swept

#: SQL can't express the trained classifier, so there is none for the whole.
ORACLE_SQL = None

#: Words of a shingle and least similarity, per cent, of the near-duplicate stage; op10's query has its own.
SHINGLE, LEAST = 5, 80

#: Chunks whose ids a worker remembers while it packs: fewer than alone, as it holds the earlier stages' memory.
REMEMBERED = 300_000


def _neutral(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with numbered columns, and each column's number by name.

    The stage before has ended, and its shuffle files may go.
    """
    swept(docs.sparkSession)
    names = {name: f"c{k}" for k, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _restored(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*(F.col(c).alias(name) for name, c in names.items()))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    session(spark)
    rows, at = _neutral(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(rows, labels, at["doc_id"], at["text"])
    scored = toxicity.score(rows, model, rows.columns, at["text"])
    return _restored(scored.where(F.col("score") < toxicity.THRESHOLD), at)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and come from a host that passes."""
    session(spark)
    rows, at = _neutral(docs)
    judged = host_quality.judge(rows, rows.columns, at["source"], at["text"])
    return _restored(judged.where("kept"), at)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the smallest id.

    Rows that repeat an id stay if their texts differ.
    """
    session(spark)
    rows, at = _neutral(docs)
    doc_id, text = at["doc_id"], at["text"]
    found = stored(jaccard.components_of(rows, doc_id, text, LEAST, shingle=SHINGLE), "classes")
    gone = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    again = stored(found.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select(F.col("doc_id").alias("again")), "again")
    # Only rows that may be in one of these lists are joined with them.
    clear, asked = parted(rows, doc_id, gone.select("gone").union(again))
    asked = stored(asked, "asked")
    kept = asked.join(gone, F.col(doc_id) == F.col("gone"), "left_anti")
    once = kept.join(again, F.col(doc_id) == F.col("again"), "left_anti")
    repeated = kept.join(again, F.col(doc_id) == F.col("again"), "left_semi").dropDuplicates([doc_id, text])
    return _restored(clear.unionByName(once).unionByName(repeated), at)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated as often as it takes them."""
    session(spark)
    rows, at = _neutral(docs)
    taken = mixing.mix(rows, rows.columns, at["doc_id"], at["source"], at["text"]).where("copies > 0")
    return _restored(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), at)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the documents fill."""
    session(spark)
    swept(spark)
    return packing.pack(docs, remembered=REMEMBERED)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written before the next reads them."""
    session(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
