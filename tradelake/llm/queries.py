"""The registered queries of this subpackage and the SQL they have to agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import crc_sql, extraction, host_quality, jaccard, licenses, merkle, mixing, packing, pieces, resampling, token_files, topk, toxicity, warc
from tradelake.llm.common import session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(session(spark), sf_dir)

        QUERIES[function.__name__] = run
        if sql:
            ORACLES[function.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extraction.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


@query()
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, as read back from token files."""
    files = token_files.write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return token_files.read_token_files(files)


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return toxicity.score(docs, model, ["doc_id"]).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('mix|' || doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM docs GROUP BY source),
levels AS (SELECT *, source_size * 2.0::DOUBLE AS lim, (source_size * 2.0::DOUBLE) / weight AS level FROM sums),
shares AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(lim) OVER (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY level, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shared
  FROM levels),
targets AS (
  SELECT source, source_size,
         least(lim, coalesce(max(CASE WHEN shared <= level THEN shared END) OVER (), level) * weight) AS target
  FROM shares),
parts AS (
  SELECT *, floor(target / source_size)::BIGINT AS whole, target / source_size - floor(target / source_size) AS chance,
         target - floor(target / source_size) * source_size AS rest
  FROM targets WHERE source_size > 0),
ranked AS (
  SELECT d.source, d.size, p.rest, (d.u / (1 - d.u)) / (p.chance / (1 - p.chance)) AS rank
  FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source WHERE d.size > 0 AND p.chance > 0),
peers AS (SELECT source, rest, rank, sum(size) AS size FROM ranked GROUP BY source, rest, rank),
run AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank) AS words FROM peers),
cuts AS (SELECT source, max(rank) AS cut FROM run WHERE words - rest <= rest - (words - size) GROUP BY source)
SELECT d.doc_id, d.size, t.source_size, t.target,
       (CASE WHEN d.size = 0 THEN 0 ELSE d.size * (p.whole + CASE WHEN p.chance > 0
          AND (d.u / (1 - d.u)) / (p.chance / (1 - p.chance)) <= c.cut THEN 1 ELSE 0 END) END)::BIGINT AS taken
FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
LEFT JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""


@query(MIX_SQL)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of all sources takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.templates(spark))


@query()
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


HOST_SQL = r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         row_number() OVER () AS r
  FROM documents),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
places AS (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5),
win AS (SELECT r, i, w[i:i+4] AS g FROM places),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY r),
base AS (
  SELECT r, doc_id, source, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN lines USING (r) LEFT JOIN rep USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
hosts AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS failed FROM judged GROUP BY source),
total AS (
  SELECT sum(n) AS n, least(greatest(sum(failed) / sum(n), 1e-6), 1 - 1e-6) AS m, count(*) AS k,
         sum(failed * failed / n) AS square, sum(n * n) AS nn FROM hosts),
spread AS (
  SELECT m, CASE WHEN n - nn / n > k - 1 THEN (square - n * m * m - (k - 1) * m * (1 - m)) / (n - nn / n - (k - 1)) ELSE 0 END AS b
  FROM total),
prior AS (SELECT m, CASE WHEN b > 0 THEN least(greatest(m * (1 - m) / b - 1, 1e-3), 1e9) ELSE 1e9 END AS s FROM spread),
rates AS (SELECT source, (m * s + failed) / (s + n) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_rate <= 0.5 AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""


@query(HOST_SQL)
def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and host verdict of every document."""
    judged = host_quality.judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), ["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


WARC_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
d AS (SELECT *, sha1(payload) AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS last_id FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r
"""


@query(WARC_SQL)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, as read back from the archives."""
    archives = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.read_warc(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query(TOPK_SQL)
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best candidates of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])) END AS s FROM w),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
least_id AS (SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(least_id, doc_id) AS component_id FROM sets LEFT JOIN least_id USING (doc_id)
"""


@query(JACCARD_SQL)
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under a Jaccard similarity of 0.9 or more."""
    return jaccard.components_of(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _resample_sql() -> str:
    """Windows as joined words, their buckets by the checksum of each distinct one."""
    words = f"regexp_extract_all({crc_sql.lower_ascii('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH {crc_sql.TABLE},
texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id, {words} AS w FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
  UNION ALL
  SELECT 't', row_number() OVER (), NULL, {words} FROM (SELECT coalesce(text, '') AS text FROM benchmark)),
spots AS (SELECT kind, r, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
spans AS (SELECT kind, r, array_to_string(w[i:i + n - 1], ' ') AS f FROM spots, range(1, 4) t(n) WHERE i + n - 1 <= len(w)),
named AS (SELECT f, {crc_sql.crc32('f')} % 10000 AS bucket FROM (SELECT DISTINCT f FROM spans), crc_table),
found AS (SELECT kind, r, bucket FROM spans JOIN named USING (f)),
sums AS (
  SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 't') AS t,
         sum(count(*) FILTER (kind = 'd')) OVER () AS all_s, sum(count(*) FILTER (kind = 't')) OVER () AS all_t
  FROM found GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain FROM sums),
weights AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM found JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (r) WHERE kind = 'd'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score::BIGINT AS score, CASE WHEN n_words >= 20 AND place <= (5 * n) // 100 THEN place END::BIGINT AS rank
FROM ranked
"""


@query(_resample_sql())
def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance for the benchmark texts, and its place in the draw."""
    docs, targets = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resampling.resample(docs, targets).select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of every document's ids and of the text that they decode to."""
    decoded = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), ["doc_id"]), ["doc_id", "ids"])
    return decoded.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _merkle_sql(levels: int = 6, tops: int = 4) -> str:
    """The tree and all proofs by one step of SQL a level; trees of ``16 ** levels`` leaves and ``16 ** tops`` sources."""

    def h(fields: list[str]) -> str:
        parts = (f"coalesce(octet_length(encode({f}::VARCHAR)) || ':' || {f}::VARCHAR, '-')" for f in fields)
        return f"sha256({' || '.join(parts)})"

    lowered = f"CASE WHEN {crc_sql.crc32('doc_id::VARCHAR')} % 5 = 0 THEN {crc_sql.lower_ascii('text')} ELSE text END"
    steps = [
        crc_sql.TABLE,
        f"""docs AS (SELECT doc_id, source, lang, n_chars, text, {lowered} AS copy FROM documents, crc_table),
leaves AS (SELECT doc_id, source, {h(['doc_id', 'source', 'lang', 'n_chars', 'text'])} AS hash,
  {h(['doc_id', 'source', 'lang', 'n_chars', 'copy'])} AS claim FROM docs),
n0 AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, hash) - 1 AS idx,
  count(*) OVER (PARTITION BY source) AS n, hash FROM leaves),
c0 AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, hash) - 1 AS idx,
  hash AS leaf, claim AS folded, '' AS proof FROM leaves)""",
    ]

    def climb(k: int, after: str, same: str) -> str:
        """Level ``k`` of a tree and the climb to it."""
        return f"""{after}{k} AS (
  SELECT source, idx // 16 AS idx, (n + 15) // 16 AS n, list(hash ORDER BY idx) AS below,
         CASE WHEN n > 1 THEN sha256(string_agg(hash, '' ORDER BY idx)) ELSE any_value(hash) END AS hash
  FROM {after}{k - 1} GROUP BY source, idx // 16, n),
{same}{k} AS (
  SELECT c.* EXCLUDE (idx, folded, proof), c.idx // 16 AS idx,
         CASE WHEN len(p.below) + p.n > 2 THEN sha256(array_to_string(p.below[:c.idx % 16] || [c.folded] || p.below[c.idx % 16 + 2:], '')) ELSE c.folded END AS folded,
         c.proof || array_to_string(p.below[:c.idx % 16] || p.below[c.idx % 16 + 2:], '') AS proof
  FROM {same}{k - 1} c JOIN {after}{k} p ON c.source IS NOT DISTINCT FROM p.source AND c.idx // 16 = p.idx)"""

    steps += [climb(k, "n", "c") for k in range(1, levels + 1)]
    steps.append(f"""ranks AS (
  SELECT source AS name, NULL::VARCHAR AS source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n, hash FROM n{levels}),
t0 AS (SELECT source, idx, n, hash FROM ranks),
d0 AS (SELECT c.doc_id, c.leaf, r.hash AS subroot, NULL::VARCHAR AS source, r.idx, c.folded, c.proof FROM c{levels} c JOIN ranks r ON c.source IS NOT DISTINCT FROM r.name)""")
    steps += [climb(k, "t", "d") for k in range(1, tops + 1)]
    return f"""WITH {', '.join(steps)}
SELECT doc_id, leaf, subroot, t.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.hash AS verified
FROM d{tops}, t{tops} t"""


@query(_merkle_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, and whether a partly lower-cased copy still leads to its root."""
    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    copy = {"text": F.when(chosen, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))}
    found = merkle.check(merkle.build(docs, claims=copy))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")
