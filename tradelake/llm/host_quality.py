"""Quality rules with host verdicts.

Each document is measured and judged by two base rules. The failures are then
counted by host, each host's rate is shrunk by a beta prior fitted to all hosts,
and a host whose shrunk rate is above ``most_failed`` loses its documents.

Null text has no words, an empty text likewise; both fail the base rules. A null
host is a host of its own. Repeated rows count as often as they occur. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import apart, by_batch, kept_schema, stored, texts_of

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows that occur twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    k = len(numbers)
    if k < 2_000_000 and k**5 < 2**63:
        code = ids[:n]
        for step in range(1, WINDOW):
            code = code * k + ids[step : step + n]
    else:  # exact too: renumber after each word, so that products stay small
        code = ids[:n]
        for step in range(1, WINDOW):
            code = np.unique(code * k + ids[step : step + n], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(words), bool)
    for step in range(WINDOW):
        inside[step : step + n] |= twice
    return int(inside.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def measures(text: str) -> tuple[int, int, int, int, int]:
    """The five counts of one text, in the order of ``MEASURES``."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at exactly the six characters
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        repeated_lines(text),
        repeated_words(words),
    )


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of each row with its counts and ``base_failed``.

    A kept column with the name of one of these gets ``_in`` behind it.
    """
    names = [part.split()[0] for part in MEASURES.split(", ")]
    rows, named = apart(docs, keep, [*names, "base_failed"], text=text)

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        found = list(zip(*map(measures, texts_of(batch))))
        return {name: batch.column(name) for name in batch.schema.names} | dict(zip(names, found))

    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return named(by_batch(rows, run, kept_schema(rows, MEASURES)).withColumn("base_failed", failed))


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """Per host: rows, failures and the rate shrunk by the empirical beta prior.

    The prior has the overall rate as its mean; its weight comes from the spread
    of the hosts' rates beyond what chance gives (method of moments, hosts
    weighted by their rows). Without such spread the prior outweighs every host.
    """
    hosts = stored(
        measured.groupBy(F.col(host).alias("host")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")
        ),
        "hosts",
    )
    total = hosts.agg(
        F.sum("n").alias("n"), F.sum("failed").alias("f"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("square"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    ).first()
    mean, strength = 0.5, 1.0
    if total.n:
        mean = min(max(total.f / total.n, 1e-6), 1 - 1e-6)
        spread = total.square - total.n * mean * mean - (total.k - 1) * mean * (1 - mean)
        scale = total.n - total.nn / total.n
        between = spread / (scale - (total.k - 1)) if scale > total.k - 1 else 0.0
        strength = min(max(mean * (1 - mean) / between - 1, 1e-3), 1e9) if between > 0 else 1e9
    rate = (F.lit(mean * strength) + F.col("failed")) / (F.lit(strength) + F.col("n"))
    return hosts.withColumn("host_rate", rate)


def judge(
    docs: DataFrame, keep: list[str], host: str = "source", text: str = "text", most_failed: float = 0.5
) -> DataFrame:
    """``keep`` columns and the host of each row with counts, ``base_failed``, ``host_rate`` and ``kept``.

    ``kept`` is false for a document that fails the base rules and for every
    document of a host whose shrunk failure rate is above ``most_failed``. A kept column
    with the name of a result gets ``_in`` behind it.
    """
    names = [part.split()[0] for part in MEASURES.split(", ")]
    rows, named = apart(docs, list(dict.fromkeys([*keep, host])), [*names, "base_failed", "host_rate", "kept"], site=host, text=text)
    kept = [name for name in rows.columns if name != "text"]
    measured = stored(measure(rows, kept), "measured")
    rates = host_rates(measured, "site").select("host", "host_rate")
    joined = measured.join(stored(rates, "host-rates"), F.col("site").eqNullSafe(F.col("host")), "left")
    return named(joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= most_failed)))
