"""The whole pipeline, stage by stage, against plain recomputation from what the stage before kept."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tradelake.llm import toxicity
from tradelake.llm.common import session

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score string"
SPACES = " \t\n\v\f\r"


def corpus(seed=2):
    """Clean and toxic texts, near copies, copies, repeated lines, nulls, empty and very long texts."""
    draw = random.Random(seed)
    words = [f"word{k}" for k in range(400)]
    bad = ["filthscum", "vilecur", "rotfiend"]
    rows, labels = [], []
    for k in range(360):
        text = " ".join(draw.choices(words, k=draw.randint(15, 120)))
        toxic = k % 6 == 0
        if toxic:
            text += " " + " ".join(draw.choices(bad, k=12))
        rows.append([k, text, "en", draw.choice(["a", "a", "b", "c", None]), len(text)])
        labels.append((k, int(toxic)))
    for k in range(360, 390):  # near copies of a clean text: few words differ
        base = rows[301][1].split() * 3
        base[draw.randrange(len(base))] = f"edit{k}"
        rows.append([k, " ".join(base), "en", "a", 1])
    rows += [[390, rows[1][1], "en", "b", 1], [391, rows[1][1], "de", None, 1], [391, rows[1][1], "de", None, 1]]
    rows += [[392, None, "en", "a", None], [393, "", None, "b", 0], [394, "same line here again now\n" * 30, "en", "a", 1], [None, rows[2][1], "en", "a", 1], [395, "One two", "en", "c", 7]]
    rows.append([396, " ".join(draw.choices(words, k=30_000)), "en", "b", 1])
    return [(*row, 9, "in") for row in rows], labels


def grams(text):
    """The features of a text, one n-gram after another."""
    data = b" " + text.lower().encode().replace(b"\n", b" ") + b" "
    out = set()
    for size in toxicity.SIZES:
        for at in range(len(data) - size + 1):
            h = data[at]
            for byte in data[at + 1 : at + size]:
                h = (h * 0x100000001B3 + byte + 1) % 2**64
            out.add(((h ^ (h >> 29)) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - toxicity.TABLE_BITS))
    return out


def brute_score(model, text):
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    return 1 / (1 + math.exp(-sum(weight.get(g, 0.0) for g in grams(text)) - model.intercept))


def words_of(text):
    return [w for w in (text or "").translate({ord(c): " " for c in SPACES}).split(" ") if w]


def passes(text):
    found = words_of(text)
    windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    covered = {j for i in range(len(found) - 4) if windows[tuple(found[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(found) >= 10 and 100 * len(covered) <= 20 * len(found)


def near_groups(rows):
    """Smallest id of each row's group of texts that share 80 per cent of their shingles of five words."""
    sets = []
    for row in rows:
        found = [w.translate({k: k + 32 for k in range(65, 91)}) for w in words_of(row[1])]
        sets.append({tuple(found[i : i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} if found else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[root(i)] = min(least.get(root(i), row[0]), row[0])
    return [least.get(root(i)) for i in range(len(rows))]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    session(spark)
    rows, labels = corpus()
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [list(map(tuple, docs.collect()))]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        kept = stage(spark, docs, folder)
        kept.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k < 4:
            assert docs.columns == [part.split()[0] for part in SCHEMA.split(", ")], name
        out.append(docs.collect() if k == 4 else list(map(tuple, docs.collect())))
    return out, labels


def same(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


def test_toxic_documents_go(stages):
    (before, after, *_), labels = stages
    texts = {row[0]: row[1] for row in before if row[0] is not None and row[0] < 360}
    known = sorted((k, t) for k, t in labels if zlib.crc32(str(k).encode()) % 3 != 1)
    y = np.array([t for _, t in known])
    found = [np.array(sorted(grams(texts[k])), "<u4") for k, _ in known]
    model = toxicity.fit(y, np.ones(len(y)), found)
    # What is learnt from, recounted: features of five documents or more, by their evidence.
    counts = [Counter(g for f, t in zip(found, y) if t == label for g in f.tolist()) for label in (0, 1)]
    totals = [int((y == label).sum()) for label in (0, 1)]
    ratio = {g: math.log((counts[1][g] + 1) / (totals[1] + 2)) - math.log((counts[0][g] + 1) / (totals[0] + 2)) for g in counts[0] | counts[1]}
    evidence = {g: abs(ratio[g]) * math.sqrt(counts[0][g] + counts[1][g]) for g in ratio if counts[0][g] + counts[1][g] >= toxicity.LEAST_DOCUMENTS}
    cut = sorted(evidence.values(), reverse=True)[: toxicity.FEATURES][-1]
    assert {g for g in evidence if evidence[g] > cut + 1e-9} <= set(model.features.tolist()) <= {g for g in evidence if evidence[g] >= cut - 1e-9}
    scores = {row: brute_score(model, row[1] or "") for row in before}
    assert same(after, [row for row in before if scores[row] < toxicity.THRESHOLD])
    gone = {row[0] for row in before} - {row[0] for row in after}
    assert gone == {k for k, t in labels if t}


def test_scores_are_those_of_the_features_one_by_one():
    draw = random.Random(3)
    texts = ["", "aé\nB", *("".join(draw.choices("abcé \nXY", k=draw.randint(0, 80))) for _ in range(60))]
    model = toxicity.Model(np.arange(0, 1 << toxicity.TABLE_BITS, 7), np.random.default_rng(1).normal(size=-(-(1 << toxicity.TABLE_BITS) // 7)), -0.3)
    assert np.allclose(model.scores(texts), [brute_score(model, t) for t in texts])


def test_low_quality_goes(stages):
    (_, before, after, *_), _ = stages
    assert same(after, [row for row in before if passes(row[1])])
    assert len(after) < len(before)


def test_one_of_each_near_group_stays(stages):
    (_, _, before, after, *_), _ = stages
    groups = near_groups(before)
    first = {}
    for row, least in zip(before, groups):
        if row[0] is None or row[0] == least:
            first.setdefault((row[0], row[1]), row[:2])
    assert same([row[:2] for row in after], first.values())
    assert len(after) < len(before)


def test_mix_takes_whole_documents_near_the_targets(stages):
    (_, _, _, before, after, _), _ = stages
    size = {row[:2]: len(words_of(row[1])) for row in before}
    taken = Counter(row[:2] for row in after)
    assert set(taken) <= set(size) and max(taken.values()) <= 2
    sources = sorted({row[3] for row in before}, key=lambda s: (s is None, s or ""))
    sums = {s: sum(size[row[:2]] for row in before if row[3] == s) for s in sources}
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    share, open_, target = 1.5 * sum(sums.values()), set(sources), {}
    while open_:
        each = share / sum(weights[s] for s in open_)
        full = {s for s in open_ if each * weights[s] >= 2 * sums[s]}
        for s in full or open_:
            target[s] = 2 * sums[s] if full else each * weights[s]
        share -= sum(target[s] for s in full)
        open_ -= full or open_
    got = Counter()
    for row in after:
        got[row[3]] += size[row[:2]]
    for s in sources:
        longest = max(size[row[:2]] for row in before if row[3] == s)
        assert abs(got[s] - target[s]) <= longest


def test_sequences_hold_every_token_once(stages):
    (_, _, _, _, before, pieces), _ = stages
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter((row[0], len(tokenizer.encode(row[1] or "", add_special_tokens=False).ids) + 1) for row in before)
    total = Counter()
    for p in pieces:
        total[p.doc_id] += p.length
        assert 0 <= p.start and p.start + p.length <= p.doc_tokens and (p.doc_id, p.doc_tokens) in wanted
    assert total == Counter({one: sum(n * c for (k, n), c in wanted.items() if k == one) for one, _ in wanted})
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 4096
