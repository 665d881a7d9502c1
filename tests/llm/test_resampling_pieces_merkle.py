"""Resampling, sentencepiece ids and the manifest against brute force; clashing names of all operators."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tradelake.llm import extraction, host_quality, merkle, mixing, pieces, resampling, toxicity
from tradelake.llm.common import placed, session
from tradelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, place int, k0 string"


def rows_of(count, seed=1):
    """Nulls in every column, empty and odd texts, repeats, and one source with a third of the rows."""
    draw = random.Random(seed)
    words = ["the", "Of", "Straße", "éÀ", "日本語", "a\tb", "x" * 90, "don't", "3.5", "İ", "end.\n", "🙂", "\x00", "▁"]
    rows = [(None, None, None, None, None), (None, "s", "en", 3, "Abc"), (7, "", "en", 0, ""), (7, "", "en", 0, ""), (7, None, "en", 0, " \n ")]
    for k in range(count):
        source = "hot" if k % 3 == 0 else f"s{draw.randrange(20)}"
        rows.append((k, source, draw.choice(["en", None]), draw.choice([k, None]), " ".join(draw.choices(words, k=draw.randrange(40))) if k % 11 else None))
    return [(*row, 5, "clash") for row in rows]


@pytest.fixture(scope="module")
def rows():
    return rows_of(500)


@pytest.fixture(scope="module")
def docs(spark, rows):
    session(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


# --- places ----------------------------------------------------------------


def test_places_in_groups(spark):
    frame = spark.range(3000).select((F.col("id") % 7).alias("x"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), F.col("id") % 2)).alias("g"))
    found = placed(frame, ["g"], [F.col("x").desc()], "places").collect()
    for group in (None, "g0", "g1"):
        own = sorted((r.place, -r.x) for r in found if r.g == group)
        assert [p for p, _ in own] == list(range(1000)) and [x for _, x in own] == sorted(x for _, x in own)
    assert {r.total for r in found} == {1000}
    assert placed(frame.limit(0), [], [F.col("x")], "none").count() == 0


# --- resampling ------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))


def buckets(text):
    found = words(text)
    return [crc32(" ".join(found[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(found) - n + 1)]


def brute_resample(rows, targets, percent):
    raw, target = Counter(), Counter()
    for _, text in rows:
        raw.update(buckets(text))
    for text in targets:
        target.update(buckets(text))
    s, t = sum(raw.values()) + 10_000, sum(target.values()) + 10_000
    out = []
    for one, text in rows:
        found = buckets(text)
        weight = sum(math.floor(1000 * math.log((target[b] + 1) * s / ((raw[b] + 1) * t))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if one is None else one}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([one, len(words(text)), len(found), weight, score, None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = place
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_resample(spark, docs, rows, percent):
    targets = ["the of Straße the of", None, "", "日本語 end 3 5"]
    table = spark.createDataFrame([(t, 1) for t in targets], "text string, weight int")
    found = resampling.resample(docs, table, percent=percent).collect()
    assert sorted(map(tuple, found), key=repr) == brute_resample([(r[0], r[4]) for r in rows], targets, percent)


def test_resample_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(docs.limit(0), none).count() == 0
    alone = resampling.resample(docs, none).collect()
    assert len(alone) == docs.count() and all(r.n_features == 0 or r.weight != 0 for r in alone)


def test_windows_of_long_texts_and_full_caches(monkeypatch):
    monkeypatch.setattr(resampling, "PART", 300)
    monkeypatch.setattr(resampling, "CACHE", 20)
    draw = random.Random(4)
    texts = ["".join(draw.choices("abXÉ é\n-日", k=draw.choice([0, 5, 299, 300, 301, 2000]))) for _ in range(200)]
    texts += ["z" * 1000, "q" * 63 + " " + "q" * 64 + " " + "q" * 500 + " a", " " * 700, "a" * 400 + " b"]
    counter, found = resampling.Words(), []
    for count, parts in counter.buckets(texts):
        at = 0
        for n in count.tolist():
            found.append(sorted(int(b) for part in parts for b in part[at : at + n] if b >= 0))
            at += n
    # A long text comes behind the ones that waited, in order.
    assert found == [sorted(buckets(t)) for t in texts]


# --- sentencepiece ---------------------------------------------------------

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def ids_of(library, text):
    return np.array(library.encode(text, add_bos=True, add_eos=True), "<u4").tobytes()


@pytest.mark.parametrize("long", [4, 4096])
def test_pieces_equal_the_library(library, long):
    draw = random.Random(3)
    letters = "abcdefghinorstuel  ..éü▁Àдаи日本\n\t\x00🙂İ"
    known = [library.id_to_piece(k) for k in range(259, 32_000)]
    texts = ["", " ", "  a  b ", "a" * 3000, "ab" * 999, "▁" * 50, "end\n\n", "ﬁ①"]
    texts += ["".join(draw.choices(letters, k=draw.randint(1, 150))) for _ in range(2000)]
    texts += ["".join(draw.choices(known, k=draw.randint(1, 12))) for _ in range(2000)]
    assert pieces.PieceEncoder(MODEL, limit=500, long=long).encode(texts) == [ids_of(library, t) for t in texts]


def test_pieces_of_long_texts(library, monkeypatch):
    monkeypatch.setattr(pieces, "PART", 1000)
    monkeypatch.setattr(pieces, "ROUND", 500)
    draw = random.Random(5)
    texts = ["".join(draw.choices("ab cd", k=5000)), "x" * 2500 + " y " + "".join(draw.choices("abcdefgh", k=6000)), "日本 " * 900]
    assert pieces.PieceEncoder(MODEL).encode(texts) == [ids_of(library, t) for t in texts]


def test_lookup_of_keys_in_one_slot():
    keys = np.array([draw * 3 for draw in range(5000)], np.int64)
    table = pieces.Lookup(keys, np.arange(5000, dtype=np.int32))
    asked = np.arange(-10, 15_010)
    assert table.get(asked).tolist() == [k // 3 if k % 3 == 0 and 0 <= k < 15_000 else -1 for k in asked.tolist()]
    assert pieces.Lookup(keys[:0], np.zeros(0, np.int32)).get(asked).max() == -1


def test_pieces_of_a_table(spark, docs, rows, library):
    encoded = pieces.encode(docs.withColumn("ids", F.lit("in")), ["doc_id", "ids", "text"])
    assert encoded.columns == ["doc_id", "ids_in", "text", "ids"]
    found = pieces.decode(encoded, ["doc_id", "ids", "text"]).collect()
    assert len(found) == len(rows)
    for r in found:
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and r.decoded == library.decode(ids)
    assert pieces.decode(pieces.encode(docs.limit(0), ["doc_id"]), ["doc_id"]).count() == 0


def test_pieces_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op12_pieces"](spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        want = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want


# --- manifest --------------------------------------------------------------


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_tree(leaves, fan):
    """Levels of a tree from its leaves to its last node."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + fan])) for i in range(0, len(last), fan)])
    return levels


def brute_proof(levels, place, fan, claimed):
    siblings = ""
    for level in levels[:-1]:
        run = level[place - place % fan : place - place % fan + fan]
        before, after = "".join(run[: place % fan]), "".join(run[place % fan + 1 :])
        siblings, claimed, place = siblings + before + after, digest(before + claimed + after), place // fan
    return siblings, claimed


def brute_manifest(rows, fan, change):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is None, row[0] or 0, leaf(row), leaf((*row[:4], change(row))), row[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {name: brute_tree([one[2] for one in sorted(groups[name], key=lambda g: g[:3])], fan) for name in names}
    top = brute_tree([trees[name][-1][0] for name in names], fan)
    out = []
    for k, name in enumerate(names):
        for place, (_, _, own, claimed, one) in enumerate(sorted(groups[name], key=lambda g: g[:3])):
            first, folded = brute_proof(trees[name], place, fan, claimed)
            rest, folded = brute_proof(top, k, fan, folded)
            out.append((one, own, trees[name][-1][0], top[-1][0], first + rest, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("count", "fan"), [(500, 16), (500, 2), (40, 3), (0, 16)])
def test_manifest(spark, count, fan):
    session(spark)
    rows = rows_of(count, 9)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    chosen = F.col("doc_id") % 5 == 0
    claims = {"text": F.when(chosen, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))}
    found = merkle.check(merkle.build(docs, claims=claims, fan=fan)).collect()

    def change(row):
        lower = row[0] is not None and row[0] % 5 == 0 and row[4] is not None
        return row[4].translate({k: k + 32 for k in range(65, 91)}) if lower else row[4]

    want = brute_manifest([row[:5] for row in rows], fan, change)
    assert sorted(map(tuple, found), key=repr) == want
    if count == 500:
        assert {r.verified for r in found} == {True, False}


def test_manifest_of_one_row_and_of_none(spark, docs):
    one = docs.where("doc_id = 3")
    found = merkle.check(merkle.build(one)).collect()
    assert [(r.leaf == r.subroot == r.root == r.folded_root, r.proof, r.verified) for r in found] == [(True, "", True)]
    empty = merkle.build(docs.limit(0))
    assert empty.root is None and merkle.check(empty).count() == 0
    long = docs.where("doc_id in (3, 4)").withColumn("text", F.repeat(F.lit("Ab "), 400_000))
    assert {r.verified for r in merkle.check(merkle.build(long)).collect()} == {True}
    assert spark_rows_limit(docs) == "1000000"


def spark_rows_limit(docs):
    return docs.sparkSession.conf.get("spark.sql.cteRecursionRowLimit")


# --- clashing names --------------------------------------------------------


def test_kept_columns_with_names_of_results(spark, docs):
    named = docs.where("doc_id < 60").withColumns({n: F.lit(n) for n in ("size", "copies", "n_words", "kept", "score", "n_chars")})
    keep = ["doc_id", "size", "copies", "n_words", "kept", "score", "n_chars", "text"]
    model = toxicity.Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    pages = named.withColumn("html", F.concat(F.lit("<p>"), "text"))
    for found, results in (
        (mixing.mix(named, keep), ["size", "source_size", "target", "copies", "taken"]),
        (host_quality.judge(named, keep), ["n_words", "kept", "host_rate"]),
        (toxicity.score(named, model, keep), ["score"]),
        (extraction.extract(pages, keep), ["text", "n_chars"]),
    ):
        assert len(set(found.columns)) == len(found.columns) and set(results) <= set(found.columns)
        for name in keep:
            kept = f"{name}_in" if name in results else name
            assert kept in found.columns
            if name not in ("doc_id", "text", *results):
                assert {r[0] for r in found.select(kept).collect()} == {name}
        assert found.count() == named.count()


def test_a_bad_host_takes_its_good_documents_along(spark):
    good, bad = " ".join(f"word{k}" for k in range(40)), "short text"
    rows = [(k, f"h{k % 10}", good if k % 10 or k % 100 == 0 else bad) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = host_quality.judge(docs, ["doc_id", "source"]).collect()
    assert {(r.source, r.base_failed, r.kept) for r in found} == {("h0", True, False), ("h0", False, False), *((f"h{k}", False, True) for k in range(1, 10))}
    lenient = host_quality.judge(docs, ["doc_id", "source"], most_failed=0.95).collect()
    assert all(r.kept is not r.base_failed for r in lenient)


# --- pages of known parts --------------------------------------------------

SENTENCE = "It was the time of the year when all of them had been in the house with the others for so long"
AROUND = """article-comments reader-comments user-comments comment-content related-articles newsletter-form cookie-policy sidebar-wrapper
footer-wrapper nav-container ad-container ad-slot ads-wrapper social-media sponsored-content siteFooter sidebarRight site-footer__text
comment-list sidebar footer breadcrumbs main-nav promoted-stories""".split()
WITHIN = """overflow-hidden has-sidebar no-comments elementor-widget-container article-body post-content entry-content content-with-sidebar
content-sidebar-wrap article-header story-text main-content headerless""".split()


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_pages_of_known_parts(seed, frame):
    """What was put into a page as its text comes out, and nothing of what was put around it."""
    draw = random.Random(seed)
    wanted, parts = [], []
    for k in range(draw.randint(2, 6)):
        text = f"{SENTENCE} {k} &amp; more."
        wanted.append(text.replace("&amp;", "&"))
        paragraph = f"<p>{text[:20]}<b>{text[20:]}</b></p>" if draw.random() < 0.5 else f"<p >{text}"
        parts.append(f'<div class="x {draw.choice(WITHIN)}">{paragraph}</div>')
        if draw.random() < 0.5:
            parts.append(f"<div class='{draw.choice(AROUND)}'><p>{SENTENCE} not {k}.</p></div>")
    inner = frame.format("\n".join(parts))
    around = [f"<div id={draw.choice(AROUND)}><p>{SENTENCE} out {k}.</p></div>" for k in range(3)]
    page = f"<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav>{around[0]}{inner}{around[1]}{around[2]}<footer>&copy; us</footer></body>"
    assert extraction.main_text(page).split("\n") == wanted


def test_other_articles_beside_the_main_one():
    main = f"<article><p>{SENTENCE}.</p><p>{SENTENCE} again.</p><p>{SENTENCE} at last.</p></article>"
    teaser = f"<article><h2>Another</h2><p>{SENTENCE} elsewhere.</p></article>"
    comments = f"<section id=comments><article><p>{SENTENCE} said I.</p><p>{SENTENCE} too.</p></article></section>"
    assert extraction.main_text(f"<main>{main}{teaser}{comments}</main>").split("\n") == [f"{SENTENCE}.", f"{SENTENCE} again.", f"{SENTENCE} at last."]


def test_quotes_and_hidden_styles():
    assert extraction.main_text('<article><p title="a>text here</p><p>two</p></article>') == "text here\ntwo"
    assert extraction.main_text(f"<article><p data-x='<b>\"' title=\"1 > 0\">{SENTENCE}</p></article>") == SENTENCE
    assert extraction.main_text(f"<div style='color:red;visibility: hidden'><p>{SENTENCE}.</p></div>") == ""


@pytest.mark.parametrize("bad", ["a<b ", '<a "', "<div>", '<a ">" ', "<!-", "<head>", "<p title='x", "&amp", '<a href="x>', "<h1>", "<svg", "<![", "</div>", "<span class=ad>", "<"])
def test_time_grows_with_the_page(bad):
    import time

    def seconds(size):
        page, began = bad * (size // len(bad)), time.process_time()
        extraction.main_text(page)
        return time.process_time() - began

    assert seconds(1 << 20) < 3
