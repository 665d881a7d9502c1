"""Each operator against brute force, and on nulls, empty and long texts, repeats and empty tables."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tradelake.llm import extraction, host_quality, jaccard, licenses, mixing, packing, token_files, topk, toxicity, warc
from tradelake.llm.common import components, encoder, session
from tradelake.llm.elias_fano import EliasFano

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, size int, node string"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty, short and long texts, repeats, and columns whose names operators use."""
    session(spark)
    draw = random.Random(3)
    words = [f"w{k}" for k in range(300)] + ["the", "of", "Straße", "éa", "<|endoftext|>", "a\tb", "x" * 300]
    rows = [(None, None, None), (None, "null id text here", "s1"), (1, None, "s1"), (2, "", "s2"), (3, " \n\t ", None), (4, "one", "s1"), (5, "One", "s2"), (6, "two words", "s1")]
    for k in range(7, 120):
        rows.append((k, "\n".join(" ".join(draw.choices(words, k=draw.randint(1, 30))) for _ in range(draw.randint(1, 12))), f"s{draw.choice([1, 1, 1, 2, 3])}"))
    base = draw.choices(words, k=150)
    for k in range(120, 150):
        copy = list(base)
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(150)] = f"edit{draw.random()}"
        rows.append((k, " ".join(copy), "s1"))
    rows += [(200, " ".join(draw.choices(words, k=30_000)), "s4"), (7, rows[8][1], "s1"), (7, rows[8][1], "s1")]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)


def tokens(text, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


# --- text of pages ----------------------------------------------------------


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text of the page that is long enough for it to be the text of it", "plain text of the page that is long enough for it to be the text of it"),
        ("<article><h1>T &amp; U</h1><p>a  b\n c<br>d</p></article><footer>&copy; x</footer>", "T & U\na b c d"),
        ("<nav><a href=x>menu</a></nav><div class='ad'>Buy the of and to</div><main><p>Text &eacute;.</p><div id=comments><p>It was the best of all that I have seen in the world.</p></div></main>", "Text é."),
        ("<article><script>var a='</p>';</script><p>one<form><input>Name</form><p>two<style>p{}</style></article><aside>side</aside>", "one\ntwo"),
    ],
)
def test_main_text(page, text):
    assert extraction.main_text(page) == text


def test_main_text_without_article():
    good = "It was the time of the year when all of them had been in the house with the others for so long."
    page = f"<html><body><ul><li><a href=a>Home</a><li><a href=b>News</a></ul><div><p>{good}</p><p>Short one.</p><p>{good}</p></div><p>Imprint</p><ul><li><a href=c>c</a></ul></body>"
    assert extraction.main_text(page).split("\n")[:3] == [good, "Short one.", good]
    assert "Home" not in extraction.main_text(page)


@pytest.mark.parametrize(
    "tag",
    [
        "div class='overflow-hidden'", "div style='overflow:hidden'", "div aria-hidden='false'", "div class='has-sidebar no-comments'", "div class=elementor-widget-container",
        "span aria-label='Search the notice'", "div data-hidden=1", "div title='display:none'", "div style='x-display:none'",
    ],
)
def test_main_text_keeps_loosely_named(tag):
    good = "It was the time of the year when all of them had been in the house with the others for so long."
    assert extraction.main_text(f"<body><{tag}><p>{good}</p></{tag.split()[0]}></body>") == good


@pytest.mark.parametrize(
    "tag",
    ["div hidden", "div class='a' HIDDEN=''", "div aria-hidden=true", "div style='color:red; display : none'", "div class='x sidebar'", "div id='site-footer'", "div class=comment-list", "div id=comment-12", "div role=navigation"],
)
def test_main_text_drops_surroundings(tag):
    good = "It was the time of the year when all of them had been in the house with the others for so long."
    assert extraction.main_text(f"<body><p>{good}</p><{tag}><p>{good} Not this.</p></div></body>") == good


def test_main_text_of_articles_below_names():
    good = "It was the time of the year when all of them had been in the house with the others for so long."
    assert extraction.main_text(f"<div class=sidebar><p>{good}</p><article><p>{good} This.</p></article></div>") == f"{good} This."
    assert extraction.main_text(f"<div hidden><article><p>{good}</p></article></div>") == ""
    assert extraction.main_text(f"<main><p>{good}</p><div id=comments><article><p>{good} Not.</p></article></div></main>") == good


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, 5), (1, "u", None, 5), (2, None, "<p>" + "the of and " * 50_000, 6)], "page_id long, url string, html string, text int")
    found = extraction.extract(pages, ["page_id", "url"]).collect()
    assert [r.n_chars for r in sorted(found, key=lambda r: r.page_id)] == [0, 0, 549_999]
    assert extraction.extract(pages.limit(0), ["page_id"]).count() == 0


# --- token files -----------------------------------------------------------


def test_encoder_equals_the_library():
    texts = ["", "A b's  c d́ é\n\nΣΑΣ ΑΣ", "tab\tand <|startoftext|>x\x1cy", "́ lone", "x" * 500, "don't 12 3,4!! …", "İstanbul ǅ"]
    assert encoder(None).encode(texts, 9) == [np.asarray(tokens(t, 9), "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5, 5, 9, 1000, 2**40], list(range(0, 5000, 3)), sorted(random.Random(1).choices(range(10**6), k=3000))])
def test_elias_fano(values):
    coded = EliasFano.from_bytes(EliasFano.encode(np.array(values, np.int64)).to_bytes())
    assert coded.range(0, len(values)).tolist() == values
    assert all(coded.select(k) == v for k, v in list(enumerate(values))[::7])
    for a in range(0, len(values), 211):
        assert coded.range(a, min(a + 300, len(values))).tolist() == values[a : a + 300]


def test_token_files(spark, docs):
    files = token_files.write_token_files(docs)
    found = sorted(token_files.read_token_files(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found if r.doc_id is not None] == sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
    assert [r.doc_id for r in found[-2:]] == [None, None]
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    want = sorted((len(t), crc(t)) for t in (tokens(r.text, 1) for r in docs.collect()))
    assert sorted((r.n_tokens, r.ids_crc32) for r in found) == want
    assert token_files.read_token_files(token_files.write_token_files(docs.limit(0))).count() == 0


# --- toxicity --------------------------------------------------------------


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    scored = toxicity.score(docs.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))), model, ["doc_id", "toxic"]).toPandas()
    predicted = scored.score >= toxicity.THRESHOLD
    assert (scored.toxic[predicted] == 1).mean() > 0.9
    assert predicted[scored.toxic == 1].mean() > 0.7
    assert predicted[scored.toxic == 0].mean() < 0.01


def test_toxicity_of_a_text_alone_and_among_others():
    texts = ["one text", "", "Another, longer text", "one text", "é", "a\0b c"]
    together = toxicity.distinct_grams(texts)
    for text, found in zip(texts, together):
        assert found.tolist() == toxicity.distinct_grams([text])[0].tolist()
    features = np.unique(np.concatenate(together + toxicity.distinct_grams(["".join(texts)])))
    model = toxicity.Model(features, np.random.default_rng(7).normal(size=len(features)), 0.1)
    for order in (texts, texts[::-1]):
        assert model.scores(order) == pytest.approx(np.concatenate([model.scores([t]) for t in order]), abs=1e-12)


def test_toxicity_edges(spark, docs):
    labels = spark.createDataFrame([(k, k % 2) for k in range(7, 60)] + [(None, 1), (8, None), (7, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs, model, ["doc_id"]).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    none = toxicity.train(docs, labels.where("toxic = 0"))
    assert toxicity.score(docs, none, ["doc_id"]).agg(F.max("score")).first()[0] == 0
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).count() == 0


# --- mixing ----------------------------------------------------------------


def test_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 100)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert found["a"] == 20 and found[None] == 200
    assert found["b"] + found["c"] == pytest.approx(1.5 * 2110 - 220)
    assert found["b"] == pytest.approx(min(2000, 2 * found["c"]))


def test_mix(spark, docs):
    found = mixing.mix(docs, ["doc_id"]).collect()
    assert found == mixing.mix(docs, ["doc_id"]).collect() or sorted(map(str, found)) == sorted(map(str, mixing.mix(docs, ["doc_id"]).collect()))
    assert len(found) == docs.count()
    assert all(r.taken in (0, r.size, 2 * r.size) for r in found)
    assert mixing.mix(docs.limit(0), ["doc_id"]).count() == 0


# --- licenses --------------------------------------------------------------


def brute_licenses(rows):
    """Documents in which some stretch of twice a notice's length on both sides of a word holds 80 per cent of its shingles."""
    out = set()
    cut = lambda text: re.findall(r"[^\W_]+", (text or "").lower())
    for name, notice in licenses.TEMPLATES.items():
        words = cut(notice)
        wanted = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        for one, text in rows:
            found = cut(text)
            places = [i for i in range(len(found) - 4) if tuple(found[i : i + 5]) in wanted]
            for at in places:
                near = {tuple(found[i : i + 5]) for i in places if abs(i - at) <= 2 * len(words)}
                if len(near) >= licenses.LEAST * len(wanted):
                    out.add((one, name))
    return out


def test_license_scan_equals_brute_force(spark):
    draw = random.Random(8)
    rows = [(None, "nothing here"), (None, "x " * 9 + licenses.TEMPLATES["mit"] + " y"), (1, None), (2, "")]
    for k in range(3, 400):
        words = [f"w{draw.randrange(99)}" for _ in range(draw.randrange(60))]
        for _ in range(draw.randrange(3)):
            notice = draw.choice(list(licenses.TEMPLATES.values())).split()
            for _ in range(draw.choice([0, 0, 1, 1, 2, 5])):  # edited words
                notice[draw.randrange(len(notice))] = f"edit{draw.random()}"
            at = draw.randrange(len(words) + 1)
            words[at:at] = notice
        rows.append((k, " ".join(words)))
    table = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, at int, license_id string")
    found = licenses.scan(table.repartition(4), licenses.templates(spark)).collect()
    assert {(r.doc_id, r.license_id) for r in found} == brute_licenses(rows)
    assert len(found) == len({(r.doc_id, r.license_id) for r in found})
    assert all(r.containment == r.n_found / r.n_shingles for r in found)


def test_license_scan(spark):
    filler = " ".join(f"word{k}" for k in range(40))
    texts = dict(enumerate([None, "", "short", filler] + [f"{filler} {'pad ' * k}{t} {filler}" for k in range(3) for t in licenses.TEMPLATES.values()]))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {(r.doc_id, r.license_id) for r in licenses.scan(rows, licenses.templates(spark)).where("containment = 1").collect()}
    names = list(licenses.TEMPLATES)
    assert {(4 + k, names[k % len(names)]) for k in range(3 * len(names))} <= found
    assert not {d for d, _ in found} & {0, 1, 2, 3}
    assert licenses.scan(rows.limit(0), licenses.templates(spark)).count() == 0


# --- packing ---------------------------------------------------------------


def test_pack(spark, docs):
    found = packing.pack(docs).toPandas()
    want = sorted(map(tuple, (tokens(r.text, 2) for r in docs.collect())))
    assert found.length.between(1, packing.LIMIT).all()
    assert found.length.sum() == sum(map(len, want))
    for _, group in found.sort_values("offset").groupby("sequence_id"):
        assert (group.offset.to_numpy() == np.r_[0, group.length.cumsum().to_numpy()[:-1]]).all()
        assert group.length.sum() <= packing.LIMIT
    by_id = {r.doc_id: tokens(r.text, 2) for r in docs.collect()}
    for r in found[found.doc_id.notna() & (found.doc_id != 7)].itertuples():
        ids = by_id[int(r.doc_id)]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start : r.start + r.length])
    ends = found[found.doc_id.notna() & (found.doc_id != 7)].sort_values(["doc_id", "start"]).groupby("doc_id")
    assert all((g.start.to_numpy() == np.r_[0, g.length.cumsum().to_numpy()[:-1]]).all() for _, g in ends)
    assert packing.pack(docs.limit(0)).count() == 0


def test_solve_uses_no_more_than_there_is():
    draw = np.random.default_rng(2)
    histogram = draw.integers(0, 50, packing.BINS)
    patterns = packing.combinations()
    assert all(sum(p) == packing.BINS and len(p) <= packing.MOST_PIECES for p in patterns)
    counts = packing.solve(histogram, patterns)
    used = np.zeros(packing.BINS, np.int64)
    for c, p in zip(counts, patterns):
        for b in p:
            used[b - 1] += c
    assert (used <= histogram).all() and (used * np.arange(1, 257)).sum() > 0.75 * (histogram * np.arange(1, 257)).sum()


@pytest.mark.parametrize("total", [0, 1, 4095, 4096, 4097, 10_000])
def test_cut_points(total):
    points = packing.cut_points(total)
    assert points[0] == total // 4096 * 4096 and points[-1] == total
    assert all(x & (x - 1) == 0 for x in np.diff(points).tolist())


# --- quality ---------------------------------------------------------------


def repeated(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + s for i, w in enumerate(windows) if windows.count(w) > 1 for s in range(5)}
    return len(inside)


def test_measures():
    draw = random.Random(4)
    for size in (0, 3, 5, 9, 80, 200):
        words = draw.choices("abc", k=size)
        assert host_quality.repeated_words([w.encode() for w in words]) == repeated(words)
    assert host_quality.measures("a #*\n\na #*\n \nb\x1cc") == (5, 9, 4, 1, 0)


def test_hosts(spark):
    bad, good = "x y z", "one two three four five six seven eight nine ten eleven"
    rows = [(k, bad if k % 10 else good, "bad") for k in range(100)] + [(k, good, "good") for k in range(100, 200)] + [(None, None, None), (300, good, None)]
    found = host_quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"), ["doc_id"]).toPandas()
    assert found.kept.sum() == 101 and not found[found.source == "bad"].kept.any()
    assert host_quality.judge(spark.createDataFrame([], "doc_id long, text string, source string"), ["doc_id"]).count() == 0


# --- archives --------------------------------------------------------------


def test_warc(spark):
    long = "<p>" + "é" * 2000
    rows = [(k, f"http://x/{k}", f"<html>{k % 7} " + "text " * 300) for k in range(40)]
    rows += [(50, None, None), (51, "u\r\nX: y", ""), (52, "u", long), (53, "u", long), (53, "u", long), (None, "u", long), (None, None, "z" * 1500), (None, None, "z" * 1500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = warc.read_warc(warc.write_warc(pages)).toPandas()
    assert len(found) == len(rows)
    assert set(found[found.record_type == "revisit"].refers_to) == {*range(33, 40), 53}
    assert (found[found.page_id == 53].record_type == "response").all()
    assert (found[found.payload_bytes == 1500].record_type == "response").all()
    assert found[found.page_id == 51].url.iloc[0] == "u%0D%0AX: y"
    assert warc.read_warc(warc.write_warc(pages.limit(0))).count() == 0


# --- search ----------------------------------------------------------------


def test_top_k(spark):
    draw = np.random.default_rng(5)
    vectors = [(k, [float(x) for x in np.round(draw.normal(size=8), 1)]) for k in range(400)]
    vectors += [(k, vectors[k - 400][1]) for k in range(400, 420)] + [(500, None), (501, [float("nan")] * 8), (502, [None] * 8), (503, [1.0]), (None, [1.0] * 8), (550, []), (50, vectors[50][1])]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = topk.top_k(rows, rows.where("vec_id % 50 = 0")).collect()
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors if i is not None and i < 500]
    for q in range(0, 400, 50):
        query = dict(whole)[q]
        want = sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in whole if i != q)[:5]
        assert [(-r.score, r.vec_id) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == want
    assert topk.top_k(rows.limit(0), rows.limit(0)).count() == 0


@pytest.mark.parametrize("partitions", [1, 8, 211])
@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_top_k_of_many_blocks(spark, partitions, coalesce):
    draw = np.random.default_rng(6)
    vectors = np.round(draw.normal(size=(700, 6)), 1)
    vectors[600:] = vectors[:100]
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        found = topk.top_k(rows, rows.where("vec_id % 5 = 0"), query_block=16, vector_block=64).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    whole = np.floor(256 * vectors).astype(np.int64)
    scores = whole[::5] @ whole.T
    want = []
    for q, row in zip(range(0, 700, 5), scores.tolist()):
        best = sorted((-s, i) for i, s in enumerate(row) if i != q)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == want


# --- near duplicates -------------------------------------------------------


def brute_components(rows):
    sets = {}
    for k, (_, text) in enumerate(rows):
        words = (text or "").encode().lower().split()
        sets[k] = {tuple(words[i : i + 3]) for i in range(len(words) - 2)} or ({tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (one, _) in enumerate(rows):
        least[root(k)] = min([x for x in (least.get(root(k)), one) if x is not None], default=None)
    return [(one, len(sets[k]), least[root(k)]) for k, (one, _) in enumerate(rows)]


@pytest.mark.parametrize("tile", [2000, 4])
def test_jaccard(spark, docs, tile):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = [tuple(r) for r in jaccard.components_of(docs, tile=tile).collect()]
    assert sorted(map(str, found)) == sorted(map(str, brute_components(rows)))
    assert jaccard.components_of(docs.limit(0)).count() == 0


def edited_copies(seed, groups=6, copies=14, length=150, most=4):
    """Texts with replaced, inserted and deleted words, so that the shingle counts of a group differ."""
    draw = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{k}" for k in range(length)]
        for _ in range(copies):
            copy = list(base)
            for _ in range(draw.randint(0, most)):
                at = draw.randrange(len(copy))
                copy[at : at + draw.randint(0, 1)] = [f"e{draw.random()}"] * draw.randint(0, 1)
            rows.append(" ".join(copy))
    draw.shuffle(rows)
    return [(k, text) for k, text in enumerate(rows)]


@pytest.mark.parametrize("tile", [2000, 4])
def test_jaccard_of_copies_of_different_sizes(spark, tile):
    rows = edited_copies(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = [tuple(r) for r in jaccard.components_of(docs, tile=tile).collect()]
    assert sorted(found) == sorted(brute_components(rows))


@pytest.mark.parametrize("split", [False, True])
def test_search_visits_sizes_in_any_order(split):
    for seed in range(20):
        draw = random.Random(seed)
        sets = []
        for _ in range(30):
            edited = set(range(100)) - set(draw.sample(range(100), draw.randint(0, 5)))
            sets.append(np.array(sorted(edited | {draw.randrange(1000, 10**9) for _ in range(draw.randint(0, 5))}), np.int64))
        side = [k % 2 if split else 0 for k in range(30)]
        links = [(a, b) for a in range(30) for b in range(a) if (side[a] != side[b] or not split) and 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))]

        def parts(edges):
            group = {k: {k} for k in range(30)}
            for a, b in edges:
                joined = group[a] | group[b]
                for x in joined:
                    group[x] = joined
            return sorted({tuple(sorted(g)) for g in group.values()})

        edges = jaccard.search(list(range(30)), sets, side, 90)
        assert {tuple(sorted(e)) for e in edges} <= {tuple(sorted(e)) for e in links}
        assert parts(edges) == parts(links)


def brute_classes(rows, shingle, least):
    """The least id of each row's component, by all pairs of rows."""
    split = [text.lower().split() for _, text in rows]
    sets = [{tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)} for words in split]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least_id = {}
    for k, (one, _) in enumerate(rows):
        least_id[root(k)] = min(one, least_id.get(root(k), one))
    return {one: least_id[root(k)] for k, (one, _) in enumerate(rows)}


def test_pipeline_stage_equals_brute_force(spark):
    """Near copies between the thresholds of the query and of the stage are dropped."""
    rows = edited_copies(9, groups=5, copies=8, most=7)
    docs = spark.createDataFrame([(k, text, "en", "a", len(text)) for k, text in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want = {one for one, least in brute_classes(rows, 5, 80).items() if one == least}
    assert want != {one for one, least in brute_classes(rows, 3, 90).items() if one == least}
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()} == want


def test_components(spark):
    draw = random.Random(6)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)] + [(400, k) for k in range(401, 450)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = {}
    for a, b in edges:
        group.setdefault(a, {a})
        group.setdefault(b, {b})
        if group[a] is not group[b]:
            joined = group[a] | group[b]
            for x in joined:
                group[x] = joined
    want = {x: min(g) for x, g in group.items() if len(g) > 1}
    assert {k: v for k, v in found.items() if k in want} == want
