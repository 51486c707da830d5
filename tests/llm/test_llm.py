"""Operators against brute force, on the small tables and on a fixture of awkward rows."""

import collections
import hashlib
import html
import math
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from roadlake.llm import byte_bpe, chat_perspective, fair_mix, hmm_lm, license_index, mih_search, page_diff, quality_mcd, queries, simhash_dedup, simhash_texts, toxicity_nnpu
from roadlake.llm.components import connected_components

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"word{i % 977} plain" for i in range(30_000))
ODD = [
    (1, "the cat sat on the mat and looked at the dog", "en", "a"), (2, None, "en", None), (3, "", None, "a"), (4, LONG, "en", "b"), (4, LONG, "en", "b"),
    (None, "the cat sat on the mat and looked at the dog", None, None), (6, " \n\t\x0b ", "de", "b"), (7, "MIT License. All rights reserved! CC-BY   é x", "fr", "c"), (8, "one two", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, very long and repeated texts, and extra columns whose names operators use inside."""
    return spark.createDataFrame(ODD, SCHEMA).withColumns({"n_words": F.lit("x"), "fp": F.lit(1), "uid": F.lit(2), "size": F.lit(3), "key": F.lit("k"), "w": F.lit(4), "kept": F.lit(5)})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet")


def brute_stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, odd, none, docs):
    texts = dict(zip(docs.doc_id, docs.text))
    got = queries.op1_quality_mcd(spark, SF).toPandas()
    assert len(got) == len(docs)
    for r in got.itertuples():
        want = brute_stats(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert not (got.base_failed & got.kept).any()
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    both = got.merge(labels, on="doc_id")
    clean, junk = both[(both.quality == 1) & ~both.base_failed], both[(both.quality == 0) & ~both.base_failed]
    assert clean.kept.mean() > 0.98 and junk.kept.mean() < 0.3
    assert quality_mcd.quality_verdicts(odd).count() == len(ODD)
    assert quality_mcd.quality_verdicts(none).count() == 0
    assert abs(quality_mcd.chi2_quantile(2, 0.95) - 5.9915) < 1e-3


def test_mcd_resists_outliers(spark):
    rng = np.random.default_rng(0)
    rows = [("en", "a", 300, int(1500 + rng.normal() * 60), 0, 0, 0, 10, 20, 20) for _ in range(300)] + [("en", "a", 300, 1500, 500, 0, 0, 900, 900, 20) for _ in range(90)]
    stats = spark.createDataFrame(rows, "lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_marks long, n_lines long")
    got = quality_mcd.judge(stats, *quality_mcd.fit(stats)).groupBy((F.col("n_symbols") > 0).alias("bad")).agg(F.avg(F.col("kept").cast("int")).alias("k")).toPandas()
    assert dict(zip(got.bad, got.k)) == {True: 0.0, False: 1.0}


def test_mcd_steps_have_few_stages(spark, docs, monkeypatch):
    """A step gathers its estimates once, before Python: each stage costs the driver memory."""
    plans = []
    monkeypatch.setattr(quality_mcd, "cut", lambda d, f=quality_mcd.cut: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or f(d))
    quality_mcd.fit(quality_mcd.text_statistics(spark.read.parquet(f"{SF}/documents.parquet"), ["lang", "source"]), max_steps=1)
    (step,) = [p for p in plans if "percentile_approx(d2" in p and " AS was#" in p]
    assert step.count("Repartition ") == 1


def test_mcd_covariance_sets_the_distance(spark):
    """Rows far outside their group's own narrow, correlated cloud are rejected, though within the floors of its centre."""
    rng = np.random.default_rng(5)
    upper = np.round(2000 + rng.normal(size=400) * 150).astype(int)
    marks = upper + np.round(rng.normal(size=400) * 60).astype(int)
    good = [("en", "a", 4000, int(20_000 + rng.normal() * 200), 0, 0, 0, int(u), int(m), 20) for u, m in zip(upper, marks)]
    bad = [("en", "a", 4001, 20_000, 0, 0, 0, 2000, 3800, 20)] * 5 + [("en", "a", 4001, 20_000, 0, 0, 0, 2350, 1650, 20)] * 5
    stats = spark.createDataFrame(good + bad, "lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_marks long, n_lines long")
    got = quality_mcd.judge(stats, *quality_mcd.fit(stats)).groupBy((F.col("n_words") == 4001).alias("bad")).agg(F.avg(F.col("kept").cast("int")).alias("k")).toPandas()
    assert dict(zip(got.bad, got.k)) == {True: 0.0, False: 1.0}


def test_search(spark):
    table = pd.read_parquet(f"{SF}/embeddings.parquet").sort_values("vec_id")
    x, ids = np.stack(table.embedding).astype(float), table.vec_id.to_numpy()
    got = queries.op2_mih_search(spark, SF).toPandas()
    hits = []
    for q, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        scores = x @ x[ids == q][0]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        hits.append(len(set(ids[order]) & set(part.vec_id)) / 20)
        assert list(part["rank"]) == list(range(1, 21)) and (np.diff(part.score) <= 0).all() and q not in set(part.vec_id)
        assert np.allclose(part.score, [scores[ids == v][0] for v in part.vec_id], atol=1e-12)
    assert set(got.query_id) == {i for i in ids if i % 20 == 0} and np.mean(hits) >= 0.9


def test_search_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [None, 1.0]), (4, [2.0, 0.0]), (5, [2.0, 0.0]), (6, [-1.0, 3.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (4, [2.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = mih_search.nearest_by_product(frame, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 4, 2.0), (0, 2, 5, 2.0), (0, 3, 6, -1.0)]
    assert mih_search.nearest_by_product(frame.limit(0), F.lit(True)).count() == 0


def brute_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """fp -> smallest fp index reachable at 3 bits or fewer."""
    prints = list(prints)
    comp = list(range(len(prints)))
    find = lambda i: i if comp[i] == i else find(comp[i])
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                comp[max(find(i), find(j))] = min(find(i), find(j))
    return {p: prints[find(i)] for i, p in enumerate(prints)}


@pytest.mark.parametrize("hot", [256, 2])
def test_near_duplicates(spark, docs, hot):
    got = simhash_dedup.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet"), hot=hot).toPandas()
    texts = dict(zip(docs.doc_id, docs.text))
    assert all(int(r.fingerprint, 16) == brute_simhash(texts[r.doc_id]) for r in got.sample(60, random_state=1).itertuples())
    fps = got.fingerprint.map(lambda x: int(x, 16))
    group = fps.map(brute_components(sorted(set(fps))))
    assert (got.groupby(group).doc_id.transform("min") == got.component_id).all() and len(got) == len(docs)


def test_crowded_fingerprints(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 1 << 62, 6)]
    prints = {b ^ sum(1 << int(i) for i in rng.choice(64, k, replace=False)) for b in base for k in (0, 1, 2, 3, 4, 6) for _ in range(25)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    for hot in (4, 1000):
        links = simhash_dedup.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp long"), hot=hot)
        comps = {r.node: r.component for r in connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).collect()}
        want = brute_components([p & (2**64 - 1) for p in signed])
        ours = collections.defaultdict(set)
        theirs = collections.defaultdict(set)
        for p in signed:
            ours[comps.get(p, p)].add(p)
            theirs[want[p & (2**64 - 1)]].add(p)
        assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_near_duplicates_odd(odd, none):
    got = simhash_dedup.near_duplicates(odd).toPandas()
    assert len(got) == len(ODD) and simhash_dedup.near_duplicates(none).count() == 0
    assert set(got[got.fingerprint == "0" * 16].doc_id) == {2, 3, 6} and set(got[got.fingerprint == "0" * 16].component_id) == {2}
    assert list(got[got.doc_id.isna()].component_id) == [1]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 2), (9, 9), (10, 11), (None, 1)] + [(i, i + 1) for i in range(100, 140)], "u long, v long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10} | {i: 100 for i in range(100, 141)}


def test_pages(spark):
    got = queries.op4_page_diff(spark, SF).toPandas()
    pages = pd.read_parquet(f"{SF}/pages.parquet")
    both = got.merge(pages, on="page_id")
    assert len(got) == len(pages)
    for r in both.itertuples():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split()) and r.n_chars == len(r.text)


def test_page_parts(spark):
    frame = "<div>Site menu line</div>{}<div>Imprint and terms</div>"
    rows = [
        (1, "http://h.org/a/1", frame.format("<p>First &amp; only &lt;b&gt;\n story</p>")), (2, "http://h.org/a/2?x=1", frame.format("<p>Second story<br>goes on</p>")), (3, "http://h.org/zzz", None), (4, None, "<p>alone"),
        (5, "http://o.org/x", "<header>top</header><main><header><h1>T&eacute;</h1></header><p>Body <b>bold</b>text<script>x('</p>')</script></p><div class='user-comments'><p>nice!</p></div><form>mail</form></main><aside>s</aside><div id=cookie-banner>ok?</div>"),
    ]
    got = {r.page_id: r for r in page_diff.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("uid", F.lit("x"))).collect()}
    assert got[1].text == "First & only <b> story" and got[1].n_deleted == 2 and got[2].text == "Second story goes on"
    assert got[3].text == "" and got[4].text == "alone" and got[5].text == "Té Body boldtext"
    assert page_diff.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_common_lines():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(0, 12)).tolist(), rng.integers(0, 5, rng.integers(0, 12)).tolist()
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert sum(page_diff.common_lines(a, b)) == best[-1][-1]


def test_common_lines_in_pieces_and_repeated():
    rng = np.random.default_rng(6)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(0, 40)).tolist(), rng.integers(0, 4, rng.integers(0, 40)).tolist()
        whole, pieces = page_diff.common_lines(a, b), page_diff.common_lines(a, b, most_bits=64)
        assert sum(whole) == sum(pieces)
    assert all(page_diff.common_lines([7] * 30_000, [5, *[7] * 30_000, 6]))


def test_page_text_outside_articles(spark):
    """Unshared text beside an article stays; names of paragraphs delete nothing; stray quotes end no tag; copies keep their article."""
    side = "<div>Same on both pages</div>"
    rows = [
        (1, "http://h.org/a/1", f"{side}<article><p class='notice'>kept</p><div class='ad-box'>buy</div></article><div><p>main story outside</p></div>"), (2, "http://h.org/a/2", f"{side}<article><p>kept</p></article>"),
        (3, "http://q.org/1", "<p title=it's>Hello world</p><p>don't stop</p><p>end <math>x</math></p>"), (None, "http://z.org/a/1", "<p>without id</p>"), (4, "http://r.org/1", "<p>a</p>" * 3 + "<p>b</p>"), (4, "http://r.org/1", "<p>a</p>" * 3 + "<p>b</p>"),
    ]
    out = page_diff.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = {r.page_id: r.text for r in out}
    assert len(out) == len(rows) and got[1] == "kept main story outside" and got[2] == "kept" and got[3] == "Hello world don't stop end x" and got[None] == "without id" and got[4] == "a a a b"


def oracle(sql, sf, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con.execute(sql).df()


def test_mix(spark, odd, none):
    got = queries.op5_fair_mix(spark, SF).toPandas().sort_values("doc_id", ignore_index=True)
    want = oracle(queries.OP5_SQL, SF, "documents").sort_values("doc_id", ignore_index=True)[list(got.columns)]
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    assert (got.taken <= 2 * got["size"]).all() and abs(got.taken.sum() - 1.5 * got["size"].sum()) <= got["size"].max()
    out = fair_mix.mix_sources(odd).toPandas()
    assert len(out) == len(ODD) and out[out.doc_id == 4].n_taken.nunique() == 1 and fair_mix.mix_sources(none).count() == 0


def test_mix_ranges(spark, monkeypatch):
    whole = {r.doc_id: r.taken for r in queries.op5_fair_mix(spark, SF).collect()}
    monkeypatch.setattr(fair_mix, "RANGE_ROWS", 50)
    assert whole == {r.doc_id: r.taken for r in queries.op5_fair_mix(spark, SF).collect()}


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), ("d", 0)], "key string, source_size long")
    got = {r.key: r.target for r in fair_mix.source_targets(sizes).collect()}
    assert got["a"] == 200 and got["b"] == 20 and got["d"] == 0 and math.isclose(got["c"], 1.5 * 1110 - 220)


def test_toxicity(spark, odd, none):
    got = queries.op6_toxicity_nnpu(spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    held = got[got.held_out]
    assert held[held.toxic == 0].predicted.mean() <= 0.02 and got[(got.toxic == 1) & ~got.held_out].score.mean() > 3 * got[got.toxic == 0].score.mean()
    labels = spark.createDataFrame([(1, 1), (2, 0), (8, None)], "doc_id long, toxic int")
    assert toxicity_nnpu.score_toxicity(odd, labels, ["doc_id"]).count() == len(ODD)
    assert toxicity_nnpu.score_toxicity(none, labels.limit(0), ["doc_id"]).count() == 0


def test_toxicity_recall_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op6_toxicity_nnpu(spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = got[got.held_out]
    assert held[held.toxic == 1].predicted.mean() >= 0.85 and held[held.toxic == 0].predicted.mean() <= 0.02


def test_toxicity_scores_by_hand(spark, odd):
    """Scores of the query's operator equal a plain sum over the learned weights; all rows may be taken as unlabelled."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    weights, bias = toxicity_nnpu.train(docs, labels, max_positive=None, max_unlabelled=None)
    got = toxicity_nnpu.score_toxicity(docs, labels, ["doc_id"], max_positive=None, max_unlabelled=None).toPandas()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in got.itertuples():
        z = bias + sum(weights.get(f, 0.0) for f in toxicity_nnpu.text_features(texts[r.doc_id]))
        assert math.isclose(r.toxic_score, 1 / (1 + math.exp(-max(-30, min(30, z)))), rel_tol=1e-6)


def test_nnpu_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(2)
    texts = [{f"w{i}" for i in rng.integers(0, 400, 30)} | ({f"bad{rng.integers(0, 4)}"} if k < 800 else set()) for k in range(4000)]
    positive = np.array([k < 400 for k in range(4000)])
    weights, bias = toxicity_nnpu.fit_sample(texts, positive, 400 / 3600)
    score = toxicity_nnpu.scorer(weights, bias)
    hidden = score([" ".join(t).encode() for t in texts[400:800]])
    clean = score([" ".join(t).encode() for t in texts[800:1200]])
    assert np.mean(np.array(hidden) >= 0.7) > 0.95 and np.mean(np.array(clean) >= 0.7) < 0.02


def test_bpe(spark, odd, none):
    import public_tokenizers as p
    import tiktoken

    path = p.path("byte_bpe_multi_50k.tiktoken")
    e = byte_bpe.encoder(path, p.PATTERN)
    real = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    for t in ("", "a" * 5000, "ab" * 3000 + "é" * 999, " \n\n\t ", "日本語" * 50, "it's 1234 <|endoftext|>", LONG):
        assert e.encode(t) == real.encode_ordinary(t) and e.decode(e.encode(t)) == t.encode()
    coded = byte_bpe.encode_table(odd, path, p.PATTERN, ["doc_id", "text"])
    for r in byte_bpe.encode_table(odd.withColumn("copy", F.col("text")), path, p.PATTERN, ["doc_id", "copy"]).collect():
        ids = real.encode_ordinary(r.copy or "")
        assert r.ids == ids and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256((r.copy or "").encode()).hexdigest()
    assert sorted(r.text for r in byte_bpe.decode_table(coded, path, ["doc_id"]).collect()) == sorted(r[1] or "" for r in ODD)
    assert byte_bpe.encode_table(none, path, p.PATTERN, ["doc_id"]).count() == 0


def brute_templates(words):
    """(label, share in place) of every template at every start, its phrases standing in the window."""
    whole = b" " + b" ".join(words) + b" "
    for label, text, phrases in license_index.TEMPLATES:
        template = license_index.license_words(text.encode())
        if any(b" " + b" ".join(license_index.license_words(p.encode())) + b" " not in whole for p in phrases):
            continue
        for start in range(-len(template) + 1, len(words)):
            same = sum(0 <= start + k < len(words) and words[start + k] == w for k, w in enumerate(template))
            window = b" ".join(words[max(0, start) : start + len(template)])
            if same / len(template) >= license_index.COVER and all(b" " + b" ".join(license_index.license_words(p.encode())) + b" " in b" " + window + b" " for p in phrases):
                yield label, same / len(template)


def test_short_pre_tokens_merge_in_few_steps(monkeypatch):
    """merge_short equals the one-by-one queue, and its steps follow the blocks of ranks, not the pre-tokens."""
    rng = np.random.default_rng(3)
    ranks = {bytes([c]): c for c in range(256)} | {b"aa": 400, b"aaa": 300, b"ab": 257, b"aab": 2000, b"ba": 299, b"aabb": 259, b"bb": 900}
    words = [bytes(rng.choice([97, 98, 99], size=rng.integers(0, 64)).astype(np.uint8)) for _ in range(3000)] + [b"a" * k for k in range(65)]
    pairs = byte_bpe.Pairs(ranks)
    assert byte_bpe.merge_short(words, pairs) == byte_bpe.merge_words(words, ranks)
    assert byte_bpe.merge_short([], pairs) == [] and byte_bpe.merge_short([b"", b"a"], pairs) == [[], [97]]
    e = byte_bpe.Encoder(ranks, r"\S+")
    met, alone = [], []
    monkeypatch.setattr(byte_bpe, "merge_short", lambda w, p, f=byte_bpe.merge_short: met.extend(w) or f(w, p))
    monkeypatch.setattr(byte_bpe, "merge_words", lambda w, r, f=byte_bpe.merge_words: alone.extend(w) or f(w, r))
    assert e.decode(e.encode("ab aab " + "ab" * 40)) == b"abaab" + b"ab" * 40
    assert sorted(met) == [b"aab", b"ab"] and alone == [b"ab" * 40]


def test_licenses(spark, odd, none, docs):
    got = queries.op8_license_index(spark, SF).toPandas().merge(docs, on="doc_id")
    for r in got.itertuples():
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), r.text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
        at = [(i, label) for p, label in license_index.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(at), ",".join(sorted({x for _, x in at})))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert (r.first_word == min(at)[0] and r.last_word == max(at)[0]) if at else math.isnan(r.first_word)
        stand = list(brute_templates([w.encode() for w in words]))
        assert set(filter(None, r.labels.split(","))) == {x for x, _ in [*stand, *((label, 1) for _, label in at)]} and r.score == (1 if at else max((c for _, c in stand), default=0))
    has = got.text.str.contains("Apache License, Version 2.0", regex=False)
    assert (got.labels.str.contains("apache-2.0") == has).all() and has.any()
    out = {r.doc_id: r for r in license_index.scan_licenses(odd, ["doc_id"]).collect()}
    assert out[7].base_labels == "cc-by,reserved" and out[7].n_base == 2 and out[2].n_words == 0 and out[2].labels == ""
    assert license_index.scan_licenses(none, ["doc_id"]).count() == 0


def test_language_model(spark, odd, none, docs):
    got = queries.op9_hmm_lm(spark, SF).toPandas().merge(docs, on="doc_id")
    words = {r.doc_id: (r.text or "").encode().lower().split() + [b" "] for r in docs.itertuples()}
    train = {i for i in words if zlib.crc32(str(i).encode()) % 5 != 1}
    counts = collections.Counter(w for i in train for w in words[i])
    n, v = sum(counts.values()), len(counts)
    for r in got.itertuples():
        w = words[r.doc_id]
        assert r.held_out == (r.doc_id not in train) and (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
    assert hmm_lm.score_texts(odd, F.col("doc_id") != 8).count() == len(ODD)
    assert hmm_lm.score_texts(none, F.lit(True)).count() == 0
    assert all(r.score == r.base_score for r in hmm_lm.score_texts(odd, F.lit(False)).collect())


def test_forward_and_baum_welch_by_enumeration(monkeypatch):
    import itertools

    rng = np.random.default_rng(4)
    chain = hmm_lm.Chain(np.array([0.6, 0.4]), np.array([[0.7, 0.3], [0.2, 0.8]]), np.array([[0.5, 0.1], [0.3, 0.3], [0.2, 0.6]]))
    seqs = [rng.integers(0, 3, n).astype(np.int32) for n in (1, 2, 5, 7, 7)]
    start, move, emit, like = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2)), []
    for s in seqs:
        paths = {}
        for p in itertools.product(range(2), repeat=len(s)):
            paths[p] = chain.start[p[0]] * np.prod([chain.emit[x, a] for x, a in zip(s, p)]) * np.prod([chain.move[a, b] for a, b in zip(p, p[1:])])
        total = sum(paths.values())
        like.append(math.log(total))
        for p, x in paths.items():
            start[p[0]] += x / total
            for a, b in zip(p, p[1:]):
                move[a, b] += x / total
            for sym, a in zip(s, p):
                emit[sym, a] += x / total
    assert np.allclose(chain.log_likelihood(seqs), like)
    for span in (1024, 3):
        monkeypatch.setattr(hmm_lm, "SPAN", span)
        got = chain.expected(seqs)
        assert np.allclose(got[0], start) and np.allclose(got[1], move) and np.allclose(got[2], emit) and math.isclose(got[3], sum(like))


def test_perspectives(spark):
    got = queries.op10_chat_perspective(spark, SMALL).toPandas()
    want = oracle(queries.OP10_SQL, SMALL, "conversations")[list(got.columns)]
    order = ["conv_id", "speaker", "turn", "role", "rendered"]
    pd.testing.assert_frame_equal(got.sort_values(order, ignore_index=True), want.sort_values(order, ignore_index=True), check_dtype=False)
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", "bye"), (1, 3, "ann", "bye"), (1, None, "cy", "x"), (None, 1, "ann", "y"), (2, 0, None, "z"), (3, 0, "system", "only")]
    for block in (256, 2):
        out = chat_perspective.rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("name", F.lit(1)), block=block).toPandas()
        assert set(out.speaker) == {"ann", "bob", "cy"} and len(out) == 18 and set(out.conv_id) == {1}
        ann = out[out.speaker == "ann"].sort_values("start")
        text = "".join(ann.rendered)
        assert text.startswith("<|user name=cy|>\nx<|end|>\n<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user name=bob|>\n<|end|>\n")
        assert [text[r.content_start : r.end] for r in ann.itertuples() if r.mask] == ["hi<|end|>\n", "bye<|end|>\n", "bye<|end|>\n"]
    assert chat_perspective.rotate_perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == before.columns and docs.count() > 0
        if name != "mixing":
            assert docs.count() <= before.count() and docs.select("doc_id").distinct().count() == docs.count()
    n = docs.groupBy("doc_id").count().toPandas()
    assert collections.Counter(got.doc_id) == dict(zip(n.doc_id, n["count"])) and n["count"].max() <= 2
    fps = simhash_dedup.near_duplicates(docs.dropDuplicates(["doc_id"]))
    assert fps.filter("doc_id <> component_id").count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_rows(spark, odd, none, name, stage):
    frame = odd.select("doc_id", "text", "lang", "source", "kept", "size")
    out = stage(spark, frame, SMALL)
    got = collections.Counter((r.doc_id, getattr(r, "text", None)) for r in out.collect())
    rows = collections.Counter((r[0], r[1]) for r in ODD)
    if name == "quality":  # all others have under 50 words; the long text repeats its windows
        assert set(got) == set()
    elif name == "toxicity":
        assert got == rows
    elif name == "near_duplicates":
        assert got == collections.Counter({k: 1 for k in rows if k[0] not in (3, 6)})
    elif name == "mixing":
        taken = {(r.doc_id, r["size"]): r.n_taken for r in fair_mix.mix_sources(frame).collect()}
        assert got == +collections.Counter({k: n * taken[k[0], len((k[1] or "").split())] for k, n in rows.items()})
    else:
        assert collections.Counter(r.doc_id for r in out.collect()) == collections.Counter(r[0] for r in ODD)
    assert stage(spark, none, SMALL).count() == 0


def test_extra_columns_survive_every_stage(spark):
    """Columns with the names of inner ones, of counts and of verdicts come out of each stage with their own values."""
    names = ["m", "w", "v_dup", "g_own", "n_words", "N_Symbols", "kept", "Distance", "base_failed", "toxic_score", "size", "bag"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = docs
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.select("doc_id", *names).collect()
        assert got and all(r[n] == f"{n}{r.doc_id}" for r in got for n in names), name
        assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in stage(spark, plain, SF).select("doc_id").collect()), name


def test_near_duplicates_stage_by_brute_force_jaccard(spark, docs):
    def grams(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {i: grams(t) for i, t in zip(docs.doc_id, docs.text)}
    ids = sorted(sets)
    comp = {i: i for i in ids}
    find = lambda i: i if comp[i] == i else find(comp[i])
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * (n := len(x & y)) >= 4 * (len(x) + len(y) - n):
                comp[max(find(a), find(b))] = min(find(a), find(b))
    kept = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [i for i in ids if find(i) == i]


def test_near_copies_not_like_the_first_are_compared(spark):
    """Links run along a chain, so that most pairs with a key's smallest node are not similar."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[12 * k : 12 * k + 200])) for k in range(12)]
    got = simhash_texts.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(k, 0) for k in range(12)]


def test_mixing_stage_takes_each_row_as_often_as_the_mix_says(spark):
    """Rows without an id or a source arrive, and rows that share an id but differ in source or size have their own verdicts."""
    rows = [(None if i % 3 == 0 else i // 4, "w " * (1 + i % 7), "en", (None, "a", "b", "c")[i % 4]) for i in range(120)]
    frame = spark.createDataFrame(rows, SCHEMA)
    verdicts = {(r.doc_id, r.source, r["size"]): r.n_taken for r in fair_mix.mix_sources(frame).collect()}
    want = collections.Counter()
    for i, text, _, source in rows:
        want[(i, source, len(text.split()))] += verdicts[(i, source, len(text.split()))]
    got = collections.Counter((r.doc_id, r.source, len(r.text.split())) for r in corpus_pipeline.mixing(spark, frame, SF).collect())
    assert got == +want and any(k[0] is None for k in got) and len(set(verdicts.values())) > 1


@pytest.mark.parametrize("big", [256, 3])
def test_near_texts_of_edited_families(spark, big):
    """Families of edited copies, with components both above and below the bound of big ones, against brute force."""
    rng = np.random.default_rng(8)
    rows = []
    for family in range(4):
        base = [f"f{family}w{rng.integers(0, 10**6)}" for _ in range(150)]
        for _ in range(12):
            words = list(base)
            for at in rng.integers(0, 150, rng.integers(0, 6)):
                words[at] = f"e{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(words)))
    sets = [frozenset(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)) for _, t in rows]
    comp = list(range(len(rows)))
    find = lambda i: i if comp[i] == i else find(comp[i])
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                comp[max(find(i), find(j))] = min(find(i), find(j))
    got = {r.doc_id: r.component_id for r in simhash_texts.near_texts(spark.createDataFrame(rows, "doc_id long, text string"), big=big, dense_rows=big).collect()}
    assert got == {i: find(i) for i in range(len(rows))}


def test_signature_by_brute_force():
    words = simhash_texts.shingles(b"a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3)
    got = simhash_texts.margins(words, 3)
    want = []
    for k in (1, 2, 3):
        mixed = []
        for h in words.tolist():
            x = (h + k * 0x9E3779B97F4A7C15) % 2**64
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
            x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
            mixed.append(x ^ x >> 31)
        want += [2 * sum(x >> b & 1 for x in mixed) - len(mixed) for b in range(64)]
    assert got.tolist() == want


def test_near_duplicates_stage_judges_rows(spark):
    """Rows that share an id but not a text, repeated rows and rows without an id."""
    text = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(80))
    rows = [(1, text, "en", "a"), (5, text, "en", "a"), (5, other, "en", "a"), (7, "own words here", "en", "a"), (7, "own words here", "en", "a"), (None, text, "en", "a"), (9, None, "en", "a"), (10, "", "en", "a")]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    assert collections.Counter((r.doc_id, r.text) for r in kept) == collections.Counter([(1, text), (5, other), (7, "own words here"), (None, text), (9, None)])
