"""Fill-in-middle, personal data and hard negatives against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadlake.llm import fill_middle, hard_negatives, personal_data, queries

SMALL = "/root/testdata/sf0.001"


def held_to_oracle(spark, name, table, keys):
    got = queries.queries()[name](spark, SMALL).toPandas()
    want = duckdb.sql(queries.oracle_sql()[name].replace(f"FROM {table}", f"FROM read_parquet('{SMALL}/{table}.parquet')")).df()
    ours, theirs = (x.sort_values(keys).reset_index(drop=True)[sorted(x.columns)] for x in (got, want))
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False)
    return got


def test_fill_in_middle(spark):
    got = held_to_oracle(spark, "op11_fill_middle", "documents", ["doc_id"])
    docs = pd.read_parquet(f"{SMALL}/documents.parquet").set_index("doc_id")
    assert set(got.form) == {"plain", "psm", "spm"}
    assert all(r.restored_sha256 == hashlib.sha256(docs.text[r.doc_id].encode()).hexdigest() for r in got.itertuples())


def test_fill_in_middle_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(fill_middle, "PIECE", 50)
    texts = ["", None, "<P>", "a<", "S>b", "é\U0001f600x\n\t", "a" * 300, "word, plain " * 40, "1" * 120, "a<S" * 30, "<" * 70, "word, plain " * 40]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "one two", 1, "x"), (3, "a<", 1, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n int, output string")
    made = fill_middle.fill_in_middle(frame, keep=["doc_id", "text", "n"])
    got = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        h = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        plain = not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90
        want = text if plain else f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
        assert (r.n, r.output, r.back) == (len(units), want, text)
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if plain else (len(p), len(m)))
    assert fill_middle.fill_in_middle(frame.limit(0)).count() == 0


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def sound(kind, said):
    digits = re.sub("[^0-9]", "", said)
    luhn = sum((v := int(c) * (1 + i % 2)) - 9 * (v > 9) for i, c in enumerate(reversed(digits))) % 10 == 0
    return [True, all(int(x) <= 255 for x in said.split(".")) if kind == 1 else True, 13 <= len(digits) <= 19 and luhn, 9 <= len(digits) <= 15][kind]


def brute_spans(text):
    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if sound(k, m[0])]


def odd_texts():
    rng = random.Random(1)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randint(0, n)))
    out = [draw(s, 60) for s in ("aB1 .-+@(%_:=0é\n9,\U0001f600", "0123456789 -", "1.25 ", "a@.b_%", "+1 ()-.9") for _ in range(250)]
    long_ones = ["1.2.3.4 " * 3000, "a" * 100_000, "1" * 50_000, "1 " * 30_000, "a.b" * 5000 + "@" + "c.d" * 5000, "+1" + " " * 30_000, "a@b.c_d@e.f%g@h.i " * 1000, "+" * 50_000, "call 1, " * 5000]
    return [*out, *long_ones, None, "", "4111 1111 1111 1111", "x@y.z", "é@y.z 000255.1.2.3 256.1.1.1.1"]


def test_base_spans(spark):
    rows = [(i, t, "x", 2) for i, t in enumerate(odd_texts())] + [(None, "x@y.z", "x", 2), (None, None, "x", 2), (None, "1.2.3.4", "x", 2), (5, "x@y.z", "x", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string, found int")
    # python's own search for emails begins again in every place of a long run
    got = personal_data.find_personal_data(frame, keep=["doc_id", "text", "key", "found"]).collect()
    assert len(got) == len(rows)
    for r in got:
        want = [] if r.text and set(r.text) in ({"a"}, {"+"}) else brute_spans(r.text)
        assert [tuple(s) for s in r.base] == want, r.text[:80]
        assert r.key == "x" and r.found == []
    assert personal_data.find_personal_data(frame.limit(0)).count() == 0


def test_query_digests(spark):
    got = queries.op12_personal_data(spark, SMALL).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    for d, text in zip(docs.doc_id, docs.text):
        want = brute_spans(text)
        said = ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for k, a, b in want)
        assert got.base_sha256[d] == hashlib.sha256(said.encode()).hexdigest()
        assert list(got.loc[d, ["n_email", "n_ip", "n_card", "n_phone"]]) == [sum(k == i for k, _, _ in want) for i in range(4)]
        assert set(said.split(",")) <= set(got.spans[d].split(",")) and (got.n_found[d] or got.spans[d] == said)


def brute_found(texts):
    """The method over dictionaries, for texts in which each slot stands alone between words."""
    places = []
    for d, text in enumerate(texts):
        cut = [(m.start(), m.end()) for m in re.finditer(r"(?<!\S)[^\s0-9@]*[0-9@]\S*(?: [^\s0-9@]*[0-9@]\S*)*", text)]
        for i, (a, b) in enumerate(cut):
            if not 4 <= b - a <= 64:
                continue
            before = re.findall(r"[a-z]+|[0-9]+|[^a-z0-9\s]", text[cut[i - 1][1] if i else 0 : a].lower()[-96:])
            after = re.findall(r"[a-z]+|[0-9]+|[^a-z0-9\s]", text[b : cut[i + 1][0] if i + 1 < len(cut) else None].lower()[:96])
            left, right = ["^"] * 3 + before, [*after, "$", "$"]
            l1, l2, l3, r1, r2 = left[-1], left[-2], left[-3], right[0], right[1]
            patterns = {f"{l1} _", f"{l2} {l1} _", f"{l3} {l2} {l1} _", f"{l1} _ {r1}", f"_ {r1} {r2}"}
            places.append((d, a, b, text[a:b].lower(), frozenset(k for k, _, _ in brute_spans(text[a:b])), patterns))
    seeds = {i: s for _, _, _, i, s, _ in places}
    edges = collections.defaultdict(set)
    for _, _, _, i, _, ps in places:
        for p in ps:
            edges[p].add(i)
    share = [sum(k in s for s in seeds.values()) / max(1, len(seeds)) for k in range(4)]
    held = {(p, k): sum(k in seeds[i] for i in members) for p, members in edges.items() for k in range(4)}
    able = {pk: n for pk, n in held.items() if n >= 3}
    sure = lambda gained: {(p, k): c for (p, k), n in able.items() if (c := (n + gained.get((p, k), 0) + 2 * share[k]) / (len(edges[p]) + 2)) >= 0.5}
    scored = sure({})
    for _ in range(2):
        score = {(i, k): 1 - math.prod(1 - scored[p, k] for p in edges if i in edges[p] and (p, k) in scored) for i in seeds if not seeds[i] for k in range(4)}
        gained = {(p, k): sum(score[i, k] for i in edges[p] if not seeds[i] and score[i, k] >= 0.8) for p, k in able}
        scored = sure(gained)
    out = set()
    for d, a, b, _, s, ps in places:
        doubts = sorted((math.prod(1 - scored[p, k] for p in ps if (p, k) in scored), k) for k in range(4) if any((p, k) in scored for p in ps))
        if not s and doubts and 1 - doubts[0][0] >= 0.8:
            out.add((d, doubts[0][1], a, b))
    return out


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(7)
    words = "the of river stone cloud green paper house night table water glass".split()
    talk = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = []
    for i in range(60):
        kind = i % 3
        said = [f"please mail user{i}@host.example", f"my desk phone is +1 (555) 010-{1000 + i}", f"server runs at 10.1.2.{i}"][kind]
        texts.append(f"{talk(9)} {said} {talk(6)}")
        texts.append(f"{talk(7)} {rng.randint(1000, 99999)} {talk(5)}")
    hidden = ["please mail user77@localhost", "my desk phone is 555 0199 777", "server runs at 2001:db8::17"]
    texts += [f"{talk(8)} {h} {talk(4)}" for h in hidden] + [texts[0]] * 20
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, s.kind, s.start, s.end) for r in personal_data.find_personal_data(frame).collect() for s in r.found}
    assert got == brute_found(texts)
    found = {(k, texts[d][a:b]) for d, k, a, b in got}
    assert found == {(0, "user77@localhost"), (3, "555 0199 777"), (1, "2001:db8::17")}


def test_hard_negatives(spark):
    got = held_to_oracle(spark, "op13_hard_negatives", "embeddings", ["anchor_id", "positive_id", "rank"])
    assert len(got) > 50


def test_hilbert_places_are_neighbours():
    for dims, bits in ((2, 3), (3, 2), (5, 2)):
        cells = np.array(list(itertools.product(range(2**bits), repeat=dims)))
        place = hard_negatives.hilbert_place(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


def brute_mine(rows):
    sound_rows = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, lab, v in rows if i is not None and lab is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in (r for r in sound_rows if r[0] % 100 == 0):
        scored = sorted(((-sum(x * y for x, y in zip(a[2], o[2])), o[0], o) for o in sound_rows if o != a and len(o[2]) == len(a[2])), key=lambda s: s[:2])
        positives = [s for s in scored if s[2][1] == a[1]][:5]
        for p in positives:
            negatives = [s for s in scored if s[2][1] != a[1] and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:5]
            out += [(a[0], p[1], n + 1, s[1], -p[0], -s[0]) for n, s in enumerate(negatives)]
    return sorted(out)


@pytest.mark.parametrize("spread", [1.0, 30_000.0])
def test_hard_negatives_by_brute_force(spark, monkeypatch, spread):
    """Clustered vectors in small blocks, so that zone maps choose; large components leave the doubles."""
    for name, value in (("BLOCK", 16), ("CHUNK", 2), ("GROUP", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8)) * spread
    rows = [(i, int(i % 4), [float(x) for x in centres[i % 6] + rng.normal(size=8) * 0.2]) for i in range(401)]
    nan, inf = float("nan"), float("inf")
    rows += [rows[0], rows[100], (500, 1, None), (501, None, [1.0] * 8), (None, 1, [1.0] * 8), (502, 1, [nan] * 8), (503, 1, [inf] * 8), (504, 1, [None] * 8), (505, 1, []), (600, 1, [1.0, 2.0]), (601, 1, [1.0, 2.0]), (602, 2, [1.0, 2.0]), (700, 3, [0.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({"block": F.lit(1), "uid": F.lit("x"), "chunk": F.lit(2)})
    got = sorted(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 100 == 0).collect())
    assert got == brute_mine(rows)
    assert hard_negatives.mine(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
