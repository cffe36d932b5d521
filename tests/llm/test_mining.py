"""Exact duplicates, phrases and hard negatives against brute force, on odd rows too."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import SF_DIR, same
from pyspark.sql import functions as F

from mereflow.llm import exact, negatives, phrases, queries

LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
ODD = ["", None, " ", "\x00", "a", "A", "é" * 300, "É" * 300, "word " * 400, "WORD " * 400, "x" * 300_000, "x" * 299_999 + "y", "日本語 １２", "a\x1cb  c", "😀 hi", "A B C D E F", "a b c d e f"]
CLASH = ("lang", "source", "n", "h", "k", "size", "row", "full", "head", "n_bytes", "kept", "keep_id", "group_size", "at", "bucket")


def low(text):
    return (text or "").encode().translate(LOW)


@pytest.mark.parametrize("name", ["op11_collocations", "op12_hard_negatives", "op13_exact_dedup"])
def test_against_sql(spark, duck, name):
    same(queries.QUERIES[name](spark, SF_DIR), duck, queries.ORACLE[name])


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in CLASH})


def test_exact_groups_of_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, t) for i, t in enumerate(ODD[:5])] + [(None, "a"), (7, "other"), (7, "other"), (None, None)]
    rows += [(1000 + i, "Hot Text" if i % 2 else "hot text") for i in range(300)]
    by = defaultdict(list)
    for i, t in rows:
        by[low(t)].append(i)
    got = exact.groups(docs_of(spark, rows), "text", digest=True).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = by[low(r.text)]
        assert (r.keep_id, r.group_size) == (max((i for i in ids if i is not None), default=None), len(ids))
        assert bytes(r.text_sha256) == hashlib.sha256(low(r.text)).digest()
    kept = Counter(low(r.text) for r in got if r.kept)
    assert kept == Counter(by.keys()) and all(r.doc_id == r.keep_id for r in got if r.kept)
    whole = docs_of(spark, rows)
    out = exact.dedup(whole)
    assert out.columns == whole.columns and Counter(low(r.text) for r in out.collect()) == kept
    assert exact.groups(docs_of(spark, rows[:0])).count() == exact.dedup(docs_of(spark, rows[:0])).count() == 0


def test_exact_groups_do_not_trust_beginnings(spark):
    """Equal lengths and equal beginnings, different ends; and a bitmap in which every bit is set."""
    rows = [(i, "s" * 400 + f"{i % 50:03d}") for i in range(200)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.groups(docs_of(spark, rows)).collect()}
    assert got == {i: (150 + i % 50, 4, i >= 150) for i in range(200)}
    assert exact.survivors(docs_of(spark, rows)).collect()[0].n == 200


def plain_phrases(rows, support, most, longest=3, share=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", low(text)):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= support}
        inside = defaultdict(int)
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        best = []
        for p, a in cand.items():
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            if 100 * inside[p] < share * a:
                best.append((-score, -a, b" ".join(p), c[p[:k]], c[p[k:]]))
        out |= {(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(best)[:most], 1)}
    return out


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "New", "york", "city", "Ünï", "x" * 40, "über", "a\x1cb", "1", "日本"] + [f"w{i}" for i in range(30)]
    join = [" ", "  ", "\t", ", ", ". ", "\n", " \x0b ", ";", " "]
    out = [(rng.choice(["en", "de", None, "en"]), "".join(rng.choice(words[: rng.choice([4, 12, 40])]) + rng.choice(join) for _ in range(rng.randrange(80)))) for _ in range(n)]
    return out + [("en", t) for t in ODD] + [("fr", None), (None, ""), ("xx", " \t,.")]


@pytest.mark.parametrize("support,most,shards", [(10, 2000, 4), (3, 5, 2), (25, 50, 9), (1, 40, 3)])
def test_phrases(spark, support, most, shards):
    rows = texts(support, 120)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(7).withColumns({c: F.lit("x") for c in CLASH if c != "lang"})
    got = phrases.collocations(df, support, most=most, shards=shards).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == plain_phrases(rows, support, most)


def test_phrases_across_blocks(spark, monkeypatch):
    """Texts that are taken in parts and blocks that are emitted often give the same phrases, and so does a hot word."""
    words = "one two three four five six seven".split()
    rng = random.Random(5)
    rows = [("en", " ".join(rng.choice(words) for _ in range(5000))), ("en", "hot word " * 4000), ("de", "hot word. " * 30), ("en", ",".join(["a b"] * 500))]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    small = lambda f: (lambda *a: _small(f(*a)))

    def _small(run):
        def inner(batches):
            phrases.PART_BYTES, phrases.BLOCK_WORDS = 100, 70
            yield from run(batches)

        return inner

    monkeypatch.setattr(phrases, "_mine", small(phrases._mine))
    monkeypatch.setattr(phrases, "_count", small(phrases._count))
    assert {tuple(r) for r in phrases.collocations(df, 10).collect()} == plain_phrases(rows, 10, 2000)


def test_phrases_of_nothing(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")).count() == 0
    with pytest.raises(ValueError):
        phrases.collocations(none, longest=4)


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_000_001
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 5), ("en", "a b", 2, big - 7)], "lang string, phrase string, size int, f long")
    assert phrases.scored(counts).first().score == 10**6 * (big - 7) ** 2 // (big * (big + 5))


def plain_negatives(rows, anchors, k=5, low_=80, high=100):
    def q(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * x) for x in v]

    own = [(i, label, q(v)) for i, v, label in rows if i is not None and label is not None and q(v) is not None]
    asked = {(i, label, tuple(v)) for i, label, v in own if i in anchors}
    out = []
    for a, label, v in asked:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, other, w in own if i != a and len(w) == len(v))
        for ps, p, _ in [x for x in scored if x[2]][:k]:
            fits = [x for x in scored if not x[2] and low_ * -ps <= 100 * -x[0] <= high * -ps][:k]
            out += [(a, p, r, i, -ps, -s) for r, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3).withColumns({c: F.lit("x") for c in (*CLASH, "q", "dims", "low", "high", "longest", "length", "data")})


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_negatives(spark, monkeypatch, spread):
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = [(i, [x * rng.choice([1, 1, 3]) + rng.gauss(0, spread) for x in centres[i % 4]], (i * 7 // 5) % 3) for i in range(400)]
    rows += [rows[0], rows[5], rows[5], (500, [0.0] * 8, 1), (501, [0.0] * 8, 2), (502, None, 1), (503, [None] * 8, 1), (504, [float("nan")] * 8, 1), (505, [float("inf")] * 8, 1), (None, [1.0] * 8, 1), (506, [1.0] * 8, None), (507, [1.0, 2.0], 1), (508, [1.0, 1.9], 2), (509, [1.0, 2.0], 1), (510, [], 1), (511, [], 2), (512, [], 1)]
    rows += [(600 + i, rows[8][1], i % 2) for i in range(60)]
    anchors = {*range(0, 400, 25), 500, 501, 502, 506, 507, 510, 600}
    monkeypatch.setattr(negatives, "BUCKET_ROWS", 64)
    df = vectors_of(spark, rows)
    got = negatives.mine(df, df.where(F.col("vec_id").isin(*anchors)))
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, anchors)


def test_negatives_of_huge_components_and_nothing(spark):
    rows = [(0, [1e12, 1.0], 0), (1, [1e12, 3.0], 0), (2, [1e12, 2.0], 1), (3, [9e11, 1e3], 1), (4, [-1e12, 0.0], 1)]
    got = [tuple(r) for r in negatives.mine(vectors_of(spark, rows), vectors_of(spark, rows[:1])).collect()]
    top = (1 << 63) - 1
    assert got == [(0, 1, 1, 2, top, top), (0, 1, 2, 3, top, top)] and len(plain_negatives(rows, {0})) == 2
    assert negatives.mine(vectors_of(spark, []), vectors_of(spark, [])).count() == 0
    assert negatives.mine(vectors_of(spark, rows), vectors_of(spark, [])).count() == 0
    assert negatives.mine(vectors_of(spark, []), vectors_of(spark, rows)).count() == 0


def test_coordinate_lists_leave_out_rows_that_cannot_reach(spark):
    """No row that reaches the threshold is missed, and in clustered vectors most others are not scored."""
    import numpy as np

    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    q = np.floor(256 * (centres[rng.integers(20, size=3000)] + rng.normal(size=(3000, 16)) * 0.1)).astype(np.int64)
    q = q[np.argsort(-(q**2).sum(1), kind="stable")]
    buckets = []
    for a in range(0, 3000, 250):
        bucket = negatives._Bucket.__new__(negatives._Bucket)
        bucket.ids, bucket.q = np.arange(a, a + 250), q[a : a + 250]
        bucket.exact = bucket.q.astype(float)
        size = np.sqrt((bucket.exact**2).sum(1))
        bucket.longest, bucket.largest, bucket.unit = size.max(), np.abs(bucket.q).max(), bucket.exact / size[:, None]
        bucket.order = np.argsort(bucket.unit, 0).astype(np.int32)
        buckets.append(bucket)
    asked = 0
    for i in range(0, 3000, 100):
        scores = q @ q[i]
        least = float(np.sort(scores)[-20])
        found = np.concatenate([b.ids[b.candidates(q[i], least)] for b in buckets])
        asked += len(found)
        assert set(np.flatnonzero(scores >= least)) <= set(found.tolist())
    assert asked < 0.3 * 30 * 3000
