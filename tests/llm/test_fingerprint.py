import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarmac.llm import fingerprint


def bag(text):
    return Counter(w for w in re.split(r"[\s!-/:-@\[-`{-~]+", (text or "").lower()) if w)


def jaccard(a, b):
    a, b = bag(a), bag(b)
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def edited(text, following):
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(0)
    vocab = [f"w{i}" for i in range(60)] + ["é", "日本"]
    out = [(i * 7, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 120)))) for i in range(120)]
    return out + [(-3, None), (-2, ""), (1000, out[5][1]), (1001, out[5][1]), (None, "last of all")]


def test_contract(spark, rows):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, place string").repartition(4)
    got = {r.doc_id: r for r in fingerprint.fingerprints(df).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)]
        text, nxt = t or "", following[1] or ""
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited(text, nxt).encode()).hexdigest()

        def near(a, b):
            return sum(a[8 * j:8 * j + 8] == b[8 * j:8 * j + 8] for j in range(32)) / 32
        assert r.near_edited == near(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == near(r.fingerprint, got[following[0]].fingerprint)
    assert got[1000].fingerprint == got[1001].fingerprint == got[35].fingerprint
    assert got[-3].fingerprint == got[-2].fingerprint


def test_collision_rate_is_generalised_jaccard(spark):
    a = " ".join(["x"] * 10 + ["y"] * 3 + ["z"] * 5 + [f"a{i}" for i in range(20)])
    b = " ".join(["x"] * 4 + ["y"] * 6 + ["q"] * 5 + [f"a{i}" for i in range(12)])
    df = spark.createDataFrame([(1, a), (2, b)], "id long, text string")
    rows = {r.id: r.signature for r in fingerprint.signatures(df, ["id"], 256).collect()}
    same = sum(rows[1][8 * i:8 * i + 8] == rows[2][8 * i:8 * i + 8] for i in range(256)) / 256
    assert abs(same - jaccard(a, b)) < 0.1


def test_one_row_empty_and_repeated(spark):
    df = spark.createDataFrame([(5, "ab cd")], "doc_id long, text string")
    r = fingerprint.fingerprints(df).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()
    assert fingerprint.fingerprints(df.filter("false")).count() == 0
    twice = fingerprint.fingerprints(df.union(df)).collect()
    assert len(twice) == 2 and twice[0].fingerprint == twice[1].fingerprint == r.fingerprint


def test_main_path_has_no_python(spark, rows):
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    plan = fingerprint.fingerprints(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_ranges(spark):
    for n in (1, 2, 5, 16):
        ids = spark.range(100).selectExpr("id * 3 AS ord")
        bounds = fingerprint._ranges(ids, n)
        parts = {r.ord: r.p for r in ids.select("ord", fingerprint._range_of(F.col("ord"), bounds).alias("p")).collect()}
        real = [b for b in bounds if b < 2**62]
        assert all(p == sum(b <= i for b in real) for i, p in parts.items())
