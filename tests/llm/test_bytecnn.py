import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.llm import language, quality
from tarmac.llm.bytecnn import MARGIN, ByteCnn, padded
from tarmac.llm.common import blocks


def test_pooled_equals_a_plain_convolution():
    cnn = ByteCnn((2, 4), 3, 2, seed=1)
    texts = ["", "abc", "héllo wörld " * 40, "x" * 32, "y" * 31]
    for block in blocks(pa.array(texts)):
        flat, first = padded(block, 32)
        got = cnn.pooled(flat, 32)
        assert first[-1] == len(got)
        for unit in range(len(got)):
            for i, table in enumerate(cnn.tables):
                best = np.full(3, -np.inf)
                for p in range(unit * 32, unit * 32 + 32):
                    best = np.maximum(best, sum(table[j][flat[p + j]] for j in range(len(table))))
                assert np.allclose(got[unit, 3 * i:3 * i + 3], best, atol=1e-5)


def test_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(0)
    x = rng.integers(97, 123, (200, 64 + MARGIN)).astype(np.uint8)
    y = (np.arange(200) % 2).astype(np.int64)
    x[y == 1, 20] = 33
    cnn = ByteCnn((2,), 8, 2)
    cnn.fit(x, y, np.ones(200), epochs=15)
    flat = np.concatenate([x[:, :64].ravel(), np.zeros(MARGIN, np.uint8)])
    assert (cnn.logits(cnn.pooled(flat, 64)).argmax(axis=1) == y).mean() > 0.95


def prose(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(0)
    rows = [(i, prose(rng, rng.randint(5, 300)), 1) for i in range(150)]
    rows += [(i, prose(rng, rng.randint(5, 300)).upper().replace(" ", "!! "), 0) for i in range(150, 200)]
    return rows


def test_quality_held_out(spark, judged):
    docs = spark.createDataFrame(judged, "doc_id long, text string, score int")
    labels = docs.selectExpr("doc_id", "score AS quality").filter("doc_id % 3 != 0")
    model = quality.fit_quality(docs, labels, epochs=8)
    rows = docs.select("*", quality.quality_score(model, F.col("text")).alias("p")).collect()
    out = [(r.p >= 0.5) == r.score for r in rows if r.doc_id % 3 == 0]
    assert sum(out) / len(out) > 0.95
    edge = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "é" * 100_000)], "doc_id long, text string")
    got = [r.p for r in edge.select(quality.quality_score(model, F.col("text")).alias("p")).collect()]
    assert all(0 <= p <= 1 for p in got) and got[0] == got[1] == got[2]
    assert edge.filter("false").select(quality.quality_score(model, F.col("text"))).count() == 0


def test_every_chunk_of_a_long_text_counts():
    model = quality.QualityModel(ByteCnn(quality.WIDTHS, quality.FILTERS, 2), None, 0.5)
    texts = ["a" * n for n in (0, 1, 120, 128, 129, 1000)]
    plain = model.features(pa.array(texts))
    # a text in a batch of others has the features it has alone
    for i, t in enumerate(texts):
        assert np.allclose(plain[i], model.features(pa.array([t]))[0], atol=1e-5)
    late = model.features(pa.array(["a" * 1000 + "!Z"]))[0]
    assert not np.allclose(late, plain[-1])


def test_quality_without_both_classes(spark, judged):
    docs = spark.createDataFrame(judged[:20], "doc_id long, text string, score int")
    none = docs.selectExpr("doc_id", "score AS quality").filter("false")
    assert quality.fit_quality(docs, none).constant == 0.5
    one = quality.fit_quality(docs, docs.selectExpr("doc_id", "score AS quality"))
    assert one.cnn is None and 0.9 < one.constant < 1


LETTERS = {"xx": "abcde", "yy": "fghij", "zz": "éèàçk"}


def test_language_held_out_and_edges(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(1, 200), LETTERS[lang]), lang)
            for i, lang in enumerate(["xx", "yy", "zz"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit_language(docs.filter("doc_id % 4 != 0"), epochs=5)
    got = docs.select("*", language.language(model, F.col("text")).alias("f")).collect()
    out = [r.f.lang == r.lang for r in got if r.doc_id % 4 == 0]
    assert sum(out) / len(out) > 0.95
    edge = spark.createDataFrame([(1, None), (2, ""), (3, "123 --"), (4, "a")], "doc_id long, text string")
    found = [r.f.lang for r in edge.select(language.language(model, F.col("text")).alias("f")).collect()]
    assert found[:3] == ["und"] * 3 and found[3] in LETTERS
    nothing = language.fit_language(docs.filter("false"))
    assert edge.select(language.language(nothing, F.col("text")).alias("f")).first().f.lang == "und"
