import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.llm import toxicity
from tarmac.llm.toxicity import ChainField, _Tokens, _chains, _one_block


def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    field = ChainField()
    field.moves = rng.normal(size=(2, 2))
    score = rng.normal(size=(5, 1))
    real = np.ones((5, 1), bool)
    got, counts = field.forward_backward(score, real, pairs=True)
    weight, total, want, moves = {}, 0.0, np.zeros(5), np.zeros((2, 2))
    for path in itertools.product((0, 1), repeat=5):
        w = np.exp(sum(score[i, 0] * s for i, s in enumerate(path))
                   + sum(field.moves[a, b] for a, b in zip(path, path[1:])))
        weight[path], total = w, total + w
        want += w * np.array(path)
        for a, b in zip(path, path[1:]):
            moves[a, b] += w
    assert np.allclose(got[:, 0], want / total) and np.allclose(counts, moves / total)


def test_padding_is_clean_and_chains_are_independent():
    rng = np.random.default_rng(1)
    field = ChainField()
    field.moves = rng.normal(size=(2, 2))
    score = rng.normal(size=(6, 2))
    real = np.ones((6, 2), bool)
    real[4:, 1] = False
    both, _ = field.forward_backward(score, real)
    for c in range(2):
        alone, _ = field.forward_backward(score[:, c:c + 1], real[:, c:c + 1])
        assert np.allclose(both[:, c], alone[:, 0])


def test_chains_start_with_rows():
    first = np.array([0, 3, 3, 3 + toxicity.CHAIN + 2])
    chain, step, n = _chains(first)
    assert n == 3 and chain[:3].tolist() == [0, 0, 0] and step[:3].tolist() == [0, 1, 2]
    assert chain[3] == 1 and chain[-1] == 2 and step[-1] == 1


def test_tokens_ignore_outer_punctuation_and_case():
    a = _Tokens(_one_block([b"Scum! (scum), SCUM x"]))
    assert (a.features[0] == a.features[1]).all() and (a.features[1] == a.features[2]).all()
    assert (a.features[0] != a.features[3]).any()
    assert len(_Tokens(_one_block([b"", b" !"])).start) == 1


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(0)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    out = []
    for i in range(400):
        words = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                bad = rng.choice(["scumm", "idiott", "verbl" + rng.choice(["en", "ung", "er", "ade"])])
                words.insert(rng.randint(0, len(words)), bad)
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_held_out_documents_and_spans(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(docs, docs.select("doc_id", "toxic").filter("doc_id % 3 != 1"))
    got = docs.select("*", toxicity.toxicity(model, F.col("text")).alias("f")).collect()
    right = [(r.f.score >= 0.7) == bool(r.toxic) for r in got if r.doc_id % 3 == 1]
    assert sum(right) / len(right) > 0.97
    for r in got:
        for s in r.f.spans:
            words = r.text[s.start:s.stop].split()
            assert words and any(w in ("scumm", "idiott") or w.startswith("verbl") for w in words)
    scores, spans = model.tag(pa.array(["é scumm, é", "", "abc"]))
    assert [(s["start"], s["stop"]) for s in spans[0]] == [(2, 8)]
    assert scores[0] > 0.7 and scores[1] < 0.3 and not spans[1]


def test_edges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    none = toxicity.fit_toxicity(docs, docs.select("doc_id", "toxic").filter("false"))
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [r.f.score for r in df.select(toxicity.toxicity(none, F.col("text")).alias("f")).collect()] == [0.5, 0.5]
    assert df.filter("false").select(toxicity.toxicity(none, F.col("text"))).count() == 0
