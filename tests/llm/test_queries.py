"""What the queries' contracts fix beside their operators: folds, thresholds and
which rows a model may learn from."""

import math
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tarmac.llm import fingerprint, language, quality, queries, toxicity

SF = "/root/testdata/sf0.001"


def held_out(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


@pytest.mark.parametrize("name, module, fit, folds, fold, limit", [
    ("op1_toxicity", toxicity, "fit_toxicity", 3, 1, 0.7), ("op4_quality", quality, "fit_quality", 5, 0, 0.3)])
def test_labelled_folds_and_thresholds(spark, monkeypatch, name, module, fit, folds, fold, limit):
    real, seen = getattr(module, fit), []
    monkeypatch.setattr(module, fit, lambda docs, labels, *a, **k: seen.append(labels) or real(docs, labels, *a, **k))
    rows = queries.queries()[name](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    for r in rows:
        assert r.held_out == held_out(r.doc_id, folds, fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
    # the model learns from all labels outside the fold and from no other
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in seen[0].select("doc_id").collect()) == sorted(
        r.doc_id for r in labels if not held_out(r.doc_id, folds, fold))


def test_language_folds(spark, monkeypatch):
    real, seen = language.fit_language, []
    monkeypatch.setattr(language, "fit_language", lambda docs, *a, **k: seen.append(docs) or real(docs, *a, **k))
    rows = queries.op2_language(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    langs = {r.lang for r in docs if not held_out(r.doc_id, 4, 2)}
    letters = {r.doc_id: any(c.isalpha() for c in r.text or "") for r in docs}
    for r in rows:
        assert r.held_out == held_out(r.doc_id, 4, 2) and 0 <= r.score <= 1
        assert r.lang_pred in langs if letters[r.doc_id] else r.lang_pred == "und"
    assert sorted(r.doc_id for r in seen[0].select("doc_id").collect()) == sorted(
        r.doc_id for r in docs if not held_out(r.doc_id, 4, 2))


def _hash(value, size, seed):
    raw = xxhash.xxh64_intdigest((value % (1 << 8 * size)).to_bytes(size, "little"), seed)
    return raw - (1 << 64) if raw >> 63 else raw


def brute_signature(text, samples):
    """Consistent weighted samples, position by position, in plain Python."""
    words = Counter(w for w in re.split(r"[\s!-/:-@\[-`{-~]+", text.lower()) if w)
    out = []
    for i in range(samples):
        best = None
        for word, weight in words.items():
            term = xxhash.xxh64_intdigest(word.encode(), 42)
            first, second = (_hash(2 * i + k, 4, _hash(term, 8, 42) % (1 << 64)) % (1 << 64) for k in (0, 1))

            def uniform(bits, width):
                return (bits + 0.5) / (1 << width)
            r = -math.log(uniform(first >> 32, 32) * uniform(first & 0xFFFFFFFF, 32))
            c = -math.log(uniform(second >> 42, 22) * uniform(second >> 21 & (1 << 21) - 1, 21))
            b = uniform(second & (1 << 21) - 1, 21)
            t = math.floor(math.log(weight) / r + b)
            ln_a = math.log(c) - r * (t - b + 1.0)
            low = _hash(t, 8, _hash(term, 8, 42) % (1 << 64)) & 0xFFFFFFFF
            packed = (int((ln_a + 512.0) * (1 << 21)) << 32) | low
            best = packed if best is None else min(best, packed)
        out.append(f"{best & 0xFFFFFFFF:08x}")
    return "".join(out)


def test_fingerprints_against_brute_force(spark):
    texts = ["one two two three three three", "a b c d e f g h a b a", "The the THE, end.", "é ü é 日本 x"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r.signature for r in fingerprint.signatures(df, ["k"]).collect()}
    same = total = 0
    for k, text in enumerate(texts):
        want = brute_signature(text, fingerprint.SAMPLES)
        pairs = [(got[k][i:i + 8], want[i:i + 8]) for i in range(0, len(want), 8)]
        same, total = same + sum(a == b for a, b in pairs), total + len(pairs)
    # a logarithm's last bit may differ between the two languages
    assert same >= total - 2


def test_fingerprint_error_is_that_of_its_samples(spark):
    """Likeness against the generalised Jaccard similarity it estimates."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = fingerprint.fingerprints(docs).select("doc_id", "near_next").collect()
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    near, errors = {r.doc_id: r.near_next for r in rows}, []
    for (i, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        a, b = (Counter(w for w in re.split(r"[\s!-/:-@\[-`{-~]+", t.lower()) if w) for t in (text, after))
        exact = sum((a & b).values()) / max(1, sum((a | b).values()))
        errors.append((near[i] - exact, math.sqrt(exact * (1 - exact) / fingerprint.SAMPLES)))
    assert sum(abs(e) <= 3 * max(s, 0.02) for e, s in errors) >= 0.95 * len(errors)
    assert math.sqrt(sum(e * e for e, _ in errors) / len(errors)) < 0.09


def test_native_queries_run_no_python(spark):
    for name in ("op8_fingerprint", "op13_quality_rules"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
    assert queries.queries()["op13_quality_rules"](spark, SF).filter(F.col("kept")).count() > 100
