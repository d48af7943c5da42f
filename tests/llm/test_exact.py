import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tarmac.llm.exact import (CountingQuotientFilter, drop_duplicates, exact_groups,
                              repeated_fingerprints)
from tarmac.llm.simhash import drop_near_duplicates


def test_filter_round_trip_and_lossless_merge():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 2**64, 500, dtype=np.uint64) for _ in range(4)]
    parts[1][:50] = parts[0][:50]
    parts[2][:20] = parts[2][0]
    merged = CountingQuotientFilter.merge(
        [CountingQuotientFilter.from_bytes(CountingQuotientFilter.of(p).to_bytes()) for p in parts])
    keys, counts = merged.items()
    want = np.unique(np.concatenate(parts), return_counts=True)
    assert (keys == want[0]).all() and (counts == want[1]).all()
    empty = CountingQuotientFilter.of(np.zeros(0, np.uint64))
    assert len(CountingQuotientFilter.merge([empty, empty]).items()[0]) == 0


def test_repeated_fingerprints(spark):
    values = [0, -1, -1, 5, 5, 5, 2**63 - 1, -(2**63), -(2**63)] + list(range(100, 200))
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(4)
    got = {r.fp: r.n for r in repeated_fingerprints(df, 7).collect()}
    assert got == {-1: 2, 5: 3, -(2**63): 2}


def test_groups_against_brute_force(spark, docs_of):
    rng = random.Random(3)
    texts = ["", None, "a", "A", "a ", "é", "long " * 5000]
    rows = [(i, rng.choice(texts)) for i in range(60)] + [(60, "once"), (None, "a"), (None, "lone")]
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    got = {(r.doc_id, r.text_sha256): r for r in exact_groups(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            r = got[i, sha]
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(ids), i == keep)


def test_drop_keeps_columns_and_one_of_repeated_rows(spark, docs_of):
    df = docs_of([(1, "x"), (2, "x"), (2, "x"), (3, None), (4, ""), (5, "y")])
    out = drop_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(2, "x"), (4, ""), (5, "y")]


def test_equal_hashes_of_32_bits_are_not_equal_texts(spark, docs_of):
    """Two texts of one 32-bit hash under null ids, one of them with copies."""
    seen = spark.range(400_000).select(F.concat(F.lit("t"), "id").alias("t")).groupBy(F.hash("t").alias("h")).agg(
        F.collect_list("t").alias("ts")).filter("size(ts) > 1").first()
    a, b = sorted(seen.ts)[:2]
    rows = [(None, a), (None, a), (None, b), (5, a), (5, b), (None, "c")]
    kept = sorted((r.doc_id is None, r.doc_id, r.text) for r in drop_duplicates(docs_of(rows)).collect())
    assert kept == [(False, 5, a), (False, 5, b), (True, None, "c")]
    only = sorted(r.text for r in drop_duplicates(docs_of([(None, a), (None, a), (None, b)])).collect())
    assert only == sorted([a, b])


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1, "x", 5), (2, "x", 6)], "doc_id long, text string, `a.b` int")
    for drop in (drop_duplicates, drop_near_duplicates):
        out = drop(df)
        assert out.columns == df.columns and len(out.collect()) == 1


def test_empty_table(spark, docs_of):
    empty = docs_of([(1, "x")]).filter("false")
    assert exact_groups(empty).count() == 0 and drop_duplicates(empty).count() == 0
