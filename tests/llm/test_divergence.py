import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tarmac.llm import divergence
from tarmac.llm.divergence import _f, _share, divergence as audit, shares

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top):
    """{(lang, source, part): [(item, value), ...]} with plain integers."""
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(words)
        in_docs[lang].update(set(words))
    out = {}
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        own = {s: counts[lang, s] for g, s in groups if g == lang}
        whole = sum(own.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept))

        share = {s: {t: p(c, t) for t in kept} for s, c in own.items()}
        base = {t: p(whole, t) for t in kept}
        for s in own:
            pairs = [(o, sum((share[s][t] - share[o][t]) ** 2 // (share[s][t] + share[o][t]) for t in kept))
                     for o in own if o != s]
            terms = [(t, (share[s][t] - base[t]) ** 2 // (share[s][t] + base[t])) for t in kept
                     if own[s][t] > 0 and share[s][t] > base[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                if items:
                    items.sort(key=lambda x: (-x[1], x[0].encode()))
                    out[lang, s, part] = items[:limit]
    return out


def rows_of(df):
    out = defaultdict(dict)
    for r in df.collect():
        assert r.rank not in out[r.lang, r.source, r.part]
        out[r.lang, r.source, r.part][r.rank] = (r.item, r.value)
    return {k: [v[i] for i in range(1, len(v) + 1)] for k, v in out.items()}


def corpus(n=260, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["É", "é", "日本", "A", "a"]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "en", "de", None, ""])
        source = rng.choice(["hot"] * 6 + [f"s{i}" for i in range(9)] + [None])
        words = [vocabulary[min(int(rng.expovariate(0.02)), len(vocabulary) - 1)] for _ in range(rng.randrange(60))]
        rows.append((lang, source, rng.choice([" ", "-9-", "\x7f"]).join(words)))
    return rows + [("fr", "x", "rare"), ("fr", "y", None), ("fr", None, ""), ("it", "alone", "uno"),
                   ("en", "no words", "12 34"), *[("en", "copies", "same same text")] * 30]


@pytest.mark.parametrize("tile, shift, at_once", [(64, 12, 1 << 20), (2, 6, 7)])
def test_against_brute_force(spark, monkeypatch, tile, shift, at_once):
    # Small tiles, blocks and steps give the same rows as large ones.
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK_SHIFT", shift)
    rows = corpus()
    df = spark.createDataFrame([(i, *r, "x", 1) for i, r in enumerate(rows)],
                               "doc_id long, lang string, source string, text string, term string, n int")
    if at_once < 100:
        rows_, joint = rows, divergence._joint
        group = divergence._Group
        rng = np.random.default_rng(1)

        def made(name, total):
            word = np.sort(rng.integers(0, 9, 20))
            return group(name, word, rng.integers(0, 2**64, 20, dtype=np.uint64), rng.integers(1, 9, 20), total, 400)

        one, others = made("a", 900), [made("b", 50), made("c", 7000)]
        want = joint(one, others, 700)
        monkeypatch.setattr(divergence, "AT_ONCE", at_once)
        assert (joint(one, others, 700) == want).all()
    assert rows_of(audit(df.repartition(4), min_docs=10, top=10)) == brute(rows, 10, 10)


def test_shares_are_exact_beyond_a_bigint_product(spark):
    cases = [(0, 0, 1), (5, 10, 3), (10**12, 10**13 + 7, 12345), (9 * 10**14, 9 * 10**14, 10**6), (0, 9 * 10**15, 1)]
    df = spark.createDataFrame(cases, "c long, t long, v long").select(_share("c", "t", "v").alias("p"))
    want = [1 + 10**9 * (c + 2) // (t + 2 * v) for c, t, v in cases]
    assert [r.p for r in df.collect()] == want
    assert [int(shares(np.array([c]), t, v)[0]) for c, t, v in cases] == want
    assert _f(np.array([10**9 + 1]), np.array([1])).tolist() == [10**18 // (10**9 + 2)]


def test_long_text_and_no_terms(spark):
    schema = "lang string, source string, text string"
    long = [("en", "a", "deep sea " * 50_000)] * 3 + [("en", "b", "Deep sky")] * 8
    assert rows_of(audit(spark.createDataFrame(long, schema))) == brute(long, 10, 10)
    few = [("en", s, "only once") for s in "abc"]
    assert rows_of(audit(spark.createDataFrame(few, schema))) == brute(few, 10, 10)
    assert audit(spark.createDataFrame([], schema)).count() == 0
