import random

import numpy as np

from tarmac.llm.common import Block
from tarmac.llm.substring import _paths, _smallest, remove_repeats, result_column


def brute(rows, window):
    """(words, kept words) by row."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        if i is None:
            continue
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def check(docs_of, rows, window=50, seed_words=10):
    df = docs_of(rows)
    out = remove_repeats(df, window=window, seed_words=seed_words)
    name = result_column(df)
    got = [(r.doc_id, r[name].n_words, r[name].n_removed, r[name].kept) for r in out.collect()]

    def key(x):
        return (x[0] is None, x[0] or 0, x[3])
    assert sorted(got, key=key) == sorted(brute(rows, window), key=key)
    return out, df


def test_planted_repeats(spark, docs_of):
    rng = random.Random(0)
    vocab = [f"w{i}" for i in range(200)] + ["é", "The", "the"]

    def prose(n):
        return [rng.choice(vocab) for _ in range(n)]
    shared = prose(130)
    rows = []
    for i in range(40):
        w = prose(rng.randint(0, 200))
        if i % 3 == 0:
            at, size = rng.randint(0, 60), rng.randint(45, 70)
            cut = rng.randint(0, len(w))
            w[cut:cut] = shared[at:at + size]
        if i % 7 == 0:
            w += ["same"] * rng.randint(40, 120)
        rows.append((i * 3, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (204, " "),
             (None, rows[0][1]), (-5, " ".join(shared)), (205, " ".join(shared[:49])),
             (206, " ".join(shared[:50]))]
    check(docs_of, rows)


def test_small_windows_many_repeats(spark, docs_of):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(30)]
    check(docs_of, rows, window=8, seed_words=3)


def test_one_id_with_several_texts(spark, docs_of):
    """Rows of one id are judged each by its own text; they spare each other."""
    rng = random.Random(8)

    def prose(n):
        return " ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 99)) for _ in range(n))
    shared, other, long = prose(120), prose(200), prose(400)
    rows = [(1, shared), (2, "too short"), (2, "x " + shared + " y"), (2, other), (2, "z " + shared),
            (3, other), (3, long), (4, long + " " + other), (4, "q"), (2, other)]
    check(docs_of, rows)


def test_columns_kept_and_empty(spark, docs_of):
    df = docs_of([(1, "a")])
    out = remove_repeats(df.filter("false"))
    assert out.count() == 0 and out.columns[:-1] == df.columns


def test_smallest_is_leftmost_of_each_span():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 5, 200).astype(np.uint64)
    for span in (1, 2, 7, 41):
        got = _smallest(values, span)
        assert got.tolist() == [i + int(values[i:i + span].argmin()) for i in range(200 - span + 1)]


def test_paths_cover_all_windows_once():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(n)).encode() for n in (0, 49, 50, 51, 300, 120)]
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    p = _paths(Block(0, len(texts), np.frombuffer(b"".join(texts), np.uint8), off), 50, 10)
    seen = sorted((int(r), int(s) + k) for r, s, n in zip(p["row"], p["start"], p["n"]) for k in range(n))
    assert seen == [(r, s) for r, t in enumerate(texts) for s in range(len(t.split()) - 49)]
