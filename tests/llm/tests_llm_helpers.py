"""Plain Python forms of operators, for comparison."""


def brute_repeats(rows, window=50):
    """{id: text} of the documents that lose words."""
    words = {i: (t or "").encode().split() for i, t in rows.items()}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p:p + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        if gone:
            out[i] = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
    return out
