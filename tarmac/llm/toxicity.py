"""Toxic spans by a linear-chain conditional random field.

A token (a run without ASCII white space) is either toxic or not. Its features
are the lower-cased word without outer punctuation and its first 3 to 6 bytes,
hashed into one weight table; neighbouring tokens are tied by a 2 x 2 table of
transition weights. Chains have ``CHAIN`` tokens.

Only documents are labelled, so the tokens that the field learns from are
labelled first: in a toxic document those tokens are toxic that have a feature
found in many different contexts of toxic documents and hardly in clean ones
(contexts, not documents: copies of a document add none). The field is then
fitted to these labels by gradient steps on forward-backward marginals.

Scoring runs forward-backward over every token of every whole text, many
chains advancing together. Tokens with a marginal of 1/2 and more make up the
offending spans; the largest marginal and the expected number of toxic tokens
give the document's score through a logistic layer.

Defined results: a null or empty text has no token and gets the score of a
text without toxic tokens; repeated rows get equal results; an empty table
gives an empty result. Without labels of both classes every score is the
labels' smoothed mean, or 0.5.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.bytecnn import Adam, Logistic
from tarmac.llm.common import (BLOCK_BYTES, LOWER, Block, blocks, byte_prefix, byte_ranges, mix, text_of,
                               word_bounds)
from tarmac.llm.sampling import class_sample, sampled_texts

CHAIN = 64
TABLE_BITS = 18
PREFIXES = (3, 4, 5, 6)

#: Labelled documents of each class, and chains of each, that the field learns from.
PER_CLASS = 3000
TRAIN_CHAINS = 48

#: Chains that advance together; bounds the memory of a pass over many tokens.
CHAINS_AT_ONCE = 4096

#: A toxic feature has so many contexts at least, so many times a clean one's
#: rate, and is so rarely that toxic by chance that one of all features would be.
MIN_CONTEXTS = 3
MIN_RATIO = 20.0

_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


class _Tokens:
    """Tokens of a block: their bounds, rows, and hashed features."""

    def __init__(self, block: Block):
        low = LOWER[block.buf]
        self.start, self.end, self.first = word_bounds(block)
        self.row = np.repeat(np.arange(block.rows), np.diff(self.first))
        start, end = self.start.copy(), self.end.copy()
        for _ in range(3):  # outer punctuation
            start += (end - start > 1) & _PUNCT[low[start]] if len(start) else 0
            end -= (end - start > 1) & _PUNCT[low[end - 1]] if len(end) else 0
        prefix = byte_prefix(low)
        self.word = byte_ranges(prefix, start, end)
        hashes = [self.word]
        for size in PREFIXES:
            hashes.append(mix(byte_ranges(prefix, start, np.minimum(start + size, end))
                              + np.uint64(size)))
        self.features = np.empty((len(hashes[0]), len(hashes)), np.int32)
        for i, h in enumerate(hashes):
            self.features[:, i] = h >> np.uint64(64 - TABLE_BITS)


class _Sample:
    """Tokens of many texts, read a block at a time."""

    def __init__(self, texts: list[bytes]):
        features, word, first, lo, size, words = [], [], [np.zeros(1, np.int64)], 0, 0, 0
        for hi, text in enumerate(texts, 1):
            size += len(text)
            if size >= BLOCK_BYTES // 2 or hi == len(texts):
                tokens = _Tokens(_one_block(texts[lo:hi]))
                features.append(tokens.features)
                word.append(tokens.word)
                first.append(tokens.first[1:] + words)
                words, lo, size = words + len(tokens.word), hi, 0
        self.first, self.word = np.concatenate(first), np.concatenate(word)
        self.row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.first))
        self.features = np.concatenate(features)


def _chains(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Place of each token (chain, step) when every row starts a new chain."""
    counts = np.diff(first)
    per_row = -(-counts // CHAIN)
    base = np.cumsum(per_row) - per_row
    nth = np.arange(int(first[-1])) - np.repeat(first[:-1], counts)
    return np.repeat(base, counts) + nth // CHAIN, nth % CHAIN, int(per_row.sum())


def _passes(first: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, int]]:
    """Tokens of at most ``CHAINS_AT_ONCE`` chains: their slice, the chain and
    step of each, and the number of chains."""
    chain, step, n = _chains(first)
    for lo in range(0, n, CHAINS_AT_ONCE):
        hi = min(lo + CHAINS_AT_ONCE, n)
        part = slice(*np.searchsorted(chain, (lo, hi)).tolist())
        yield part, chain[part] - lo, step[part], hi - lo


class ChainField:
    """Weights of the field: emission table, bias, and transitions [from, to]."""

    def __init__(self) -> None:
        self.table = np.zeros(1 << TABLE_BITS, np.float32)
        self.bias = np.full(1, -4.0)
        self.moves = np.zeros((2, 2))

    def emission(self, features: np.ndarray) -> np.ndarray:
        score = np.full(len(features), self.bias[0])
        for i in range(features.shape[1]):
            score += self.table[features[:, i]]
        return score

    def forward_backward(self, score: np.ndarray, real: np.ndarray,
                         pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Toxic marginals of padded chains (steps x chains), and the expected
        numbers of transitions if ``pairs``. A step that is not real is clean."""
        steps, n = score.shape
        odds = np.where(real, np.exp(np.clip(score, -30, 30)), 1e-13)
        move = np.exp(self.moves)
        ahead = np.empty((steps, 2, n))
        a, b = np.ones(n), odds[0]
        total = a + b
        ahead[0, 0], ahead[0, 1] = a / total, b / total
        for i in range(1, steps):
            p, q = ahead[i - 1]
            a = p * move[0, 0] + q * move[1, 0]
            b = (p * move[0, 1] + q * move[1, 1]) * odds[i]
            total = a + b
            ahead[i, 0], ahead[i, 1] = a / total, b / total
        marginal = np.empty((steps, n))
        marginal[-1] = ahead[-1, 1]
        counts = np.zeros((2, 2)) if pairs else None
        x, y = np.ones(n), np.ones(n)  # backward values of clean and toxic
        for i in range(steps - 2, -1, -1):
            to_clean, to_toxic = x, y * odds[i + 1]
            if pairs:
                joint = np.stack([ahead[i, 0] * move[0, 0] * to_clean, ahead[i, 0] * move[0, 1] * to_toxic,
                                  ahead[i, 1] * move[1, 0] * to_clean, ahead[i, 1] * move[1, 1] * to_toxic])
                counts += ((joint / joint.sum(axis=0)) * real[i + 1]).sum(axis=1).reshape(2, 2)
            x = move[0, 0] * to_clean + move[0, 1] * to_toxic
            y = move[1, 0] * to_clean + move[1, 1] * to_toxic
            total = x + y
            x, y = x / total, y / total
            clean, toxic = ahead[i, 0] * x, ahead[i, 1] * y
            marginal[i] = toxic / (clean + toxic)
        return marginal, counts

    def marginals(self, tokens: _Tokens | _Sample) -> np.ndarray:
        """Toxic probability of each token."""
        out = np.zeros(len(tokens.features))
        for part, chain, step, n in _passes(tokens.first):
            score, real = np.zeros((CHAIN, n)), np.zeros((CHAIN, n), bool)
            score[step, chain] = self.emission(tokens.features[part])
            real[step, chain] = True
            out[part] = self.forward_backward(score, real)[0][step, chain]
        return out

    def fit(self, tokens: _Tokens | _Sample, toxic: np.ndarray, epochs: int = 25, rate: float = 0.25,
            decay: float = 2e-6) -> None:
        """Gradient steps on the likelihood of the token labels."""
        adam = Adam([self.table, self.bias, self.moves], rate)
        scale = 1.0 / max(toxic.sum(), 1.0)
        for epoch in range(epochs):
            adam.rate = rate * (1 - epoch / epochs) + 0.02
            grad, bias, moves = np.zeros(len(self.table)), 0.0, np.zeros((2, 2))
            for part, chain, step, n in _passes(tokens.first):
                features, want = tokens.features[part], toxic[part]
                score, gold = np.zeros((CHAIN, n)), np.zeros((CHAIN, n))
                real = np.zeros((CHAIN, n), bool)
                score[step, chain], gold[step, chain] = self.emission(features), want
                real[step, chain] = True
                marginal, counts = self.forward_backward(score, real, pairs=True)
                error = (marginal[step, chain] - want) * scale
                for i in range(features.shape[1]):
                    grad += np.bincount(features[:, i], error, len(self.table))
                bias += error.sum()
                a, b, both = gold[:-1], gold[1:], real[1:]
                moves += counts - np.array([[((1 - a) * (1 - b) * both).sum(), ((1 - a) * b * both).sum()],
                                            [(a * (1 - b) * both).sum(), (a * b * both).sum()]])
            grad[np.abs(grad) < 1e-9] = 0
            adam.step([(grad + decay * self.table).astype(np.float32), np.array([bias]),
                       moves * scale + 1e-3 * self.moves])


def _described(field: ChainField, tokens: _Tokens | _Sample, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the log-odds of its most toxic token and the logarithm of its
    expected number of toxic tokens; and each token's marginal."""
    p = field.marginals(tokens)
    most = np.zeros(rows)
    np.maximum.at(most, tokens.row, p)
    sure = np.where(p >= 0.2, p, 0.0)
    count = np.bincount(tokens.row, sure, rows)
    most = np.clip(most, 1e-4, 1 - 1e-4)
    return np.column_stack([np.log(most / (1 - most)), np.log1p(count)]), p


class ToxicityModel:
    def __init__(self, field: ChainField | None, layer: Logistic | None, constant: float):
        self.field, self.layer, self.constant = field, layer, constant

    def tag(self, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
        """Scores, and spans (code points from start to stop, with p)."""
        if self.field is None:
            return np.full(len(texts), self.constant), [[] for _ in range(len(texts))]
        scores, spans = [], []
        for block in blocks(texts):
            tokens = _Tokens(block)
            features, p = _described(self.field, tokens, block.rows)
            scores.append(self.layer.predict(features))
            found: list[list[dict]] = [[] for _ in range(block.rows)]
            hot = np.flatnonzero(p >= 0.5)
            if len(hot):
                # code points before each byte
                points = np.concatenate(([0], np.cumsum((block.buf & 0xC0) != 0x80)))
                row = tokens.row[hot]
                new = np.concatenate(([True], (np.diff(hot) > 1) | (np.diff(row) > 0)))
                group = np.cumsum(new) - 1
                lead = np.flatnonzero(new)
                tail = np.append(lead[1:], len(hot)) - 1
                base = points[block.off[row[lead]]]
                begin = points[tokens.start[hot[lead]]] - base
                stop = points[tokens.end[hot[tail]]] - base
                peak = np.zeros(len(lead))
                np.maximum.at(peak, group, p[hot])
                for r, s, e, q in zip(row[lead].tolist(), begin.tolist(), stop.tolist(), peak.tolist()):
                    found[r].append({"start": s, "stop": e, "p": q})
            spans.extend(found)
        return (np.concatenate(scores) if scores else np.zeros(0)), spans


def _one_block(texts: list[bytes]) -> Block:
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return Block(0, len(texts), np.frombuffer(b"".join(texts), np.uint8), off)


def _weak_labels(tokens: _Tokens | _Sample, toxic_row: np.ndarray) -> np.ndarray:
    """1 for the tokens of toxic rows with a feature that marks toxic contexts."""
    toxic = toxic_row[tokens.row]
    before = np.concatenate(([np.uint64(0)], tokens.word[:-1])) if len(tokens.word) else tokens.word
    after = np.concatenate((tokens.word[1:], [np.uint64(0)])) if len(tokens.word) else tokens.word
    context = mix(before) ^ (mix(after) >> np.uint64(1))
    size = 1 << TABLE_BITS
    mark = np.zeros(len(toxic), bool)
    for i in range(tokens.features.shape[1]):
        feature = tokens.features[:, i].astype(np.uint64)
        key = mix(context + feature * np.uint64(0x9E3779B97F4A7C15))
        _, first = np.unique(key * np.uint64(2) + toxic.astype(np.uint64), return_index=True)
        bad = np.bincount(tokens.features[first, i], toxic[first], size)
        good = np.bincount(tokens.features[first, i], ~toxic[first], size)
        rate = (bad / max(bad.sum(), 1)) / ((good + 0.5) / max(good.sum(), 1))
        # Chernoff bound of a binomial tail: bad of (bad + good) contexts toxic
        # when each one is with the share of all.
        n, q = np.maximum(bad + good, 1), max(bad.sum(), 1) / max(bad.sum() + good.sum(), 2)
        share = np.clip(bad / n, 1e-12, 1 - 1e-12)
        surprise = n * (share * np.log(share / q) + (1 - share) * np.log((1 - share) / (1 - q)))
        tested = max((n >= MIN_CONTEXTS).sum(), 1)
        marks = (bad >= MIN_CONTEXTS) & (rate >= MIN_RATIO) & (surprise >= np.log(tested))
        mark |= marks[tokens.features[:, i]]
    return (mark & toxic).astype(float)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
                 text_col: str = "text", per_class: int = PER_CLASS) -> ToxicityModel:
    """Learn from the ids and 0/1 labels of ``labels``."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("k"), F.col(label).cast("int").alias("y"))
    chosen = class_sample(known, "y", "k", per_class).groupBy("k").agg(F.max("y").alias("y"))

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, label_, text in zip(*(batch.column(c).to_pylist() for c in ("id", "y", "t"))):
                words = text.encode().split()
                count = max(1, -(-len(words) // CHAIN))
                rng = np.random.default_rng(zlib.crc32(str(i).encode()))
                picks = range(count) if count <= TRAIN_CHAINS else \
                    sorted(rng.choice(count, TRAIN_CHAINS, replace=False).tolist())
                out.append((label_, b"\n".join(
                    b" ".join(words[k * CHAIN:(k + 1) * CHAIN]) for k in picks)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())],
                names=["y", "part"])

    rows = sorted({(r["y"], bytes(r["part"])) for r in
                   sampled_texts(docs, chosen, id_col, text_col).mapInArrow(chains, "y int, part binary").collect()})
    y = np.array([r[0] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(None, None, 0.5 if not len(y) else float((y.sum() + 1) / (len(y) + 2)))
    tokens = _Sample([r[1] for r in rows])
    field = ChainField()
    field.fit(tokens, _weak_labels(tokens, y > 0))
    features, _ = _described(field, tokens, len(rows))
    return ToxicityModel(field, Logistic(features, y, np.ones(len(y)), ridge=0.1), 0.5)


def toxicity(model: ToxicityModel, text: Column) -> Column:
    """struct(score, spans) of each text; a span is (start, stop, p) in code points."""
    kind = "struct<score: double, spans: array<struct<start: bigint, stop: bigint, p: double>>>"

    @F.arrow_udf(kind)
    def tagged(texts: pa.Array) -> pa.Array:
        scores, spans = model.tag(texts)
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())]))
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(spans, span)],
                                          names=["score", "spans"])

    return tagged(text_of(text))
