"""Quality by a byte-level convolutional network.

A text is cut into chunks of ``CHUNK`` bytes that overlap by half and cover
all of it. Filters learned on labelled chunks are max-pooled in each chunk; a
document's probability comes from the mean and the largest pooled value of
each filter over all its chunks, through a logistic layer. The network is
fitted on a bounded sample of labelled rows; every document is then scored in
Arrow batches, a few megabytes of text at a time, without any shuffle.

Defined results: a null or empty text is scored as a chunk of zero bytes;
repeated rows get equal scores; an empty table gives an empty result. Without
any usable label every score is 0.5, with one class only its smoothed share.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.bytecnn import ByteCnn, Logistic, padded, sample_windows
from tarmac.llm.common import blocks, text_of, written
from tarmac.llm.sampling import class_sample, sampled_texts

CHUNK = 256
WIDTHS = (2, 4)
FILTERS = 16

#: Labelled documents of each class, and chunks of each, that the network learns from.
PER_CLASS = 2500
TRAIN_CHUNKS = 3


class QualityModel:
    def __init__(self, cnn: ByteCnn | None, layer: Logistic | None, constant: float):
        self.cnn, self.layer, self.constant = cnn, layer, constant

    def features(self, texts: pa.Array) -> np.ndarray:
        """Per text the mean and the largest pooled value of each filter."""
        out = []
        for block in blocks(texts):
            flat, first = padded(block, CHUNK // 2)
            halves = np.maximum(self.cnn.pooled(flat, CHUNK // 2), 0)
            # a chunk is two neighbouring halves of a text; a text's last half
            # belongs to the chunk before it, if there is one
            chunks = halves.copy()
            np.maximum(chunks[:-1], halves[1:], out=chunks[:-1])
            last = first[1:] - 1
            chunks[last] = halves[last]
            lone = np.diff(first) == 1
            keep = np.ones(len(chunks), bool)
            keep[last[~lone]] = False
            start = first[:-1] - np.concatenate(([0], np.cumsum(~lone)[:-1]))
            chunks = chunks[keep]
            sizes = np.diff(np.append(start, len(chunks)))
            out.append(np.hstack([np.add.reduceat(chunks, start, axis=0) / sizes[:, None],
                                  np.maximum.reduceat(chunks, start, axis=0)]))
        return np.concatenate(out) if out else np.zeros((0, 2 * FILTERS * len(WIDTHS)))

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.cnn is None:
            return np.full(len(texts), self.constant)
        return self.layer.predict(self.features(texts))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
                text_col: str = "text", per_class: int = PER_CLASS, epochs: int = 12) -> QualityModel:
    """Learn from the ids and 0/1 labels of ``labels`` (one row of an id is enough)."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("k"), F.col(label).cast("int").alias("y"))
    chosen = class_sample(known, "y", "k", per_class).groupBy("k").agg(F.max("y").alias("y"))
    sample = written(sampled_texts(docs, chosen, id_col, text_col), "quality-sample")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, data = [], []
            for i, label_, text in zip(*(batch.column(c).to_pylist() for c in ("id", "y", "t"))):
                for row in sample_windows(text.encode(), CHUNK, TRAIN_CHUNKS, zlib.crc32(str(i).encode())):
                    y.append(label_)
                    data.append(row.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(data, pa.binary())],
                                             names=["y", "chunk"])

    rows = sorted((r["y"], bytes(r["chunk"])) for r in
                  sample.mapInArrow(chunks, "y int, chunk binary").collect())
    y = np.array([r[0] for r in rows], np.int64)
    if not len(y) or y.min() == y.max():
        return QualityModel(None, None, 0.5 if not len(y) else float((y.sum() + 1) / (len(y) + 2)))
    windows = np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(len(rows), -1)
    weights = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    model = QualityModel(ByteCnn(WIDTHS, FILTERS, 2), None, 0.5)
    model.cnn.fit(windows, y, weights, epochs)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = model.features(batch.column("t"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array(list(f.astype(np.float64)), pa.list_(pa.float64()))],
                names=["y", "f"])

    rows = sorted((r["y"], r["f"]) for r in
                  sample.mapInArrow(described, "y int, f array<double>").collect())
    y = np.array([r[0] for r in rows], float)
    features = np.array([r[1] for r in rows])
    model.layer = Logistic(features, y, np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())))
    return model


def quality_score(model: QualityModel, text: Column) -> Column:
    """Probability (0 to 1) that a text is of label 1."""
    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts), pa.float64())

    return scored(text_of(text))
