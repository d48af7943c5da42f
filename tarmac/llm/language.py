"""Language identification by a byte convolutional network.

Filters of several widths, max-pooled over windows of ``WINDOW`` bytes and
followed by a softmax, are trained in numpy on windows of labelled texts. Every
window of a text is read, in batches; the text's language has the largest mean
log-probability over its windows.

Defined results: ``und`` with score 0 for a null text, one without a letter,
or if there is no labelled text to learn from; repeated rows get equal
results; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.bytecnn import ByteCnn, padded, sample_windows, softmax
from tarmac.llm.common import blocks, text_of
from tarmac.llm.sampling import class_sample

WINDOW = 256
WIDTHS = (2, 4, 6)
FILTERS = 8

#: Documents of each language, and windows of each, that the network learns from.
PER_CLASS = 600
TRAIN_WINDOWS = 3
UNKNOWN = "und"


class LanguageModel:
    def __init__(self, cnn: ByteCnn | None, names: list[str]):
        self.cnn, self.names = cnn, names

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and its score for each text."""
        if self.cnn is None:
            return np.zeros(len(texts), np.int64), np.full(len(texts), 1.0 if self.names else 0.0)
        best, score = [], []
        for block in blocks(texts):
            flat, first = padded(block, WINDOW)
            logits = self.cnn.logits(self.cnn.pooled(flat, WINDOW)).astype(np.float64)
            log_p = np.log(softmax(logits) + 1e-6)
            mean = np.add.reduceat(log_p, first[:-1], axis=0) / np.diff(first)[:, None]
            chance = softmax(mean)
            best.append(chance.argmax(axis=1))
            score.append(chance.max(axis=1))
        if not best:
            return np.zeros(0, np.int64), np.zeros(0)
        return np.concatenate(best), np.concatenate(score)


def fit_language(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 id_col: str = "doc_id", per_class: int = PER_CLASS, epochs: int = 8) -> LanguageModel:
    """Learn from the rows of ``labelled`` with a text and a language."""
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("y"), F.col(text_col).alias("t"))

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, data = [], []
            for i, lang, text in zip(*(batch.column(c).to_pylist() for c in ("id", "y", "t"))):
                for row in sample_windows(text.encode(), WINDOW, TRAIN_WINDOWS, zlib.crc32(str(i).encode())):
                    y.append(lang)
                    data.append(row.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.string()), pa.array(data, pa.binary())],
                                             names=["y", "window"])

    sample = sorted((r["y"], bytes(r["window"])) for r in
                    class_sample(rows, "y", "id", per_class)
                    .mapInArrow(windows_of, "y string, window binary").collect())
    names = sorted({y for y, _ in sample})
    if len(names) < 2:
        return LanguageModel(None, names)
    index = {name: i for i, name in enumerate(names)}
    labels = np.array([index[y] for y, _ in sample], np.int64)
    data = np.frombuffer(b"".join(w for _, w in sample), np.uint8).reshape(len(sample), -1)
    share = np.bincount(labels) / len(labels)
    model = LanguageModel(ByteCnn(WIDTHS, FILTERS, len(names)), names)
    model.cnn.fit(data, labels, 1 / (len(names) * share[labels]), epochs)
    return model


def language(model: LanguageModel, text: Column) -> Column:
    """struct(lang, score) of each text."""
    @F.arrow_udf("struct<best: int, score: double>")
    def predicted(texts: pa.Array) -> pa.Array:
        best, score = model.predict(texts)
        return pa.StructArray.from_arrays([pa.array(best, pa.int32()), pa.array(score, pa.float64())],
                                          names=["best", "score"])

    found = predicted(text_of(text))
    names = F.array(*[F.lit(n) for n in model.names]) if model.names else F.array(F.lit(UNKNOWN))
    known = F.coalesce(text.rlike(r"\p{L}"), F.lit(False)) & F.lit(bool(model.names))
    return F.struct(
        F.when(known, F.element_at(names, found["best"] + 1)).otherwise(F.lit(UNKNOWN)).alias("lang"),
        F.when(known, found["score"]).otherwise(F.lit(0.0)).alias("score"))
