"""Best-fit packing of tokenised documents by minimum bin slack.

Every bin is filled by the fullest feasible combination of the lengths still
to be placed: the longest one is taken first, and a subset-sum program over a
bit set (bit s is set if the lengths can sum to s) finds the best fill of the
rest; the combination is then removed. Pieces of equal length are
interchangeable, so the program runs on the counts by length (at most
``capacity`` numbers, whatever the corpus' size), and one combination is used
as often as the counts allow. What each piece gets then follows from its rank
among the pieces of its length, and ranks are counted in two steps (within a
task, then over the tasks' counts), so no task sees all pieces of a length.

Defined results: a null or empty text is the single id ``end_id``; repeated
rows are packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.llm.common import text_of, written

CAPACITY = 1024
END_ID = 2


#: The pre-tokenizer settings that BytePairIds reproduces, and its public pattern.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """The public byte alphabet of byte-level vocabularies: printable bytes stand
    for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class BytePairIds:
    """Ids of whole texts by a byte-level BPE file of the ``tokenizers`` library.

    Where the file's merges stand in the order of their ids, merging by rank in
    :mod:`tiktoken` gives the same ids at a quarter of the time and without a
    memory of words. Any other file, and any text with one of the file's special
    strings, goes to the file's own library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self._path, self._own = path, None
        self._special = [t["content"] for t in file.get("added_tokens") or ()]
        self._ranked = self._by_rank(path, file)

    def _library(self):
        """The file's own library, loaded when a text needs it."""
        if self._own is None:
            from tokenizers import Tokenizer

            self._own = Tokenizer.from_file(self._path)
        return self._own

    @staticmethod
    def _by_rank(path: str, file: dict):
        import tiktoken

        model, split = file["model"], file.get("pre_tokenizer") or {}
        vocab = model.get("vocab")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
        ordered = model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges") \
            and not file.get("normalizer") and all(split.get(k) == v for k, v in _BYTE_LEVEL.items()) \
            and len(vocab) == 256 + len(merges) \
            and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        if not ordered:
            return None
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in piece): i for piece, i in vocab.items()}
        return tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self._ranked is None or any(s in text for s in self._special):
            ids = self._library().encode(text, add_special_tokens=False).ids
        else:
            ids = self._ranked.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


_TOKENIZERS: dict[str, BytePairIds] = {}


def _tokenizer(path: str) -> BytePairIds:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = BytePairIds(path)
    return _TOKENIZERS[path]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, " \
         "task int, rank bigint"


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                     end_id: int = END_ID, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids. Only a longer document is cut; its
    first piece is the shorter one. ``rank`` numbers the pieces of a length
    within the task that made them."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        tokenizer = _tokenizer(tokenizer_path)
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids, rows = part.column(0).to_pylist(), []
                for doc, text in zip(ids, part.column(1)):
                    data = tokenizer.encode(text.as_py()) + end
                    n = len(data) // 4
                    at, piece = 0, 0
                    while at < n:
                        length = min((n - at) % capacity or capacity, n - at)
                        rows.append((doc, piece, at, length,
                                     zlib.crc32(data[4 * at:4 * (at + length)])))
                        at, piece = at + length, piece + 1
                cols = list(zip(*rows))
                length = np.array(cols[3], np.int64)
                # rank: how many of this length came before in the task
                order = np.argsort(length, kind="stable")
                same = length[order]
                heads = np.flatnonzero(np.concatenate(([True], same[1:] != same[:-1])))
                sizes = np.diff(np.append(heads, len(same)))
                rank = np.empty(len(length), np.int64)
                rank[order] = np.arange(len(same)) - np.repeat(heads, sizes) + seen[same]
                seen[same[heads]] += sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.int64()), pa.array(length),
                     pa.array(cols[4], pa.int64()),
                     pa.array(np.full(len(length), task, np.int32)), pa.array(rank)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       text_of(text_col).alias("text")).mapInArrow(cut, PIECES)


def _fullest(counts: np.ndarray, room: int) -> list[int]:
    """Lengths, each at most as often as counted, with the greatest sum that
    fits into ``room``: subset sums on a bit set, longest lengths first."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in range(min(room, len(counts) - 1), 0, -1):
        left = min(int(counts[length]), room // length)
        take = 1
        while left > 0:  # binary splitting: 1, 2, 4, ... copies at once
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, take = left - take, take * 2
            if reach >> room & 1:
                left = 0
        if reach >> room & 1:
            break
    total, found = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            found += [length] * take
            total -= length * take
    return found


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """[(lengths of a bin, number of such bins)] that hold all counted pieces."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        combination = [longest, *_fullest(left, capacity - longest)]
        left[longest] += 1
        lengths, uses = np.unique(combination, return_counts=True)
        times = int((left[lengths] // uses).min())
        left[lengths] -= uses * times
        plan.append((sorted(combination, reverse=True), times))
    return plan


def _places(plan: list[tuple[list[int], int]], capacity: int) -> dict[int, tuple]:
    """By length: arrays of the first rank, the uses in a bin, the first bin
    and the offset of each run of places, in the order of ranks."""
    runs: dict[int, list] = {}
    used = np.zeros(capacity + 1, np.int64)
    first_bin = 0
    for lengths, times in plan:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            uses = lengths.count(length)
            runs.setdefault(length, []).append((used[length], uses, first_bin, offset))
            used[length] += uses * times
            offset += uses * length
        first_bin += times
    return {length: tuple(np.array(x, np.int64) for x in zip(*rows)) for length, rows in runs.items()}


PACKED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, " \
         "sequence_id bigint, offset bigint"


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence and offset; see the module's text."""
    pieces = written(tokenized_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col),
                     "packing-pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most ``capacity`` rows, whatever the input.
    totals = per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    places = _places(packing_plan({r["length"]: r["n"] for r in totals}, capacity), capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("task", "length",
                              F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    shared = docs.sparkSession.sparkContext.broadcast(places)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence = np.empty(len(length), np.int64)
            offset = np.empty(len(length), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                first, uses, first_bin, base = table[int(value)]
                run = np.searchsorted(first, rank[at], side="right") - 1
                nth = rank[at] - first[run]
                sequence[at] = first_bin[run] + nth // uses[run]
                offset[at] = base[run] + nth % uses[run] * value
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(offsets, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("rank") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(place, PACKED)
