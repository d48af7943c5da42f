"""SentencePiece encoding and decoding by a batched numpy Viterbi.

A text gets one leading space, spaces become the mark U+2581, and it is cut
wherever no piece has the two bytes at the cut side by side: no piece crosses a
cut, so the parts are encoded alone (a part is a run of marks with the letters
that follow, or what stands inside a word, as a comma or a line end). The
distinct parts of a block of texts are found by Arrow, and each is looked up
once. New parts are sorted by length, and those of about one length advance
together: at each end position the substrings of every piece length are hashed
from prefix sums, the hashes probe the sorted hashes of the vocabulary, and the
largest total score of all parts is taken at once, with the piece length as
backpointer (the longer piece of equals). A character without a piece is written
as its UTF-8 bytes' pieces. Every encoded part is held against a second hash of
its pieces, so a hash collision cannot pass. Parts are remembered, up to a
bound, by each worker.

A unigram vocabulary's scores are log-probabilities, and the best sum is the
encoding. A vocabulary made by merges has ranks as scores, whose sum means
nothing; there the trellis has transitions too: two neighbouring pieces are
allowed only if merging their joined text would give just these two. Of all
segmentations exactly one has only allowed neighbours, and it is the one that
merging gives, so the same forward pass with backpointers finds it; as one piece
at most may end at each position, the first that may is taken, longest first. Whether
two pieces may meet is worked out by undoing their merges, latest first, and
asking whether the pieces then at the border would have merged earlier.

Defined results: a null or empty text has no ids and decodes to the empty
string; repeated rows get equal ids; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.llm.common import Block, blocks, mix, text_of

MARK = "▁"

#: Parts that a Python worker remembers at most, and their characters.
CACHE_ENTRIES = 1_000_000
CACHE_CHARS = 1 << 24

#: Parts that advance together at most, times their length.
BATCH_CELLS = 1 << 18

#: Pieces that are tried at once rather than longest first.
FEW = 256

#: Bytes of text that are cut and encoded at a time, or one text.
TEXT_BYTES = 4 << 20

#: Ids that are decoded at a time, or those of one text.
DECODED_IDS = 1 << 18

#: Bits of the table that tells which hashes may be pieces.
SEEN_BITS = 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHECK = np.uint64(0xC2B2AE3D27D4EB4F)


def _codes(words: list[str], lengths: np.ndarray) -> np.ndarray:
    """Code points, one row per word, with zeros behind its end."""
    out = np.zeros((len(words), int(lengths.max())), np.uint32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer(
        "".join(words).encode("utf-32-le"), np.uint32)
    return out


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Vocabulary:
    """Pieces of a model file, with their hashes sorted."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = {}
        plain = []
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain.append(i)
        self.id_bytes = {i: b for b, i in self.byte_ids.items()}
        self.unknown = model.unk_id()
        self.piece_array = np.array(self.pieces, dtype=object)
        self.is_byte = np.zeros(size, bool)
        self.is_byte[list(self.id_bytes)] = True
        sizes = np.array([len(self.pieces[i]) for i in plain], np.int64)
        codes, last = _codes([self.pieces[i] for i in plain], sizes), sizes - 1
        keys, checks = (self.hashes(codes, base)[np.arange(len(plain)), last] for base in (_BASE, _CHECK))
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(plain, np.int32)[order]
        scores = np.array([model.get_score(i) for i in plain], np.float64)
        self.scores = scores[order]
        self.sizes, self.checks = sizes[order], checks[order]
        self.lengths = sorted(set(self.sizes.tolist()))
        self.unknown_score = scores.min() - 10.0
        # Most substrings are no piece: a bit by the hash's top bits tells at once.
        # For the others the top bits give the first key that shares them.
        top = (self.keys >> np.uint64(64 - SEEN_BITS)).astype(np.int64)
        self.seen = np.zeros(1 << SEEN_BITS, bool)
        self.seen[top] = True
        self.first = np.zeros(1 << SEEN_BITS, np.int32)
        self.first[top[::-1]] = np.arange(len(top) - 1, -1, -1)
        self.shared = int(np.bincount(top).max())
        self.ended = np.append(self.keys, np.uint64(2**64 - 1))
        # Bytes that no piece has side by side; inside a character is no cut.
        self.cuts = np.ones((256, 256), bool)
        self.cuts[:, 0x80:0xC0] = False
        for i in plain:
            raw = np.frombuffer(self.pieces[i].replace(MARK, " ").encode(), np.uint8)
            self.cuts[raw[:-1], raw[1:]] = False
        self._spell_pieces()
        longest = int(self.sizes.max())
        self.powers, self.check_powers = (np.cumprod(
            np.array([1] + [int(base)] * longest, np.uint64), dtype=np.uint64) for base in (_BASE, _CHECK))
        # Parts by their text: those with a first mark, without it, and others.
        self.known: dict[str, bytes] = {}
        self.inner: dict[str, bytes] = {}
        self.held = 0
        self.last: tuple[pa.Array, pa.Array] | None = None
        # Merges are scored 0, -1, -2, ...: log-probabilities are no whole numbers.
        long = self.sizes > 1
        self.merged = bool((scores == np.round(scores)).all())
        self.usable = np.ones(len(self.keys), bool)
        if self.merged:
            self.rank = np.where(long, -self.scores, -1).astype(np.int64)
            self._split_pieces()

    def _spell_pieces(self) -> None:
        """The UTF-8 bytes of all pieces, with spaces for marks, one after the other."""
        spelled = [bytes([self.id_bytes[i]]) if i in self.id_bytes else piece.replace(MARK, " ").encode()
                   for i, piece in enumerate(self.pieces)]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_sizes = np.array([len(s) for s in spelled], np.int64)
        self.spelled_at = np.cumsum(self.spelled_sizes) - self.spelled_sizes
        #: Bytes of a piece's first character.
        self.lead = np.array([len(piece.replace(MARK, " ")[:1].encode()) for piece in self.pieces], np.int64)

    def _split_pieces(self) -> None:
        """For each piece the two that its last merge joins (-1: a character).
        A piece that merging its own text does not give is never used."""
        self.left = np.full(len(self.keys), -1, np.int64)
        self.right = np.full(len(self.keys), -1, np.int64)
        index = {self.pieces[i]: k for k, i in enumerate(self.ids.tolist())}
        rank = self.rank.tolist()
        for k, i in enumerate(self.ids.tolist()):
            parts = list(self.pieces[i])
            while len(parts) > 2:
                found = [(rank[index[a + b]], at) for at, (a, b) in enumerate(zip(parts, parts[1:]))
                         if a + b in index]
                if not found:
                    break
                at = min(found)[1]
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2 and all(p in index for p in parts):
                self.left[k], self.right[k] = (index[p] for p in parts)
            elif len(parts) > 1:
                self.usable[k] = False

    def _may_meet(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of pieces ``a`` and ``b`` gives just them.
        -1 stands for no piece, which any other may meet."""
        allowed = np.ones(len(a), bool)
        rows = np.flatnonzero(a >= 0)
        x, y = a[rows], b[rows]
        limit = np.full(len(rows), np.iinfo(np.int64).max)
        while len(rows):
            hits, joined = self._find(self.keys[x] * self.powers[self.sizes[y]] + self.keys[y])
            merges = np.zeros(len(rows), bool)
            merges[hits] = self.rank[joined] < limit[hits]
            allowed[rows[merges]] = False
            # Undo the later of the two last merges. Of one rank the left one
            # comes first, so a merge at the border beats y's but not x's.
            undo_x = self.rank[x] > self.rank[y]
            limit = np.where(undo_x, self.rank[x], self.rank[y] + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
            on = ~merges & (x >= 0) & (y >= 0)
            rows, x, y, limit = rows[on], x[on], y[on], limit[on]
        return allowed

    @staticmethod
    def hashes(codes: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
        """Prefix hashes: column j has the first j + 1 characters."""
        out = np.empty(codes.shape, np.uint64)
        value = np.zeros(len(codes), np.uint64)
        mixed = mix(codes.astype(np.uint64) + base)
        for j in range(codes.shape[1]):
            value = value * base + mixed[:, j]
            out[:, j] = value
        return out

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces', and their places in the sorted keys."""
        top = hashes >> np.uint64(64 - SEEN_BITS)
        maybe = np.flatnonzero(self.seen[top])
        hashes = hashes[maybe]
        at = self.first[top[maybe]].astype(np.int64)
        for _ in range(self.shared - 1):
            at += self.ended[at] < hashes
        found = self.keys[np.minimum(at, len(self.keys) - 1)] == hashes
        return maybe[found], at[found]

    def _viterbi(self, words: list[str], lengths: np.ndarray) -> list[bytes]:
        """Packed ids of words, longest first."""
        codes = _codes(words, lengths)
        longest = codes.shape[1]
        prefix = np.zeros((len(words), longest + 1), np.uint64)
        prefix[:, 1:] = self.hashes(codes)
        best = np.zeros((len(words), longest + 1))
        step = np.ones((len(words), longest + 1), np.int32)
        piece = np.full((len(words), longest + 1), -1, np.int64)  # place in the sorted keys
        sizes = np.array([x for x in self.lengths[::-1] if x <= longest], np.int64)
        alive = np.searchsorted(-lengths, -np.arange(longest + 1), side="right")
        for end in range(1, longest + 1):
            fit, n = sizes[sizes <= end], alive[end]
            hashes = prefix[:n, end, None] - prefix[:n, end - fit] * self.powers[fit]
            hits, at = self._find(hashes.ravel())
            keep = self.usable[at]
            hits, at = hits[keep], at[keep]
            # by word, and of one word the longest piece first
            rows, size = hits // max(len(fit), 1), fit[hits % max(len(fit), 1)]
            if self.merged:
                self._step_merged(end, rows, size, at, step, piece)
            else:
                self._step_scored(end, rows, size, at, step, piece, best)
        # All words follow their backpointers together; ids fill up from the right.
        checks = np.zeros((len(words), longest + 1), np.uint64)
        checks[:, 1:] = self.hashes(codes, _CHECK)
        ids = np.zeros((len(words), longest), np.uint32)
        filled = np.zeros(len(words), np.int64)
        odd = np.zeros(len(words), bool)
        rows, end = np.arange(len(words)), lengths
        while len(rows):
            at, start = piece[rows, end], end - step[rows, end]
            real = checks[rows, end] - checks[rows, start] * self.check_powers[end - start] == self.checks[at]
            odd[rows[(at < 0) | ~real]] = True
            filled[rows] += 1
            ids[rows, longest - filled[rows]] = self.ids[at]
            on = start > 0
            rows, end = rows[on], start[on]
        used = np.arange(longest)[None, :] >= longest - filled[:, None]
        flat = ids[used].astype("<u4").tobytes()
        stops = (4 * np.cumsum(filled)).tolist()
        out = [flat[a:b] for a, b in zip([0, *stops], stops)]
        for row in np.flatnonzero(odd).tolist():
            out[row] = self._spelled(words[row], step[row], piece[row])
        return out

    def _step_merged(self, end: int, rows: np.ndarray, size: np.ndarray, at: np.ndarray,
                     step: np.ndarray, piece: np.ndarray) -> None:
        """Each word's only piece up to ``end`` that may meet the one before it.
        Without one the last character is unknown."""
        few = len(rows) <= FEW
        todo = np.arange(len(rows)) if few else np.flatnonzero(np.diff(rows, prepend=-1))
        while len(todo):
            row, place, start = rows[todo], at[todo], end - size[todo]
            good = self._may_meet(piece[row, start], place)
            step[row[good], end], piece[row[good], end] = size[todo[good]], place[good]
            if few:
                break
            todo = todo[~good] + 1
            todo = todo[todo < len(rows)]
            todo = todo[rows[todo] == rows[todo - 1]]

    def _step_scored(self, end: int, rows: np.ndarray, size: np.ndarray, at: np.ndarray,
                     step: np.ndarray, piece: np.ndarray, best: np.ndarray) -> None:
        """The best sum up to ``end``: an unknown character, unless there is a piece."""
        best[:, end] = best[:, end - 1] + self.unknown_score
        # by piece length; the rows of one length are distinct
        for k in np.unique(size).tolist():
            part = size == k
            row, found = rows[part], at[part]
            total = best[row, end - k] + self.scores[found]
            better = total >= best[row, end]
            row = row[better]
            best[row, end], step[row, end], piece[row, end] = total[better], k, found[better]

    def _spelled(self, word: str, step: np.ndarray, piece: np.ndarray) -> bytes:
        """The same for one word with an unknown character, or with a piece whose
        hash collides: their bytes are spelled out."""
        ids, end = [], len(word)
        while end:
            start, at = end - int(step[end]), int(piece[end])
            if at >= 0 and self.pieces[self.ids[at]] == word[start:end]:
                ids.append(int(self.ids[at]))
            else:
                ids.extend(self.byte_ids.get(b, self.unknown)
                           for b in reversed(word[start:end].encode("utf-8", "surrogatepass")))
            end = start
        return np.array(ids[::-1], "<u4").tobytes()

    def _learn(self, keys: set[str], mark: str = MARK) -> None:
        """Remember the ids of parts, given without their first ``mark``."""
        known, held = self.known if mark else self.inner, sorted(keys, key=len, reverse=True)
        words = [(mark + k).replace(" ", MARK) for k in held]
        lengths = np.array([len(w) for w in words], np.int64)
        lo = 0
        while lo < len(words):
            most = max(1, BATCH_CELLS // (int(lengths[lo]) + 1))
            half = int(np.searchsorted(-lengths, -(lengths[lo] / 2), side="right"))
            hi = min(lo + most, half)
            known.update(zip(held[lo:hi], self._viterbi(words[lo:hi], lengths[lo:hi])))
            lo = hi
        self.held += int(lengths.sum())

    def _ids_of(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, with spaces for marks."""
        if len(self.known) + len(self.inner) > CACHE_ENTRIES or self.held > CACHE_CHARS:
            self.known.clear()
            self.inner.clear()
            self.held = 0
        known, inner = self.known, self.inner
        ids = [known.get(p[1:]) if p[0] == " " else inner.get(p) for p in parts]
        new = [p for p, x in zip(parts, ids) if x is None]
        if new:
            self._learn({p[1:] for p in new if p[0] == " "})
            self._learn({p for p in new if p[0] != " "}, "")
            ids = [known[p[1:]] if p[0] == " " else inner[p] for p in parts]
        return ids

    def _encode_block(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the offsets of each text's."""
        some = np.diff(block.off) > 0
        buf = np.insert(block.buf, block.off[:-1][some], 0x20)
        off = block.off + np.concatenate(([0], np.cumsum(some)))
        if not len(buf):
            return np.zeros(0, np.int32), off
        cut = self.cuts.ravel()[(buf[:-1].astype(np.uint16) << 8) | buf[1:]]
        cut[off[(off > 0) & (off < len(buf))] - 1] = True
        bounds = np.concatenate(([0], np.flatnonzero(cut) + 1, [len(buf)]))
        parts = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
            None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(buf)]).dictionary_encode()
        data = self._ids_of(parts.dictionary.cast(pa.string()).to_numpy(zero_copy_only=False).tolist())
        which = parts.indices.to_numpy()
        counts = np.fromiter(map(len, data), np.int64, len(data)) // 4
        sizes = counts[which]
        ids = np.frombuffer(b"".join(data), "<u4").astype(np.int32)[
            _ranges((np.cumsum(counts) - counts)[which], sizes)]
        return ids, np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(bounds, off)]

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """A list of ids for each text of a string column without nulls. Spark calls
        for a batch's ids again to decode them: the last batch is remembered once."""
        last, self.last = self.last, None
        if last and last[0].equals(texts):
            return last[1]
        lists = self._encode_texts(texts)
        self.last = texts, lists
        return lists

    def _encode_texts(self, texts: pa.Array) -> pa.Array:
        if pc.any(pc.match_substring(texts, MARK)).as_py():
            texts = pc.replace_substring(texts, MARK, " ")
        values, offsets, total = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
        for block in blocks(texts, TEXT_BYTES):
            ids, off = self._encode_block(block)
            values.append(ids)
            offsets.append(off[1:] + total)
            total += len(ids)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)),
                                        pa.array(np.concatenate(values)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        lists = self.encode_array(pa.array(texts, pa.string()))
        data = lists.values.to_numpy().astype("<u4").tobytes()
        stops = (4 * lists.offsets.to_numpy().astype(np.int64)).tolist()
        return [data[a:b] for a, b in zip(stops, stops[1:])]

    def _join(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            if i in self.id_bytes:
                raw.append(self.id_bytes[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.pieces[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: np.ndarray) -> str:
        if self.is_byte[ids].any():
            text = self._join(ids.tolist())
        else:
            text = "".join(self.piece_array[ids])
        return text.replace(MARK, " ")[1:]

    def _decode_rows(self, ids: np.ndarray, off: np.ndarray) -> pa.Array:
        """The text of each row's ids; a row begins at its offset."""
        sizes, at = self.spelled_sizes[ids], self.spelled_at[ids]
        first = off[:-1][off[:-1] < off[1:]]
        lead = self.lead[ids[first]]
        sizes[first] -= lead
        at[first] += lead
        buf = self.spelled[_ranges(at, sizes)]
        stops = np.concatenate(([0], np.cumsum(sizes)))[off]
        if self.is_byte[ids].any():
            # Rows are the bytes read as UTF-8 if that is valid, from row to row
            # too; a mark spelled in bytes and a first byte left out go the long way.
            raw, edges = buf.tobytes(), stops[stops < len(buf)]
            try:
                raw.decode("utf-8")
                valid = not (self.is_byte[ids[first]].any() or (buf[edges] & 0xC0 == 0x80).any()
                             or MARK.encode() in raw)
            except UnicodeDecodeError:
                valid = False
            if not valid:
                return pa.array([self.decode(ids[a:b]) for a, b in zip(off[:-1], off[1:])], pa.string())
        return pa.Array.from_buffers(pa.string(), len(off) - 1, [
            None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(buf)])

    def decode_array(self, lists: pa.Array) -> pa.Array:
        """The text of each list of ids."""
        values, off = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().astype(np.int64)
        parts, lo = [pa.array([], pa.string())], 0
        while lo < len(off) - 1:
            hi = max(int(np.searchsorted(off, off[lo] + DECODED_IDS, side="right")) - 1, lo + 1)
            hi = min(hi, len(off) - 1)
            parts.append(self._decode_rows(values[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]))
            lo = hi
        return pa.concat_arrays(parts)


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def encode(text: Column, path: str) -> Column:
    """array<int> with the ids of each text."""
    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        return vocabulary(path).encode_array(texts)

    return encoded(text_of(text))


def decode(ids: Column, path: str) -> Column:
    """The text of an array of ids."""
    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        return vocabulary(path).decode_array(lists)

    return decoded(ids)
