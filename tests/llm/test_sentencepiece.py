import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.llm import sentencepiece as operator
from tarmac.llm.sentencepiece import MARK, Vocabulary, decode, encode

PATH = P.path("piece_bpe_32k.model")
VOCAB = Vocabulary(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
SCORES = {VOCAB.pieces[i]: float(s) for i, s in zip(VOCAB.ids.tolist(), VOCAB.scores.tolist())}


def ids_of(vocab, text):
    return list(memoryview(vocab.encode([text])[0]).cast("I"))


def brute(word):
    """Largest total score over all segmentations into pieces and unknown characters."""
    best = [0.0] + [float("-inf")] * len(word)
    for end in range(1, len(word) + 1):
        best[end] = best[end - 1] + VOCAB.unknown_score
        for start in range(end):
            if word[start:end] in SCORES:
                best[end] = max(best[end], best[start] + SCORES[word[start:end]])
    return best[-1]


def test_best_score_of_a_unigram_vocabulary():
    """The same pieces read as unigrams: the best sum of scores."""
    vocab = Vocabulary(PATH)
    vocab.merged, vocab.usable = False, np.ones(len(vocab.keys), bool)
    rng = random.Random(0)
    words = {MARK + "".join(rng.choice("abcdefghtioné日") for _ in range(rng.randint(1, 12))) for _ in range(300)}
    words |= {MARK * 3 + "the", MARK}
    vocab._learn({w[1:] for w in words})
    for word in words:
        pieces = [vocab.pieces[i] for i in memoryview(vocab.known[word[1:]]).cast("I")]
        unknown = sum(1 for c in word if c not in SCORES)
        got = sum(SCORES[p] for p in pieces if p in SCORES) + unknown * vocab.unknown_score
        assert abs(got - brute(word)) < 1e-6


def test_ids_of_documents_are_the_librarys(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert VOCAB.merged
    for text, data in zip(texts, VOCAB.encode(texts)):
        assert list(memoryview(data).cast("I")) == LIBRARY.encode(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("aab ct   hesionTHE.,\n\té日🙂"), max_size=40))
def test_ids_are_the_librarys(text):
    assert ids_of(VOCAB, text) == LIBRARY.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"], exclude_characters=[MARK]), max_size=80))
def test_round_trip(text):
    assert VOCAB.decode(np.array(ids_of(VOCAB, text), np.int64)) == text


def test_columns(spark):
    long = "word " * 30_000
    rows = [(1, None), (2, ""), (3, "Hello  the world\n é日本 🙂"), (3, "Hello  the world\n é日本 🙂"), (4, long),
            (5, "x" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    out = df.select("*", encode(F.col("text"), PATH).alias("ids"))
    back = out.select("doc_id", "text", "ids", decode(F.col("ids"), PATH).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in back)
    assert len([r for r in back if r.doc_id == 1][0].ids) == 0
    assert df.filter("false").select(encode(F.col("text"), PATH)).count() == 0


def test_joined_words_are_worked_out_once_each():
    """60 words joined in pairs in many ways: no piece crosses the signs between
    them, so only the words and signs are remembered, not 7,200 joined words."""
    vocab, rng = Vocabulary(PATH), random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(60)]
    texts = [" ".join(a + sign + b for b in words) for a in words for sign in (",", "\n")]
    for text, data in zip(texts, vocab.encode(texts)):
        assert list(memoryview(data).cast("I")) == LIBRARY.encode(text)
    assert len(vocab.known) + len(vocab.inner) <= 3 * len(words)


def test_a_batch_called_twice_is_encoded_once(monkeypatch):
    """Spark's plan calls for the ids of a batch, and again for them to decode them."""
    vocab, batch = Vocabulary(PATH), pa.array(["one two", "", "three\nfour"])
    calls, real = [], vocab._encode_texts
    monkeypatch.setattr(vocab, "_encode_texts", lambda texts: calls.append(len(texts)) or real(texts))
    first = vocab.encode_array(batch)
    again = vocab.encode_array(pa.array(batch.to_pylist()))
    assert calls == [3] and again.equals(first)
    other = vocab.encode_array(pa.array(["one two", "", "three\nfive"]))
    assert calls == [3, 3] and not other.equals(first)
    assert vocab.decode_array(other).to_pylist() == ["one two", "", "three\nfive"]


@pytest.mark.parametrize("size", [1, 7, 40])
def test_blocks_and_sliced_columns(monkeypatch, size):
    monkeypatch.setattr(operator, "TEXT_BYTES", size)
    monkeypatch.setattr(operator, "DECODED_IDS", size)
    texts = ["", "a", " a", "a ", "   ", "é", "\n", "日本 語", "", "the cat, the hat.\n\nthe", "🙂🙂", ""]
    lists = VOCAB.encode_array(pa.array(["before", *texts, "after"]).slice(1, len(texts)))
    assert lists.to_pylist() == [LIBRARY.encode(t) for t in texts]
    assert VOCAB.decode_array(lists).to_pylist() == texts
    assert VOCAB.decode_array(lists.slice(2, 5)).to_pylist() == texts[2:7]
    assert VOCAB.decode_array(lists.slice(0, 1)).to_pylist() == [""]


def test_a_text_with_marks_reads_them_as_spaces():
    for text in (f"a{MARK}b", MARK, f" {MARK} x{MARK}"):
        assert ids_of(VOCAB, text) == ids_of(VOCAB, text.replace(MARK, " "))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(sorted(VOCAB.id_bytes)),
                                   st.sampled_from([VOCAB.byte_ids[b] for b in "日".encode() + MARK.encode()]),
                                   st.integers(0, len(VOCAB.pieces) - 1)), max_size=8), max_size=5))
def test_any_ids_decode_as_one_by_one(rows):
    """Also bytes that are no text, alone or across two rows."""
    got = VOCAB.decode_array(pa.array(rows, pa.list_(pa.int32()))).to_pylist()
    assert got == [VOCAB.decode(np.array(r, np.int64)) for r in rows]
