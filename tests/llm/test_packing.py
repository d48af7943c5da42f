import random
import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tarmac.llm.packing import BytePairIds, _fullest, pack, packing_plan

PATH = P.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
IDS = BytePairIds(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t\r  'sabZé1.,!日\x1c")), st.characters(
    exclude_categories=["Cs"])), max_size=60))
def test_ids_are_the_librarys(text):
    want = WHOLE.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(IDS.encode(text), "<u4").tolist() == want


def test_special_string():
    text = "a <|endoftext|> b"
    assert np.frombuffer(IDS.encode(text), "<u4").tolist() == \
        WHOLE.encode(text, add_special_tokens=False).ids


def test_every_code_point_and_long_words():
    """Both libraries cut a text alike around every character there is."""
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for lo in range(0, len(chars), 400):
        text = "".join(f"a{c}b1{c}2 {c}{c} .{c}" for c in chars[lo:lo + 400:7])
        assert np.frombuffer(IDS.encode(text), "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids
    for text in ("a" * 300_000, "abcdefghij" * 30_000, " " * 100_000, "é日" * 50_000):
        assert np.frombuffer(IDS.encode(text), "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_files_of_other_kinds_go_to_their_library():
    other = P.path("word_bpe_49k.json")
    text = "Some words, and MORE <|endoftext|> words"
    ids = BytePairIds(other)
    assert ids._ranked is None
    assert np.frombuffer(ids.encode(text), "<u4").tolist() == Tokenizer.from_file(other).encode(
        text, add_special_tokens=False).ids


def test_fullest_is_optimal():
    rng = random.Random(0)
    for _ in range(200):
        room = rng.randint(0, 40)
        counts = np.zeros(41, np.int64)
        for _ in range(rng.randint(0, 8)):
            counts[rng.randint(1, 40)] += rng.randint(1, 3)
        found = _fullest(counts, room)
        assert all(found.count(x) <= counts[x] for x in found)
        sums = {0}
        for x in range(1, 41):
            for _ in range(int(counts[x])):
                sums |= {s + x for s in sums if s + x <= room}
        assert sum(found) == max(sums)


def test_plan_places_all_and_little_is_left():
    rng = random.Random(1)
    counts = {}
    for _ in range(5000):
        n = rng.randint(1, 1024)
        counts[n] = counts.get(n, 0) + 1
    plan = packing_plan(dict(counts))
    used = {}
    for lengths, times in plan:
        assert sum(lengths) <= 1024
        for x in lengths:
            used[x] = used.get(x, 0) + times
    assert used == counts
    total = sum(k * v for k, v in counts.items())
    assert sum(t for _, t in plan) <= -(-total // 1024) * 1.02


def test_pack_end_to_end(spark, docs_of):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma,", "délta", "x.\ny", "  "]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 40, 900, 3000]))))
            for i in range(60)]
    rows += [(100, None), (101, ""), (102, "same"), (102, "same"), (None, "no id")]
    got = pack(docs_of(rows), PATH).toPandas()
    for doc, text in rows:
        ids = np.array(WHOLE.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        mine = got[got.doc_id.isna()] if doc is None else got[got.doc_id == doc]
        copies = sum(1 for d, _ in rows if d == doc)
        assert mine.length.sum() == len(ids) * copies
        assert len(mine) == -(-len(ids) // 1024) * copies
        for r in mine.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            assert r.length == 1024 or r.piece == 0
    for _, bin_ in got.sort_values("offset").groupby("sequence_id"):
        assert bin_.length.sum() <= 1024
        assert (bin_.offset.to_numpy() == np.cumsum(bin_.length.to_numpy()) - bin_.length.to_numpy()).all()


def test_empty(spark, docs_of):
    assert pack(docs_of([(1, "a")]).filter("false"), PATH).count() == 0
