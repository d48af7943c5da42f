import importlib.util
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tarmac.llm import simhash
from tarmac.llm.common import documents
from tests_llm_helpers import brute_repeats

SF = "/root/testdata/sf0.001"


def test_stages_hold_against_brute_force(spark):
    docs, names = documents(spark, SF), [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact dedup", "near dedup", "substring dedup", "packing"]
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    kept = corpus_pipeline.drop_low_quality(spark, docs, SF)
    assert kept.columns == columns
    kept = spark.createDataFrame(kept.collect(), docs.schema)
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert set(rows) <= set(before) and 0.6 < len(rows) / len(before) < 1
    # exact copies: the largest id stays
    out = corpus_pipeline.drop_exact_copies(spark, kept, SF)
    want = {t: max(i for i, x in rows.items() if x == t) for t in rows.values()}
    rows = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == columns and rows == {i: t for t, i in want.items()}
    kept = spark.createDataFrame(out.collect(), docs.schema)
    # near copies: the smallest id of a component stays
    out = corpus_pipeline.drop_near_copies(spark, kept, SF)
    fps = {i: simhash.fingerprint(t or "") for i, t in rows.items()}
    root = {i: i for i in rows}
    changed = True
    while changed:
        changed = False
        for i in rows:
            for j in rows:
                if bin(fps[i] ^ fps[j]).count("1") <= 3 and root[j] < root[i]:
                    root[i], changed = root[j], True
    rows = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == columns and set(rows) == {i for i in root if root[i] == i}
    kept = spark.createDataFrame(out.collect(), docs.schema)
    # repeated passages
    out = corpus_pipeline.cut_repeats(spark, kept, SF)
    want = brute_repeats(rows)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == columns
    for i, t in rows.items():
        assert got[i].text == (want[i] if i in want else t)
        assert got[i].n_chars == (len(want[i]) if i in want else len(t))
    packed = corpus_pipeline.pack_sequences(spark, spark.createDataFrame(out.collect(), docs.schema), SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(rows)


def test_null_and_repeated_ids_through_every_stage(spark):
    """No stage loses a text that its rule does not name, whatever its id is."""
    rng = __import__("random").Random(5)

    def prose(n):
        return " ".join(rng.choice("abcdefghijklmnopqrst") + str(rng.randint(0, 999)) for _ in range(n)) + "."
    texts = [prose(rng.randint(60, 200)) for _ in range(24)]
    rows = [(None, texts[0], 1), (None, texts[1], 2), (None, texts[1], 3), (None, None, 4)]
    rows += [(7, texts[2], 5), (7, texts[3], 6), (7, texts[3], 6), (7, None, 7)]
    rows += [(i, t, 8) for i, t in enumerate(texts[4:], 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `source.x` int")
    texts_of = lambda df: sorted({(r.text or "") for r in df.collect()})
    want = sorted({t or "" for _, t, _ in rows})
    for stage in (corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies, corpus_pipeline.cut_repeats):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert texts_of(out) == want
        docs = spark.createDataFrame(out.collect(), docs.schema)
    # equal texts left once, under the largest id; the empty text too
    assert docs.count() == len(want)
    scored = corpus_pipeline.drop_low_quality(spark, docs, SF)
    assert scored.columns == docs.columns and set(texts_of(scored)) <= set(want)
    packed = corpus_pipeline.pack_sequences(spark, docs, SF)
    assert packed.count() == docs.count()
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_run_and_extra_columns(spark):
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None
    assert entry.queries()["pipeline"](spark, SF).count() > 100
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (2, "", 6), (3, "a b", 7)],
                                 "doc_id long, text string, keep_id int")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "keep_id"]
    # exact: null and empty are equal, so 2 stays of them
    assert sorted(r.doc_id for r in docs.collect()) == [2, 3]
    empty = docs.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


@pytest.mark.parametrize("name", ["op5_substring_dedup", "op9_exact_dedup", "op11_source_divergence",
                                  "op13_quality_rules"])
def test_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = con.sql(entry.oracle_sql()[name])
    assert cols == sorted(want.columns)
    got = sorted(tuple(r) for r in df.select(*cols).collect())
    assert got == sorted(want.select(", ".join(cols)).fetchall())


CONTRACT = {
    "op1_": ("doc_id", "held_out", "score", "predicted"),
    "op2_": ("doc_id", "held_out", "lang_pred", "score"),
    "op3_": ("page_id", "url", "text", "n_chars"),
    "op4_": ("doc_id", "held_out", "score", "predicted"),
    "op5_": ("doc_id", "n_words", "n_removed", "kept_sha256"),
    "op6_": ("doc_id", "n_ids"),
    "op7_": ("doc_id", "fingerprint", "component_id"),
    "op8_": ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"),
    "op9_": ("doc_id", "keep_id", "group_size", "kept", "text_sha256"),
    "op11_": ("lang", "source", "part", "item", "value", "rank"),
    "op12_": ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"),
    "op13_": ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
    "op10_": ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"),
}


def test_contract_columns(spark):
    con = duckdb.connect()
    n = {t: con.sql(f"SELECT count(*) FROM '{SF}/{t}.parquet'").fetchall()[0][0] for t in ("documents", "pages")}
    for prefix, columns in CONTRACT.items():
        names = [k for k in entry.queries() if k.startswith(prefix)]
        assert len(names) == 1
        df = entry.queries()[names[0]](spark, SF)
        assert tuple(df.columns[:len(columns)]) == columns
        if prefix not in ("op10_", "op11_", "op12_"):
            assert df.count() == n["pages" if prefix == "op3_" else "documents"]


def test_guard_is_in_the_entry_alone():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in os.listdir(f"{root}/tarmac/llm"):
        if name.endswith(".py"):
            with open(f"{root}/tarmac/llm/{name}") as f:
                assert "ImportError" not in f.read()
    assert importlib.util.find_spec("tarmac.llm") and "corpus_pipeline" in sys.modules
