"""Queries of the corpus operators: one thin query per operator over its whole
table, and the DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (divergence, exact, fingerprint, language, packing, quality, rules, sentencepiece,
                        simhash, substring, template, toxicity, whitening)
from tarmac.llm.common import documents, fold, read_table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; the operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Score from which on a document counts as of label 1.
TOXIC_FROM = 0.7
GOOD_FROM = 0.3


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = read_table(spark, sf_dir, "labels").filter(fold("doc_id", 3) != 1)
    model = toxicity.fit_toxicity(docs, labels)
    return (docs.select("doc_id", toxicity.toxicity(model, F.col("text")).alias("found"))
            .select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "found.score",
                    (F.col("found.score") >= TOXIC_FROM).cast("int").alias("predicted"), "found.spans"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit_language(docs.filter(fold("doc_id", 4) != 2))
    return (docs.select("doc_id", language.language(model, F.col("text")).alias("found"))
            .select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"),
                    F.col("found.lang").alias("lang_pred"), "found.score"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.main_texts(read_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = read_table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0)
    model = quality.fit_quality(docs, labels)
    return (docs.select("doc_id", quality.quality_score(model, F.col("text")).alias("score"))
            .select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                    (F.col("score") >= GOOD_FROM).cast("int").alias("predicted")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = substring.remove_repeats(docs, window=50)
    found = F.col(substring.result_column(docs))
    return out.select("doc_id", found["n_words"].alias("n_words"), found["n_removed"].alias("n_removed"),
                      F.sha2(found["kept"], 256).alias("kept_sha256"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("piece_bpe_32k.model")
    docs = documents(spark, sf_dir)
    ids = docs.select("doc_id", "text", sentencepiece.encode(F.col("text"), path).alias("ids"))
    back = ids.select("doc_id", "text", "ids", sentencepiece.decode(F.col("ids"), path).alias("decoded"))
    return back.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"),
        F.sha2(F.array_join(F.transform("ids", lambda x: x.cast("string")), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, radius=3)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"),
                        capacity=1024, end_id=2)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir), min_docs=10, top=10)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=4)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = F.col(rules.result_column(docs))
    return rules.quality_rules(docs).select("doc_id", *[found[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_lines_removed", "kept_chars")])


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_language": op2_language,
        "op3_html_text": op3_html_text,
        "op4_quality": op4_quality,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_simhash": op7_simhash,
        "op8_fingerprint": op8_fingerprint,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_packing": op10_packing,
        "op11_source_divergence": op11_source_divergence,
        "op12_whitening": op12_whitening,
        "op13_quality_rules": op13_quality_rules,
    }


OP9_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP5_SQL = r"""
WITH words AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (
    SELECT doc_id, p, hash(array_to_string(w[p:p + 49], ' ')) AS h1,
           md5(array_to_string(w[p:p + 49], ' ')) AS h2
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM words WHERE len(w) >= 50)),
first AS (SELECT h1, h2, min(doc_id) AS first_doc FROM windows GROUP BY h1, h2),
repeated AS (
    SELECT doc_id, p FROM windows JOIN first USING (h1, h2) WHERE first_doc < doc_id),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM repeated),
marked AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
lost AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i
    FROM words JOIN marked USING (doc_id)),
kept AS (
    SELECT lost.doc_id, array_to_string(list(word ORDER BY lost.i), ' ') AS kept
    FROM lost ANTI JOIN gone ON lost.doc_id = gone.doc_id AND lost.i = gone.i GROUP BY lost.doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(len(marked.gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN marked.gone IS NULL THEN array_to_string(w, ' ')
                   ELSE coalesce(kept.kept, '') END) AS kept_sha256
FROM words LEFT JOIN marked USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


OP11_SQL = r"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
counts AS MATERIALIZED (
    SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS d
    FROM (SELECT r, lang, source, unnest(w) AS term FROM docs) GROUP BY lang, source, term),
kept AS MATERIALIZED (
    SELECT lang, term, CAST(sum(n) AS BIGINT) AS n_lang FROM counts GROUP BY lang, term HAVING sum(d) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n_lang) AS total FROM kept GROUP BY lang),
known AS MATERIALIZED (
    SELECT counts.lang, source, term, n, n_lang FROM counts JOIN kept USING (lang, term)),
groups AS MATERIALIZED (
    SELECT g.lang, g.source, coalesce(langs.v, 0) AS v, coalesce(langs.total, 0) AS lang_total,
           coalesce(k.total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM known GROUP BY lang, source) k USING (lang, source)),
shares AS MATERIALIZED (
    SELECT g.lang, g.source, kept.term, coalesce(known.n, 0) AS n,
           CAST(1 + (1000000000 * CAST(coalesce(known.n, 0) + 2 AS HUGEINT)) // (g.total + 2 * g.v) AS BIGINT) AS p,
           CAST(1 + (1000000000 * CAST(kept.n_lang + 2 AS HUGEINT)) // (g.lang_total + 2 * g.v) AS BIGINT) AS q
    FROM groups g JOIN kept USING (lang)
    LEFT JOIN known ON known.lang = g.lang AND known.source = g.source AND known.term = kept.term),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
pairs AS (
    SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN sums ON sums.lang = g.lang AND sums.source = g.source AND sums.item = h.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value
    FROM shares WHERE n > 0 AND p > q)
SELECT * FROM (
    SELECT lang, source, part, item, value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 10
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


OP13_SQL = rf"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
words AS MATERIALIZED (
    SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
    SELECT r, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS x
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM words WHERE len(w) >= 3)),
again AS (
    SELECT r, unnest([p, p + 1, p + 2]) AS i
    FROM (SELECT r, p, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT i) AS n FROM again GROUP BY r),
lines AS MATERIALIZED (
    SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line),
judged AS (
    SELECT r, n, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS ink,
           NOT regexp_matches(line, {_quoted(rules.SENTENCE_END)})
           OR 100 * len(list_filter(w, lambda x: regexp_matches(x, {_quoted(rules.ODD_WORD)})))
              > {rules.MAX_ODD} * len(w)
           OR regexp_matches(line, {_quoted(rules.MENU_LABEL)})
           OR len(list_filter(w, lambda x: regexp_matches(x, {_quoted(rules.SEPARATOR)}))) >= 2
           OR len(w) <= {rules.BOILERPLATE_WORDS} AND regexp_matches(line, {_quoted(rules.BOILERPLATE)})
           AS fails
    FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM lines)),
of_lines AS (
    SELECT r, sum(n) AS n, sum(n - 1) AS dup, sum(n - (CASE WHEN fails THEN 0 ELSE 1 END)) AS removed,
           sum(CASE WHEN fails THEN 0 ELSE ink END) AS kept_chars
    FROM judged GROUP BY r),
facts AS (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(l.dup, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
           coalesce(l.n, 0) AS n_lines, coalesce(removed, 0) AS n_lines_removed,
           coalesce(kept_chars, 0) AS kept_chars
    FROM docs JOIN words USING (r) LEFT JOIN repeated USING (r) LEFT JOIN of_lines l USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * (word_chars - kept_chars) <= {rules.MAX_LOST} * word_chars AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_lines_removed AS BIGINT) AS n_lines_removed,
       CAST(kept_chars AS BIGINT) AS kept_chars
FROM (SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words
             AS base_failed FROM facts)
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_substring_dedup": OP5_SQL, "op9_exact_dedup": OP9_SQL,
            "op11_source_divergence": OP11_SQL, "op13_quality_rules": OP13_SQL}
