import re

import pytest
from pyspark.sql import functions as F

from tarmac.llm import rules
from tarmac.llm.rules import clean_documents, quality_rules, result_column

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PYTHON = {n: re.compile(getattr(rules, n).replace(r"\z", r"\Z"))
          for n in ("SENTENCE_END", "ODD_WORD", "SEPARATOR", "MENU_LABEL", "BOILERPLATE")}


def brute(text):
    """The same rules, line by line and window by window."""
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for p in range(len(words) - 2):
        windows.setdefault(tuple(words[p:p + 3]), []).append(p)
    covered = {p + i for at in windows.values() if len(at) > 1 for p in at for i in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    kept, seen = [], set()
    for line in lines:
        w = WORD.findall(line)
        odd = sum(bool(PYTHON["ODD_WORD"].search(x)) for x in w)
        fails = (line in seen or not PYTHON["SENTENCE_END"].search(line) or 100 * odd > 30 * len(w)
                 or PYTHON["MENU_LABEL"].search(line)
                 or sum(bool(PYTHON["SEPARATOR"].search(x)) for x in w) >= 2
                 or len(w) <= 40 and PYTHON["BOILERPLATE"].search(line))
        seen.add(line)
        if not fails:
            kept.append(line)
    ink = sum(map(len, words))
    kept_ink = sum(len(x) for line in kept for x in WORD.findall(line))
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), ink, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), base, len(lines), len(lines) - len(kept), kept_ink,
            not base and 100 * (ink - kept_ink) <= 30 * ink, "\n".join(kept))


PROSE = " ".join(f"word{i} stands{i % 7} here{i % 11}." for i in range(60))
CASES = [
    None, "", "   \n\t \n", "one two", PROSE, PROSE + "\n" + PROSE, PROSE + "\nHome\nAbout us\nAll rights reserved.",
    "\n".join([PROSE, "Home | News | Sport | More.", "Enable JavaScript to go on.", "No mark at its end",
               "Wait!! What!! No!! Go!!", "a# b# c# d.", "A quoted end.”", " ", "\x1cx\x85y."]),
    "go on now " * 40, "a b c a b c " * 20, "x y\r\nx y\r\nx y", "é " * 60, "!!! ??? " * 30,
    "Short line.\n" * 80, "\U0001F600 " * 55 + "fin.", PROSE.replace(" ", "\x0b"), "w" * 5000 + ". " + PROSE,
]


@pytest.fixture()
def judged(docs_of):
    docs = docs_of(list(enumerate(CASES)) + [(None, PROSE), (4, PROSE), (None, None)])
    return docs.withColumnRenamed("fp", "rules").withColumnRenamed("n", "a.b"), docs


def test_against_brute_force(judged):
    docs, _ = judged
    out = quality_rules(docs)
    assert out.columns[:-1] == docs.columns and out.columns[-1] == result_column(docs) == "_rules"
    got = [(r.doc_id, r.text, tuple(r["_rules"])) for r in out.collect()]
    assert len(got) == len(CASES) + 3
    for i, text, found in got:
        assert found == brute(text), (i, text and text[:60])


def test_clean_documents_keeps_columns(judged):
    docs, _ = judged
    out = clean_documents(docs)
    assert out.columns == docs.columns
    by = {r.doc_id: r.text for r in out.collect()}
    assert by[6] == PROSE and 5 not in by and 0 not in by


def test_no_prose_survives_by_length_and_long_texts_pass(spark, docs_of):
    long = "\n".join(f"This is sentence number {i} of a long text." for i in range(30_000))
    rows = {r.doc_id: r["rules"] for r in quality_rules(docs_of([(1, long), (2, "spam spam spam " * 40_000)])).collect()}
    assert rows[1]["n_words"] == 270_000 and rows[1]["kept"] is False  # its windows repeat
    assert rows[1]["n_lines_removed"] == 0
    assert rows[2]["n_repeat_words"] == 120_000 and rows[2]["base_failed"]


def test_no_python_in_the_plan(docs_of):
    plan = quality_rules(docs_of([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange hash", plan)


def test_empty_table(docs_of):
    assert quality_rules(docs_of([(1, "x")]).filter(F.lit(False))).count() == 0
