"""Quality rules, line first: every line is judged alone, lines that fail are
removed, and a document that loses too much of its text is rejected.

Base rules look at the whole text: too few words, or too many words in windows
of three words that occur twice or more. Then each distinct line with a word
is judged:

* punctuation: a line fails if no sentence ends in it, or if too many of its
  words hold symbols or end in doubled marks;
* navigation: it fails if it is a known menu label, or if separators stand
  between its words;
* boilerplate: a short line with a licence, copyright, cookie or call-to-action
  phrase fails, and so does a line that the document had before.

What is left are the first copies of the lines that pass. The document is kept
if at most ``MAX_LOST`` per cent of its word characters went.

Only DataFrame functions are used, on arrays within a row: no row moves, so a
hot source, copies or frequent lines make no difference.

Defined results: a null text is an empty one, and an empty text has no words,
fails the base rules and is not kept. Repeated rows and ties are judged one by
one, an empty table gives an empty result, other columns pass through. Work
grows with the words of a text (times the logarithm, for the windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.exprs import let
from tarmac.llm.common import free_name, text_of

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words, in windows found twice or more
WINDOW = 3
MAX_LOST = 30      # per cent of the word characters
MAX_ODD = 30       # per cent of a line's words with symbols or doubled marks
BOILERPLATE_WORDS = 40
#: Places of windows that fit beside 40 bits of their hash.
PLACES = 1 << 24

# White space between words, and the symbols counted.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "[#*$%&|<>]+"

INK = r"[^\x20\x09-\x0D]"
GAP = r"[\x20\x09-\x0D]+"
#: A closing mark, perhaps with quotes or brackets after it, at the end of a word.
SENTENCE_END = r"[.!?…。！？][\"'”’»)\]]*([\x20\x09-\x0D]|\z)"
#: A word that is no prose: it holds a symbol, or ends in doubled marks.
ODD_WORD = r"[#*$%&|<>{}\\~^=]|[!?]{2,}\z"
#: What every odd word and every separator holds.
ODD_MARK = r"[#*$%&|<>{}\\~^=/«»‹›•·→]|[!?]{2}|::|--"
#: A word that only separates menu items.
SEPARATOR = r"\A([|/<>«»‹›•·→]|::|>>|<<|--+)\z"
MENU_LABEL = (
    r"(?i)\A[\x20\x09-\x0D]*(home|menu|search|log ?in|log ?out|sign ?(in|up|out)|register|next|previous|"
    r"prev|back( to top)?|read more|more|share( this)?|print|skip to (main )?content|contact( us)?|"
    r"about( us)?|site ?map|help|faq|older posts|newer posts|loading)[\x20\x09-\x0D.!?:>»›…]*\z")
BOILERPLATE = (
    r"(?i)©|\(c\) ?[0-9]{4}|(?:\A|[^a-z])(?:all rights reserved|copyright [0-9]{4}|licensed under|released under the|"
    r"terms of (use|service)|privacy policy|cookie policy|(uses?|accept|our) cookies|enable javascript|"
    r"lorem ipsum|click here|subscribe (to|now)|sign up for|our newsletter|powered by|follow us on|"
    r"share (this|on) )")


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, GAP), lambda w: w != "")


def _ink(text: Column) -> Column:
    """Code points of a text that stand in words."""
    return F.char_length(F.translate(text, BLANKS, ""))


def repeated_words(w: Column) -> Column:
    """How many words lie in a window of three words that the list ``w`` has
    twice or more. Sorted hashes that carry their place find the windows that
    may be equal; those are then sorted as words, so equal ones are neighbours."""
    def hashed(x: Column, i: Column) -> Column:
        return F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(
            F.lit(-PLACES)).bitwiseOR(i.cast("bigint"))

    def alike(x: Column, y: Column) -> Column:
        return F.shiftrightunsigned(x.bitwiseXOR(y), 24).eqNullSafe(F.lit(0).cast("bigint"))

    def maybe(s: Column) -> Column:
        found = F.filter(s, lambda x, k: alike(x, F.get(s, k - 1)) | alike(x, F.get(s, k + 1)))
        return F.transform(found, lambda x: x.bitwiseAND(F.lit(PLACES - 1)).cast("int"))

    def window(i: Column) -> Column:
        return F.struct(*[F.get(w, i + k).alias(f"w{k}") for k in range(WINDOW)], i.alias("i"))

    def same(x: Column, y: Column) -> Column:
        equal = x["w0"] == y["w0"]
        for k in range(1, WINDOW):
            equal = equal & (x[f"w{k}"] == y[f"w{k}"])
        return F.coalesce(equal, F.lit(False))

    def covered(s: Column) -> Column:
        again = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
        places = F.transform(again, lambda x: F.array(*[x["i"] + k for k in range(WINDOW)]))
        return F.size(F.array_distinct(F.flatten(places)))

    n = F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))
    hashes = F.sort_array(F.transform(F.slice(w, F.lit(1), n), hashed))
    # A list whose places do not fit beside the hashes has all its windows sorted.
    candidates = F.when(n < PLACES, let(hashes, maybe)).otherwise(F.sequence(F.lit(0), n - 1))
    return let(F.sort_array(F.transform(candidates, window)), covered)


def line_fails(line: Column) -> Column:
    """Whether a line fails one of the rules that look at it alone."""
    def by_word(w: Column) -> Column:
        odd = F.size(F.filter(w, lambda x: x.rlike(ODD_WORD)))
        return (odd * 100 > F.size(w) * MAX_ODD) | (
            F.size(F.filter(w, lambda x: x.rlike(SEPARATOR))) >= 2)

    # Most lines hold no mark that could make a word odd or a separator.
    marked = F.when(line.rlike(ODD_MARK), let(words(line), by_word)).otherwise(F.lit(False))
    boilerplate = line.rlike(BOILERPLATE) & (F.size(words(line)) <= BOILERPLATE_WORDS)
    return ~line.rlike(SENTENCE_END) | line.rlike(MENU_LABEL) | marked | boilerplate


def _facts(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(INK))
    of_lines = let(lines, lambda x: let(F.array_distinct(x), lambda first: F.struct(
        F.size(x).alias("n"), F.size(first).alias("n_first"),
        F.filter(first, lambda line: ~line_fails(line)).alias("kept"))))
    of_words = let(words(text), lambda w: F.struct(
        F.size(w).alias("n"), repeated_words(w).alias("n_repeated")))
    return F.struct(
        _ink(text).alias("word_chars"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).alias("n_symbols"),
        of_lines.alias("lines"), of_words.alias("words"))


RESULT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, n_lines bigint, n_lines_removed bigint, kept_chars bigint, kept boolean, "
          "cleaned string")


def quality_rules(docs: DataFrame, text_col: str = "text", result: str = "rules") -> DataFrame:
    """``docs`` with a struct column (named by :func:`result_column`) of the
    base counts, the verdicts and ``cleaned``, the lines that passed."""
    facts, name = free_name(docs, "_facts"), free_name(docs, result)
    # bound once per row, so no part of it is worked out again by its readers
    with_facts = docs.withColumn(facts, _facts(text_of(F.col(f"`{text_col}`"))))

    def judged(f: Column) -> Column:
        n, lines = f["words"]["n"], f["lines"]
        kept_chars = F.when(lines["n"] == F.size(lines["kept"]), f["word_chars"].cast("bigint")).otherwise(
            F.aggregate(lines["kept"], F.lit(0).cast("bigint"), lambda s, x: s + _ink(x)))
        base_failed = (n < MIN_WORDS) | (f["words"]["n_repeated"].cast("bigint") * 100 >
                                         n.cast("bigint") * MAX_REPEATED)
        enough = (f["word_chars"] - kept_chars) * 100 <= f["word_chars"].cast("bigint") * MAX_LOST
        return F.struct(
            n.alias("n_words"), f["word_chars"].alias("word_chars"), f["n_symbols"].alias("n_symbols"),
            (lines["n"] - lines["n_first"]).alias("n_dup_lines"),
            f["words"]["n_repeated"].alias("n_repeat_words"), base_failed.alias("base_failed"),
            lines["n"].alias("n_lines"), (lines["n"] - F.size(lines["kept"])).alias("n_lines_removed"),
            kept_chars.alias("kept_chars"), (~base_failed & enough).alias("kept"),
            F.array_join(lines["kept"], "\n").alias("cleaned"))

    out = with_facts.withColumn(name, let(F.col(facts), judged).cast(f"struct<{_ddl()}>"))
    return out.drop(facts)


def _ddl() -> str:
    return ", ".join(":".join(field.split(" ")) for field in RESULT.split(", "))


def result_column(docs: DataFrame, result: str = "rules") -> str:
    """Name of the column that :func:`quality_rules` adds to ``docs``."""
    return free_name(docs, result)


def clean_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, with their cleaned text, all columns kept."""
    judged = quality_rules(docs, text_col)
    found = F.col(result_column(docs))
    columns = [found["cleaned"].alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return judged.filter(found["kept"]).select(*columns)
