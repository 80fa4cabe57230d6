"""Line-first quality rules, with DataFrame functions only.

Each line (split at newline) is held against three families of rules and removed when it fails one:

* punctuation: the line is short and ends without terminal punctuation, or its characters are symbols to a tenth and
  more, or nearly all of its words shout;
* navigation: several separators (``|``, ``»``, ``›``, ``•``) among few words;
* boilerplate: a phrase of page furniture (PHRASES), or a line of one word said over and over.

Then a document is rejected if it lost more than MAX_LOST of its word characters, or if it fails the base rules (fewer
than MIN_WORDS words, or more than half of its words in 3-word windows that it repeats). Windows are found by sorting
the 64-bit hashes of a document's windows inside its row, so nothing is shuffled.

Defined results: a null or empty text has no words and fails; lines without a word are neither counted nor removed;
repeated rows and ties are judged alike, each on its own. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.text import SPACES, WORD, fresh, whole

#: Fixed values.
SYMBOLS = "#*$%&|<>"
SYMBOL = "[#*$%&|<>]"
SEPARATORS = "|»›•"
SEPARATOR = "[|»›•]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SHORT_LINE = 4
MAX_SYMBOL_SHARE = 0.1
MAX_LOST = 0.5
PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "use cookies", "cookie policy", "enable javascript", "lorem ipsum",
    "sign up for our newsletter", "subscribe to our", "click here", "share on facebook", "licensed under", "copyright ©", "powered by",
)


def _let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _holds(text: Column, parts) -> Column:
    """Whether any of the strings is in the text."""
    return reduce(or_, (F.contains(text, F.lit(x)) for x in parts))


def repeated_words(words: Column) -> Column:
    """Number of words in 3-word windows found twice or more among the words, the first finding included. words: bound by _let, as each of them is looked at with its neighbours."""

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), marked))

    def marked(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        twice = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return covered(F.sort_array(F.transform(twice, lambda x: x["i"])))

    def covered(p: Column) -> Column:
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at")), lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["at"])).alias("n"), i.alias("at")), lambda a: a["n"])

    hashed = F.transform(words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(F.slice(hashed, 1, F.size(words) - 2), counted)).cast("long")


def line_fails(line: Column, symbols: Column, separators: Column, shouts: Column, phrases: Column) -> Column:
    """Whether a line fails. The other columns tell what its text holds anywhere, so that most lines are spared those rules."""
    count = F.regexp_count(line, F.lit(WORD))
    bare = lambda: F.length(F.regexp_replace(line, SPACES, ""))
    ended = F.rlike(line, F.lit(r"[.!?…:;]['\"”’»)\]]*[\x20\x09-\x0D]*$"))
    one_word = F.rlike(line, F.lit(rf"^[\x20\x09-\x0D]*(?:{WORD}{SPACES})?({WORD})(?:{SPACES}\1)+[\x20\x09-\x0D]*$"))
    many = F.regexp_count(line, F.lit(SEPARATOR))
    return _let(count, lambda n: (
        ((n < SHORT_LINE) & ~ended)
        | (symbols & (F.regexp_count(line, F.lit(SYMBOL)) > MAX_SYMBOL_SHARE * bare()))
        | (shouts & (n >= 2) & (F.regexp_count(line, F.lit("!{2,}")) * 2 > n))
        | (separators & (many >= 3) & (many * 4 >= n))
        | (phrases & _holds(F.lower(line), PHRASES))
        | ((n >= 8) & one_word)
    ))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def cleaned(text: str | Column) -> Column:
    """The text without the lines that fail."""
    text = whole(text)
    held = F.struct(_holds(text, SYMBOLS).alias("symbols"), _holds(text, SEPARATORS).alias("separators"), F.contains(text, F.lit("!!")).alias("shouts"), _holds(F.lower(text), PHRASES).alias("phrases"))
    return _let(held, lambda h: F.array_join(F.filter(_lines(text), lambda x: ~(F.rlike(x, F.lit(WORD)) & line_fails(x, *(h[c] for c in ("symbols", "separators", "shouts", "phrases"))))), "\n"))


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(_lines(text), lambda x: F.rlike(x, F.lit(WORD)))
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def judged(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the columns of MEASURES, named by measure_names(docs)."""
    n, chars, symbols, lines, repeats, clean, base, kept = measure_names(docs)
    (made,) = fresh(docs, "made")
    text = whole(text_col)
    by_words = _let(F.array_remove(F.split(text, SPACES), ""), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"), repeated_words(w).alias("repeats")))
    n_symbols = F.when(_holds(text, SYMBOLS), F.regexp_count(text, F.lit(SYMBOL))).otherwise(F.lit(0)).cast("long")
    # A generator of one row: what it makes is worked out once, and a filter on it stays above it.
    out = docs.withColumn(made, F.explode(F.array(F.struct(by_words.alias("w"), n_symbols.alias("symbols"), _duplicate_lines(text).alias("lines"), cleaned(text).alias("clean")))))
    out = out.select(*docs.columns, *(F.col(f"{made}.{x}").alias(name) for x, name in (("w.n", n), ("w.chars", chars), ("symbols", symbols), ("lines", lines), ("w.repeats", repeats), ("clean", clean))))
    left = F.length(F.regexp_replace(clean, SPACES, ""))
    out = out.withColumn(base, (F.col(n) < MIN_WORDS) | (100 * F.col(repeats) > MAX_REPEATED_PERCENT * F.col(n)))
    return out.withColumn(kept, ~F.col(base) & (left >= (1 - MAX_LOST) * F.col(chars)))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean_text", "base_failed", "kept")


def measure_names(docs: DataFrame) -> list[str]:
    return fresh(docs, *MEASURES)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, the measures, base_failed and kept (see the module)."""
    slim = docs.select(F.col(id_col).alias("the id"), F.col(text_col).alias("the text"))
    return judged(slim, "the text").select(F.col("the id").alias(id_col), *(c for c in MEASURES if c != "clean_text"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows that stay, in docs' columns, their text without the lines that failed."""
    names = dict(zip(MEASURES, measure_names(docs)))
    good = judged(docs, text_col).where(F.col(names["kept"])).withColumn(text_col, F.col(names["clean_text"]))
    if "n_chars" in docs.columns and text_col != "n_chars":
        good = good.withColumn("n_chars", F.length(text_col).cast("long"))
    return good.select(*docs.columns)
