"""Line-first cleaning with built-in expressions only.

Every line of a text is judged on its own: a line fails that looks like navigation, is mostly
marks, or is boilerplate. Failing lines are removed; a document goes when it fails the base rules
(too few words, too many words inside repeated 5-word windows) or loses too much of its words.

One pass over the texts, no shuffle: each document is judged from its own row, so no group of rows
ever meets in a task. A text of n words costs n log n at most.

Defined cases: a null text counts as an empty one (no words, base_failed, not kept); blank lines
never fail and count for nothing; repeated rows are judged alike; an empty table gives no rows;
other columns, whatever their names, pass through ``clean`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, let, words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
#: A line fails when more than this part of its words, in percent, carries a run of marks.
MAX_MARKED_PCT = 30
#: A line is navigation when more than this part of its words, in percent, is a bare separator.
MAX_SEPARATOR_PCT = 25
#: A document goes when more than this part of its words, in percent, stood in failing lines.
MAX_LOST_PCT = 50

SYMBOLS = r"[#*$%&|<>]"
MARK_RUN = r"[!?#*$%&|<>^~=_]{2,}"
SEPARATOR = r"^[|>»·•/]+$"
BOILERPLATE = (r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie policy|we use cookies"
               r"|enable javascript|(licensed|released) under|is licensed under|copyright \(c\)|©"
               r"|click here|sign up for|subscribe to our|back to top|skip to content)")


def n_repeat_words(w: Column) -> Column:
    """Words lying in a ``WINDOW``-word window that the same word array holds at least twice.

    Windows are compared by 64-bit hash (a text of 20,000 words has 2e8 pairs of windows, so a
    false match has odds of about 1e-11). Positions of windows that occur again are sorted; each
    covers its five words, less what the next one covers.
    """
    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.when(k == F.size(p) - 1, WINDOW).otherwise(F.least(F.lit(WINDOW), F.get(p, k + 1) - x)))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def positions(s: Column) -> Column:
        again = F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | ((k < F.size(s) - 1) & (F.get(s, k + 1)["h"] == x["h"])))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def repeats(h: Column) -> Column:
        keyed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(F.sort_array(keyed), lambda s: let(positions(s), covered)))

    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    return F.when(F.size(w) < WINDOW, 0).otherwise(let(hashes, repeats)).cast("long")


def line_fails(line: Column) -> Column:
    """Whether a line is removed: navigation, mostly marks, or boilerplate."""
    def rules(w: Column) -> Column:
        n = F.size(w)
        marked = F.size(F.filter(w, lambda x: x.rlike(MARK_RUN)))
        bare = F.size(F.filter(w, lambda x: x.rlike(SEPARATOR)))
        return (n > 0) & ((marked * 100 > n * MAX_MARKED_PCT) | (bare * 100 > n * MAX_SEPARATOR_PCT))
    return let(words(line), rules) | line.rlike(BOILERPLATE)


def judged(docs: DataFrame, text_col: str = "text", as_col: str = "rules") -> DataFrame:
    """``docs`` with one struct column: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lost (words in failing lines), base_failed, kept and the cleaned text."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def of_lines(lines: Column) -> Column:
        full = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        good = F.filter(lines, lambda x: ~line_fails(x))
        return F.struct(let(full, lambda f: F.size(f) - F.size(F.array_distinct(f))).cast("long").alias("n_dup_lines"), F.array_join(good, "\n").alias("clean"))

    of_words = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        n_repeat_words(w).alias("n_repeat_words")))
    w, ln, out = fresh(docs, "_words", "_lines", "_left")
    df = docs.withColumn(w, of_words).withColumn(ln, let(F.split(text, "\n"), of_lines))
    df = df.withColumn(out, F.size(words(F.col(f"{ln}.clean"))).cast("long"))
    n, rep = F.col(f"{w}.n_words"), F.col(f"{w}.n_repeat_words")
    failed = (n < MIN_WORDS) | (rep * 100 > n * MAX_REPEAT_PCT)
    lost = n - F.col(out)
    return df.withColumn(as_col, F.struct(
        n.alias("n_words"), F.col(f"{w}.word_chars").alias("word_chars"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.col(f"{ln}.n_dup_lines").alias("n_dup_lines"), rep.alias("n_repeat_words"), lost.alias("n_lost"),
        failed.alias("base_failed"), (~failed & (lost * 100 <= n * MAX_LOST_PCT)).alias("kept"),
        F.col(f"{ln}.clean").alias("clean"))).drop(w, ln, out)


def clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents that pass, without their failing lines; ``n_chars``, where there is one, follows.

    The verdict leaves a generator of one row: a filter on it is not moved below, where the rules
    would be evaluated once for the filter and once for the cleaned text."""
    r, one = fresh(docs, "_rules", "_rule")
    df = judged(docs, text_col, r).select(*[f"`{c}`" for c in docs.columns], F.explode(F.array(F.col(r))).alias(one))
    df = df.where(F.col(f"{one}.kept")).withColumn(text_col, F.col(f"{one}.clean"))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.char_length(text_col).cast(docs.schema["n_chars"].dataType))
    return df.select(*[f"`{c}`" for c in docs.columns])
