"""Line-first cleaning, in SQL functions alone.

Every line with a word is judged by itself, failing lines are removed, and a document that loses too
much of its text with them is rejected. A line fails if

* punctuation: over ``PUNCTUATION_PERCENT`` of its characters are neither letters, their combining
  marks nor digits;
* navigation: it has at least ``SEPARATORS`` separators, or at most ``SHORT_WORDS`` words and no
  mark at its end;
* boilerplate: it holds one of the phrases;
* repetition: it equals an earlier line.

Base figures of the whole text come with it: words, characters in words, symbols, repeated lines,
and words lying in 8-word windows that the text holds twice or more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veracast.llm.common import refuse_taken

LEAST_WORDS = 20
REPEATED_PERCENT = 30
WINDOW = 8
PUNCTUATION_PERCENT = 20
SEPARATORS = 3
SHORT_WORDS = 3
KEPT_PERCENT = 50

BLANK = r"[ \t-\r]"
SEPARATOR_CHARS = "|»›•·"
SYMBOL_CHARS = "#*$%&|<>"
END_CLASS = r"[.!?…:;)\"”'’।॥。！？][ \t-\r]*$"
BLANKS = " \t\n\x0b\f\r"
PHRASES = (
    "all rights reserved",
    "privacy policy",
    "terms of use",
    "terms of service",
    "cookie",
    "javascript",
    "click here",
    "sign up",
    "subscribe",
    "copyright",
    "licensed under",
    "lorem ipsum",
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANK}+"), "")


def _line_fails(line: Column) -> Column:
    tight = F.length(F.translate(line, BLANKS, ""))
    odd = tight - F.length(F.regexp_replace(line, r"[^\p{L}\p{M}\p{N}]+", ""))
    separators = F.length(line) - F.length(F.translate(line, SEPARATOR_CHARS, ""))
    low = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in PHRASES:
        boilerplate = boilerplate | low.contains(phrase)
    return (
        (100 * odd > PUNCTUATION_PERCENT * tight)
        | (separators >= SEPARATORS)
        | (~line.rlike(END_CLASS) & (F.regexp_count(line, F.lit(r"[^ \t-\r]+")) <= SHORT_WORDS))
        | boilerplate
    )


def _chars(text: Column) -> Column:
    return F.length(F.translate(text, BLANKS, "")).cast("bigint")


def _joined_with(step: int):
    return lambda h, i: F.xxhash64(h, F.get("_pairs", i + step))


def _with_repeats(df: DataFrame) -> DataFrame:
    """Adds the number of words in windows found twice or more.

    Windows are compared by 64-bit hashes. Only texts with equal hashes go on: they sort (hash, place)
    pairs, mark those next to an equal hash and add up the words the marked windows cover.
    """
    # Hashes of 1, 2, 4 and 8 words from each place on, each made of two of the ones before.
    df = df.withColumn("_at", F.transform("_words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        df = df.withColumn("_pairs", F.col("_at")).withColumn(
            "_at",
            F.transform(
                F.slice("_pairs", F.lit(1), F.greatest(F.size("_pairs") - step, F.lit(0))),
                _joined_with(step),
            ),
        )
    pairs = F.transform("_at", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn(
        "_pairs",
        F.when(F.size(F.array_distinct("_at")) < F.size("_at"), F.array_sort(pairs)).otherwise(
            F.expr("cast(array() as array<struct<h: bigint, i: int>>)")
        ),
    ).drop("_at")
    beside = lambda e, k: (
        F.get("_pairs", k - 1)["h"].eqNullSafe(e["h"])
        | F.get("_pairs", k + 1)["h"].eqNullSafe(e["h"])
    )
    places = F.sort_array(F.transform(F.filter("_pairs", beside), lambda e: e["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")),
        lambda a, i: F.struct(
            (a["n"] + WINDOW - F.greatest(F.lit(0), a["upto"] - i)).alias("n"),
            (i + WINDOW).alias("upto"),
        ),
        lambda a: a["n"],
    )
    return df.withColumn("_repeat", covered).drop("_pairs")


def judge(docs: DataFrame, into: str = "_quality", text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``into``: figures, ``clean`` text, base_failed and kept.

    A null text has no words and no lines; with fewer than LEAST_WORDS words a document fails
    whatever its lines. Every row gives one row. A column ``into`` is refused. Columns named ``_words``, ``_lines``, ``_repeat``,
    ``_base``, ``_good``, ``_at`` and ``_pairs`` are set aside and put back.
    """
    refuse_taken(docs, into)
    own = docs.columns
    all_columns = F.struct(*[docs[c] for c in own]).alias("_row")
    body = docs[text]
    lines = F.filter(F.split(F.coalesce(body, F.lit("")), "\n"), lambda s: s.rlike(r"[^ \t-\r]"))
    df = docs.select(
        all_columns, body.alias("_text"), words_of(body).alias("_words"), lines.alias("_lines")
    )
    df = df.withColumn("_unlike", F.array_distinct("_lines"))
    df = _with_repeats(df)
    n_words = F.size("_words").cast("bigint")
    df = df.select(
        "_row",
        "_unlike",
        F.struct(
            n_words.alias("n_words"),
            F.coalesce(_chars(F.col("_text")), F.lit(0)).alias("word_chars"),
            F.coalesce(
                F.length("_text") - F.length(F.translate("_text", SYMBOL_CHARS, "")), F.lit(0)
            )
            .cast("bigint")
            .alias("n_symbols"),
            (F.size("_lines") - F.size("_unlike")).cast("bigint").alias("n_dup_lines"),
            F.col("_repeat").alias("n_repeat_words"),
        ).alias("_base"),
    )
    df = df.withColumn("_good", F.filter("_unlike", lambda s: ~_line_fails(s)))
    left = F.aggregate("_good", F.lit(0).cast("bigint"), lambda n, s: n + _chars(s))
    base_failed = (F.col("_base.n_words") < LEAST_WORDS) | (
        100 * F.col("_base.n_repeat_words") > REPEATED_PERCENT * F.col("_base.n_words")
    )
    df = df.select("_row", "_base", "_good", left.alias("_left"), base_failed.alias("_failed"))
    enough = 100 * F.col("_left") >= KEPT_PERCENT * F.col("_base.word_chars")
    # Always true, and not known to the optimizer: a filter on the verdict stays above this point
    # instead of being rewritten over all expressions below it.
    here = F.monotonically_increasing_id() >= 0
    quality = F.struct(
        "_base.*",
        F.col("_left").alias("chars_left"),
        F.array_join("_good", "\n").alias("clean"),
        F.col("_failed").alias("base_failed"),
        (~F.col("_failed") & enough & here).alias("kept"),
    )
    return df.select("_row.*", quality.alias(into))
