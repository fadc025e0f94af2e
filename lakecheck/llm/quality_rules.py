"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the whole text and every rule a comparison of two
measures, so the operator is one narrow map over the scan: no shuffle, no user function, no state.

A rule (name, part, whole, least, most) holds if least <= part / whole <= most (None: open); it is
compiled to integer arithmetic, 1000 * part against the limit in thousandths * whole, so results do
not depend on floating point.  A rule whose ``whole`` is 0 holds.

Defined cases: NULL and empty texts have no word, every count 0 and fail the base; extra columns are
kept by ``measure`` unless they clash with a measure's name, which then wins; repeated rows are judged
one by one.  64-bit hashes stand for the words of a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 8

# fixed values: very frequent function words of English, German, French and Spanish
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "that", "with", "for", "on", "der", "die", "und", "das", "ist", "mit", "ein",
              "eine", "zu", "von", "le", "la", "les", "de", "des", "et", "un", "une", "que", "est", "el", "los", "y", "en", "con",
              "por", "su", "del", "se"]

#: name, part, whole, least and most part of the whole in thousandths
THRESHOLDS: list[tuple[str, str, str, int | None, int | None]] = [
    ("mean_word_length", "word_chars", "n_words", 2000, 15000),
    ("symbols", "n_symbols", "n_words", None, 300),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 300),
    ("capitals", "n_upper", "word_chars", None, 400),
    ("exclamations", "n_exclaims", "n_words", None, 300),
    ("stop_words", "n_stop_words", "n_words", 5, None),
]


def _arrays(text: Column) -> dict[str, Column]:
    return {"__words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
            "__lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))}


def _repeats(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: positions inside 8-word windows that occur twice or more in the text.  The sort
    of the windows is evaluated only for texts that have a repeated one."""
    k = F.size("__wh") - WINDOW
    df = df.withColumn("__win", F.when(k >= 0, F.transform(F.sequence(F.lit(0), k), lambda i: F.xxhash64(
        *[F.get(F.col("__wh"), i + j) for j in range(WINDOW)]))))
    df = df.withColumn("__order", F.when(F.size(F.array_distinct("__win")) < F.size("__win"), F.array_sort(
        F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    at = lambda j: F.get(F.col("__order"), j)["h"]
    df = df.withColumn("__starts", F.when(F.col("__order").isNotNull(), F.array_sort(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("__order") - 1),
                 lambda j: F.coalesce(at(j) == at(j - 1), F.lit(False)) | F.coalesce(at(j) == at(j + 1), F.lit(False))),
        lambda j: F.get(F.col("__order"), j)["i"]))))
    step = lambda i: F.least(F.lit(WINDOW), F.get(F.col("__starts"), i + 1) - F.get(F.col("__starts"), i))
    covered = F.aggregate(F.sequence(F.lit(0), F.size("__starts") - 2), F.lit(WINDOW), lambda a, i: a + step(i))
    return df.withColumn("n_repeat_words", F.when(F.col("__starts").isNotNull(), covered).otherwise(0).cast("long")) \
             .drop("__win", "__order", "__starts", "__wh")


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measures of each text as long columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.withColumn("__text", text).withColumns(_arrays(F.col("__text")))
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    df = df.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.concat_ws("", "__words")).cast("long"),
        "n_symbols": F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_exclaims": F.regexp_count("__text", F.lit("!")).cast("long"),
        "n_upper": F.regexp_count("__text", F.lit(r"\p{Lu}")).cast("long"),
        "n_stop_words": F.size(F.filter("__words", lambda w: F.array_contains(stop, F.lower(w)))).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__wh": F.transform("__words", lambda w: F.xxhash64(w)),
    }).drop("__words", "__lines", "__text")
    return _repeats(df)


def verdict(thresholds=None) -> Column:
    """The whole threshold table as one boolean column over the measures."""
    ok = F.lit(True)
    for _, part, whole, least, most in thresholds if thresholds is not None else THRESHOLDS:
        holds = F.lit(True)
        if least is not None:
            holds &= F.col(part) * 1000 >= F.col(whole) * least
        if most is not None:
            holds &= F.col(part) * 1000 <= F.col(whole) * most
        ok &= (F.col(whole) == 0) | holds
    return ok


def judge(docs: DataFrame, text_col: str = "text", thresholds=None) -> DataFrame:
    """``docs`` with measures, base_failed and kept."""
    return measure(docs, text_col).withColumn(
        "base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    ).withColumn("kept", ~F.col("base_failed") & verdict(thresholds))
