"""Quality rules: a table of thresholds over ratios of a text, compiled into one projection.

All counts are column expressions over the whole text; nothing is shuffled. Repeated windows are found
inside a row: positions sorted by a short hash give every candidate, and the candidates are compared by
their words. NULL and empty texts have no words and fail the base rules. Ratios over nothing are 0.
Rows are judged one by one, so ids may be NULL or repeat; an empty table gives no rows. Input
columns named like an output column are replaced, others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACES, text_of, words_of

SYMBOLS = r"[#*$%&|<>]"
# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au avec ce dans de des du en est et la le les par pour que qui sur un une "
    "auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "al con del el es las lo los no por se su una y"
).split()
STOP_WORDS += [word.capitalize() for word in STOP_WORDS]

# Rule, ratio, least and most allowed value; a text that breaks none is kept.
RULES = [
    ("word_length", "word_chars / n_words", 1.5, 25.0),
    ("symbols", "n_symbols / n_words", 0.0, 0.3),
    ("stop_words", "n_stop_words / n_words", 0.01, 1.0),
    ("duplicate_lines", "n_dup_lines / n_word_lines", 0.0, 0.5),
    ("ellipsis_lines", "n_ellipsis_lines / n_word_lines", 0.0, 0.5),
    ("bullet_lines", "n_bullet_lines / n_word_lines", 0.0, 0.9),
]
LEAST_WORDS = 50
MOST_REPEATED = 50  # in hundredths of the words

INDEX_BITS = 30  # more words than a text can hold


def repeated_words(words: str) -> Column:
    """Words of the array column that lie in a window of three that the text holds twice or more."""
    n = F.size(words)
    col = F.col(words)
    windows_of_three = F.arrays_zip(*[F.slice(col, k, n - 2) for k in (1, 2, 3)])
    return F.when(n < 3, F.lit(0).cast("bigint")).otherwise(
        _let(
            F.transform(windows_of_three, lambda window: F.xxhash64(window)),
            lambda hashes: F.when(
                F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")
            ).otherwise(_covered(hashes, col, n)),
        )
    )


def _covered(hashes: Column, col: Column, n: Column) -> Column:
    """Words in windows that repeat, from the hashes of all windows in order."""
    # The upper bits of a number are a short hash of the window, the lower ones its place.
    short = F.transform(hashes, lambda h, i: F.shiftleft(h, INDEX_BITS).bitwiseOR(i.cast("bigint")))
    pairs = _let(
        F.sort_array(short),
        lambda s: F.zip_with(
            F.slice(s, 1, F.size(s) - 1),
            F.slice(s, 2, F.size(s) - 1),
            lambda a, b: F.when(F.shiftright(a.bitwiseXOR(b), INDEX_BITS) == 0, F.array(a, b)),
        ),
    )
    met = F.array_distinct(F.flatten(F.filter(pairs, lambda pair: pair.isNotNull())))
    candidates = F.transform(met, lambda v: v.bitwiseAND((1 << INDEX_BITS) - 1).cast("int"))
    windows = F.transform(
        candidates,
        lambda i: F.struct(
            col[i].alias("a"), col[i + 1].alias("b"), col[i + 2].alias("c"), i.alias("i")
        ),
    )
    sure = _with_equal_neighbour(F.sort_array(windows), lambda w: F.struct(w["a"], w["b"], w["c"]))
    starts = F.sort_array(F.transform(sure, lambda w: w["i"]))
    return _let(
        starts,
        lambda s: F.aggregate(
            F.zip_with(
                s,
                F.concat(F.slice(s, 2, F.size(s)), F.array(n)),
                lambda here, following: F.when(here.isNull(), 0).otherwise(F.least(F.lit(3), following - here)),
            ),
            F.lit(0).cast("bigint"),
            lambda total, x: total + x,
        ),
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _with_equal_neighbour(values: Column, part) -> Column:
    """Elements of a sorted array whose ``part`` equals that of the one before or behind."""
    return _let(
        values,
        lambda s: F.filter(
            s,
            lambda v, i: F.coalesce(part(v) == part(F.get(s, i - 1)), F.lit(False))
            | F.coalesce(part(v) == part(F.get(s, i + 1)), F.lit(False)),
        ),
    )


def with_counts(docs: DataFrame) -> DataFrame:
    """Rows with the counts the rules look at."""
    words, lines = F.col("_words"), F.col("_lines")
    count = lambda array: F.size(array).cast("bigint")
    texts = docs.withColumns(
        {
            "_words": words_of(text_of()),
            "_lines": F.filter(F.split(text_of(), "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
        }
    )
    return texts.withColumns(
        {
            "n_words": count(words),
            "word_chars": F.char_length(F.array_join(words, "")).cast("bigint"),
            "n_symbols": F.regexp_count(text_of(), F.lit(SYMBOLS)).cast("bigint"),
            "n_dup_lines": count(lines) - count(F.array_distinct(lines)),
            "n_repeat_words": repeated_words("_words"),
            "n_stop_words": count(F.filter(words, lambda w: w.isin(STOP_WORDS))),
            "n_word_lines": count(lines),
            "n_ellipsis_lines": count(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))),
            "n_bullet_lines": count(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))),
        }
    ).drop("_words", "_lines")


def judged(docs: DataFrame, rules=RULES) -> DataFrame:
    """Rows with their counts, ``base_failed``, ``broken`` (names of the rules a text breaks) and
    ``kept``."""
    counted = with_counts(docs)
    few = F.col("n_words") < LEAST_WORDS
    repeats = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    breaks = []
    for name, ratio, least, most in rules:
        above, below = (F.col(c.strip()) for c in ratio.split("/"))
        value = F.when(below == 0, F.lit(0.0)).otherwise(above / below)
        breaks.append(F.when((value < least) | (value > most), F.lit(name)))
    broken = F.array_compact(F.array(*breaks))
    return counted.withColumns({"base_failed": few | repeats, "broken": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken") == 0)
    )
