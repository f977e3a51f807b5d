"""Quality rules: a threshold table compiled into one projection.

``THRESHOLDS`` names ratios of a text and the range in which a text is kept. ``compile_rules``
turns the table into a single boolean expression over one struct of measurements; everything is
built-in SQL functions, so no Python worker starts and no row is shuffled.

Higher-order functions see arrays as lambda variables (:func:`_let`), never as repeated
expressions: each array is built once per row.

Defined results: NULL or empty text has no words and fails; a word is a run of characters other
than space, tab, line feed, vertical tab, form feed and carriage return; lines are cut at line
feeds; very long texts are measured whole in n log n; extra columns are kept as they are, except
that columns with the names of the measurements are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.tables import SPACES, unused

# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

# Common function words of the four main languages of web prose here.
STOP_WORDS = (
    "a an and are as at be by for from in is it not of on or that the this to was with "
    "au avec dans de des du elle en est et la le les par pas pour que qui sur un une "
    "als auf auch das dem den der die ein eine für im ist mit nicht sich sie und von zu "
    "al como con del el es las los lo no por se su una y"
).split()

# Base rules, by contract.
LEAST_WORDS = 50
REPEATS_OF_WORDS = (100, 50)

# (measurement, at least, at most); None leaves a side open. A text must hold all of them.
THRESHOLDS: tuple[tuple[str, float | None, float | None], ...] = (
    ("mean_word_chars", 2.0, 12.0),
    ("symbols_per_word", None, 0.1),
    ("stop_word_share", 0.05, None),
    ("letter_word_share", 0.7, None),
    ("shouted_word_share", None, 0.5),
    ("duplicate_line_share", None, 0.4),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of a text as an array; none for NULL."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(plain, " "), "")


def _bits(size: Column) -> Column:
    """Bits that hold every position below ``size``."""
    return (F.floor(F.log2(size.cast("double"))) + 1).cast("int")


def _covered(hashes: Column) -> Column:
    """Words in windows that occur twice or more, from the hashes of all three-word windows.

    Hash and position share one long: sorted, equal windows are neighbours. Repeated positions
    p cover three words each, or up to the next one. A window's hash keeps 64 bits less those of
    the positions (49 bits for a text of 20,000 words).
    """

    def from_sorted(packed: Column, bits: Column) -> Column:
        def repeated(x: Column, i: Column) -> Column:
            before, after = F.get(packed, i - 1), F.get(packed, i + 1)
            key = F.call_function("shiftright", x, bits)
            return F.coalesce(F.call_function("shiftright", before, bits) == key, F.lit(False)) | F.coalesce(
                F.call_function("shiftright", after, bits) == key, F.lit(False)
            )

        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - F.lit(1)
        positions = F.sort_array(F.transform(F.filter(packed, repeated), lambda x: x.bitwiseAND(mask)))
        return _let(
            positions,
            lambda at: F.aggregate(
                F.transform(at, lambda p, i: F.coalesce(F.least(F.get(at, i + 1) - p, F.lit(3)), F.lit(3))),
                F.lit(0).cast("bigint"),
                lambda total, n: total + n,
            ),
        )

    return _let(
        _bits(F.size(hashes)),
        lambda bits: _let(
            F.sort_array(
                F.transform(
                    hashes,
                    lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("bigint")),
                )
            ),
            lambda packed: from_sorted(packed, bits),
        ),
    )


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a three-word window found twice or more."""
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return _let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0).cast("bigint")),
    )


def _counts(text: Column, words: Column) -> Column:
    """All counts of a text whose words are at hand."""
    stops = F.array(*[F.lit(w) for w in STOP_WORDS])
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    without_symbols = F.translate(text, SYMBOLS, "")

    def of_words(test: Callable[[Column], Column]) -> Column:
        return F.size(F.filter(words, test)).cast("bigint")

    return F.struct(
        F.size(words).cast("bigint").alias("n_words"),
        F.aggregate(words, F.lit(0).cast("bigint"), lambda total, w: total + F.length(w)).alias("word_chars"),
        (F.length(text) - F.length(without_symbols)).cast("bigint").alias("n_symbols"),
        _let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("bigint").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        _let(lines, F.size).cast("bigint").alias("n_lines"),
        of_words(lambda w: F.lower(w).isin(*STOP_WORDS)).alias("n_stop_words"),
        of_words(lambda w: F.upper(w) != F.lower(w)).alias("n_letter_words"),
        of_words(lambda w: F.endswith(w, F.lit("!"))).alias("n_shouted_words"),
    )


RATIOS: dict[str, tuple[str, str]] = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "stop_word_share": ("n_stop_words", "n_words"),
    "letter_word_share": ("n_letter_words", "n_words"),
    "shouted_word_share": ("n_shouted_words", "n_words"),
    "duplicate_line_share": ("n_dup_lines", "n_lines"),
}


def compile_rules(counts: Column, thresholds=THRESHOLDS) -> Column:
    """The table as one condition. Ratios are compared by multiplication, so no count is a divisor."""
    verdict = F.lit(True)
    for name, least, most in thresholds:
        above, below = (counts[part].cast("double") for part in RATIOS[name])
        if least is not None:
            verdict = verdict & (above >= F.lit(least) * below)
        if most is not None:
            verdict = verdict & (above <= F.lit(most) * below)
    return verdict


def base_failed(counts: Column) -> Column:
    times, share = REPEATS_OF_WORDS
    return (counts["n_words"] < LEAST_WORDS) | (times * counts["n_repeat_words"] > share * counts["n_words"])


def measure(docs: DataFrame, text: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """Adds the measurements, ``base_failed`` and ``kept`` to every row."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    counts = _let(words_of(whole), lambda words: _counts(whole, words))
    rated = _let(
        counts,
        lambda c: F.struct(
            *[c[m].alias(m) for m in MEASURES],
            base_failed(c).alias("base_failed"),
            (~base_failed(c) & compile_rules(c, thresholds)).alias("kept"),
        ),
    )
    names = (*MEASURES, "base_failed", "kept")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    found = unused(docs, "_rated")
    return docs.select(*others, rated.alias(found)).select(*others, *[F.col(found)[n].alias(n) for n in names])


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows that hold all rules, with their own columns."""
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counts = _let(words_of(whole), lambda words: _counts(whole, words))
    return docs.filter(_let(counts, lambda c: ~base_failed(c) & compile_rules(c)))
