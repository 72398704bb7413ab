"""Quality rules: a threshold table compiled into one projection of Spark functions.

Every measure is a ratio of lengths, symbols, stop words or lines of one text, so the
filter is a narrow plan: no shuffle, no join, no function outside the JVM.

Defined cases: a null or empty text has no words and fails the base rules; a ratio
with a zero denominator is null and passes its rule, as there is nothing to judge; a
repeated document gets the same verdict each time; an empty table gives an empty one;
a column of the input that has the name of a result is replaced by the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on with as was be by this are from or an at not have which "
    "le la les de des du et un une en est que qui dans pour par sur au avec ne pas ce il elle "
    "der die das und den von zu mit ist ein eine im nicht auf dem des sich als es auch für "
    "el los las del y que en un una por con para se su al lo como más no"
).split()


class Rule(NamedTuple):
    """A text passes while low <= measure <= high; None leaves a side open."""

    measure: str
    low: float | None
    high: float | None


#: The production table. Open measures: MEASURES.
RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbols_per_word", None, 0.25),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("bullet_line_ratio", None, 0.9),
    Rule("ellipsis_line_ratio", None, 0.5),
)

_LISTED = ",".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
#: Counts per text. `w` is the array of words, `ln` the lines with a word.
COUNTS = {
    "n_words": "cast(size(w) AS bigint)",
    "word_chars": "cast(char_length(translate(t, sp, '')) AS bigint)",
    "n_symbols": f"cast(char_length(t) - char_length(translate(t, '{SYMBOLS}', '')) AS bigint)",
    "n_dup_lines": "cast(size(ln) - size(array_distinct(ln)) AS bigint)",
    "n_lines": "cast(size(ln) AS bigint)",
    "n_stop_words": f"cast(size(filter(w, x -> x IN ({_LISTED}))) AS bigint)",
    "n_bullet_lines": r"cast(size(filter(ln, x -> ltrim(x) RLIKE '^[-*•]')) AS bigint)",
    "n_ellipsis_lines": r"cast(size(filter(ln, x -> rtrim(x) LIKE '%...' OR rtrim(x) LIKE '%…')) AS bigint)",
}
MEASURES = {
    "words": ("n_words", None),
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
    "repeat_word_ratio": ("n_repeat_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "bullet_line_ratio": ("n_bullet_lines", "n_lines"),
    "ellipsis_line_ratio": ("n_ellipsis_lines", "n_lines"),
}


def compile_rules(rules: Sequence[Rule] = RULES) -> Column:
    """True for a text that passes every row of the table."""
    verdict = F.lit(True)
    for r in rules:
        if r.measure not in MEASURES:
            raise ValueError(f"unknown measure {r.measure!r}; there are {sorted(MEASURES)}")
        over, under = MEASURES[r.measure]
        value = F.col(over) if under is None else F.col(over) / F.nullif(F.col(under), F.lit(0))
        for bound, ok in ((r.low, value >= F.lit(r.low)), (r.high, value <= F.lit(r.high))):
            if bound is not None:
                verdict = verdict & F.coalesce(ok, F.lit(True))
    return verdict


def repeated_window_words(words: str, width: int = 3) -> str:
    """SQL for the number of words in windows of `width` words found twice or more in the array.

    Windows are compared by a 64-bit hash of their words. Only a text in which two hashes
    agree is sorted; a window covers the words up to the next repeated window.
    """
    window = ", ".join(["x", *(f"get({words}, i + {k})" for k in range(1, width))])
    hashes = f"slice(transform({words}, (x, i) -> xxhash64({window})), 1, size({words}) - {width - 1})"
    ordered = "sort_array(transform(h, (x, i) -> struct(x AS h, i AS i)))"
    places = ("sort_array(transform(filter(s, (x, j) -> x.h = get(s, j - 1).h OR x.h = get(s, j + 1).h), x -> x.i))")
    covered = f"aggregate(transform(p, (x, j) -> least({width}, coalesce(get(p, j + 1) - x, {width}))), 0L, (a, x) -> a + x)"
    # get() of a negative index is null, as one past the end.
    inner = f"element_at(transform(array({ordered}), s -> element_at(transform(array({places}), p -> {covered}), 1)), 1)"
    repeats = f"CASE WHEN size(array_distinct(h)) < size(h) THEN {inner} ELSE 0L END"
    return f"CASE WHEN size({words}) < {width} THEN 0L ELSE element_at(transform(array({hashes}), h -> {repeats}), 1) END"


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the counts of COUNTS, n_repeat_words and base_failed."""
    names = [*COUNTS, "n_repeat_words", "base_failed", "kept"]
    taken = {n.lower() for n in names}
    t = F.coalesce(docs[text], F.lit(""))
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    held = F.struct(*keep) if keep else F.struct(F.lit(1))
    split = docs.select(held.alias("d"), t.alias("t"), F.lit(SPACES).alias("sp"))
    split = split.withColumns({
        "w": F.regexp_extract_all("t", F.lit(WORD), F.lit(0)),
        "ln": F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD)),
    })
    counted = split.select("d", *[F.expr(e).alias(n) for n, e in COUNTS.items()], F.expr(repeated_window_words("w")).alias("n_repeat_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counted = counted.withColumn("base_failed", failed)
    return counted.select(*(["d.*"] if keep else []), *[n for n in names if n != "kept"])


def quality(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """`docs` with its counts, `base_failed` and `kept`."""
    return measure(docs, text).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def passing(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of `docs` that pass, as they are.

    A filter on `kept` would be pushed below the projections, with a copy of every measure in
    each place that names it; a generator stays where it is and reads the verdict once.
    """
    judged = quality(docs.select(F.struct("*").alias("d"), docs[text].alias("_t")), rules, "_t")
    return judged.select(F.inline(F.when(F.col("kept"), F.array("d"))))
