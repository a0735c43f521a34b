"""Quality rules: a threshold table compiled into one projection of built-in functions.

``measures`` names the figures, ``THRESHOLDS`` the bounds, ``quality_rules`` puts both into one
projection: no shuffle, no user function, a row in gives a row out. A text of any length stays in
its row; the work per text is a sort of its words at most.

NULL and empty texts have no words: all figures are 0, the rules reject them. Repeated rows are
judged one by one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .columns import let

# Fixed value: what separates words.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
# Fixed value: the symbols that are counted.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Frequent function words of the four languages at hand.
STOP_WORDS = """
the of and to in that is was with for on be as at it are an or
der die das und in den von zu mit sich auf für ist im dem nicht ein eine des
le la les de et un une que est pour dans des du en sur par pas qui avec au
el los las de y que en un una por con para del se lo como más su al es
""".split()


class Threshold(NamedTuple):
    """A text is rejected when ``measure`` is below ``low`` or above ``high`` (None: no bound)."""

    measure: str
    low: float | None
    high: float | None


# The rules beside the base rule. Ratios are per word unless the name says otherwise.
THRESHOLDS = [
    Threshold("mean_word_chars", 1.5, 25.0),
    Threshold("symbol_ratio", None, 0.1),
    Threshold("stop_word_ratio", 0.01, None),
    Threshold("dup_line_ratio", None, 0.6),
]
# The base rule of the query: few words, or many of them in repeated windows.
BASE = [Threshold("n_words", 20, None), Threshold("repeat_percent", None, 30.0)]


def _neighbours(items: Column, field: str) -> Column:
    """Of structs sorted by ``field``: those that share its value with a neighbour."""

    def shared(x: Column, k: Column) -> Column:
        before, after = F.get(items, k - 1)[field], F.get(items, k + 1)[field]
        return F.coalesce(before == x[field], F.lit(False)) | F.coalesce(after == x[field], F.lit(False))

    return F.filter(items, shared)


def _paired(marks: Column, step: int) -> Column:
    """Hash of each mark with the one ``step`` places on."""
    n = F.size(marks) - step
    return F.zip_with(F.slice(marks, 1, n), F.slice(marks, step + 1, n), lambda a, b: F.xxhash64(a, b))


def _window_marks(words: Column) -> Column:
    """A hash per window of eight words, made by doubling: of two, four and eight words. Needs eight words."""
    one = F.transform(words, lambda w: F.xxhash64(w))
    return let(one, lambda m: let(_paired(m, 1), lambda m2: let(_paired(m2, 2), lambda m4: _paired(m4, 4))))


def _repeat_starts(words: Column, marks: Column) -> Column:
    """Sorted starts (from 1) of the windows that occur twice or more, compared as text."""
    numbered = F.sort_array(F.transform(marks, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))
    alike = let(numbered, lambda s: _neighbours(s, "h"))
    texts = F.sort_array(F.transform(alike, lambda x: F.struct(F.array_join(F.slice(words, x["i"], WINDOW), " ").alias("v"), x["i"].alias("i"))))
    return F.sort_array(F.transform(let(texts, lambda s: _neighbours(s, "v")), lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Words inside the windows that begin at the sorted ``starts``."""
    widths = F.transform(starts, lambda i, k: F.least(F.coalesce(F.get(starts, k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(widths, F.lit(0).cast("long"), lambda total, x: total + x)


def _repeat_words(words: Column) -> Column:
    """Words inside repeated windows. Only a text with a repeated window hash is sorted."""

    def counted(marks: Column) -> Column:
        plain = F.size(F.array_distinct(marks)) == F.size(marks)
        return F.when(plain, F.lit(0).cast("long")).otherwise(let(_repeat_starts(words, marks), _covered))

    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(let(_window_marks(words), counted))


def measures(text: Column) -> Column:
    """One struct with the measures of a text.

    n_words, word_chars, n_symbols, n_dup_lines, n_lines (with a word), n_stop_words and
    n_repeat_words: words inside windows of eight words that the text has at least twice. Equal
    windows are found by a hash first; only windows whose hash repeats are compared as text.
    """
    stops = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})

    def found(body: Column) -> Column:
        of_words = let(F.array_remove(F.split(body, SPACES), ""), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.filter(w, lambda x: x.isin(stops))).cast("long").alias("n_stop_words"),
            _repeat_words(w).alias("n_repeat_words")))
        of_lines = let(F.filter(F.split(body, "\n"), lambda x: F.translate(x, SPACE, "") != ""), lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
        word_chars = F.length(F.translate(body, SPACE, "")).cast("long")
        n_symbols = (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long")
        return let(of_words, lambda w: let(of_lines, lambda lines: F.struct(
            w["n_words"].alias("n_words"), word_chars.alias("word_chars"), n_symbols.alias("n_symbols"), lines["n_dup_lines"].alias("n_dup_lines"),
            w["n_repeat_words"].alias("n_repeat_words"), lines["n_lines"].alias("n_lines"), w["n_stop_words"].alias("n_stop_words"))))

    return let(F.coalesce(text, F.lit("")), found)


def measure(name: str, of: Column) -> Column:
    """A field of the struct of ``measures`` or a ratio of two of them; 0 when the text has no words."""
    ratios = {
        "mean_word_chars": ("word_chars", "n_words", 1.0),
        "symbol_ratio": ("n_symbols", "n_words", 1.0),
        "stop_word_ratio": ("n_stop_words", "n_words", 1.0),
        "dup_line_ratio": ("n_dup_lines", "n_lines", 1.0),
        "repeat_percent": ("n_repeat_words", "n_words", 100.0),
    }
    if name not in ratios:
        return of[name]
    above, below, times = ratios[name]
    return F.when(of[below] > 0, F.lit(times) * of[above] / of[below]).otherwise(F.lit(0.0))


def fails(rules: list[Threshold], of: Column) -> Column:
    """True where a rule of the table is broken."""
    broken = F.lit(False)
    for rule in rules:
        if rule.low is not None:
            broken = broken | (measure(rule.measure, of) < rule.low)
        if rule.high is not None:
            broken = broken | (measure(rule.measure, of) > rule.high)
    return broken


def quality_rules(docs: DataFrame, keep: list[str], text: str = "text", base: list[Threshold] = BASE, rules: list[Threshold] = THRESHOLDS) -> DataFrame:
    """``keep``, the measures, ``base_failed`` and ``kept`` (no rule of either table is broken)."""
    of = F.col("__m")
    measured = docs.select(*keep, measures(F.col(text)).alias("__m"))
    return measured.select(*keep, "__m.*", fails(base, of).alias("base_failed"), (~(fails(base, of) | fails(rules, of))).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", rules: list[Threshold] = BASE + THRESHOLDS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    The verdict is one expression: a filter on columns of a projection would be pushed below it, with a copy of all measures for each of its terms.
    """
    return docs.filter(let(measures(F.col(f"`{text}`")), lambda of: ~fails(rules, of)))
