"""Quality rules: a table of thresholds compiled into one projection of text measures.

The measures are built-in functions over the words and lines of a text; no user function runs.  Each
intermediate array is bound once as a lambda variable (``let``), so nothing is evaluated per element
that depends on the whole text, and the cost is that of one sort of a text's three-word windows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from layerhouse.llm.inputs import BLANKS

#: Frequent function words (fixed values): English, French, German, Spanish.
STOP_WORDS = (
    "the of and to in is that for it was on are as with be at this from or have by not but an which "
    "le la les des et en un une du dans que est pour qui sur au par pas avec il "
    "der die das und in den von zu mit sich des auf ist im dem nicht ein eine als auch "
    "el los las y en que un una por con para del se no su lo como es al"
).split()

#: Low bits of a window's number that hold its place.
PLACE_BITS = 20

#: Characters that count as symbols (fixed values).
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A text fails where ``measure / per`` lies outside ``[least, most]``; a zero ``per`` passes."""

    name: str
    measure: str
    per: str | None = None
    least: float | None = None
    most: float | None = None


#: The contract's base: too few words, or mostly repeated three-word windows.
BASE = (
    Rule("too_few_words", "n_words", least=50),
    Rule("repeated_windows", "n_repeat_words", "n_words", most=0.5),
)

#: Production thresholds.
RULES = (
    Rule("word_length", "word_chars", "n_words", least=2, most=14),
    Rule("symbols", "n_symbols", "word_chars", most=0.04),
    Rule("exclamations", "n_exclamations", "n_words", most=0.3),
    Rule("capitals", "n_upper", "n_letters", most=0.6),
    Rule("letters", "n_letters", "word_chars", least=0.6),
    Rule("stop_words", "n_stop_words", "n_words", least=0.01),
    Rule("equal_neighbours", "n_equal_neighbours", "n_words", most=0.2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("open_lines", "n_ellipsis_lines", "n_lines", most=0.5),
    Rule("bullets", "n_bullet_lines", "n_lines", most=0.9),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def spaced(text: Column) -> Column:
    """The text with a space for each of ``BLANKS``."""
    return F.translate(text, BLANKS, " " * len(BLANKS))


def split_words(spaced_text: Column) -> Column:
    """Runs of characters other than spaces."""
    return F.array_remove(F.split(spaced_text, " "), "")


def _removed(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _covered(places: Column) -> Column:
    """Words that three-word windows at these places cover together."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(-3).alias("last"))
    return F.aggregate(F.sort_array(places), start, lambda a, p: F.struct(
        (a["sum"] + F.least(F.lit(3), p - a["last"])).alias("sum"), p.alias("last")))["sum"]


def _repeat_words(words: Column) -> Column:
    """Words inside a three-word window that occurs twice or more.

    A window is one number, its hash above and its place in the low bits, so sorting makes equal windows
    neighbours.  Only windows with an equal neighbour are looked at by their words; a text in which two different
    windows share a hash, or with more words than the low bits count, is sorted by the words as well.
    """
    def window(first: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
        return body(F.get(words, first), F.get(words, first + 1), F.get(words, first + 2))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")

    def of(starts: Column, number: Callable[[Column, Column], Column]) -> Column:
        return F.sort_array(F.transform(starts, lambda w, i: number(w, i)))

    def repeated(ordered: Column, same: Callable[[Column, Column], Column]) -> Column:
        return F.filter(ordered, lambda x, j: same(F.get(ordered, j - 1), x) | same(F.get(ordered, j + 1), x))

    def alike(x: Column, y: Column) -> Column:
        return F.shiftright(x, PLACE_BITS) == F.shiftright(y, PLACE_BITS)

    def mixed(again: Column) -> Column:
        """Neighbours of one hash with other words."""
        return F.size(F.filter(again, lambda x, j: alike(x, F.get(again, j + 1)) & (
            window(place(x), F.struct) != window(place(F.get(again, j + 1)), F.struct))))

    starts = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    hashed = of(starts, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(
        F.lit(-(1 << PLACE_BITS))).bitwiseOR(i.cast("long")))
    spelled = let(of(starts, lambda w, i: F.struct(w.alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("i"))),
                  lambda ordered: repeated(ordered, lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])))
    slow = _covered(F.transform(spelled, lambda x: x["i"]))
    fast = let(let(hashed, lambda ordered: repeated(ordered, alike)), lambda again: F.when(
        mixed(again) == 0, _covered(F.transform(again, place))).otherwise(slow))
    return F.when(F.size(words) < (1 << PLACE_BITS), fast).otherwise(slow)


def measures(text: Column) -> Column:
    """All measures of a text as one struct of longs; a null text has no words and no lines."""
    def of(t: Column) -> Column:
        return let(spaced(t), lambda flat: let(split_words(flat), lambda words: let(F.regexp_replace(t, r"\P{L}+", ""), lambda letters: let(
            F.filter(F.split(t, "\n"), lambda line: F.ltrim(line, F.lit(BLANKS)) != ""), lambda lines: F.struct(*[
                value.cast("long").alias(name) for name, value in {
                    "n_words": F.size(words),
                    "word_chars": F.length(F.replace(flat, F.lit(" "), F.lit(""))),
                    "n_symbols": _removed(t, SYMBOLS),
                    "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
                    "n_repeat_words": _repeat_words(words),
                    "n_lines": F.size(lines),
                    "n_exclamations": F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit(""))),
                    "n_letters": F.length(letters),
                    "n_upper": F.length(F.regexp_replace(letters, r"\P{Lu}+", "")),
                    "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))),
                    "n_equal_neighbours": F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1)))),
                    "n_ellipsis_lines": F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
                    "n_bullet_lines": F.size(F.filter(lines, lambda x: F.ltrim(x).rlike(r"^[-*•]\s"))),
                }.items()])))))

    return of(F.coalesce(text, F.lit("")))


def fails(rule: Rule, value: Callable[[str], Column]) -> Column:
    """Compiled without division: a ratio bound ``m / p <= b`` is ``m <= b * p``."""
    scale = F.lit(1.0) if rule.per is None else value(rule.per).cast("double")
    measure, bad = value(rule.measure).cast("double"), F.lit(False)
    if rule.least is not None:
        bad = bad | (measure < F.lit(float(rule.least)) * scale)
    if rule.most is not None:
        bad = bad | (measure > F.lit(float(rule.most)) * scale)
    return bad


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the base measures, ``base_failed``, ``kept`` and ``failed``, the names of all failed rules.

    Null and empty texts have zero measures and fail the base for their few words.  Repeated rows are
    judged one by one, an empty table gives an empty result, other columns are not read.
    """
    measured = df.select(F.col(id_col).alias("doc_id"), F.inline(F.array(measures(F.col(text_col).cast("string")))))
    base = [fails(rule, F.col) for rule in BASE]
    named = F.array_compact(F.array(*[F.when(fails(rule, F.col), F.lit(rule.name)) for rule in (*BASE, *rules)]))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (base[0] | base[1]).alias("base_failed"), (F.size(named) == 0).alias("kept"), named.alias("failed"),
    )
