"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule is measured on a sample: the seconds it costs and the share it rejects. The rule that rejects most per second
runs first, and a text that one rule rejects is not looked at by the later ones. The order changes the cost, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import materialize

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Rows that costs and selectivities are measured on.
SAMPLE_ROWS = 400


def words(text: Column) -> Column:
    """The words of a text; none for a null. Plain replacements and a one-character split cost less than a pattern."""
    spaced = F.coalesce(text, F.lit(""))
    for other in SPACES[1:]:
        spaced = F.replace(spaced, F.lit(other), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def word_chars(found: Column) -> Column:
    return F.char_length(F.array_join(found, "")).cast("long")


def n_symbols(text: Column) -> Column:
    """Counted by replacement: one pass for each symbol, without a pattern."""
    text = F.coalesce(text, F.lit(""))
    size = F.octet_length(text)
    return sum((size - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in SYMBOLS), F.lit(0)).cast("long")


def _count(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")


def n_dup_lines(text: Column) -> Column:
    return _let(lines(text), lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long")


def n_repeat_words(found: Column) -> Column:
    """Words that lie in a window of five words found twice or more, each counted once.

    Windows are compared by 64-bit hash and sorted with their places, so the work is n log n in the words of a text.
    """
    return _let(found, _n_repeat_words)


def _n_repeat_words(found: Column) -> Column:
    last = F.size(found) - WINDOW

    def repeated(hashes: Column) -> Column:
        ordered = F.sort_array(hashes)
        twice = _let(ordered, lambda x: F.array_distinct(F.filter(x, lambda h, j: F.coalesce(F.get(x, j - 1) == h, F.lit(False)))))
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        # Few repeated windows are looked up one by one; many are found by sorting the places. Both give the same places.
        few = lambda again: F.transform(F.filter(placed, lambda x: F.array_contains(again, x["h"])), lambda x: x["i"])
        starts = _let(twice, lambda again: F.when(F.size(again) <= 8, few(again)).otherwise(_let(F.sort_array(placed), _starts)))
        return _let(starts, _covered)

    hashes = F.transform(found, lambda w, i: F.xxhash64(w, *[F.get(found, i + n) for n in range(1, WINDOW)]))
    windows = F.slice(hashes, F.lit(1), last + 1)
    count = _let(windows, lambda hashes: F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), repeated(hashes)).otherwise(0))
    return F.when(last >= 1, count).otherwise(0).cast("long")


def _starts(placed: Column) -> Column:
    """Places, in order, of the hashes that a neighbour in the sorted list shares."""

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(F.get(placed, a)["h"] == F.get(placed, b)["h"], F.lit(False))

    return F.sort_array(F.transform(F.filter(placed, lambda _, j: same(j, j - 1) | same(j, j + 1)), lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Words that the windows at these places cover."""
    own = F.transform(starts, lambda at, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - at, F.lit(WINDOW))))
    return F.aggregate(own, F.lit(0), lambda total, x: total + x)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@dataclass(frozen=True)
class Rule:
    """A text is rejected where ``rejects`` is true; a null counts as false.

    ``rejects`` takes the text, its words and a function from the name of a statistic to its column.
    """

    name: str
    rejects: Callable[[Column, Column, Callable[[str], Column]], Column]


#: Each statistic of a text as an expression of the text and its words.
STATISTICS = {
    "n_words": lambda text, found: F.size(found).cast("long"),
    "word_chars": lambda text, found: word_chars(found),
    "n_symbols": lambda text, found: n_symbols(text),
    "n_dup_lines": lambda text, found: n_dup_lines(text),
    "n_repeat_words": lambda text, found: n_repeat_words(found),
}


def _share(part: Column, whole: Column, percent: int) -> Column:
    return part * 100 > whole * percent


def _echoes(found: Column) -> Column:
    """Words equal to the word before them."""
    return F.size(F.filter(found, lambda w, i: F.coalesce(F.get(found, i - 1) == w, F.lit(False))))


RULES = (
    Rule("few_words", lambda text, found, of: of("n_words") < 10),
    Rule("repeated_words", lambda text, found, of: _share(of("n_repeat_words"), of("n_words"), 20)),
    Rule("symbols", lambda text, found, of: _share(of("n_symbols"), of("n_words"), 10)),
    Rule("repeated_lines", lambda text, found, of: _share(of("n_dup_lines"), F.size(lines(text)), 40)),
    Rule("capitals", lambda text, found, of: _share(_count(text, "[A-ZÀ-ÖØ-Þ]{2}") * 2, of("word_chars"), 40)),
    Rule("exclamations", lambda text, found, of: _share(F.char_length(text) - F.char_length(F.replace(text, F.lit("!"), F.lit(""))), of("n_words"), 50)),
    Rule("echoes", lambda text, found, of: _let(found, lambda x: _share(_echoes(x), F.size(x), 30))),
    Rule("word_length", lambda text, found, of: (of("word_chars") < of("n_words") * 2) | (of("word_chars") > of("n_words") * 20)),
)


def _verdict(rule: Rule, text: Column, found: Column, known: dict[str, Column] | None = None) -> Column:
    text = F.coalesce(text, F.lit(""))

    def of(name: str) -> Column:
        return known[name] if known else STATISTICS[name](text, found)

    return F.coalesce(rule.rejects(text, found, of), F.lit(False))


def measured(docs: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) on the first ``sample_rows`` rows, best rejection per second first.

    The sample only estimates; it decides no text. On an empty table the given order stays.
    """
    sample = materialize(docs.select(F.col(text).alias("t")).limit(sample_rows), "cascade-sample")

    def seconds(value: Column) -> tuple[float, float]:
        start = time.perf_counter()
        share = sample.agg(F.avg(value.cast("double"))).first()[0]
        return time.perf_counter() - start, share or 0.0

    found = words(F.col("t"))
    seconds(F.size(found) > 0)
    base, _ = seconds(F.size(found) > 0)
    costs = [(rule, *seconds(_verdict(rule, F.col("t"), found))) for rule in rules]
    costs = [(rule, max(spent - base, 1e-3), share) for rule, spent, share in costs]
    return sorted(costs, key=lambda x: -x[2] / x[1])


def rejected_by(text: Column, found: Column, ordered: Sequence[Rule], known: dict[str, Column] | None = None) -> Column:
    """The name of the first rule that rejects, or null; later rules are then not computed."""
    out = F.lit(None).cast("string")
    for rule in reversed(list(ordered)):
        out = F.when(_verdict(rule, text, found, known), F.lit(rule.name)).otherwise(out)
    return out


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", out: str = "rejected_by") -> DataFrame:
    """The documents with a column ``out``: the rule that rejected the text, null where it passes all.

    A null text has no words and is judged like an empty one. Every row is kept, repeated rows too; other columns pass
    through, and one named like ``out`` is replaced. An empty table stays empty. Texts are read whole.
    """
    ordered = [rule for rule, _, _ in measured(docs, rules, text)]
    verdict = _let(words(F.col(text)), lambda found: rejected_by(F.col(text), found, ordered))
    return docs.withColumn(out, verdict)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the statistics, base_failed, kept: every text with its statistics, and the cascade's verdict where the two
    base rules pass. Nulls, repeated rows and other columns as in :func:`cascade`, but only the key is carried along.
    """
    base_rules = {"few_words", "repeated_words"}
    ordered = [rule for rule, _, _ in measured(docs, [r for r in RULES if r.name not in base_rules], text)]
    rows = docs.select(F.col(key), F.col(text).alias("text"), words(F.col(text)).alias("words"))
    rows = rows.select(key, "text", "words", *[value(F.col("text"), F.col("words")).alias(name) for name, value in STATISTICS.items()])
    known = {name: F.col(name) for name in STATISTICS}
    base = [_verdict(r, F.col("text"), F.col("words"), known) for r in RULES if r.name in base_rules]
    failed = base[0] | base[1]
    verdict = F.when(failed, F.lit("base")).otherwise(rejected_by(F.col("text"), F.col("words"), ordered, known))
    return rows.select(key, *STATISTICS, failed.alias("base_failed"), verdict.isNull().alias("kept"))
