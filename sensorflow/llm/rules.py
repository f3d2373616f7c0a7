"""Quality rules as a short-circuit cascade.

Each rule is a column that is true for a text to reject, made of measures of the text. The cascade is ordered on a sample of at most
``SAMPLE_ROWS`` texts of at most ``SAMPLE_CHARS`` characters, taken from the first input tasks that have them. One job counts which rules reject
which texts together; each rule's cost is how much longer it takes on the whole sample than on a quarter of it, so what every job
costs falls out. Next is always the rule with the most rejections a second among the texts that the rules before it leave; a text
that one rule rejects is not judged by the later ones. The order changes the work, never the verdict. DataFrame functions only:
words are hashed once, windows are hashes of eight word hashes, and the costly search for repeated windows runs only where the
windows are not all different.

Null and empty texts have no words and are rejected as too short. Equal rows get equal verdicts, extra columns pass through
``quality_filter`` unchanged, an empty table stays empty.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.frames import BLANKS, WORD_BREAK, let, packed, read, unpacked

#: Characters that mark broken markup and tables.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
#: Bounds of the sample from which the cascade's order is estimated: rows, and characters of a text.
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 1 << 14
#: How often the sample and its quarter are timed for each rule; the least counts.
TIMES = 3


def full(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(full(text), WORD_BREAK, -1), "")


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("bigint")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(full(text), BLANKS, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return (F.length(full(text)) - F.length(F.translate(full(text), SYMBOLS, ""))).cast("bigint")


def filled_lines(text: Column) -> Column:
    return F.filter(F.split(full(text), "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")


def line_counts(text: Column) -> Column:
    """Struct of ``n_lines``, lines with a word, and ``n_dup_lines``, those of them that are equal to an earlier one."""

    def counted(lines: Column) -> Column:
        n = F.size(lines).cast("bigint")
        return F.struct(n.alias("n_lines"), (n - F.size(F.array_distinct(lines))).alias("n_dup_lines"))

    return let(filled_lines(text), counted)


def window_hashes(hashes: Column, size: int = WINDOW) -> Column:
    """Hash of each window of ``size`` words, by position; empty if there are fewer words."""
    places = F.sequence(F.lit(0), F.size(hashes) - size)
    windows = F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]))
    return F.when(F.size(hashes) >= size, windows).otherwise(F.array().cast("array<bigint>"))


def covered(windows: Column, size: int = WINDOW) -> Column:
    """Words covered by windows that occur at least twice."""

    def repeated(ordered: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            return F.coalesce((F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"]), F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"]))

    def summed(places: Column) -> Column:
        step = F.transform(places, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(places, i + 1) - p, F.lit(size))))
        return F.aggregate(step, F.lit(0).cast("bigint"), lambda total, x: total + x)

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(ordered, repeated), summed)


def n_repeat_words(text: Column) -> Column:
    hashes = F.transform(words_of(text), lambda w: F.xxhash64(w))

    def counted(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(covered(windows))

    return let(let(hashes, lambda found: window_hashes(found)), counted)


@dataclass(frozen=True)
class Measures:
    """What rules judge a text by."""

    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_lines: Column
    n_dup_lines: Column
    n_repeat_words: Column

    @classmethod
    def of(cls, text: Column) -> Measures:
        lines = line_counts(text)
        return cls(n_words(text), word_chars(text), n_symbols(text), lines["n_lines"], lines["n_dup_lines"], n_repeat_words(text))

    @classmethod
    def named(cls) -> Measures:
        """Those that are columns already."""
        return cls(*[F.col(field.name) for field in fields(cls)])


@dataclass(frozen=True)
class Rule:
    """``broken(measures)`` is true for a text to reject."""

    name: str
    broken: Callable[[Measures], Column]


def base_rules() -> list[Rule]:
    return [
        Rule("too_few_words", lambda m: m.n_words < MIN_WORDS),
        Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
    ]


def style_rules() -> list[Rule]:
    """Beyond the base: symbols, repeated lines, words too short or too long on average."""
    return [
        Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
        Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > m.n_lines),
        Rule("short_words", lambda m: 2 * m.word_chars < 3 * m.n_words),
        Rule("long_words", lambda m: m.word_chars > 25 * m.n_words),
    ]


def sample_of(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[str | None]:
    """Texts of bounded length from as few input tasks as have enough of them."""
    texts = docs.select("text").where(F.length(full(F.col("text"))) <= chars)
    return [row[0] for row in texts.take(rows)]


def seconds_of(sample: DataFrame, quarter: DataFrame, rule: Rule) -> float:
    """What the rule costs on the sample beyond its quarter."""
    broken = rule.broken(Measures.of(F.col("text")))

    def timed(rows: DataFrame) -> float:
        began = time.perf_counter()
        rows.agg(F.count_if(broken)).first()
        return time.perf_counter() - began

    timed(quarter)  # makes the code
    less = min(timed(quarter) for _ in range(TIMES))
    return max(min(timed(sample) for _ in range(TIMES)) - less, 1e-4)


def in_order(rules: Sequence[Rule], seconds: dict[str, float], rejected: dict[tuple[bool, ...], int]) -> list[Rule]:
    """By rejections a second among the texts that the rules before leave; ties by name. ``rejected`` counts texts by what each rule says."""
    left, out = dict(enumerate(rules)), []
    while left:

        def rate(at: int) -> float:
            return sum(n for says, n in rejected.items() if says[at]) / seconds[rules[at].name]

        best = min(left, key=lambda at: (-rate(at), rules[at].name))
        out.append(left.pop(best))
        rejected = {says: n for says, n in rejected.items() if not says[best]}
    return out


def cascade_order(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> list[Rule]:
    """The rules in the cascade's order."""
    texts = sample_of(docs, sample_rows, sample_chars)
    make = docs.sparkSession.createDataFrame
    sample, quarter = (make([(t,) for t in some], "text string").coalesce(1).persist() for some in (texts, texts[: len(texts) // 4]))
    try:
        measures = Measures.of(F.col("text"))
        says = F.array(*[F.coalesce(rule.broken(measures), F.lit(False)) for rule in rules])
        rejected = {tuple(row[0]): row[1] for row in sample.groupBy(says.alias("says")).count().collect()}
        return in_order(rules, {rule.name: seconds_of(sample, quarter, rule) for rule in rules}, rejected)
    finally:
        sample.unpersist()
        quarter.unpersist()


def rejected_by(measures: Measures, rules: Sequence[Rule]) -> Column:
    """Name of the first rule in order that rejects the text, else null; CASE stops at the first that holds."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.broken(measures), F.lit(rule.name)).otherwise(verdict)
    return verdict


def quality_filter(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects."""
    ordered = cascade_order(docs, rules or base_rules() + style_rules(), sample_rows)
    return unpacked(packed(docs, "text").where(rejected_by(Measures.of(F.col("text")), ordered).isNull()))


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The base is asked for of every document; the cascade of the other rules runs on its measures, and only on what the base keeps."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.col("text")
    base = docs.select(
        "doc_id",
        n_words(text).alias("n_words"),
        word_chars(text).alias("word_chars"),
        n_symbols(text).alias("n_symbols"),
        line_counts(text).alias("lines"),
        n_repeat_words(text).alias("n_repeat_words"),
    ).select("*", "lines.*")
    measures = Measures.named()
    failed = (measures.n_words < MIN_WORDS) | (100 * measures.n_repeat_words > 30 * measures.n_words)
    rejected = rejected_by(measures, cascade_order(docs, style_rules()))
    return base.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, False).otherwise(rejected.isNull()).alias("kept"),
    )
