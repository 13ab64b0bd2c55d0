"""Quality rules: a table of thresholds compiled into one Spark projection.

The table names a measure, a bound below or above, and a reason. compile_rules turns it into expressions over the
measures of a text; everything is evaluated inside the JVM, without user functions and without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_CLASS

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it with as on be by this are from or an was not at "
    "le la les de des du un une et en est que qui dans pour par sur avec au il pas "
    "der die das und den von zu mit im ist ein eine nicht sich auf für dem auch des "
    "el los las y del al una con por se su para como más lo no es o"
).split()


@dataclass(frozen=True)
class Rule:
    """A text fails where the measure is below low or above high."""

    measure: str
    low: float | None = None
    high: float | None = None


#: The thresholds. They are lenient: prose in any of the four languages keeps well clear of them.
RULES = (
    Rule("n_words", low=20),
    Rule("mean_word_chars", low=2, high=20),
    Rule("symbol_ratio", high=0.3),
    Rule("stop_ratio", low=0.02),
    Rule("dup_line_ratio", high=0.5),
    Rule("repeat_ratio", high=0.3),
)


def _let(value: Column, body) -> Column:
    """Bind value once for use in body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, width: int) -> Column:
    """How many words are inside windows of width words that occur twice or more. Windows are sorted by their hash, so
    that equal ones are neighbours: n log n, whatever the text's length."""

    at = F.sequence(F.lit(1), F.greatest(F.size(words) - width + 1, F.lit(1)))
    hashes = F.transform(at, lambda i: F.xxhash64(F.slice(words, i, F.lit(width))))

    def covered(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), count))

    def count(rows: Column) -> Column:
        n = F.size(rows)
        same = lambda a, b: F.get(rows, a)["h"] == F.get(rows, b)["h"]
        twice = F.filter(rows, lambda r, i: F.coalesce(((i > 0) & same(i, i - 1)) | ((i < n - 1) & same(i, i + 1)), F.lit(False)))
        start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to"))
        add = lambda a, x: F.struct((a["n"] + x + width - F.greatest(x, a["to"])).alias("n"), (x + width).alias("to"))
        return F.aggregate(F.sort_array(F.transform(twice, lambda r: r["i"])), start, add)["n"]

    return F.when(F.size(words) < width + 1, F.lit(0)).otherwise(_let(hashes, covered))


def measures() -> Column:
    """A struct of the measures of the column text, each computed once. A null text has no words."""
    stop = list(dict.fromkeys(STOP_WORDS))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = lambda x: F.size(x).cast("long")

    def count(b: Column) -> Column:
        words, lines = b["words"], b["lines"]
        return F.struct(
            size(words).alias("n_words"),
            F.char_length(F.translate(b["text"], " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            (F.char_length(b["text"]) - F.char_length(F.translate(b["text"], SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (size(lines) - size(F.array_distinct(lines))).alias("n_dup_lines"),
            size(lines).alias("n_lines"),
            repeated_words(words, 8).cast("long").alias("n_repeat_words"),
            size(F.filter(words, lambda w: w.isin(*stop))).alias("n_stop_words"),
        )

    def relate(m: Column) -> Column:
        n = F.greatest(m["n_words"], F.lit(1))
        own = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_stop_words")
        return F.struct(
            *[m[c].alias(c) for c in own],
            (m["word_chars"] / n).alias("mean_word_chars"), (m["n_symbols"] / n).alias("symbol_ratio"), (m["n_stop_words"] / n).alias("stop_ratio"),
            (m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1))).alias("dup_line_ratio"), (m["n_repeat_words"] / n).alias("repeat_ratio"),
        )

    parts = F.struct(
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(WORD_CLASS), F.lit(0)).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CLASS)).alias("lines"),
    )
    return _let(_let(parts, count), relate)


def compile_rules(m: Column, rules=RULES) -> Column:
    """The array of the names of the rules that the measures m fail."""
    tests = []
    for r in rules:
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (m[r.measure] < r.low)
        if r.high is not None:
            bad = bad | (m[r.measure] > r.high)
        tests.append(F.when(bad, F.lit(r.measure)))
    return F.array_compact(F.array(*tests))


def verdict(rules=RULES) -> Column:
    """A struct: the measures of the column text, base_failed, failed (names of rules) and kept."""

    def judged(m: Column) -> Column:
        base = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
        return F.struct(m.alias("measures"), base.alias("base_failed"), compile_rules(m, rules).alias("failed"))

    return _let(_let(measures(), judged), lambda v: F.struct(v["measures"].alias("measures"), v["base_failed"].alias("base_failed"), v["failed"].alias("failed"), (~v["base_failed"] & (F.size(v["failed"]) == 0)).alias("kept")))


def judge(docs: DataFrame, keep: list[str | Column], rules=RULES) -> DataFrame:
    """The columns to keep and verdict, a struct of measures (a struct), base_failed, failed (rule names) and kept.

    base_failed: under 20 words, or over 30 % of them in 8-word windows that occur twice or more. Null and empty texts
    have no words and fail. Rows are judged one by one: repeated rows get the same verdict, an empty table gives none.
    """
    return docs.select(*keep, verdict(rules).alias("verdict"))


def keep_good(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    return docs.where(verdict(rules)["kept"])
