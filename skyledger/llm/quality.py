"""Quality rules: a table of thresholds compiled into Spark expressions, without user functions.

A text's measures are integers, a rule bounds a measure or the ratio of two in thousandths, so a
verdict is exact. Long arrays are kept as columns of a projection of their own, because an array
that a lambda refers to would be built again for each element.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import SPACE

BLANKS = " \t\n\x0b\f\r"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for with as on be this are or at by from an a have not but was "
    "der die das und in zu den von mit ist im für auf nicht ein eine als auch dem des sich er es "
    "le la les de des et un une en que qui pour dans sur est au du ne pas par avec "
    "el los las y del se con una su para al lo como más o pero sus no por"
)


@dataclass(frozen=True)
class Rule:
    """`low` and `high` bound `part`, or 1000 * part / whole; a whole of 0 passes."""

    name: str
    part: str
    whole: str | None = None
    low: int | None = None
    high: int | None = None

    def failed(self) -> Column:
        part, tests = F.col(self.part), []
        unit = F.lit(1)
        if self.whole:
            part, unit = part * 1000, F.col(self.whole)
        if self.low is not None:
            tests.append(part < unit * self.low)
        if self.high is not None:
            tests.append(part > unit * self.high)
        return reduce(lambda a, b: a | b, tests)


BASE_RULES = (
    Rule("few_words", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", "n_words", high=500),
)
RULES = (
    Rule("many_words", "n_words", high=100_000),
    Rule("word_length", "word_chars", "n_words", low=2000, high=12_000),
    Rule("symbols", "n_symbols", "n_words", high=100),
    Rule("stop_words", "n_stop_words", "n_words", low=20),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=500),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=900),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=300),
)
MEASURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_stop_words n_bullet_lines n_cut_lines".split()
)


def add_measures(df: DataFrame, text: str = "text", stop_words: str = STOP_WORDS) -> DataFrame:
    """Add the MEASURES of `text` as bigint columns; null counts as empty, and all are then 0.

    Helper columns start with `_q_`; other columns keep their names and values, but those named like a
    measure are replaced. A repeated row is measured again. Windows of three words are compared by
    64-bit hashes.
    """
    size = lambda c: F.greatest(F.size(c), F.lit(0)).cast("bigint")
    none = F.array().cast("array<string>")
    df = df.withColumn("_q_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("_q_trim", F.trim("_q_text", F.lit(BLANKS)))
    df = df.withColumns(
        {
            "_q_words": F.when(F.col("_q_trim") == "", none).otherwise(F.split("_q_trim", f"{SPACE}+")),
            "_q_lines": F.filter(F.split("_q_text", "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != ""),
        }
    )
    word = lambda i: F.get("_q_words", i)
    windows = F.when(F.size("_q_words") < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(2), F.size("_q_words") - 1), lambda i: F.xxhash64(word(i - 2), word(i - 1), word(i)))
    )
    df = df.withColumn("_q_windows", windows)
    # Only a text that repeats a window sorts its windows; equal ones are then neighbours.
    pairs = F.transform("_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("_q_windows")) < F.size("_q_windows")
    df = df.withColumn("_q_sorted", F.when(repeats, F.sort_array(pairs)))

    def start(x: Column, k: Column) -> Column:
        near = lambda j: F.coalesce(F.get("_q_sorted", j)["h"] == x["h"], F.lit(False))
        return F.when(near(k - 1) | near(k + 1), x["i"])

    df = df.withColumn("_q_starts", F.sort_array(F.array_compact(F.transform("_q_sorted", start))))
    gaps = F.transform("_q_starts", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_q_starts", k + 1) - p, F.lit(3))))
    covered = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, b: a + b)
    df = df.withColumns(
        {
            "n_words": size("_q_words"),
            "word_chars": F.length(F.array_join("_q_words", "")).cast("bigint"),
            "n_symbols": F.regexp_count("_q_text", F.lit("[#*$%&|<>]")).cast("bigint"),
            "n_dup_lines": size("_q_lines") - size(F.array_distinct("_q_lines")),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("bigint"),
            "n_lines": size("_q_lines"),
            "n_stop_words": size(F.filter("_q_words", lambda w: w.isin(*dict.fromkeys(stop_words.split())))),
            "n_bullet_lines": size(F.filter("_q_lines", lambda x: F.ltrim(x).rlike("^[-*•]"))),
            "n_cut_lines": size(F.filter("_q_lines", lambda x: x.rlike("(\\.\\.\\.|…)\\s*$"))),
        }
    )
    return df.drop(*(c for c in df.columns if c.startswith("_q_")))


def judge(df: DataFrame, text: str = "text", base: tuple = BASE_RULES, rules: tuple = RULES) -> DataFrame:
    """Add the measures, `base_failed` and `kept`, which is true if no rule of either table fails.

    Null, empty and blank texts fail for want of words. Every row gets a verdict of its own. STOP_WORDS are
    of four languages; texts of others fail for want of stop words unless a table for them is given.
    """
    any_failed = lambda table: reduce(lambda a, b: a | b, (r.failed() for r in table), F.lit(False))
    df = add_measures(df, text).withColumn("base_failed", any_failed(base))
    return df.withColumn("kept", ~F.col("base_failed") & ~any_failed(rules))


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text passes, with the columns they came with."""
    clash = {*MEASURES, "base_failed", "kept"} & {*df.columns}
    named = df.withColumnsRenamed({c: f"_in_{c}" for c in clash})
    judged = judge(named, f"_in_{text}" if text in clash else text)
    # A filter on a plain expression is moved below the projections and repeats all of their work in each
    # lambda; it stays where it is if it depends on a row number.
    good = judged.withColumn("_q_pass", F.col("kept") & (F.monotonically_increasing_id() >= 0)).where("_q_pass")
    return good.drop(*MEASURES, "base_failed", "kept", "_q_pass").withColumnsRenamed({f"_in_{c}": c for c in clash}).select(df.columns)
