"""Text search by trigram postings (P23): candidates from the index, each verified by the pattern.

The index is a table (gram, id), range-partitioned and sorted by gram, so a search
reads the row groups of its grams only.  A pattern's grams are those of the literal
runs that every match must contain; a pattern without one scans the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conewise.plans.reports import text_search

SIZE = 3


def postings(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (gram, id) of the lower-cased texts, clustered by gram; null texts have none."""
    text = F.lower(F.col(text_col))
    starts = F.when(F.length(text) >= SIZE, F.sequence(F.lit(1), F.length(text) - (SIZE - 1)))
    grams = F.array_distinct(F.transform(starts, lambda at: F.substring(text, at, F.lit(SIZE))))
    found = df.select(F.explode(grams).alias("gram"), F.col(id_col).alias("id")).distinct()
    return found.repartitionByRange("gram", "id").sortWithinPartitions("gram", "id")


def required_runs(pattern: str) -> list[str]:
    """Literal ASCII runs that stand in every match of ``pattern``; [] if the pattern has groups or alternatives."""
    if any(c in pattern for c in "|()\\"):
        return []
    runs, run, at = [], "", 0
    while at < len(pattern):
        c, after = pattern[at], pattern[at + 1:at + 2]
        if c == "[":
            end = pattern.find("]", at + 2)
            if end < 0:
                return []
            runs, run, at = [*runs, run], "", end + 1
        elif c in ".^$*+?":
            runs, run, at = [*runs, run], "", at + 1
        elif c == "{":
            end = pattern.find("}", at)
            if end < 0:
                return []
            runs, run, at = [*runs, run], "", end + 1
        elif after in ("*", "?", "{") and after:  # may stand no time
            runs, run, at = [*runs, run], "", at + 1
        elif after == "+":  # stands once at least, the next character need not follow the first
            runs, run, at = [*runs, run + c], "", at + 1
        elif ord(c) < 128:
            run, at = run + c.lower(), at + 1
        else:  # other letters may change length or form with their case
            runs, run, at = [*runs, run], "", at + 1
    return [r.lower() for r in [*runs, run] if len(r) >= SIZE]


def pattern_grams(pattern: str) -> list[str]:
    return sorted({r[i:i + SIZE] for r in required_runs(pattern) for i in range(len(r) - SIZE + 1)})


def search(df: DataFrame, index: DataFrame, id_col: str, text_col: str, pattern: str | None) -> DataFrame:
    """The rows of ``text_search``, looked up in ``index`` where the pattern allows it."""
    grams = pattern_grams(pattern or "")
    if not grams:
        return text_search(df, text_col, pattern)
    hits = index.filter(F.col("gram").isin(grams)).groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") == len(grams))
    return text_search(df.join(hits.select(F.col("id").alias(id_col)), id_col, "left_semi"), text_col, pattern)
