r"""Line de-duplication by overlapping three-line windows.

Lines are split at ``\n``; lines with a character other than white space are
numbered.  Every three such lines in a row make a window, hashed (128 bits) after
the white space at their ends is cut.  A window's first occurrence, by
``doc_id`` and then place, stays; all later ones cover their three lines, and
covered places are merged and removed.  A blank line goes with the line before it.

Windows are counted by partial aggregates; only repeated windows come back to
the documents, through a plain join that adaptive execution can split, and are
reduced to line numbers of a document before the texts join them.

Defined cases: a null text stays null and has no lines; documents with fewer
than three lines stay as they are; rows with the same id and text are one
document and get the same result; null ids come after all others; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conewise.llm.common import plain_text, read_table, ship, written

WINDOW = 3
_BLANK = r"[^\x20\x09-\x0D]"
_SPACE = " \t\n\v\f\r"
_EDGES = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(lines: Column) -> Column:
    """(place, h1, h2) of each window over trimmed lines."""

    def window(i: Column) -> Column:
        part = F.slice(lines, i + 1, WINDOW)
        return F.struct(i.cast("long").alias("place"), F.xxhash64(part).alias("h1"),
                        F.xxhash64(F.lit(1), part).alias("h2"))

    at = F.when(F.size(lines) >= WINDOW, F.sequence(F.lit(0), F.size(lines) - WINDOW)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(at, window)


def covered_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, covered): numbers of the lines to remove in each document that repeats a window."""
    text = F.col("text")
    full = F.transform(F.filter(_lines(text), lambda x: x.rlike(_BLANK)), lambda x: F.regexp_replace(x, _EDGES, ""))
    windows = written(
        docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"))
        .select("doc_id", F.xxhash64("text").alias("tie"), F.inline(F.transform(F.array(full), _windows)[0])), "windows")
    where = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie", "place")
    again = written(windows.groupBy("h1", "h2").agg(F.min(where).alias("first"), F.max(where).alias("last"))
                    .filter("first <> last").drop("last"), "repeated-windows")
    later = windows.join(again, ["h1", "h2"]).filter(where != F.col("first"))
    return (later.groupBy("doc_id", "tie")
            .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set(
                F.sequence(F.col("place"), F.col("place") + (WINDOW - 1)))))).alias("covered")))


def remaining(text: str, covered: set[int]) -> tuple[str, int]:
    """The text without the non-blank lines of these numbers and the blank lines after them, and how many went."""
    number, kept = -1, []
    lines = text.split("\n")
    for line in lines:
        number += bool(line.strip(_SPACE))
        if number not in covered:
            kept.append(line)
    return "\n".join(kept), len(lines) - len(kept)


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, removed = [], []
        for text, covered in zip(batch.column("text"), batch.column("covered"), strict=True):
            new, n = (text.as_py(), 0) if not covered.is_valid or not text.is_valid else remaining(text.as_py(), set(covered.as_py()))
            texts.append(new)
            removed.append(n)
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string()), "n_removed": pa.array(removed, pa.int64())})


def line_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, its text without repeated windows, and the number of lines removed."""
    ship(docs.sparkSession)
    # the same join at every size: by sorting, whether or not the list would fit a broadcast
    covered = written(covered_lines(docs), "covered-lines").hint("merge")
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"),
                        F.xxhash64(plain_text()).alias("text_hash"))
    joined = keyed.join(covered, keyed.id.eqNullSafe(covered.doc_id) & (keyed.text_hash == covered.tie), "left").select(
        F.col("id").alias("doc_id"), "text", "covered")
    return joined.mapInArrow(_cleaned, "doc_id long, text string, n_removed long")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH every AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)
),
numbered AS (
  SELECT doc_id, pos, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS has_words,
         sum(CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS n
  FROM every
),
full_lines AS (
  SELECT doc_id, n, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM numbered WHERE has_words
),
windows AS (
  SELECT doc_id, n, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
  FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY n)
),
ranked AS (
  SELECT doc_id, n, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, n) AS k FROM windows WHERE c IS NOT NULL
),
covered AS (SELECT DISTINCT doc_id, unnest([n, n + 1, n + 2]) AS n FROM ranked WHERE k > 1),
kept AS (
  SELECT x.doc_id, string_agg(x.line, chr(10) ORDER BY x.pos) AS text, count(*) AS n_kept
  FROM numbered x LEFT JOIN covered c ON x.doc_id = c.doc_id AND x.n = c.n WHERE c.n IS NULL GROUP BY x.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) - coalesce(k.n_kept, 0) END AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
