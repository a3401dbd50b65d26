r"""Quality rules on DataFrames: text rules, and lines that many documents of a host share.

Text rules (per document): words, their code points, symbols, repeated lines and
words in repeated five-word windows.  A document with fewer than 10 words, or
with more than a fifth of its words in repeated windows, fails.

Line rule (across documents): each line with a word is normalised (one space
for each run of white space, trimmed, letters as they are) and hashed.  For each
host and line the distinct documents, told apart by their whole text, are
counted; exact copies count once.  Lines that at least ``min_documents`` distinct documents of
a host share, and more than ``max_share`` of the host's documents, are removed.
A document that loses lines is rejected as depleted if it keeps fewer than
``MIN_WORDS`` words or less than ``min_left`` of the words it had.

Distinct documents of a (host, line) are counted by partial aggregates; lines
above the limits are written, so that a hot line or host is split by adaptive
execution in the join back.

Defined cases: a null text has no words and fails; a null host is a host of its
own; rows with the same text are one document for the counts; equal rows (same
id, host and text) are judged alike; no rows give no rows; texts of any length are
read whole; other columns are not read; a line that stands
twice in a document counts once for the host and is removed at both places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conewise.llm.common import plain_text, read_table, words, written

#: Production limits.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_DOCUMENTS = 20
MAX_SHARE = 0.005
MIN_LEFT = 0.3
#: Words in a window whose repeats count.
WINDOW = 5

_SPACE = r"[\x20\x09-\x0D]+"
_KEY = ["doc_id", "tie", "host"]


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def repeat_words(w: Column) -> Column:
    """Words that stand in a window of five words found twice or more in the text."""

    def covered(places: Column) -> Column:
        # a place covers five words, or those up to the next place if that is nearer
        steps = F.transform(places, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeated(order: Column) -> Column:
        # in (hash, place) order equal windows are neighbours
        like = lambda x, i: F.coalesce(F.get(order, i)["h"] == x["h"], F.lit(False))
        chosen = F.filter(order, lambda x, i: like(x, i - 1) | like(x, i + 1))
        return _bound(F.sort_array(F.transform(chosen, lambda x: x["i"])), covered)

    def count(hashes: Column) -> Column:
        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_bound(order, repeated))

    windows = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    return F.when(F.size(w) < WINDOW, 0).otherwise(_bound(windows, count)).cast("long")


def line_hash(line: Column) -> Column:
    """The first 60 bits of the MD5 of a line, with one space for each run of white space and none at its ends."""
    norm = F.trim(F.regexp_replace(line, _SPACE, " "))
    return F.conv(F.substring(F.md5(F.encode(norm, "UTF-8")), 1, 15), 16, 10).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def measured(docs: DataFrame) -> DataFrame:
    """One row per document, without its text: the rule counts, and hash and words of each line with a word."""
    text = F.col("text")
    by_words = _bound(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    return (
        docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string").alias("host"), plain_text().alias("text"))
        .select("doc_id", "host", F.xxhash64("text").alias("tie"), "text", by_words.alias("m"), lines_with_words(text).alias("lines"))
        .select(
            *_KEY, "m.*", F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.transform("lines", lambda x: F.struct(line_hash(x).alias("line"), F.size(words(x)).alias("words"))).alias("lines"))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                    | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
        .withColumn("row", F.monotonically_increasing_id())
    )


def shared_lines(rows: DataFrame, min_documents: int, max_share: float) -> DataFrame:
    """(host, line, documents): lines above both limits, documents told apart by their whole text."""
    seen = rows.select(F.struct("host").alias("at"), "tie", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
    counts = (seen.groupBy("at", "line").agg(F.countDistinct("tie").alias("documents"))
              .filter(F.col("documents") >= min_documents))
    hosts = rows.groupBy(F.struct("host").alias("at")).agg(F.count("*").alias("of"))
    return (counts.join(hosts, "at").filter(F.col("documents") > max_share * F.col("of"))
            .select(F.col("at.host").alias("host"), "line", "documents"))


def quality(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE,
            min_left: float = MIN_LEFT) -> DataFrame:
    """Verdict of each document of ``docs`` (doc_id, text, source).

    Columns: doc_id, tie (hash of the text), host, the rule counts, base_failed,
    n_removed_words, removed (hashes of its lines above the limits), kept.
    """
    rows = written(measured(docs), "measured")
    shared = written(shared_lines(rows, min_documents, max_share), "shared-lines")
    lines = rows.select("row", "host", F.inline("lines")).groupBy("row", "host", "line").agg(F.sum("words").alias("words"))
    hit = lines.join(shared, lines.host.eqNullSafe(shared.host) & (lines.line == shared.line), "inner")
    lost = (hit.select("row", lines.line, "words").groupBy("row")
            .agg(F.sum("words").alias("n_removed_words"), F.sort_array(F.collect_set("line")).alias("removed")))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < MIN_WORDS) | (left < min_left * F.col("n_words")))
    return (
        rows.drop("lines").join(lost, "row", "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
        .withColumn("kept", ~(F.col("base_failed") | depleted))
        .drop("row")
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without rejected documents; lines above the limits are gone from the others' texts."""
    columns = docs.columns
    kept = quality(docs).filter("kept").groupBy(*_KEY).agg(F.first("removed").alias("removed"))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(plain_text()).alias("text_hash"), F.col("source").cast("string").alias("at"))
    joined = keyed.join(kept, keyed.id.eqNullSafe(kept.doc_id) & (keyed.text_hash == kept.tie)
                        & keyed.at.eqNullSafe(kept.host))
    lines = F.split("doc.text", "\n", -1)
    text = F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(
        F.array_join(F.filter(lines, lambda x: ~F.array_contains("removed", line_hash(x))), "\n"))
    changed = {"text": text, "n_chars": F.when(F.col("removed").isNull(), F.col("doc.n_chars")).otherwise(
        F.length(text).cast(docs.schema["n_chars"].dataType))} if "n_chars" in columns else {"text": text}
    return joined.select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in columns])


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents
),
w AS (
  SELECT r, doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
),
windows AS (
  SELECT r, i, w[i:i + 4] AS win FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w)
),
again AS (
  SELECT r, unnest(range(i, i + 5)) AS place FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1
),
repeats AS (SELECT r, count(DISTINCT place) AS n FROM again GROUP BY r),
line_rows AS (
  SELECT r, host, left(md5(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')), 15) AS line,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, host, unnest(lines) AS x FROM w)
),
line_docs AS (SELECT r, host, line, sum(n) AS n FROM line_rows GROUP BY ALL),
counts AS (SELECT l.host, l.line, count(DISTINCT d.text) AS n FROM line_docs l JOIN d USING (r) GROUP BY ALL),
hosts AS (SELECT host, count(*) AS n FROM d GROUP BY ALL),
shared AS (
  SELECT c.host, c.line FROM counts c JOIN hosts h ON c.host IS NOT DISTINCT FROM h.host
  WHERE c.n >= {MIN_DOCUMENTS} AND c.n > {MAX_SHARE} * h.n
),
lost AS (
  SELECT r, sum(n) AS n FROM line_docs l JOIN shared s ON l.line = s.line AND l.host IS NOT DISTINCT FROM s.host GROUP BY r
),
m AS (
  SELECT w.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(p.n, 0) AS n_repeat_words, coalesce(l.n, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN repeats p USING (r) LEFT JOIN lost l USING (r)
),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR (n_removed_words > 0 AND (n_words - n_removed_words < {MIN_WORDS}
                            OR n_words - n_removed_words < {MIN_LEFT} * n_words))) AS kept,
       n_removed_words
FROM b
"""
