r"""Source divergence audit by in-mapper stripes.

Terms are runs of ASCII letters (A-Z lower-cased) and of characters beyond ASCII.
A task folds whole documents into one hash stripe per language and term: in how
many documents the term stands, and how often it stands in each source.  When
its stripes hold ``SPILL`` counts, the task emits them and starts anew.  Spilled
stripes are merged by key with partial aggregates, first by (language, term,
source), then by (language, term); a merged stripe has one count a source.  Terms
in at least ``min_documents`` documents of their language are kept.

A group (language, source) with N kept occurrences gives a term with count c the
share p = 1 + floor(1e9 (c + 1) / (N + V)), V the language's kept terms; a language
its own share likewise.  f(p, q) = floor((p - q)**2 / q).

``pair``: for two sources of a language, f summed over all kept terms.  With p0 for
a term that a group lacks, f(p, q) = f(p0, q0) + [f(p, q0) - f(p0, q0)] +
[f(p0, q) - f(p0, q0)] + rest.  The first is V times one number; the next two need
only how many terms of a group have which count; the rest is 0 unless both groups
have the term, and comes from the merged stripes, whose pairs a task adds up
before it emits them.  So a stripe is never filled up with the sources it lacks.

``term``: the terms of a group whose share is above the language's, the ``ranks``
first by f, straight from the stripes' counts.

All arithmetic is on whole numbers.  Pairs of sources are the result itself; no
documents or terms are paired.

Defined cases: null text, language or source count as ''; a group without kept
terms has N = 0; a language without kept terms gives its pairs the value 0 and no
terms; equal rows and rows with the same id are documents of their own; texts of any
length are folded in parts; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conewise.llm.common import TEXT_ROWS, plain_text, read_table, ship, written

#: Counts that a task's stripes hold before they are emitted.
SPILL = 300_000
#: Bytes of a text that are split into words at a time.
PART = 1 << 22
#: Pairs of counts that are worked on at a time, and sums of pairs held before they are emitted.
PAIRS = 1 << 20
SUMS = 500_000
#: Shares are in units of 1 / SCALE.
SCALE = 1_000_000_000
MIN_DOCUMENTS = 3
RANKS = 200

_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_STRIPE = "lang string, term string, df long, counts array<struct<source: string, n: long>>"


def term_counts(text: str) -> Counter:
    """How often each term stands in a text, terms in UTF-8."""
    raw = text.encode().translate(_TERMS)
    if len(raw) <= PART:
        return Counter(raw.split())
    found: Counter = Counter()
    start = 0
    while start < len(raw):
        end = raw.find(b" ", start + PART)
        end = len(raw) if end < 0 else end
        found.update(raw[start:end].split())
        start = end
    return found


def stripes(docs: DataFrame, spill: int = SPILL) -> DataFrame:
    """Written table of the stripes that the tasks emit."""

    def emit(folded: dict) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
        rows = [(lang, term, stripe) for lang, terms in folded.items() for term, stripe in terms.items()]
        for a in range(0, len(rows), 10_000):
            some = rows[a : a + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in some], pa.string()), pa.array([r[1].decode() for r in some], pa.string()),
                 pa.array([r[2][0] for r in some], pa.int64()),
                 pa.array([[{"source": s, "n": n} for s, n in r[2][1].items()] for r in some], kind)], ["lang", "term", "df", "counts"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded: dict[str, dict[bytes, list]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text")), strict=True):
                terms, source = folded.setdefault(lang.as_py(), {}), source.as_py()
                for term, n in term_counts(text.as_py()).items():
                    stripe = terms.get(term)
                    if stripe is None:
                        terms[term] = [1, {source: n}]
                        held += 1
                        continue
                    stripe[0] += 1
                    counts = stripe[1]
                    if source in counts:
                        counts[source] += n
                    else:
                        counts[source] = n
                        held += 1
                if held >= spill:
                    yield from emit(folded)
                    folded, held = {}, 0
        yield from emit(folded)

    texts = docs.select(*[plain_text(c).alias(c) for c in ("lang", "source", "text")])
    return written(texts.mapInArrow(fold, _STRIPE), "stripes", TEXT_ROWS)


def merged(emitted: DataFrame, min_documents: int) -> DataFrame:
    """Written table of the kept terms' stripes: lang, term, total, counts (source, n)."""
    each = emitted.select("lang", "term", "df", F.posexplode("counts").alias("at", "c"))
    by_source = (each.groupBy("lang", "term", F.col("c.source").alias("source"))
                 .agg(F.sum("c.n").alias("n"), F.sum(F.when(F.col("at") == 0, F.col("df")).otherwise(0)).alias("df")))
    whole = by_source.groupBy("lang", "term").agg(
        F.sum("df").alias("df"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return written(whole.filter(F.col("df") >= min_documents).drop("df"), "merged-stripes")


def share(count: Column, occurrences: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (occurrences + terms)), null without terms."""
    wide = lambda c: c.cast("decimal(18,0)")
    by = F.when(terms > 0, occurrences + terms)
    return 1 + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + 1), wide(by))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, item, value): what terms that both groups have add to a pair, summed up within a task."""
    sums: dict[tuple[str, str, str], int] = {}

    def emit() -> pa.RecordBatch:
        keys = list(sums)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.string()) for i in range(3)] + [pa.array(list(sums.values()), pa.int64())],
            ["lang", "source", "item", "value"])

    for batch in batches:
        counts = batch.column("counts")
        size = np.asarray(pc.list_value_length(counts)).astype(np.int64)
        flat = pc.list_flatten(counts)
        p, p0 = (np.asarray(flat.field(c)) for c in ("p", "p0"))
        names = flat.field("source").dictionary_encode()
        langs = batch.column("lang").dictionary_encode()
        source = np.asarray(names.indices).astype(np.int64)
        lang = np.repeat(np.asarray(langs.indices).astype(np.int64), size)
        names, langs = names.dictionary.to_pylist(), langs.dictionary.to_pylist()
        first, width = np.repeat(np.cumsum(size) - size, size), np.repeat(size, size)
        upto = np.concatenate(([0], np.cumsum(width)))  # each count meets all of its stripe
        a = 0
        while a < len(p):
            b = max(a + 1, int(np.searchsorted(upto, upto[a] + PAIRS, side="right")) - 1)
            one = np.repeat(np.arange(a, b), width[a:b])
            two = first[one] + np.arange(len(one)) - (upto[one] - upto[a])
            one, two = one[one != two], two[one != two]
            a = b
            if not len(one):
                continue
            value = _f(p[one], p[two]) - _f(p[one], p0[two]) - _f(p0[one], p[two]) + _f(p0[one], p0[two])
            key = (lang[one] * len(names) + source[one]) * len(names) + source[two]
            order = np.argsort(key, kind="stable")
            key = key[order]
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            for k, v in zip(key[starts].tolist(), np.add.reduceat(value[order], starts).tolist(), strict=True):
                k, j = divmod(k, len(names))
                k, i = divmod(k, len(names))
                at = (langs[k], names[i], names[j])
                sums[at] = sums.get(at, 0) + v
            if len(sums) >= SUMS:
                yield emit()
                sums.clear()
    yield emit()


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, ranks: int = RANKS, spill: int = SPILL) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    ship(docs.sparkSession)
    kept = merged(stripes(docs, spill), min_documents)
    each = kept.select("lang", "term", "total", F.inline("counts"))
    every = docs.select(plain_text("lang").alias("lang"), plain_text("source").alias("source")).distinct()
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    of_group = each.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = every.join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left").fillna(0, ["v", "lang_n", "group_n"])
    groups = written(groups.withColumn("p0", share(F.lit(0), F.col("group_n"), F.col("v"))), "groups")
    shares = written(
        each.join(groups, ["lang", "source"]).select(
            "lang", "source", "term", "n", "p0", share(F.col("n"), F.col("group_n"), F.col("v")).alias("p"),
            share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q")), "shares")

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                           divergence(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= ranks))

    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    different = F.col("source") != F.col("item")
    base = groups.join(other, "lang").filter(different).select(
        "lang", "source", "item", F.coalesce(F.col("v") * divergence(F.col("p0"), F.col("q0")), F.lit(0)).alias("value"))
    alike = written(shares.groupBy("lang", "source", "n", "p", "p0").agg(F.count("*").alias("terms")), "counts")
    met = alike.join(other, "lang").filter(different)
    mine = met.select("lang", "source", "item", (F.col("terms") * (
        divergence(F.col("p"), F.col("q0")) - divergence(F.col("p0"), F.col("q0")))).alias("value"))
    # the same counts as the other source's: its shares are then the second argument
    theirs = met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("terms") * (
        divergence(F.col("q0"), F.col("p")) - divergence(F.col("q0"), F.col("p0")))).alias("value"))
    both = (shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("counts"))
            .select("lang", "counts").mapInArrow(_met, "lang string, source string, item string, value long"))
    wide = F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")
    pairs = (base.unionByName(mine).unionByName(theirs).unionByName(both).groupBy("lang", "source", "item").agg(wide)
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(ranked)))
    return pairs.unionByName(terms)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCUMENTS}),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(sum(c.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source
  GROUP BY ALL
),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + g.v)::HUGEINT AS p,
         1 + ({SCALE}::HUGEINT * (k.total + 1)) // (l.n + l.v)::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {RANKS}
"""
