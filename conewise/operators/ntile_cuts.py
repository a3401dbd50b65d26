"""``ntile`` by exact cut points, without sorting the rows.

The last value of each bucket is found by histograms that close in on its rank:
each pass counts the values between the bounds known so far in ``BINS`` bins and
keeps the bin that holds the rank.  It ends when the bin has one value, or few
rows.  Only rows at a cut are then ranked, by value and id; every other row's
bucket follows from comparing its value with the cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conewise.operators.rank import global_row_number, ntile_from_rank
from conewise.sources.sinks import materialise, scratch_root

#: Bins of a pass, and rows that may be ranked instead of closing in further.
BINS = 1024
FEW = 10_000


def last_ranks(total: int, n: int) -> list[int]:
    """Rank of the last row of each bucket but the last; buckets without rows have none."""
    out, at = [], 0
    for k in range(n - 1):
        size = total // n + (k < total % n)
        at += size
        if size and at < total:
            out.append(at)
    return out


def _close_in(values: DataFrame, ranks: list[int], bins: int, few: int) -> list[tuple]:
    """(low, high, rows below low) for each rank: bounds of values that hold it."""
    low, high, known = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    found = {r: (low, high, 0, known) for r in ranks}
    active = set(ranks) if low != high else set()
    while active:
        marks = []
        for r in active:
            low, high, _, _ = found[r]
            share = (F.col("v").cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low) or 1.0)
            bin_ = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
            marks.append(F.when(F.col("v").between(F.lit(low), F.lit(high)), F.struct(F.lit(r).cast("long").alias("r"), bin_.alias("bin"))))
        rows = (values.select("v", F.explode(F.filter(F.array(*marks), lambda x: x.isNotNull())).alias("m"))
                .groupBy("m").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect())  # BINS rows a rank
        for r in sorted(active):
            below = found[r][2]
            for row in sorted((x for x in rows if x["m"]["r"] == r), key=lambda x: x["low"]):
                if below + row["n"] >= r:
                    stuck = (row["low"], row["high"]) == found[r][:2]  # values too near to tell apart as doubles
                    found[r] = (row["low"], row["high"], below, row["n"])
                    if row["low"] == row["high"] or row["n"] <= few or stuck:
                        active.discard(r)
                    break
                below += row["n"]
    return [found[r] for r in ranks]


def ntile_by_cuts(df: DataFrame, value: str, unique: str, n: int, name: str, bins: int = BINS, few: int = FEW) -> DataFrame:
    """``df`` with ``ntile(n) over (order by value nulls last, unique)``; ``value`` is a number, ``unique`` a key.

    Passes read only these two columns, written once; no rows give no rows.
    """
    values = materialise(df.select(F.col(value).alias("v"), F.col(unique).alias("u")), "values", root=scratch_root(df.sparkSession))
    total, known = values.agg(F.count("*"), F.count("v")).first()
    ranks = last_ranks(total, n)
    cuts = _close_in(values.filter("v is not null"), [r for r in ranks if r <= known], bins, few)
    spans = sorted({c[:2]: c[2] for c in cuts}.items())
    at_cut = [(F.col("v").between(F.lit(low), F.lit(high)), below) for (low, high), below in spans]
    nulls_cut = any(r > known for r in ranks)
    inside: Column = F.lit(False)
    for cond, _ in at_cut:
        inside = inside | cond
    inside = F.coalesce(inside, F.lit(False)) | (F.col("v").isNull() & F.lit(nulls_cut))
    # rank among the rows at cuts only; the rows between cuts are added back by span
    tied = global_row_number(values.filter(inside).withColumn("_no", F.col("v").isNull()),
                             [F.col("_no").asc(), F.col("v").asc(), F.col("u").asc()], "_rn")
    offset, ranked_below = F.lit(None).cast("bigint"), values.filter(inside).agg(
        *[F.count_if(F.col("v") < F.lit(low)).alias(f"c{i}") for i, ((low, _), _) in enumerate(spans)],
        F.count("v").alias("known")).first()
    for i, (cond, below) in enumerate(at_cut):  # of overlapping spans the lowest decides
        offset = F.coalesce(offset, F.when(cond, F.lit(below - ranked_below[f"c{i}"])))
    offset = F.coalesce(offset, F.lit(known - ranked_below["known"]))  # nulls
    places = tied.select(F.col("u").alias("_u"), ntile_from_rank(F.col("_rn") + offset, F.lit(total), n).alias("_tile"))
    # a row away from all cuts is behind every bucket whose cut lies below its value
    bucket: Column = F.lit(1)
    for low, high, *_ in cuts:
        bucket = bucket + F.when(F.col(value).isNull() | (F.col(value) > F.lit(high)), 1).otherwise(0)
    return (df.join(places, F.col(f"`{unique}`") == F.col("_u"), "left")
            .withColumn(name, F.coalesce("_tile", bucket).cast("bigint")).drop("_u", "_tile"))
