"""Distinct counts that add up: exact bitmaps of ids, built once on the finest level and rolled up.

Spark's bitmap functions split ids into buckets of 32,768; a bitmap has a fixed
size, so the state of one (key, bucket) is bounded whatever the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, keys: list[Column], id_col: str) -> DataFrame:
    """One row per key and bucket of ids: ``bucket`` and the bitmap ``ids``; null ids are in none.

    Distinct bits are dealt by key and bucket before there are bitmaps: a task with
    few rows of each key and bucket would else send a whole bitmap for each.
    """
    names = [*_names(keys, df), "bucket"]
    bits = df.filter(F.col(id_col).isNotNull()).select(
        *keys, F.bitmap_bucket_number(F.col(id_col)).alias("bucket"), F.bitmap_bit_position(F.col(id_col)).alias("_bit")).distinct()
    return bits.repartition(*names).groupBy(*names).agg(F.bitmap_construct_agg("_bit").alias("ids"))


def _names(keys: list[Column], df: DataFrame) -> list[str]:
    return df.select(*keys).columns


def distinct_from_bitmaps(bitmaps: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Distinct ids of each (coarser) key: bitmaps of a bucket are merged, then their bits are added up."""
    names = _names(keys, bitmaps)
    merged = bitmaps.select(*keys, "bucket", "ids").groupBy(*names, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return distinct_of_whole(merged, keys=[F.col(n) for n in names], name=name)


def distinct_of_whole(bitmaps: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Distinct ids of each key that has one bitmap per bucket, as ``id_bitmaps`` makes them: no bitmap is moved."""
    counted = bitmaps.select(*keys, F.bitmap_count("ids").alias("_n"))
    return counted.groupBy(*_names(keys, bitmaps)).agg(F.sum("_n").alias(name))
