"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conewise.session import checkpoint_dir, ship  # noqa: F401  (operators take ship from here)

#: Upper-case ASCII letters and their lower-case forms: the contracts lower A-Z only.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: One run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of whole texts, or of pairs of sets, that a Python worker gets at a time.
TEXT_ROWS = 1000
PAIR_ROWS = 200
_ROOTS: dict[str, tuple[SparkSession, str]] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Spark's reader only, so any store that Spark reaches will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A folder of this application inside ``spark.checkpoint.dir``, removed when it ends."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{app}"
        _ROOTS[app] = (spark, root)
        atexit.register(remove_scratch, app)
    return _ROOTS[app][1]


def remove_scratch(app: str) -> None:
    """Delete the application's intermediate tables; safe to call twice or after the session ended."""
    spark, root = _ROOTS.pop(app, (None, ""))
    if spark is None or spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    This cuts lineage (a lost executor re-reads files), fixes row ids made by
    ``monotonically_increasing_id`` and gives joins real sizes and plain
    exchanges on both sides, which adaptive execution can split when skewed.
    ``batch_rows`` bounds the rows that Python workers get at a time.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_BATCH)
    if batch_rows:
        spark.conf.set(_BATCH, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def plain_text(c: str = "text") -> Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words(c: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """Number of parts so that each holds about ``per_part`` rows."""
    return max(least, -(-rows // per_part))
