"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

1. quality      documents that the rules reject go, lines above the host limits leave the texts
2. exact_dedup  of equal texts the smallest id stays
3. near_dedup   of each group of near copies (five-word shingles, Jaccard 0.8) the smallest id stays
4. pii          personal data is masked
5. packing      the remaining texts are encoded and packed into sequences
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from conewise.llm import exact_dedup, jaccard_join, packing, pii, quality
from conewise.llm.common import new_folder, read_table

#: (name, function of (spark, docs, sf_dir)).
STAGES = [
    ("quality", quality.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_dedup", jaccard_join.stage),
    ("pii", pii.stage),
    ("packing", packing.stage),
]

#: The last stages tokenise and run a genetic search, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each reads what its predecessor wrote."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
