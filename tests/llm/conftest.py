import os

import pytest

SMALL = "/root/testdata/sf0.001"
TOKENIZER = "byte_bpe_50k.json"


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers
    return public_tokenizers.path


@pytest.fixture(scope="session")
def texts():
    import pyarrow.parquet as pq
    return pq.read_table(os.path.join(SMALL, "documents.parquet"))["text"].to_pylist()


@pytest.fixture(scope="session")
def frame(spark):
    """A frame of documents with extra columns whose names operators use inside."""
    def make(rows, types="doc_id long, text string, source string"):
        names = [c.split()[0] for c in types.split(", ")]
        width = len(names)
        full = [tuple(r) + (None,) * (width - len(r)) + (1, "x", 2, "y") for r in rows]
        return spark.createDataFrame(full, types + ", row long, tie string, n long, keep string").repartition(3)
    return make


#: Nulls, empty texts, ties and repeated rows.
ODD = [
    (1, None), (None, "lone text without an id"), (None, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"),
    (5, "one two"), (6, "One  two"), (7, "one two"), (None, "one two"), (8, "é😀 ß\nİK"),
]
