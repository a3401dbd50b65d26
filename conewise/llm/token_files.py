"""Token-ID / binary output: flat id files with 64-bit document offsets.

Documents are range-partitioned by ``doc_id``, so that files in order hold them
in ascending order.  Each task encodes its range and writes, under a name of
its own attempt,

* ``<name>.bin``   the ids, little-endian unsigned, 16 bits if the vocabulary allows, else 32
* ``<name>.idx``   64-bit little-endian start of each document in the file, and the end
* ``<name>.doc``   64-bit document ids, and ``<name>.nul``, one byte each, 1 for a null id

A Parquet manifest names the files of the attempts that Spark committed; files
of lost attempts are never read.  A file's base, the ids in all files before
it, is a prefix sum over the manifest (one row a file).  Readers map the files
into memory.

The folder must be a shared file system that all machines mount, as memory
maps need files; it is made inside ``spark.checkpoint.dir`` by the query.

Defined cases: a null text is empty and holds the end id only; null ids come
first; rows with the same id are ordered by the hash of their text and then by
their place in the input; texts of any length are encoded whole; no rows give an
empty manifest; other columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conewise.llm import tokens
from conewise.llm.common import new_folder, parts_for, plain_text, read_table, ship

MANIFEST = "part int, name string, width int, documents long, ids long"
DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Characters that a task encodes at a time.
SLICE = 2_000_000
#: Bytes of text whose ids a file holds on average; with little text, some files for each core.
FILE_BYTES = 128 << 20
FILES_A_CORE = 4


def mounted(folder: str) -> str:
    """The path of a folder that Python can open."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"token files need a mounted shared folder, not {url.scheme}:// ({folder})")
    return unquote(url.path)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, files: int | None = None) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files and return the manifest.

    ``files`` follows from the bytes of the texts if it is not given.
    """
    spark = docs.sparkSession
    ship(spark)
    if not files:
        size = docs.select(F.sum(F.octet_length(plain_text()))).first()[0] or 0
        files = parts_for(size, FILE_BYTES, FILES_A_CORE * spark.sparkContext.defaultParallelism)
    path = mounted(folder)
    os.makedirs(path, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer_path)
        end = np.array([end_id], encoder.dtype).tobytes()
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex[:16]}"
        total = rows = 0
        with (open(f"{path}/{name}.bin", "wb") as ids_file, open(f"{path}/{name}.idx", "wb") as idx_file,
              open(f"{path}/{name}.doc", "wb") as doc_file, open(f"{path}/{name}.nul", "wb") as nul_file):
            idx_file.write(np.array([0], "<u8").tobytes())
            for batch in batches:
                doc_id = batch.column(0)
                doc_file.write(doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                nul_file.write(doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
                sizes = np.asarray(pc.binary_length(batch.column(1)))
                for a, b in tokens.slices(sizes.tolist(), SLICE):
                    got = [ids + end for ids in encoder.encode(batch.column(1).slice(a, b - a).to_pylist())]
                    ids_file.writelines(got)
                    ends = total + np.cumsum([len(g) // encoder.dtype.itemsize for g in got], dtype=np.int64)
                    idx_file.write(ends.astype("<u8").tobytes())
                    total, rows = int(ends[-1]), rows + len(got)
        if rows:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "name": [name], "width": pa.array([encoder.dtype.itemsize], pa.int32()),
                "documents": [rows], "ids": [total]})

    order = ["doc_id", "tie", "row"]
    ordered = (docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"))
               .select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
               .repartitionByRange(files, *order).sortWithinPartitions(*order))
    ordered.select("doc_id", "text").mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens and the crc32 of its 32-bit ids."""
    path = mounted(folder)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                yield from digests(f"{path}/{f['name']}", f["width"], f["base"])

    return based.repartitionByRange(max(1, manifest.count()), "part").mapInArrow(read, DIGESTS)


def digests(file: str, width: int, base: int, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    ids = np.memmap(f"{file}.bin", f"<u{width}", "r")
    idx = np.memmap(f"{file}.idx", "<u8", "r")
    doc = np.memmap(f"{file}.doc", "<i8", "r")
    nul = np.memmap(f"{file}.nul", np.uint8, "r")
    for a in range(0, len(doc), rows):
        b = min(a + rows, len(doc))
        at = idx[a : b + 1].astype(np.int64)
        crc = [zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(doc[a:b], mask=nul[a:b] == 1), "start": base + at[:-1],
            "n_tokens": np.diff(at), "ids_crc32": pa.array(crc, pa.int64())})


def token_ids(folder: str, file_name: str, width: int) -> np.ndarray:
    """The ids of one file, mapped into memory."""
    return np.memmap(f"{mounted(folder)}/{file_name}.bin", f"<u{width}", "r")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, folder)
