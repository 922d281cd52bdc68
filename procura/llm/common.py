"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.session import checkpoint_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs no upstream work) and lets Spark
    drop the shuffle files of the written plan at once, so the disk holds one
    step of an operator at a time.  The folder is deleted when the session ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/procura-llm-{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a generator of ``{column: values}`` dicts in schema order."""
    types_ = _arrow_schema(df.sparkSession, schema)

    def run(batches):
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in types_], schema=types_)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def held_out(doc_id: Column) -> Column:
    """True for the documents that no model may learn from: crc32 of the id as
    text, modulo 4, is 2.  A null id is not held out (it joins no label)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def texts_of(column: pa.Array) -> list[str]:
    """The column's strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def per_process(name: str, make: Callable):
    """An object made once per Python worker and kept between its tasks.  One
    is kept at a time, so that a worker which goes on to another operator does
    not hold the tables of all operators before it."""
    kept = sys.modules.setdefault("_procura_llm_kept", types.ModuleType("_procura_llm_kept")).__dict__
    if kept.get("name") != name:
        kept["name"], kept["object"] = name, None  # the old one goes before the new one is made
        kept["object"] = make()
    return kept["object"]


# --- rolling hashes over words -------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def word_hasher(limit: int = 300_000) -> dict:
    """A dict from word bytes to its XXH64 that keeps the first ``limit``
    words it meets (the frequent ones come early)."""
    import xxhash

    class Hashes(dict):
        def __missing__(self, word):
            value = xxhash.xxh64_intdigest(word, 7)
            if len(self) < limit:
                self[word] = value
            return value

    return Hashes()


def hash_words(words: list[bytes], hashes: dict) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _MULT + words[i:i + n]
    out ^= out >> np.uint64(31)
    out *= _MIX
    return out ^ (out >> np.uint64(29))


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Mask of the ``n`` positions covered by runs of ``size`` at ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(starts, n), 1)
    np.add.at(edge, np.minimum(np.asarray(starts) + size, n), -1)
    return np.cumsum(edge[:n]) > 0
