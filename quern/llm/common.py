"""Shared pieces: the folder all executors see, lineage cuts, word splitting and hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
CACHE_WORDS = 150_000  # entries a worker's word cache holds before it starts afresh


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where that is unset (tests on one machine)."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="quern-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of what is made and run inside are deleted as it ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder; later stages survive lost executors without recomputing it."""
    shared_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # of a plan of its own, for it is run this once


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like ``cut`` for wide or long tables: a zstd Parquet table in the shared folder, pruned by column when read."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete the tables made by ``stored`` or ``cut`` under these, which nothing reads any more."""
    for df in tables:
        plan = df._jdf.queryExecution().analyzed()
        held = plan.rdd().getCheckpointFile() if plan.getClass().getSimpleName() == "LogicalRDD" else None
        if held is not None and held.isDefined():
            discard(df.sparkSession, held.get())
            continue
        for path in {file.rpartition("/")[0] for file in df.inputFiles()}:
            discard(df.sparkSession, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has made in the shared folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


BROADCAST_BYTES = 48 << 20  # of a table that is sent whole to every task; above, the same join is made by shuffle


def bounded(df: DataFrame) -> DataFrame:
    """The table, materialised, with a broadcast hint while its measured bytes are few: 24 a row, and those of its arrays and texts."""
    df = cut(df)
    width = F.lit(24 + 8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind == "array":
            width = width + F.greatest(F.size(f.name), F.lit(0)) * 32
    with shuffles_freed(df.sparkSession):
        size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


_made: list = [None, None]


def once(value, make):
    """``make(value)``, kept for a worker's next tasks as long as they bring the same (broadcast) object."""
    if _made[0] is not value:
        _made[:] = value, make(value)
    return _made[1]


class WordHashes(dict):
    """Word bytes to 64-bit hash; starts afresh when full, so memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(cache: WordHashes, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k-word window along the last axis, in order; none if there are fewer words."""
    n = max(h.shape[-1] - k + 1, 0)
    acc = np.zeros((*h.shape[:-1], n), dtype=np.uint64)
    for i in range(k if n else 0):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + h[..., i : i + n]
    return mix(acc)


def shingle_set(cache: WordHashes, text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; A-Z lower-cased, words split at ASCII white space.

    With fewer than k words the whole sequence is one shingle; without words the set is empty.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(cache, words)
    if len(h) < k:
        return mix(windows(h, len(h)) + np.uint64(len(h)))
    return np.unique(windows(h, k))


STEP = 256  # texts that are Python objects at a time


def binary(column) -> Iterator[bytes | None]:
    """An Arrow string column as UTF-8 bytes, without decoding, a few texts at a time."""
    column = column.cast(pa.binary())
    for at in range(0, len(column), STEP):
        yield from column.slice(at, STEP).to_pylist()


def holds(text: Column, setup) -> Column:
    """A boolean column from ``setup()``, which gives a test of one text as UTF-8 bytes; only ``text`` goes to Python."""
    @F.arrow_udf("boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        test = setup()
        for batch in batches:
            yield pa.array([test(t) for t in binary(batch)], pa.bool_())
            pa.default_memory_pool().release_unused()

    return run(text)


BATCH_ROWS = 1000  # rows of an Arrow batch of whole texts


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of the session hold at most BATCH_ROWS rows, so that long texts stay within a worker's memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
