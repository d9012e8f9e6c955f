"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of the columns that operators add while they work start so; inputs are projected first, so nothing clashes.
OWN = "__"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often and wherever in ``body`` it stands.

    A column of an earlier select is not enough: the optimizer may put its expression back, into lambdas too.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder of ``spark.checkpoint.dir`` and read it from there.

    Later stages then neither repeat the work nor depend on files of one executor. A folder of this machine is
    used only if none is set and the whole session runs in one process, as in tests.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="candlehouse-llm-"))
    return df.checkpoint()


#: Bytes of an Arrow batch between Spark and its Python workers.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on this session hands rows to Python workers in batches of about BATCH_BYTES, whatever the length of a text.

    Spark's own bounds are 10,000 rows and 64 MB, which with whole documents takes tens of MB several times over in every task, in
    the executor and in its Python worker. A bound that the session has set already stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for rows whose crc32 of the id as text leaves ``fold`` by ``folds``; a null id is never held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds == fold, F.lit(False))


def sample_ids(rows: DataFrame, key: str, bound: int, seed: int = 17) -> DataFrame:
    """At most ``bound`` different non-null values of ``key``: those whose hash is smallest.

    Each task keeps ``bound`` rows, so neither a shuffle of all rows nor a hot key matters beyond the
    pre-aggregated ``distinct``.
    """
    return (rows.select(key).where(F.col(key).isNotNull()).distinct()
            .orderBy(F.xxhash64(key, F.lit(seed)), key).limit(bound))


def texts_of(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """One text for each of the few ``ids`` (bounded by :func:`sample_ids`, hence broadcast); repeated ids give their smallest text."""
    return (docs.select(key, "text").join(F.broadcast(ids), key)
            .groupBy(key, *[c for c in ids.columns if c != key]).agg(F.min("text").alias("text")))
