"""Shared pieces of the training-data operators: durable tables, broadcasts of checked size, text maps."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest object that an operator broadcasts, in bytes.
BROADCAST_BYTES = 64 << 20


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; a temporary one only in local mode, where it is unset."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
    elif not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="headwater-checkpoint-"))


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return a frame that reads it; lineage ends there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of frames that are no longer referenced."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def checked_broadcast(spark: SparkSession, value, n_bytes: int):
    """Broadcast a value whose size is known; anything above ``BROADCAST_BYTES`` is an error, not a risk."""
    if n_bytes > BROADCAST_BYTES:
        raise ValueError(f"{n_bytes} bytes exceed the broadcast bound of {BROADCAST_BYTES}")
    return spark.sparkContext.broadcast(value)


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, in any case, made from the given ones."""
    held, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in held:
            n += "_"
        held.add(n.lower())
        out.append(n)
    return out


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` for columns of any names: those of the batches that ``run`` gets are their places."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, schema)


def map_text(
    df: DataFrame, text_col: str, keep: list[str], fields: list[T.StructField], per_batch: Callable[[list[str]], list[list]], start: Callable[[], object] | None = None
) -> DataFrame:
    """Append ``fields`` computed from whole texts, Arrow batch by Arrow batch, beside the ``keep`` columns.

    ``per_batch(texts[, state])`` returns one list per field. ``state`` comes from ``start()``, once per task.
    A kept column whose name equals a new field's name, in any case, is dropped in favour of the new field. Null texts
    arrive as ''. Spark bounds a batch by ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB) as well as by rows.
    """
    names = {f.name.lower() for f in fields}
    keep = [c for c in keep if c.lower() not in names]
    src = df.select(*map(col, keep), F.coalesce(col(text_col).cast("string"), F.lit("")).alias(spare(df, "text")[0]))
    schema = T.StructType(src.schema.fields[: len(keep)] + fields)
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start() if start else None
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = part.column(part.num_columns - 1).to_pylist()
                out = per_batch(texts, state) if start else per_batch(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))] + [pa.array(v, type=t) for v, t in zip(out, types, strict=True)], names=[*keep, *[f.name for f in fields]]
                )

    return map_batches(src, run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
