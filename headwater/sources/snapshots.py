"""Snapshots in buckets of their key: yesterday's and today's meet without an exchange.

Every snapshot of a table is written in the same number of buckets, one file each, sorted by key. A join of two of them
on that key, as ``diff.snapshot_diff`` makes it, then reads bucket beside bucket: no row moves, however large they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

BUCKETS = 64


def write_snapshot(df: DataFrame, table: str, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Write a snapshot as a table of the catalogue at ``path``, which must be empty; the table. Null keys share a bucket."""
    (df.repartition(buckets, key).sortWithinPartitions(key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)
