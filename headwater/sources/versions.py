"""Versions of a table: data that is written once, and small markers that are created once.

A version's rows go to a folder of their own. Then a marker ``log/<number>.json`` is made: written beside, and moved to
its name only if that name is absent. Two writers can't get the same number; the later one takes the next. Readers take
the last marker, so they see the version before or the version after, whole, whenever a writer dies. Nothing is
overwritten. A file system must move files atomically for that, as HDFS does; folders without a marker are leftovers
(``leftovers``).

Counters are observed while the rows are written, in the same pass. If a law over rows or counters fails, there is no
marker and the version before stays. A failed fetch makes a marker with its health alone, which names the rows of the
last accepted version.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Attempts of a writer to get a number while others take them.
ATTEMPTS = 50
#: What is said of a fetch.
FETCHED, KEPT, FAILED = "LIVE_FETCH_SUCCEEDED", "LIVE_FETCH_FAILED_USING_LAST_KNOWN_GOOD", "LIVE_FETCH_FAILED"


class LawBroken(ValueError):
    """Laws that the rows or counters of a version break, with how often; the version has not been accepted."""

    def __init__(self, broken: dict[str, int]):
        super().__init__(", ".join(f"{k}: {n}" for k, n in broken.items()))
        self.broken = broken


def _path(spark: SparkSession, name: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(name)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _listed(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _numbers(spark: SparkSession, base: str) -> list[int]:
    return [int(n[:-5]) for n in _listed(spark, f"{base}/log") if n.endswith(".json") and n[:-5].isdigit()]


def _create_once(spark: SparkSession, name: str, text: str) -> bool:
    """Whether a file of that name has been made; false if there is one."""
    folder, _, last = name.rpartition("/")
    fs, beside = _path(spark, f"{folder}/.{last}-{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(hadoop.Path(name)), plain)
        return True
    except Exception as e:
        fs.delete(beside, False)
        if "FileAlreadyExists" in str(e):
            return False
        raise


def last_marker(spark: SparkSession, base: str) -> dict | None:
    """The last marker: number, version and path of the rows (None before the first one), counters, health."""
    numbers = _numbers(spark, base)
    if not numbers:
        return None
    _, p = _path(spark, f"{base}/log/{max(numbers):020d}.json")
    return json.loads("\n".join(r.value for r in spark.read.text(p.toString(), wholetext=True).collect()))


def _commit(spark: SparkSession, base: str, make) -> dict:
    for _ in range(ATTEMPTS):
        before = last_marker(spark, base) or {"number": -1, "version": None, "path": None, "rows": 0}
        body = {"number": before["number"] + 1, **make(before)}
        if _create_once(spark, f"{base}/log/{body['number']:020d}.json", json.dumps(body, ensure_ascii=False)):
            return body
    raise RuntimeError(f"no number was free in {ATTEMPTS} attempts")


def publish(
    df: DataFrame, base: str, version: str, counters: dict[str, Column] | None = None, row_laws: dict[str, Column] | None = None, count_laws: dict[str, Column] | None = None, health: dict | None = None
) -> dict:
    """Write the rows and accept them as a version; the marker. A version that is the last one already is not written again.

    ``counters`` are aggregates over the rows, ``row_laws`` conditions on each row, ``count_laws`` conditions on
    ``rows`` and the counters. A null law is a broken one.
    """
    spark = df.sparkSession
    known = last_marker(spark, base)
    if known and known["version"] == version and known["health"].get("fetch_status") == FETCHED:
        return known
    path = f"{base}/data/{version}-{uuid.uuid4().hex}"
    seen, laws = Observation(), row_laws or {}
    measures = {"rows": F.count(F.lit(1)), **(counters or {}), **{f"law {n}": F.count_if(~F.coalesce(c, F.lit(False))) for n, c in laws.items()}}
    # the last step before the files: a task that is run again is counted once
    df.observe(seen, *[c.alias(n) for n, c in measures.items()]).write.parquet(path)
    got = {n: seen.get.get(n) for n in measures}
    broken = {n: got.pop(f"law {n}") for n in laws}
    if count_laws:
        schema = T.StructType([T.StructField(n, T.LongType()) for n in got])
        row = spark.createDataFrame([tuple(got.values())], schema).select(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in count_laws.items()]).first()
        broken |= {n: int(not row[n]) for n in count_laws}
    broken = {n: k for n, k in broken.items() if k}
    if broken:
        raise LawBroken(broken)
    told = {"fetch_status": FETCHED, **(health or {})}
    return _commit(spark, base, lambda _: {"version": version, "path": path, "rows": got["rows"], "counters": got, "health": told})


def publish_health(spark: SparkSession, base: str, health: dict | None = None) -> dict:
    """A marker of a fetch that failed: the rows of the last accepted version stay, if there are any."""

    def make(before: dict) -> dict:
        good = {"available": before["path"] is not None, "item_count": before["rows"]}
        told = {**(health or {}), "fetch_status": KEPT if good["available"] else FAILED, "last_known_good": good}
        return {"version": before["version"], "path": before["path"], "rows": before["rows"], "counters": before.get("counters", {}), "health": told}

    return _commit(spark, base, make)


def read_version(spark: SparkSession, base: str) -> DataFrame | None:
    """The rows of the last accepted version, None if there is none."""
    known = last_marker(spark, base)
    return spark.read.parquet(known["path"]) if known and known["path"] else None


def leftovers(spark: SparkSession, base: str) -> list[str]:
    """Folders of rows that no marker names: writers that died or were refused, or that are still at work."""
    named = set()
    for n in _numbers(spark, base):
        _, p = _path(spark, f"{base}/log/{n:020d}.json")
        named |= {json.loads(r.value)["path"] for r in spark.read.text(p.toString(), wholetext=True).collect()}
    return [f"{base}/data/{n}" for n in _listed(spark, f"{base}/data") if f"{base}/data/{n}" not in named]
