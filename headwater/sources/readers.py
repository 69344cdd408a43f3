"""Readers of feeds, packages and captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_items(spark: SparkSession, path: str, item: T.StructType) -> DataFrame:
    """Items of a JSON file that is an array or an envelope {generated_at, items}; (generated_at, pos, item fields).

    Files are read whole, one file to a row (``feed_files.read_feed_files`` reads large ones in ranges). What is no
    object is dropped (a string that holds the JSON text of an object counts as that object); ``pos`` counts all values,
    so that gaps show where.
    """
    raw = spark.read.text(path, wholetext=True).select(F.btrim("value").alias("v"))
    values = T.ArrayType(T.StringType())  # as their JSON text
    envelope = F.from_json("v", T.StructType([T.StructField("generated_at", T.StringType()), T.StructField("items", values)]))
    both = raw.select(F.when(F.col("v").startswith("["), F.from_json("v", values)).otherwise(envelope["items"]).alias("items"), F.when(~F.col("v").startswith("["), envelope["generated_at"]).alias("generated_at"))
    rows = both.select("generated_at", F.posexplode("items").alias("pos", "x")).where(F.coalesce(F.json_object_keys("x").isNotNull(), F.lit(False)))
    return rows.select("generated_at", "pos", F.from_json("x", item).alias("item")).select("generated_at", "pos", "item.*")


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    """Items of captured RSS files: title, link, pubDate, source."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "link", "pubDate")] + [T.StructField("source", T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_url", T.StringType())]))])
    rows = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    return rows.select("title", "link", F.col("pubDate").alias("pub_date"), F.col("source._VALUE").alias("source"))


def read_keyword_feeds(spark: SparkSession, feeds: dict[str, str]) -> DataFrame:
    """Items of captured RSS files, one file or folder per keyword: keyword, kw_pos, pos, title, link, pub_date, source.

    Positions are the order of the keywords and of the items within a file. A file is read whole; one that is no feed
    gives no rows.
    """
    inner = "title STRING, link STRING, pubDate STRING, source STRING"
    out = None
    for k, (keyword, path) in enumerate(feeds.items()):
        raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.regexp_extract_all("value", F.lit(r"(?s)<item\b[^>]*>.*?</item\s*>"), F.lit(0))).alias("pos", "x"))
        one = raw.select(F.lit(keyword).alias("keyword"), F.lit(k).alias("kw_pos"), "pos", F.from_xml("x", inner).alias("i"))
        out = one if out is None else out.unionByName(one)
    return out.select("keyword", "kw_pos", "pos", "i.title", "i.link", F.col("i.pubDate").alias("pub_date"), "i.source")


def read_releases(spark: SparkSession, path: str, release: T.StructType) -> DataFrame:
    """Releases of procurement packages, {releases: [...]} or bare arrays."""
    raw = spark.read.text(path, wholetext=True).select(F.btrim("value").alias("v"))
    inside = F.from_json("v", T.StructType([T.StructField("releases", T.ArrayType(release))]))["releases"]
    return raw.select(F.explode(F.when(F.col("v").startswith("["), F.from_json("v", T.ArrayType(release))).otherwise(inside)).alias("r")).select("r.*")


def read_pages(spark: SparkSession, path: str, base: str) -> DataFrame:
    """Captured HTML files as (url, html, content_sha256); the address is the base and the file's name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.concat(F.lit(base.rstrip("/") + "/"), name).alias("url"), F.decode("content", "UTF-8").alias("html"), F.sha2("content", 256).alias("content_sha256"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), "length")


def select_sources(registry: list[dict], requested: str = "", accepted: str = "ACCEPTED") -> list[dict]:
    """Sources that are enabled and accepted, of those requested (comma-separated codes; none: all). A request for any other is an error."""
    usable = {s["code"]: s for s in registry if s.get("enabled") and s.get("status") == accepted}
    codes = [c.strip() for c in requested.split(",") if c.strip()]
    known = {s["code"] for s in registry}
    for code in codes:
        if code not in known:
            raise ValueError(f"unknown source {code}")
        if code not in usable:
            raise ValueError(f"source {code} may not be selected")
    return [s for c, s in usable.items() if not codes or c in codes]


def option(env: dict, name: str, kind: str, default, least=None, most=None):
    """A typed parameter: int, bool or percent; an unset one is the default, one out of range an error."""
    text = str(env.get(name, "")).strip()
    if not text:
        return default
    if kind == "bool":
        return text.lower() in ("1", "true", "yes", "on")
    value = float(text) if kind == "percent" else int(text)
    if (least is not None and value < least) or (most is not None and value > most):
        raise ValueError(f"{name}: {value} is outside {least}..{most}")
    return value


def item_count(spark: SparkSession, path: str, item: T.StructType) -> tuple[int, str]:
    """(items of a file, '') or (0, why it could not be read)."""
    try:
        rows = spark.read.text(path, wholetext=True).select(F.btrim("value").alias("v"))
        whole = F.from_json("v", T.StructType([T.StructField("items", T.ArrayType(item))]))["items"]
        held = rows.agg(F.count_if(F.col("v").startswith("{") & whole.isNotNull()).alias("good"), F.count("*").alias("files"), F.sum(F.size(whole)).alias("n")).first()
    except Exception as error:
        return 0, f"unreadable: {type(error).__name__}"
    return (held.n, "") if held.files and held.good == held.files else (0, "an object with a list of items is needed")


def read_optional(spark: SparkSession, read, schema: T.StructType, name: str) -> tuple[DataFrame, list[str]]:
    """(rows, warnings) of an input that may be absent or broken: then there are no rows and one warning, and the rest goes on."""
    try:
        out = read()
        out.limit(1).count()
        return out, []
    except Exception as error:
        return spark.createDataFrame([], schema), [f"{name} is not available ({type(error).__name__})"]


#: What can become of a source that was looked at.
ACCEPTANCE = ("ACCEPTED_FOR_TRIGGER_PILOT", "PILOT_ONLY", "DISABLED", "REJECTED")


def registry_errors(registry: dict, statuses=ACCEPTANCE) -> list[str]:
    """All errors of a registry of sources; an empty list means that it may be used."""
    if not isinstance(registry, dict) or not isinstance(registry.get("sources"), list):
        return ["an object with a list of sources is needed"]
    listed, errors, seen = registry.get("acceptance_statuses"), [], set()
    if not isinstance(listed, list) or sorted(map(str, listed)) != sorted(statuses):
        errors.append("acceptance_statuses: each status is needed once")
    for k, s in enumerate(registry["sources"]):
        code = str(s.get("code") or "").strip() if isinstance(s, dict) else ""
        if not code:
            errors.append(f"sources[{k}]: a code is needed")
            continue
        if code in seen:
            errors.append(f"{code}: stands more than once")
        seen.add(code)
        if s.get("acceptance_status") not in statuses:
            errors.append(f"{code}: unknown status")
        if s.get("acceptance_status") == "REJECTED" and not str(s.get("acceptance_reason") or "").strip():
            errors.append(f"{code}: a rejected source needs a reason")
    return errors
