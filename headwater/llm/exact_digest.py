"""Fingerprints of canonical texts, groups of equal texts, and texts beside their successors.

The canonical form of a text is its compatibility composition (NFKC), case-folded, composed again, with white space
(Unicode's, the ASCII separators 1C to 1F included) at its ends removed and within it made one space. Its digest is XXH3 with 128 bits, as 32 hexadecimal
digits: equal texts have equal digests, wherever they stand.

Groups are exact. Digests are counted first; only texts whose digest stands more than once are read again, and those are
aggregated by digest and canonical bytes, so bytes are compared by the aggregation itself and copies shrink to one in
every task before they move. A digest with several canonical texts makes several groups; its rows, and only those, are
joined by bytes as well. Hot digests are salted where rows meet their group.

Null texts are empty texts, which are equal to each other and to texts of white space alone. Null ids are kept; a group
is named by its smallest id that is not null, by null if there is none. Repeated rows are copies. Empty tables give no
rows. Texts are whole. Columns are found by exact names; results have names of their own.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.llm.common import BROADCAST_BYTES, col, durable, map_text

#: Parts of a digest where rows meet their group.
SALTS = 32


def canonical(text: str) -> str:
    if text.isascii():
        return " ".join(text.lower().split())
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split())


def wide_hash(form: str, digits: int = 32) -> str:
    """The first hexadecimal digits of the 128-bit hash of a canonical text."""
    from xxhash import xxh3_128_hexdigest

    return xxh3_128_hexdigest(form.encode("utf-8", "surrogatepass"))[:digits]


def digests(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, out: str = "fingerprint", digits: int = 32) -> DataFrame:
    """The ``keep`` columns (all by default) and the digest of each text."""
    hashed = lambda texts: [[wide_hash(canonical(t), digits) for t in texts]]
    return map_text(df, text_col, df.columns if keep is None else keep, [T.StructField(out, T.StringType())], hashed)


def _few(df: DataFrame, row_bytes: int) -> DataFrame:
    """Marked for broadcast if its rows fit the bound."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None, digits: int = 32) -> DataFrame:
    """(id, fingerprint, group_id, copies) of every row; ``group_id`` is the smallest id among rows of equal canonical texts.

    ``known`` are rows whose digests have been computed: id, fingerprint and other columns, which stay. Of those, rows
    with an id in common are told apart by their digests alone. Fewer ``digits`` only make equal digests of different
    texts more frequent, which changes no group.
    """
    src = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    rows = durable(digests(src, "text", ["id"], "fingerprint", digits)) if known is None else known
    more = [c for c in rows.columns if c not in ("id", "fingerprint")]
    many = durable(rows.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select("fingerprint"))
    forms = [T.StructField("fingerprint", T.StringType()), T.StructField("form", T.StringType())]

    def formed(texts: list[str]) -> list[list[str]]:
        out = [canonical(t) for t in texts]
        return [[wide_hash(f, digits) for f in out], out]

    # whole forms are keys of the aggregation: equal bytes become one row before anything moves
    copied = map_text(src, "text", ["id"], forms, formed).join(_few(many, 64), "fingerprint", "left_semi")
    classes = durable(copied.groupBy("fingerprint", "form").agg(F.min("id").alias("group_id"), F.count("*").alias("copies")))
    mixed = durable(classes.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select("fingerprint"))

    def meet(rows: DataFrame, classes: DataFrame, *on: str, how: str = "inner") -> DataFrame:
        salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
        salt = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(SALTS))
        met = rows.withColumn("salt", salt).join(classes.withColumn("salt", salts), [*on, "salt"], how)
        return met.select("id", "fingerprint", *map(col, more), "group_id", "copies")

    plain = classes.drop("form")
    if mixed.isEmpty():
        out = meet(rows, plain, "fingerprint", how="left")
    else:
        told = copied.join(_few(mixed, 64), "fingerprint", "left_semi")
        if more:
            told = told.groupBy("id", "fingerprint").agg(F.min("form").alias("form"))
            held = rows.join(mixed, "fingerprint", "left_semi").alias("r").join(told.alias("t"), F.expr("r.id <=> t.id and r.fingerprint = t.fingerprint"))
            told = held.select("r.*", "t.form")
        out = meet(rows.join(mixed, "fingerprint", "left_anti"), plain.join(mixed, "fingerprint", "left_anti"), "fingerprint", how="left")
        out = out.unionByName(meet(told, classes.join(mixed, "fingerprint", "left_semi"), "fingerprint", "form"))
    one = F.col("copies").isNull()
    return out.withColumns({"group_id": F.when(one, F.col("id")).otherwise(F.col("group_id")), "copies": F.coalesce("copies", F.lit(1).cast("long"))})


def map_successors(df: DataFrame, id_col: str, text_col: str, fields: list[T.StructField], pair: Callable[[str, str], list]) -> DataFrame:
    """(id, *fields) with ``pair(text, text of the next row)``, in ascending order of ids; the first row follows the last.

    Rows are ranged by id and read in order, so each task knows all successors but that of its last row. Of every task
    the first and the last text are kept beside the results; the last ones meet the first ones of the next task. Null
    ids stand first; rows of equal ids are ordered by their texts.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    src = df.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    # equal rows may part: which of them is the next one does not matter
    ranged = src.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order, "text")
    done = T.StructType([src.schema["id"], *fields])
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("head", T.StringType()), T.StructField("tail", T.StringType()), *done.fields])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last = TaskContext.get().partitionId(), None, None
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                cut = b.slice(lo, 512)
                rows = []
                for row in zip(cut.column(0).to_pylist(), cut.column(1).to_pylist()):
                    first = row[1] if first is None else first
                    if last is not None:
                        rows.append((last[0], *pair(last[1], row[1])))
                    last = row
                if rows:
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip([[part] * n, [0] * n, [None] * n, [None] * n, *zip(*rows)], types.types)], schema=types)
        if last is not None:
            ends = [[part], [1], [first], [last[1]], [last[0]], *[[None]] * len(fields)]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(ends, types.types)], schema=types)

    found = durable(ranged.mapInArrow(run, schema))
    ends = found.where("end = 1")
    # one row for each task: the numbers alone meet
    numbers = ends.select("part")
    w = Window.orderBy("part")
    follows = numbers.select("part", F.coalesce(F.lead("part").over(w), F.min("part").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    heads = ends.select(F.col("part").alias("next"), F.col("head").alias("after"))
    open_ = ends.select("part", "id", "tail").join(follows, "part").join(heads, "next").select("id", "tail", "after")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pa.schema([types.field(f.name) for f in done])
        for b in batches:
            for key, text, after in zip(*[b.column(i).to_pylist() for i in range(3)]):
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((key, *pair(text, after)), of.types)], schema=of)

    return found.where("end = 0").select(*done.names).unionByName(open_.mapInArrow(close, T.StructType([schema[n] for n in done.names])))


def edited(text: str, after: str) -> str:
    """The text with its last quarter replaced by the first characters of the next one."""
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


def _judged(text: str, after: str) -> list:
    from hashlib import sha256

    changed = edited(text, after)
    form, form2, form3 = canonical(text), canonical(changed), canonical(after)
    digest, digest2, digest3 = map(wide_hash, (form, form2, form3))
    # equal digests are compared by bytes
    alike = lambda d, f: float(digest == d and form == f)
    return [len(text), sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), digest, digest2, alike(digest2, form2), alike(digest3, form3)]


def digest_report(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprints of the text and its edited form, their likeness, and the group of equal texts."""
    kinds = {"n_chars": T.LongType(), "edited_sha256": T.StringType(), "fingerprint": T.StringType(), "edited_fingerprint": T.StringType(), "near_edited": T.DoubleType(), "near_next": T.DoubleType()}
    rows = durable(map_successors(docs, "doc_id", "text", [T.StructField(n, t) for n, t in kinds.items()], _judged))
    return exact_groups(docs, known=rows).withColumnRenamed("id", "doc_id").select("doc_id", *kinds, "group_id", "copies")
