"""The report queries against their SQL, and operators that have no table to run over."""

import duckdb
import pytest
from pyspark.sql import types as T

from headwater.operators import reports
from headwater.plans import catalogue
from headwater.plans import reports as plans  # noqa: F401
from headwater.sources import readers

SF = "/root/testdata/sf0.001"
NAMES = [n for n, f in catalogue.queries().items() if f.__module__ == "headwater.plans.reports"]


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(columns), sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_report_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "part", "events", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(catalogue.oracle_sql()[name])
    expected = _rows([d[0] for d in want.description], want.fetchall())
    got = catalogue.queries()[name](spark, SF)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == expected
    assert expected[1]


def test_laws_name_what_is_broken(spark):
    from headwater.operators import quality

    row = reports.source_counters(spark.createDataFrame([("tender_corpus", "evaluated", True, False), ("other", None, None, None)], "data_origin string, outcome string, has_signal boolean, editorial_suppressed boolean"))
    broken = {r.law for r in quality.violations(row, reports.source_laws()).collect() if r.n}
    assert broken == {"production_is_tender_and_event"}


def test_orders_as_people_sort(spark):
    df = spark.createDataFrame([("b",), ("Ä",), ("a",), ("B",)], "t string")
    assert [r.t for r in df.orderBy(*reports.candidate_order("t")).collect()] == ["a", "Ä", "B", "b"]


def test_optional_inputs_and_counts(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType())])
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text('{"items": [{"id": "a"}, {"id": "b"}]}')
    bad.write_text("[1, 2]")
    assert readers.item_count(spark, str(good), schema) == (2, "")
    assert readers.item_count(spark, str(bad), schema)[0] == 0 and readers.item_count(spark, str(bad), schema)[1]
    assert readers.item_count(spark, str(tmp_path / "none.json"), schema)[0] == 0
    rows, warnings = readers.read_optional(spark, lambda: spark.read.schema(schema).json(str(tmp_path / "none.json")), schema, "snapshot")
    assert rows.count() == 0 and len(warnings) == 1
    rows, warnings = readers.read_optional(spark, lambda: spark.createDataFrame([("a",)], schema), schema, "snapshot")
    assert rows.count() == 1 and not warnings


def test_registry_errors():
    whole = {"acceptance_statuses": list(readers.ACCEPTANCE), "sources": [{"code": "A", "acceptance_status": "PILOT_ONLY"}]}
    assert readers.registry_errors(whole) == []
    assert readers.registry_errors([]) and readers.registry_errors({"sources": {}})
    wrong = {"acceptance_statuses": ["REJECTED"], "sources": [{"code": "A", "acceptance_status": "X"}, {"code": "A", "acceptance_status": "REJECTED"}, {"code": " "}, 3]}
    assert len(readers.registry_errors(wrong)) == 6


def test_folding_of_every_character(spark):
    import unicodedata

    from pyspark.sql import functions as F

    from headwater.functions import text

    chars = [chr(c) for c in range(0x80, 0x20000) if not 0xD800 <= c <= 0xDFFF]
    rows = spark.createDataFrame([(c, "x" + c) for c in chars] + [("two", "\ufb03 \uac01\u2460\u2026 \uff21\u33ab")], "c string, t string")
    got = {r.c: r.f for r in rows.select("c", text._decomposed(F.col("t")).alias("f")).collect()}
    want = lambda t: "".join(x for x in unicodedata.normalize("NFKD", t) if not 0x300 <= ord(x) <= 0x36F)
    assert [c for c in chars if got[c] != want("x" + c)] == []
    assert got["two"] == want("\ufb03 \uac01\u2460\u2026 \uff21\u33ab")
    folded = spark.createDataFrame([("\uff34\uff25\uff2e\uff24\uff25\uff32 \ufb01n\u2122",)], "t string").select(text.fold_search(F.col("t")).alias("f")).first().f
    assert folded == "tender fintm"
