"""Accepted versions, bucketed snapshots, folded decisions and members of JSON."""

import json
import random

import pytest
from pyspark.sql import functions as F

from headwater.functions import guards
from headwater.operators import diff, feedback, increments
from headwater.sources import sinks, snapshots, versions


def test_versions_are_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    assert versions.last_marker(spark, base) is None and versions.read_version(spark, base) is None
    first = versions.publish(spark.range(10), base, "v1", {"total": F.sum("id")}, {"positive": F.col("id") >= 0}, {"all": F.col("rows") == 10, "sum": F.col("total") == 45})
    assert (first["number"], first["rows"], first["counters"], first["health"]) == (0, 10, {"rows": 10, "total": 45}, {"fetch_status": versions.FETCHED})
    # a writer that dies after its rows and before its marker
    with monkeypatch.context() as m:
        m.setattr(versions, "_create_once", lambda *_: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            versions.publish(spark.range(3), base, "v2")
    assert versions.last_marker(spark, base)["version"] == "v1" and versions.read_version(spark, base).count() == 10
    assert len(versions.leftovers(spark, base)) == 1
    # the same version again: written anew, accepted once
    assert versions.publish(spark.range(3), base, "v2")["number"] == 1
    assert versions.publish(spark.range(99), base, "v2")["rows"] == 3
    assert versions.read_version(spark, base).count() == 3


def test_broken_laws_refuse_a_version(spark, tmp_path):
    base = str(tmp_path / "t")
    versions.publish(spark.range(4), base, "v1")
    rows = spark.range(20).withColumn("x", F.when(F.col("id") != 3, F.col("id")))
    with pytest.raises(versions.LawBroken) as e:
        versions.publish(rows, base, "v2", {"n": F.count("x")}, {"small": F.col("x") < 15, "fine": F.col("id") >= 0}, {"all": F.col("rows") == F.col("n"), "some": F.col("rows") > 0})
    assert e.value.broken == {"small": 6, "all": 1}
    assert versions.last_marker(spark, base)["version"] == "v1"


def test_a_failed_fetch_writes_health_alone(spark, tmp_path):
    base = str(tmp_path / "t")
    none = versions.publish_health(spark, base, {"error_code": "HTTP_502"})
    assert none["path"] is None and none["health"] == {"error_code": "HTTP_502", "fetch_status": versions.FAILED, "last_known_good": {"available": False, "item_count": 0}}
    assert versions.read_version(spark, base) is None
    versions.publish(spark.range(7), base, "v1", health={"healthy_sources": 2})
    kept = versions.publish_health(spark, base)
    assert kept["health"] == {"fetch_status": versions.KEPT, "last_known_good": {"available": True, "item_count": 7}} and kept["version"] == "v1"
    assert versions.read_version(spark, base).count() == 7
    assert sinks.publish(spark.range(1), base, "v2", accept=False) == "v1" and sinks.publish(spark.range(2), base, "v3") == "v3" == sinks.current(spark, base)
    assert [json.loads((tmp_path / "t" / "log" / f"{n:020d}.json").read_text())["version"] for n in range(5)] == [None, "v1", "v1", "v1", "v3"]


def test_writers_at_once_get_numbers_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    base = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: versions.publish(spark.range(i + 1), base, f"v{i}"), range(6)))
    assert sorted(m["number"] for m in got) == list(range(6))
    last = versions.last_marker(spark, base)
    assert last["number"] == 5 and versions.read_version(spark, base).count() == last["rows"] and versions.leftovers(spark, base) == []


def test_bucketed_snapshots_meet_without_an_exchange(spark, tmp_path):
    old = spark.range(200).select(F.when(F.col("id") % 50 != 7, F.col("id")).alias("k"), F.lit("a").alias("v"), (F.col("id") % 3).alias("w"))
    new = spark.range(100, 300).select(F.col("id").alias("k"), F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("v"), (F.col("id") % 3).alias("w"))
    a, b = (snapshots.write_snapshot(df, f"snap_{tmp_path.name}_{i}".replace("-", "_"), str(tmp_path / str(i)), "k", 8) for i, df in enumerate((old, new)))
    found = diff.snapshot_diff(a, b, "k", ["v", "w"])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = diff.snapshot_diff(old, new, "k", ["v", "w"])
    key = lambda df: sorted((str(r.k), r.change, tuple(r.changed_fields)) for r in df.collect())
    assert key(found) == key(want)


EVENTS = "item string, ts timestamp, event_id string, decision string"


def decisions(spark, rng, n, first=0):
    import datetime as dt

    day = dt.datetime(2026, 7, 1)
    rows = [(rng.choice(["hot", "hot", None, *[f"i{k}" for k in range(30)]]), day + dt.timedelta(minutes=rng.randrange(500)), f"e{first + k}", rng.choice("abc")) for k in range(n)]
    return spark.createDataFrame(rows, EVENTS)


def states(df):
    return sorted(((r.item, r.decision, r.created_at, r.updated_at, r.n_events) for r in df.collect()), key=str)


def test_folded_state_equals_full_recomputation(spark, tmp_path):
    rng, base, parts = random.Random(5), str(tmp_path / "d"), []
    cols = ("item", "ts", "event_id", "decision")
    assert increments.read_state(spark, base) is None
    for k, n in enumerate((60, 1, 40)):
        parts.append(decisions(spark, rng, n, 1000 * k).cache())
        done = increments.fold_events(parts[-1], base, *cols, buckets=8)
        assert done.fresh == n and (n > 1 or len(done.buckets) == 1)
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        assert states(increments.read_state(spark, base)) == states(feedback.current_state(whole, *cols))
    before = states(increments.read_state(spark, base))
    # folded again, as a whole and in part: nothing is fresh, nothing changes
    assert increments.fold_events(whole, base, *cols, buckets=8).fresh == 0
    assert increments.fold_events(parts[1].unionByName(parts[1]), base, *cols, buckets=8).fresh == 0
    assert states(increments.read_state(spark, base)) == before
    assert increments.fold_events(parts[0].limit(0), base, *cols, buckets=8) == increments.Folded(0, ())


def test_untouched_buckets_stay_as_they_are(spark, tmp_path):
    rng, base = random.Random(6), str(tmp_path / "d")
    cols = ("item", "ts", "event_id", "decision")
    increments.fold_events(decisions(spark, rng, 80), base, *cols, buckets=8)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "d" / "state").rglob("*.parquet")}
    one = decisions(spark, rng, 1, 5000)
    done = increments.fold_events(one, base, *cols, buckets=8)
    left = {p for p in files if f"bucket={done.buckets[0]}" not in str(p)}
    assert len(done.buckets) == 1 and left and all(p.exists() and p.stat().st_mtime_ns == files[p] for p in left)


def test_a_fold_that_died_between_its_writes_is_run_again(spark, tmp_path):
    rng, base = random.Random(7), str(tmp_path / "d")
    cols = ("item", "ts", "event_id", "decision")
    first, second = decisions(spark, rng, 50).cache(), decisions(spark, rng, 50, 1000).cache()
    increments.fold_events(first, base, *cols, buckets=4)

    def die():
        raise OSError("died")

    with pytest.raises(OSError):
        increments.fold_events(second, base, *cols, buckets=4, before_log=die)
    assert increments.fold_events(second, base, *cols, buckets=4).fresh == 50
    assert states(increments.read_state(spark, base)) == states(feedback.current_state(first.unionByName(second), *cols))


def random_json(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 5)
    if kind < 5:
        return [rng.choice(['a"b', 'x": 1', "\\", "send email", "é{}[],:", "", "Set-Price"]), rng.randint(-9, 9), rng.random(), None, True][kind]
    if kind == 5:
        return [random_json(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["score", "Risk_SCORE", "k", 'q"uo', "back\\", "next_action", "set_price_now", "contact", "ü", ""]): random_json(rng, depth + 1) for _ in range(rng.randrange(4))}


def members_of(v):
    if isinstance(v, list):
        for x in v:
            yield from members_of(x)
    elif isinstance(v, dict):
        for k, x in v.items():
            yield k, x if isinstance(x, str) else None, isinstance(x, (int, float)) and not isinstance(x, bool)
            yield from members_of(x)


def test_members_of_json_at_any_depth(spark):
    import re

    rng = random.Random(8)
    made = [random_json(rng) for _ in range(400)]
    rows = [(i, json.dumps(v, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]))) for i, v in enumerate(made)] + [(400, None), (401, "")]
    df = spark.createDataFrame(rows, "i int, j string").withColumn("m", guards.json_members(F.col("j")))
    got = df.select("i", "m", guards.forbidden_members(F.col("m")).alias("f")).collect()
    for r in got:
        want = list(members_of(made[r.i])) if r.i < 400 else []
        assert [tuple(m) for m in r.m] == want
        bad = {
            k for k, text, number in want
            if re.search("outreach_action|contact_action|send_email|send_whatsapp|set_price", k, re.I) or (number and re.search("score", k, re.I))
            or (re.search("action|outreach|contact", k, re.I) and text is not None and re.search("outreach|contact|send[_ -]?(email|whatsapp)|set[_ -]?price", text, re.I))
        }
        assert set(r.f) == bad and len(r.f) == len(bad)
    deep = "{\"a\":" * 500 + '{"score": 1}' + "}" * 500
    assert spark.createDataFrame([(deep,)], "j string").select(guards.forbidden_members(guards.json_members(F.col("j"))).alias("f")).first().f == ["score"]
    variant = spark.range(1).select(F.parse_json(F.lit('{"x": [{"set_price": 2}], "score": "no"}')).alias("v"))
    assert variant.select(guards.forbidden_members(guards.json_members(F.to_json("v"))).alias("f")).first().f == ["set_price"]
