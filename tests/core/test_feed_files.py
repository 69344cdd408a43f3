"""Feed files read in ranges against whole-file parsing."""

import json
import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from headwater.sources import feed_files
from headwater.sources.feed_files import read_feed_files


def rss(n, seed=0, cdata=True):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        filler = "".join(rng.choice("abc é<>&\n ") for _ in range(rng.randint(0, 90)))
        hidden = f"<![CDATA[{filler}<item><title>no</title></item>]]>" if cdata and i % 3 == 0 else filler.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
        out.append(f"<item><title>t{i} é</title><link>http://x/{i}</link><media:thumb/><description>{hidden}</description><pubDate>d{i}</pubDate><source url='u'>S{i}</source></item>{rng.choice(['', chr(10)])}")
    return f"<?xml version='1.0' encoding='UTF-8'?><rss xmlns:media='m'><channel><title>feed</title>{''.join(out)}</channel></rss>"


@pytest.mark.parametrize("range_bytes", [700, 4096, 1 << 20])
@pytest.mark.parametrize("cdata", [True, False])
def test_rss_ranges_equal_a_whole_parse(spark, tmp_path, range_bytes, cdata):
    text = rss(150, range_bytes, cdata)
    (tmp_path / "a.xml").write_text(text, encoding="utf-8")
    df = read_feed_files(spark, {"kw": str(tmp_path / "a.xml")}, range_bytes=range_bytes)
    got = [(r.title, r.link, r.pub_date, r.source) for r in df.orderBy("kw_pos", "file", "at").collect()]
    assert got == [tuple((i.findtext(n) or "").strip() for n in ("title", "link", "pubDate", "source")) for i in ET.fromstring(text).iter("item")]
    if range_bytes == 700:
        assert df.rdd.getNumPartitions() > 10


def test_files_of_other_keywords_are_not_read(spark, tmp_path):
    (tmp_path / "a.xml").write_text(rss(3))
    (tmp_path / "b.xml").write_text(rss(5))
    feeds = {"one": str(tmp_path / "a.xml"), "two": str(tmp_path / "b.xml"), "gone": str(tmp_path / "not there" / "c.xml")}
    one = read_feed_files(spark, feeds, keywords=["one"])
    assert one.count() == 3 and one.rdd.getNumPartitions() == 1
    some = read_feed_files(spark, feeds, keywords=["one", "two", "unknown"])
    assert some.where(F.col("title") != "t0 é").count() == 6 and {r.kw_pos for r in some.select("kw_pos").collect()} == {0, 1}
    # filters of one frame do not meet
    assert some.where("keyword = 'one'").unionByName(some.where("keyword = 'two'")).count() == 8
    assert read_feed_files(spark, feeds, keywords=[]).collect() == []
    with pytest.raises(Exception, match="c.xml"):
        read_feed_files(spark, feeds).count()


def test_broken_feeds_are_rows_with_errors(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<rss><item><title>a</title></item><item><title>b</item><item><title>c</title></item><item>open")
    (tmp_path / "b.xml").write_text("no feed")
    (tmp_path / "c.xml").write_text("")
    rows = read_feed_files(spark, {k: str(tmp_path / f"{k}.xml") for k in "abc"}).orderBy("kw_pos", "at").collect()
    assert [(r.keyword, r.title, r.error is None) for r in rows] == [("a", "a", True), ("a", None, False), ("a", "c", True), ("a", None, False)]


def values(n, seed=1):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        made.append(rng.choice([{"a": i, "b": "é{\n}" * rng.randrange(6), "c": [{"a": 1}, {"d": []}], "e": {}}, {"a": i}, {}, i, "x,{", None, [{"a": 9}], {"a": None, "b": "q"}]))
    return made


@pytest.mark.parametrize("range_bytes", [64, 500, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2, 1])
@pytest.mark.parametrize("bare", [True, False])
def test_json_ranges_equal_a_whole_parse(spark, tmp_path, range_bytes, indent, bare):
    held = values(80, range_bytes)
    whole = held if bare else {"generated_at": "2026-07-12 \"é\"", "items": held, "more": {"items": [{"z": 1}]}}
    (tmp_path / "a.json").write_text(json.dumps(whole, indent=indent, ensure_ascii=False), encoding="utf-8")
    df = read_feed_files(spark, {"k": str(tmp_path)}, "json", range_bytes=range_bytes)
    rows = df.orderBy("at").collect()
    assert [json.loads(r.item) for r in rows] == [v for v in held if isinstance(v, dict)]
    assert {r.generated_at for r in rows} == {None if bare else '2026-07-12 "é"'} and not any(r.error for r in rows)
    if indent and range_bytes == 64:
        assert df.rdd.getNumPartitions() > 20


def test_json_items_as_columns_and_errors(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.json").write_text('{"generated_at": "g", "items": [{"title": "x"}, 3, {"title": "y", "n": 1}]}')
    (tmp_path / "b.json").write_text('{"nothing": 1}')
    (tmp_path / "c.json").write_text('[{"title": "z"}, {"title": ')
    kind = T.StructType([T.StructField("title", T.StringType())])
    rows = read_feed_files(spark, {"k": str(tmp_path)}, "json", kind).orderBy("file", "at").collect()
    assert [(r.file[-6:], r.title, r.error is None) for r in rows] == [("a.json", "x", True), ("a.json", "y", True), ("b.json", None, False), ("c.json", "z", True), ("c.json", None, False)]


def test_json_without_order_in_its_lines_is_found_out(spark, tmp_path):
    text = "[\n" + ",\n".join('{"a":\n{"b":\n{"c": "' + "x" * 40 + '"}}}' for _ in range(60)) + "\n]"
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="split"):
        read_feed_files(spark, {"k": str(tmp_path / "a.json")}, "json", range_bytes=64).collect()
    assert read_feed_files(spark, {"k": str(tmp_path / "a.json")}, "json", range_bytes=64, split=False).count() == 60


def test_items_and_marks_over_buffer_borders(spark, tmp_path, monkeypatch):
    held = values(60, 5)
    (tmp_path / "a.json").write_text(json.dumps(held, indent=2), encoding="utf-8")
    (tmp_path / "a.xml").write_text(rss(40), encoding="utf-8")
    for size in (1, 7, 64):
        monkeypatch.setattr(feed_files, "BUFFER_BYTES", size)
        reader = feed_files.FeedReader({"feeds": json.dumps([["k", str(tmp_path / "a.xml")]]), "range_bytes": "900"})
        assert sum(1 for p in reader.partitions() for _ in reader.read(p)) == 40
        monkeypatch.setattr(feed_files, "BUFFER_BYTES", 1 << 20)
        reader = feed_files.FeedReader({"feeds": json.dumps([["k", str(tmp_path / "a.json")]]), "kind": "json", "range_bytes": "100"})
        parts = reader.partitions()
        monkeypatch.setattr(feed_files, "BUFFER_BYTES", size)
        assert sum(1 for p in parts for _ in reader.read(p)) == sum(isinstance(v, dict) for v in held)


def test_items_that_are_no_objects_are_dropped(spark, tmp_path):
    from pyspark.sql import types as T

    from headwater.sources.readers import read_items

    kind = T.StructType([T.StructField("title", T.StringType())])
    (tmp_path / "a.json").write_text('{"generated_at": "g", "items": [{"title": "x"}, 3, "{", null, [1], [{"title": "n"}], {}, {"title": "y"}]}')
    assert [(r.pos, r.title) for r in read_items(spark, str(tmp_path / "a.json"), kind).orderBy("pos").collect()] == [(0, "x"), (6, None), (7, "y")]
    (tmp_path / "b.json").write_text('[1, {"title": "z"}]')
    assert [(r.generated_at, r.pos, r.title) for r in read_items(spark, str(tmp_path / "b.json"), kind).collect()] == [(None, 1, "z")]
