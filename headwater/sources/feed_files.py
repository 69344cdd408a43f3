"""Captured feed files as a data source: one partition for each keyword and byte range.

``spark.read.format("feed_files")`` with the options ``feeds`` (a JSON list of [keyword, file or folder]), ``kind``
(``rss`` or ``json``) and ``range_bytes`` lists files and their sizes while planning; only tasks read them. A range owns
the records that begin in it and reads on to the end of its last one, so a file of any size is read by many tasks, each
of which holds one buffer. With the option ``keywords`` (a JSON list) files of other keywords are not even listed. It is
an option and no pushed filter: Spark 4.1 shares one reader between all scans of a frame, so a filter that the reader
takes from one of them would take rows from the others (tested: two filters on one frame then give the second's rows twice).

RSS: a record is an ``item`` element. A range may begin within a CDATA section; then its first section mark is a closing
one, and what stands before it is skipped. A section longer than ``CDATA_BYTES``, and comments around items, are not told apart.

JSON: an array, or an object with ``items`` (and ``generated_at`` before them). Line feeds never stand within JSON
strings, so the items of an indented file begin at a line feed and the indentation of the first one. A range begins at
the first such place in it and decodes value by value. A file without line feeds between its items is one range, decoded
value by value as well; one that is indented without order is found out where two ranges disagree, and is an error that
tells to set ``split`` to false. Values that are no objects are dropped.

Paths are local or shared ones, or addresses that pyarrow's file systems open. A file that is no feed, and a record that
is broken, give one row with ``error`` and nothing else. Rows are in order by (kw_pos, file, at).
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from xml.parsers import expat

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, of a file's beginning that tells its form, of a buffer, and of the longest CDATA section.
RANGE_BYTES, HEAD_BYTES, BUFFER_BYTES, CDATA_BYTES = 32 << 20, 1 << 16, 1 << 20, 1 << 20
_PLACE = "keyword string, kw_pos int, file string, at bigint"
SCHEMAS = {"rss": f"{_PLACE}, title string, link string, pub_date string, source string, error string", "json": f"{_PLACE}, generated_at string, item string, error string"}
_OPEN, _ENDS, _CDATA, _SHUT = (re.compile(p) for p in (rb"<item(?=[\s>/])|<!\[CDATA\[", rb"</item\s*>|<item\s*/>|<!\[CDATA\[", rb"<!\[CDATA\[|\]\]>", rb"\]\]>"))
_TOP = re.compile(r'\s*\{(?:(?!"items"\s*:).)*?"items"\s*:\s*\[', re.S)
_TIME = re.compile(r'"generated_at"\s*:\s*("(?:[^"\\]|\\.)*")')


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class Range(InputPartition):
    """The records of a file that begin in [lo, hi); ``mark`` is what stands before each item of an indented file."""

    keyword: str
    kw_pos: int
    path: str
    lo: int
    hi: int
    size: int
    generated_at: str | None = None
    mark: bytes | None = None
    first: bool = True
    error: str | None = None


class Bytes:
    """A file read forward from a place, a buffer at a time."""

    def __init__(self, path: str, at: int):
        fs, name = _opened(path)
        self.file = fs.open_input_file(name)
        self.file.seek(at)
        self.at, self.held = at, b""  # place of the first byte that is held

    def more(self) -> bool:
        got = self.file.read(max(BUFFER_BYTES, len(self.held)))
        self.held += got
        return bool(got)

    def skip(self, n: int) -> None:
        self.at, self.held = self.at + n, self.held[n:]

    def find(self, pattern: re.Pattern, start: int = 0, upto: int | None = None, ahead: int = 64) -> re.Match | None:
        """The first match from ``start`` on that begins before the place ``upto``."""
        while True:
            if (m := pattern.search(self.held, start)) and m.end() < len(self.held):
                return m if upto is None or self.at + m.start() < upto else None
            start = max(start, len(self.held) - ahead)
            if upto is not None and self.at + start >= upto:
                return None
            if not self.more():
                m = pattern.search(self.held, start)
                return m if m and (upto is None or self.at + m.start() < upto) else None


def _item(record: bytes, encoding: str | None) -> list[str | None]:
    """Texts of title, link, pubDate and source of an item, without regard to name spaces."""
    found: dict[str, list[str]] = {}
    open_: list[str] = []

    def start(name: str, _) -> None:
        open_.append(name)
        if len(open_) == 2:
            found.setdefault(name, [])

    def text(data: str) -> None:
        if len(open_) == 2:
            found[open_[1]].append(data)

    parser = expat.ParserCreate(encoding)
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, lambda _: open_.pop(), text
    parser.Parse(record, True)
    return ["".join(found[n]).strip() if n in found else None for n in ("title", "link", "pubDate", "source")]


def rss_rows(r: Range) -> Iterator[tuple]:
    place = (r.keyword, r.kw_pos, r.path)
    head = Bytes(r.path, 0)
    head.more()
    named = re.match(rb"\s*(?:\xef\xbb\xbf)?<\?xml[^>]*encoding=[\"']([A-Za-z0-9._-]+)", head.held[:200])
    encoding = named[1].decode() if named else "utf-8"
    data = Bytes(r.path, r.lo) if r.lo else head
    if r.lo and (m := data.find(_CDATA, upto=r.lo + CDATA_BYTES)) and m[0] == b"]]>":
        data.skip(m.end())
    while m := data.find(_OPEN, upto=r.hi):
        if m[0] == b"<![CDATA[":  # of an item of the range before, or between items
            shut = data.find(_SHUT, m.end())
            if not shut:
                return
            data.skip(shut.end())
            continue
        data.skip(m.start())
        at, end = data.at, 0
        while True:  # the first closing tag outside of CDATA
            stop = data.find(_ENDS, end)
            if not stop or stop[0] != b"<![CDATA[":
                break
            inner = data.find(_SHUT, stop.end())
            if not (stop := inner):
                break
            end = inner.end()
        if not stop:
            yield (*place, at, None, None, None, None, "the item does not end")
            return
        try:
            yield (*place, at, *_item(data.held[: stop.end()], encoding), None)
        except expat.ExpatError as e:
            yield (*place, at, None, None, None, None, f"the item is broken: {expat.ErrorString(e.code)}")
        data.skip(stop.end())


def json_rows(r: Range) -> Iterator[tuple]:
    place, none = (r.keyword, r.kw_pos, r.path), (r.generated_at, None)
    if r.error:
        yield (*place, 0, *none, r.error)
        return
    data = Bytes(r.path, r.lo if r.first else max(0, r.lo - len(r.mark)))
    marks = re.compile(re.escape(r.mark)) if r.mark else None
    if not r.first:
        m = data.find(marks, ahead=len(r.mark))
        while m and data.at + m.end() <= r.lo:
            m = data.find(marks, m.start() + 1, ahead=len(r.mark))
        if not m or data.at + m.end() > r.hi:
            return
        data.skip(m.end() - 1)
    decoder, chars = json.JSONDecoder(), codecs.getincrementaldecoder("utf-8")()
    text, at, ended = "", data.at, False
    before = ""

    def fill() -> bool:
        nonlocal text, ended
        if not data.held and not data.more():
            ended = True
            return False
        text += chars.decode(data.held)
        data.skip(len(data.held))
        return True

    over = None  # where the first mark at or beyond the end of the range stands
    fill()
    while True:
        rest = text.lstrip(" \t\r\n,")
        if not rest and fill():
            continue
        skipped = text[: len(text) - len(rest)]
        before, at, text = (before + skipped)[-256:], at + len(skipped.encode()), rest
        if not text or text[0] == "]":
            return
        if r.mark and at + 1 > r.hi and text[0] == "{" and (before + "{").encode().endswith(r.mark):
            return
        try:
            value, n = decoder.raw_decode(text)
            if n == len(text) and not ended and fill():
                continue  # a number may go on
        except json.JSONDecodeError as e:
            if fill():
                continue
            yield (*place, at, *none, f"the value is broken: {e.msg}")
            return
        taken = text[:n]
        if r.mark and at + len(taken.encode()) >= r.hi and over is None:
            # a mark within a value, at or beyond the end of this range, is where the next range would begin
            inner = taken.encode()
            over = next((at + m.end() for m in marks.finditer(inner) if at + m.end() > r.hi), None)
            if over is not None and over <= r.size:
                raise ValueError(f"{r.path}: items and their parts are indented alike; set split to false")
        if isinstance(value, dict):
            yield (*place, at, r.generated_at, taken, None)
        before, at, text = (before + taken)[-256:], at + len(taken.encode()), text[n:]


def _json_head(path: str, size: int) -> tuple[int, bytes | None, str | None, str | None]:
    """(where the items begin, the mark of an indented file, its time, an error)."""
    data = Bytes(path, 0)
    data.more()
    head = data.held[:HEAD_BYTES].decode("utf-8", "ignore")
    body = head.removeprefix("﻿")
    gone = len(head) - len(body)
    if body.lstrip()[:1] == "[":
        start, time = gone + len(body) - len(body.lstrip()) + 1, None
    elif m := _TOP.match(body):
        told = _TIME.search(body[: m.end()])
        start, time = gone + m.end(), json.loads(told[1]) if told else None
    else:
        return 0, None, None, "an array or an object with a list of items is needed"
    lines = re.match(r"[ \t\r]*(\n[ \t]*)\S", head[start:])
    return len(head[:start].encode()), (lines[1] + "{").encode() if lines else None, time, None


class FeedReader(DataSourceReader):
    def __init__(self, options: dict):
        wanted = json.loads(options.get("keywords", "null"))
        self.feeds = [(k, name, path) for k, (name, path) in enumerate(json.loads(options["feeds"])) if wanted is None or name in wanted]
        self.kind, self.range_bytes = options.get("kind", "rss"), int(options.get("range_bytes", RANGE_BYTES))
        self.split = str(options.get("split", "true")).lower() == "true"

    def partitions(self) -> list[Range]:
        out = []
        for kw_pos, keyword, path in self.feeds:
            fs, name = _opened(path)
            info = fs.get_file_info(name)
            found = [info] if info.type == pafs.FileType.File else [i for i in fs.get_file_info(pafs.FileSelector(name, recursive=True)) if i.type == pafs.FileType.File]
            for i in sorted(found, key=lambda i: i.path):
                # the address of a file within a folder: its path below the folder
                file = path if i.path == info.path else path.rstrip("/") + i.path[len(name.rstrip("/")) :]
                base, mark, time, error = _json_head(file, i.size) if self.kind == "json" else (0, None, None, None)
                if not self.split or (self.kind == "json" and not mark):
                    out.append(Range(keyword, kw_pos, file, base, i.size, i.size, time, None, True, error))
                    continue
                for lo in range(base, max(i.size, base + 1), self.range_bytes):
                    out.append(Range(keyword, kw_pos, file, lo, min(lo + self.range_bytes, i.size), i.size, time, mark, lo == base, error))
        return out

    def read(self, partition: Range | None) -> Iterator[tuple]:
        if partition is not None:  # there is one without a value if there are no files
            yield from (rss_rows if self.kind == "rss" else json_rows)(partition)


class FeedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feed_files"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "rss")]

    def reader(self, schema) -> FeedReader:
        return FeedReader(dict(self.options))


def read_feed_files(
    spark: SparkSession, feeds: dict[str, str], kind: str = "rss", item: T.StructType | None = None, keywords: list[str] | None = None, range_bytes: int = RANGE_BYTES, split: bool = True
) -> DataFrame:
    """Rows of captured feeds of the ``keywords`` (none: all); with ``item``, JSON items as columns of their own."""
    spark.dataSource.register(FeedFiles)
    options = {"feeds": json.dumps(list(feeds.items())), "keywords": json.dumps(keywords), "kind": kind, "range_bytes": range_bytes, "split": str(split).lower()}
    rows = spark.read.format("feed_files").options(**options).load()
    if item is None:
        return rows
    return rows.withColumn("item", F.from_json("item", item)).select("keyword", "kw_pos", "file", "at", "generated_at", "error", "item.*")
