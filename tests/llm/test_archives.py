"""WARC archives: every record by its index, and joined ranges."""

import base64
import hashlib

from rowloom.llm import warc
from rowloom.sources.session import new_path

DDL = "page_id long, url string, html string, file string"
ROWS = [
    (5, "http://a/1", "<p>one</p>", "x"), (3, "http://a/2", "<p>one</p>", "y"), (9, None, "<p>one</p>", None), (1, "u\r\nv", None, "z"),
    (2, "u", "", "z"), (7, "ü", "é" * 5000, "z"), (None, "n", "<p>one</p>", "z"), (3, "http://a/2", "<p>one</p>", "y"), (8, "w", "alone", "z"),
]


def expected(smallest):
    firsts = {}
    for page_id, _, html, _ in ROWS:
        if page_id is not None:
            firsts[html or ""] = min(firsts.get(html or "", page_id), page_id)
    for page_id, _, html, _ in ROWS:
        data = (html or "").encode()
        first = firsts[html or ""] if len(data) >= smallest else page_id
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        yield page_id, len(data), digest, "response" if first == page_id else "revisit", None if first == page_id else first


def test_round_trip(spark):
    for smallest in (0, 6):
        got = warc.round_trip(spark.createDataFrame(ROWS, DDL).repartition(3), smallest).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(expected(smallest), key=repr)


def test_selected_records(spark):
    index = warc.write(spark.createDataFrame(ROWS, DDL).coalesce(1), new_path(spark, "warc"))
    assert index.select("file").distinct().count() == 1
    chosen = index.filter("page_id IN (7, 8)")
    got = {r.page_id: (r.url, bytes(r.payload)) for r in warc.read(chosen).collect()}
    assert got == {7: ("ü", ("é" * 5000).encode()), 8: ("w", b"alone")}


def test_ranges_are_joined_and_bounded():
    near, far = warc.GAP_BYTES, warc.FETCH_BYTES
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 15 + near, 5), ("a", 21 + 2 * near, 7), ("b", 0, far + 9), ("b", far + 9, 1)]
    got = [(f, s, e, len(m)) for f, s, e, m in warc.ranges(rows)]
    assert got == [("a", 0, 20 + near, 3), ("a", 21 + 2 * near, 28 + 2 * near, 1), ("b", 0, far + 9, 1), ("b", far + 9, far + 10, 1)]


def test_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], DDL)).collect() == []
