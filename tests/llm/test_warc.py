import base64
import gzip
import hashlib
import json
import pathlib
import re
from collections import defaultdict

import pytest

from attesta.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, first string"


@pytest.fixture
def pages(spark):
    same = "<p>copy</p>"
    rows = [(5, "u5", same), (3, "u3", same), (9, None, same), (1, "u\n1", None), (2, "u2", ""), (4, "u4", "ünï\r\n\r\nWARC/1.1\r\n"), (7, "u7", "x" * 200_000)]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, pages, tmp_path, compress, least):
    path = str(tmp_path / "w")
    warc.write_archives(pages, path, least, compress)
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    groups = defaultdict(list)
    for k, v in html.items():
        groups[v].append(k)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(html)
    for r in got:
        data = html[r.page_id]
        first = min(groups[data])
        revisit = len(data) >= least and r.page_id != first
        assert r.record_type == ("revisit" if revisit else "response") and r.refers_to == (first if revisit else None)
        assert r.payload_bytes == len(data) and r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r.payload is None) if revisit else bytes(r.payload) == data


def test_headers_alone_and_pushed_filters(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    slim = warc.read_archives(spark, path, "page_id long, record_type string")
    assert {tuple(r) for r in slim.filter("record_type = 'revisit'").collect()} == {(5, "revisit"), (9, "revisit"), (2, "revisit")}
    assert [r.page_id for r in slim.filter("page_id in (4) and record_type = 'response'").collect()] == [4]
    plan = slim.filter("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan.split("BatchScan")[0]


def test_plain_reader_agrees_and_index_is_optional(spark, pages, tmp_path):
    path = tmp_path / "w"
    warc.write_archives(pages, str(path))
    for index in path.glob("*.idx"):
        index.write_text("")  # as good as none: the reader must then find the members itself
    names = json.loads(next(path.glob("_archives-*")).read_text())
    raw = b"".join(gzip.decompress((path / n).read_bytes()) for n in names)
    assert raw.count(b"WARC-Record-ID") == pages.count()


def test_an_index_that_ends_early_loses_nothing(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"text {i % 20} " * 50) for i in range(30)], "page_id long, url string, html string").coalesce(1)
    path = tmp_path / "w"
    warc.write_archives(pages, str(path))
    for keep in (1, 7, 0):
        for index in path.glob("*.idx"):
            index.write_text("\n".join(index.read_text().split("\n")[:keep]))
        assert warc.read_archives(spark, str(path), "page_id long").count() == 30
    for index in path.glob("*.idx"):
        index.write_text("0\n999999999")
    with pytest.raises(Exception, match="does not fit the archive"):
        warc.read_archives(spark, str(path), "page_id long").count()


def test_damage_is_seen(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "some text"), (2, "v", "some text"), (3, "w", "other")], "page_id long, url string, html string").coalesce(1)
    path = tmp_path / "w"
    warc.write_archives(pages, str(path), compress=False)
    read = lambda: warc.verified(warc.read_archives(spark, str(path)).filter("record_type = 'response'")).collect()
    assert len(read()) == 2
    archives = [p for p in path.glob("*.warc")]
    raw = b"".join(p.read_bytes() for p in archives)
    ids = dict(re.findall(rb"WARC-Record-ID: (\S+)\r\n(?:[^\r]+\r\n)*?X-Page-ID: (\d)", raw))
    assert ids[re.search(rb"WARC-Refers-To: (\S+)", raw).group(1)] == b"1"
    for p in archives:
        p.write_bytes(p.read_bytes().replace(b"other", b"otter"))
    with pytest.raises(Exception, match="payload does not fit its header: page 3"):
        read()
    for p in archives:
        p.write_bytes(p.read_bytes().replace(b"Content-Length", b"Content-Lenght"))
    with pytest.raises(Exception, match="no record header at byte 0"):
        read()


def test_foreign_archives(spark, tmp_path):
    head, block = warc.record({"record_type": "response", "page_id": 1, "url": "u", "payload_digest": "D", "payload_bytes": 1, "refers_to": None, "payload": b"a"})
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(head + block) + gzip.compress(head + block))
    (tmp_path / "b.warc").write_bytes((head + block) * 3)
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert len(got) == 5 and all(bytes(r.payload) == b"a" for r in got)


def test_uncommitted_archives_are_not_read(spark, pages, tmp_path):
    path = tmp_path / "w"
    warc.write_archives(pages, str(path))
    names = json.loads(next(path.glob("_archives-*")).read_text())
    (path / "left-over.warc.gz").write_bytes((path / names[0]).read_bytes())
    assert warc.read_archives(spark, str(path), "page_id long").count() == pages.count()


def test_ties_nulls_and_no_pages(spark, tmp_path):
    rows = [(1, "a", "t"), (1, "b", "t"), (None, "c", "t"), (None, "d", "alone"), (2, "e", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    got = {(r.page_id, r.url): (r.record_type, r.refers_to) for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert got == {(1, "a"): ("response", None), (1, "b"): ("response", None), (None, "c"): ("revisit", 1), (None, "d"): ("response", None), (2, "e"): ("revisit", 1)}
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    assert pathlib.Path(tmp_path / "none").exists()
