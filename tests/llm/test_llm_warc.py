import base64
import glob
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rainpanel.llm import warc
from rainpanel.llm.common import new_folder

PAGES = [
    (1, "http://a.org/", "<p>same</p>"), (2, "http://b.org/", "<p>same</p>"), (3, None, None), (4, "x\r\ny", ""),
    (5, "http://c.org/", "é😀" * 3000), (6, "http://d.org/", "<html>" + "long " * 200_000), (None, "http://e.org/", "<p>same</p>"),
    (7, "http://f.org/", "rep"), (7, "http://f.org/", "rep"), (7, "http://g.org/", "rep"), (8, "u", "x\r\n\r\nWARC/1.1\r\n"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def frame(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_bytes", F.lit("own")).repartition(3)


def test_pages_come_back(spark):
    got = warc.warc_query(frame(spark)).collect()
    leader = {}
    for page, _, html in PAGES:
        leader[digest(html)] = max(leader.get(digest(html), -1), -1 if page is None else page)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter(
        (p, len((h or "").encode()), digest(h)) for p, _, h in PAGES)
    responses = [r for r in got if r.record_type == "response"]
    assert {r.payload_digest: r.page_id for r in responses} == leader and len(responses) == len(leader)
    assert all(r.refers_to is None for r in responses)
    assert all(r.refers_to == leader[r.payload_digest] for r in got if r.record_type == "revisit")
    assert warc.warc_query(frame(spark, [])).count() == 0


def test_small_payloads_may_all_be_responses(spark):
    folder = new_folder(spark, "warc-test")
    warc.write_archives(frame(spark).select("page_id", "url", "html"), folder, least_bytes=1_000_000_000).count()
    assert {r.record_type for r in warc.read_archives(spark, folder).collect()} == {"response"}


def test_an_archive_starts_with_its_dictionary(spark, tmp_path):
    records = [warc.make_record(i, f"http://a.org/{i}", (f"<p>word {i} " * 40).encode(), digest("x"), None, False) for i in range(300)]
    path = tmp_path / "a.warc.zst"
    with open(path, "wb") as target:
        warc.write_archive(target, records)
    content = path.read_bytes()
    assert content[:4] == (0x184D2A5D).to_bytes(4, "little") and len(content) < sum(map(len, records)) / 4
    assert [f["WARC-Record-ID"] for f, _ in warc.read_archive(content)] == [f"<urn:page:{i}>" for i in range(300)]
    with pytest.raises(ValueError):
        list(warc.read_archive(content[8 + int.from_bytes(content[4:8], "little"):]))
    assert not glob.glob(str(tmp_path / "_*"))


def test_damage_is_noticed():
    fields = {"WARC-Payload-Digest": "sha1:" + digest("x"), "WARC-Record-ID": "<urn:page:1>", "WARC-Type": "response"}
    with pytest.raises(ValueError):
        warc.describe(fields, b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\ny")
