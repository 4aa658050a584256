import base64
import hashlib
import re
import uuid

import pytest

from strata.llm import warc
from strata.llm.warc import MAGIC, read_warc, write_warc

SCHEMA = "page_id long, url string, html string, payload string, digest string"


def expected(rows):
    first = {}
    for page, _, html, *_ in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, url, html, *_ in rows:
        raw = (html or "").encode()
        to = first.get(html or "")
        revisit = to is not None and page != to and page is not None
        out.append((page, url, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def read(spark, rows, tmp_path, block):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    write_warc(spark.createDataFrame(rows, SCHEMA).repartition(2), path)
    return sorted([(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read_warc(spark, path, block).collect()], key=str)


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_magic_inside_payloads(spark, tmp_path, block):
    record = MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    bodies = ["plain", None, "", MAGIC, MAGIC * 3, record, "x" + record + record + "y", "a\r\n\r\n" + record, record[:-4], MAGIC + "Content-Length: 9999999\r\n\r\n",
              "été  \x00 \r\n\r\n", "WARC/1.0\r", "WARC/1.0\r\nWARC", "plain", record]
    rows = [(k, f"http://x/{k}", b, "p", None) for k, b in enumerate(bodies)]
    assert read(spark, rows, tmp_path, block) == expected(rows)


def test_edge_rows(spark, tmp_path):
    rows = [(3, None, "same", "a", "b"), (3, "http://u", "same", "a", "b"), (4, "http://v", "same", None, None), (None, "http://w", "other", None, None), (9, "http://long", "word " * 500_000, None, None)]
    assert read(spark, rows, tmp_path, 1 << 20) == expected(rows)
    assert read(spark, rows[:0], tmp_path, 1 << 20) == []


def test_chain_ends_where_a_length_is_wrong(spark, tmp_path):
    path = f"{tmp_path}/broken"
    good = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    spark.createDataFrame([(good.format(1) + good.format(2) + MAGIC + "Content-Length: 70000\r\n\r\nshort" + good.format(3),)], "value string").coalesce(1).write.text(path)
    assert [r.page_id for r in read_warc(spark, path).collect()] == [1, 2]


def test_tables(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    path = f"{tmp_path}/pages"
    write_warc(pages, path, compression="none")
    assert sorted([tuple(r)[2:] for r in warc.read_warc(spark, path, 5000).select("file", "off", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]) == sorted(expected([tuple(r) for r in pages.collect()]))


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_payloads_come_back(spark, tmp_path, block):
    record = MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    bodies = ["plain", None, "", MAGIC * 3, "x" + record + record + "y", record[:-4], "été \x00 \r\n\r\n", "word " * 100_000, "plain", record]
    rows = [(k, f"http://x/{k}", b, "p", None) for k, b in enumerate(bodies)]
    path = f"{tmp_path}/payloads"
    write_warc(spark.createDataFrame(rows, SCHEMA).repartition(2), path)
    got = {r.page_id: r for r in read_warc(spark, path, block).collect()}
    for k, body in enumerate(bodies):
        raw = (body or "").encode()
        if got[k].record_type == "revisit":
            assert got[k].payload is None and got[got[k].refers_to].payload == raw
        else:
            assert got[k].payload == raw
    assert sum(r.record_type == "revisit" for r in got.values()) == 2


def test_records_have_the_headers_of_the_format(spark, tmp_path):
    write_warc(spark.createDataFrame([(1, "http://x/1", "a", "p", None), (2, "http://x/2", "a", "p", None)], SCHEMA), f"{tmp_path}/dated", compression="none")
    heads = [r.value.split("\r\n\r\n")[0] for r in spark.read.option("lineSep", MAGIC).text(f"{tmp_path}/dated").collect() if r.value]
    assert len(heads) == 2
    for head in heads:
        names = [line.split(": ", 1)[0] for line in head.split("\r\n")]
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(names)
        assert re.search(r"(?m)^WARC-Date: \d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ\r?$", head)


def test_record_ids_are_unique_and_revisits_have_a_profile(spark, tmp_path):
    rows = [(1, "u", "a", None, None)] * 3 + [(2, "u", "a", None, None), (None, "u", "b", None, None), (None, None, "c", None, None)]
    path = f"{tmp_path}/ids"
    write_warc(spark.createDataFrame(rows, SCHEMA).repartition(2), path, compression="none")
    heads = [dict(line.split(": ", 1) for line in r.value.split("\r\n\r\n")[0].split("\r\n")) for r in spark.read.option("lineSep", MAGIC).text(path).collect() if r.value]
    assert len({h["WARC-Record-ID"] for h in heads}) == len(rows)
    for h in heads:
        revisit = h["WARC-Type"] == "revisit"
        assert h.get("WARC-Profile") == (warc.PROFILE if revisit else None)
        assert ("Content-Type" in h) != revisit and "WARC-Refers-To" not in h
    assert sorted((str(r.page_id), r.record_type) for r in read_warc(spark, path).collect()) == [("1", "response")] * 3 + [("2", "revisit")] + [("None", "response")] * 2


def test_query_gives_revisits_their_digest_and_reads_every_record(spark, tmp_path):
    """Equal payloads, also of pages without an id, and URLs that end in the magic's letters."""
    from strata.llm.queries import op7_warc
    rows = [(1, "u", "same"), (2, "u", "same"), (None, "u", "same"), (4, "u", None), (5, "u", ""), (6, "http://x/WARC/1.0", "a"), (7, "WARC/1.0 ", "b"), (8, "x\r\nWARC/1.0\r\n", "c"), (None, "u", "d")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, op7_warc(spark, str(tmp_path)).collect()), key=str)

    def row(page, html, to=None):
        raw = html.encode()
        return page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if to else "response", to

    assert got == sorted([row(1, "same"), row(2, "same", 1), row(None, "same", 1), row(4, ""), row(5, "", 4), row(6, "a"), row(7, "b"), row(8, "c"), row(None, "d")], key=str)
    path = f"{tmp_path}/urls"
    write_warc(spark.read.parquet(f"{tmp_path}/pages.parquet").where("page_id in (6, 7)"), path)
    assert sorted(r.url for r in read_warc(spark, path).collect()) == ["WARC/1.0 ", "http://x/WARC/1.0"]
