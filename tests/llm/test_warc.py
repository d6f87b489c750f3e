import base64
import gzip
import hashlib
import io
import os
import random

import pyarrow as pa
import pytest

from check_oracle import connect, differences
from strataflow.llm import warc
from tests.conftest import SF, plan_of, rows

PAGE = "page_id LONG, url STRING, html STRING, payload STRING, record_id STRING, _last LONG"


def pages(spark, *triples):
    return spark.createDataFrame([(*t, "p", "r", 1) for t in triples], PAGE)


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain(triples, least=0):
    out = []
    for page_id, _, html in triples:
        payload = (html or "").encode()
        ids = [i for i, _, h in triples if (h or "").encode() == payload and i is not None]
        last = max(ids, default=None)
        again = len(payload) >= least and page_id != last
        out.append((page_id, len(payload), digest(payload), *(("revisit", last) if again else ("response", None))))
    return sorted(out, key=repr)


def some_pages():
    draw = random.Random(3)
    htmls = [None, "", "a", "<p>é\r\n\r\nWARC/1.1\r\n", "x" * 300_000, "\x1f\x8b" * 9]
    urls = [None, "http://a/", "http://ä.b/c d\nWARC-Type: none"]
    own = [(i, draw.choice(urls), draw.choice(htmls) if i % 3 else f"page {i} " * i) for i in range(120)]
    return [*own, *own[:5], (None, "u", "a"), (None, "u", "only without id"), (None, "u", "only without id"), (-4, "u", "a")]


@pytest.mark.parametrize("least", [0, 5])
def test_pages_come_back(spark, base, least):
    made = some_pages()
    warc.write_pages(pages(spark, *made).repartition(4), f"{base}/w", least)
    got = warc.archived_pages(spark, f"{base}/w")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows(got, *names) == plain(made, least)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_payloads_and_uris_come_back(spark, base, compression):
    warc.register(spark)
    made = [(i, f"http://h/{i}", f"<p>{i}é</p>" * i) for i in range(50)]
    out = warc.page_records(pages(spark, *made)).select(*warc.WRITTEN).repartition(3).write.format("warc")
    out.option("compression", compression).option("fileBytes", 2_000).mode("append").save(base)
    back = spark.read.format("warc").load(base)
    assert rows(back.select("target_uri", "payload")) == sorted(((u, bytearray(h.encode())) for _, u, h in made), key=repr)
    assert len(os.listdir(base)) > 8
    assert back.where("digest_ok").count() == 50
    # An archive of several tasks: each file is read by one of them, small ones together.
    assert spark.read.format("warc").option("partitionBytes", 3_000).load(base).rdd.getNumPartitions() > 3
    assert back.rdd.getNumPartitions() == 1


def test_predicates_on_headers_reach_the_files(spark, base):
    made = [(i, f"http://h{i % 3}/{i}", "same" if i % 2 else f"own {i}") for i in range(40)]
    warc.write_pages(pages(spark, *made), base)
    back = spark.read.format("warc").load(base)
    chosen = back.where("record_type = 'revisit' AND target_uri LIKE 'http://h1%' AND content_length < 100 AND headers['warc-type'] = 'revisit'")
    left = [line for line in plan_of(chosen).splitlines() if "Filter (" in line]
    assert len(left) == 1
    assert "headers" in left[0]  # what a field map holds is no column
    assert not any(c in left[0] for c in ("record_type", "target_uri", "content_length"))
    ids = {r.record_id.split(":")[2] for r in chosen.collect()}
    assert ids == {str(i) for i in range(39) if i % 2 and i % 3 == 1}
    for condition in ["NOT (record_type = 'response')", "refers_to IS NOT NULL", "refers_to <=> NULL", "record_type IN ('revisit', 'x')",
                      "NOT (refers_to = 'x')", "NOT (refers_to <=> 'x')", "content_length >= 70", "record_id LIKE '%5'", "record_id > 'urn:page:3'"]:
        pushed = rows(back.where(condition).select("record_id"))
        assert pushed == rows(back.select("*").cache().where(condition).select("record_id")), condition
        spark.catalog.clearCache()
    bare = back.sparkSession.read.format("warc").option("payload", "false").load(base)
    assert bare.where("payload IS NOT NULL").count() == 0
    assert bare.count() == 40


class Watched(io.BytesIO):
    """An open file that counts what is read."""

    seen = 0

    def size(self):
        return len(self.getbuffer())

    def read(self, n=-1):
        data = super().read(n)
        self.seen += len(data)
        return data


def record(i, payload, kind="response"):
    values = {"record_id": f"urn:page:{i}", "record_type": kind, "target_uri": "u", "refers_to": None, "payload_sha1": None}
    return warc.record_bytes({**values, "payload": payload}, "2024-01-01T00:00:00Z")


@pytest.mark.parametrize("packed", [True, False])
def test_unwanted_payloads_are_not_read(packed):
    noise = random.Random(1).randbytes(3_000_000)
    parts = [record(i, noise[: 1_000_000 * (i % 3)], "response" if i % 2 else "revisit") for i in range(12)]
    file = Watched(b"".join(map(warc.gzip_member, parts)) if packed else b"".join(parts))
    found = [v["record_id"] for v, *_ in warc.records(file, packed, lambda v: v["record_type"] == "revisit", True)]
    assert found == [f"urn:page:{i}" for i in range(0, 12, 2)]
    assert file.seen < 0.6 * file.size()


def test_members_written_by_others_and_records_in_one_member():
    parts = [record(i, b"x" * i * 50_000) for i in range(6)]
    for data in (b"".join(map(gzip.compress, parts)), gzip.compress(b"".join(parts)), gzip.compress(parts[0]) + warc.gzip_member(b"".join(parts[1:]))):
        for refused in (set(), {"urn:page:2"}, {f"urn:page:{i}" for i in range(5)}):
            found = warc.records(Watched(data), True, lambda v, r=refused: v["record_id"] not in r, True)
            want = [(f"urn:page:{i}", i * 50_000) for i in range(6) if f"urn:page:{i}" not in refused]
            assert [(v["record_id"], len(p)) for v, _, p, _ in found] == want
    assert gzip.decompress(warc.gzip_member(parts[3])) == parts[3]
    assert list(warc.records(Watched(b""), True, lambda v: True, True)) == []


def test_fields_are_read_as_others_write_them():
    block = b"WARC/1.0\r\nwarc-type: response\r\nX-A: one\r\n two\r\nX-A: three\r\nWARC-Record-ID:<u:1>\r\nno field"
    fields = warc.parsed(block)
    assert fields == {"warc-type": "response", "x-a": "one two, three", "warc-record-id": "<u:1>"}
    assert warc.values_of(fields)["record_id"] == "u:1"


def test_damage_is_named(spark, base):
    whole = warc.gzip_member(record(1, b"x" * 5_000)) + warc.gzip_member(record(2, b"y" * 5_000))
    for name, data in {"cut": whole[:-30], "text": b"no archive at all", "plain": record(1, b"abc")[:-9]}.items():
        path = f"{base}/{name}.warc" + (".gz" if name == "cut" else "")
        with open(path, "wb") as file:
            file.write(data)
        warc.register(spark)
        with pytest.raises(Exception, match=f"{name}.warc"):
            spark.read.format("warc").load(path).collect()


def test_only_committed_files_count(spark, base):
    warc.register(spark)
    made = pages(spark, *[(i, "u", f"{i}") for i in range(10)])
    warc.write_pages(made, base)
    with open(f"{base}/part-left.warc.gz", "wb") as file:
        file.write(b"what a lost task left")
    assert spark.read.format("warc").load(base).count() == 10
    warc.write_pages(made, base)
    assert spark.read.format("warc").load(base).count() == 20
    writer = warc.WarcWriter(base, False, "now", True, 1 << 20)
    batch = pa.RecordBatch.from_pylist([{c: "aa" if c != "payload" else b"x" for c in warc.WRITTEN}])
    message = writer.write(iter([batch]))
    assert len([f for f in os.listdir(base) if f in message.names]) == 1
    writer.abort([message, None])
    assert not [f for f in os.listdir(base) if f in message.names]
    warc.page_records(made.limit(3)).select(*warc.WRITTEN).write.format("warc").mode("overwrite").save(base)
    assert spark.read.format("warc").load(base).count() == 3


def test_no_pages(spark, base):
    warc.write_pages(pages(spark).where("page_id > 0"), base)
    assert warc.archived_pages(spark, base).count() == 0


def test_same_rows_as_sql(spark):
    assert differences(spark, connect(SF), "op13_warc", SF) == []
