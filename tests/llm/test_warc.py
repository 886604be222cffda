import zlib

import pytest

from fitframe.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, digest string")


def test_round_trip_nulls_ties_and_unicode(spark, tmp_path):
    same = "é" * 600
    rows = [(1, None, None, "x", "y"), (2, "u\r\nX: y", same, None, None), (3, "v", same, None, None), (None, "w", same, None, None),
            (4, "z", "", None, None), (5, "z", "a" * 1000, None, None), (5, "z", "a" * 1000, None, None), (6, "s", "short", None, None),
            (7, "s", "short", None, None), (8, "long", "text \n" * 200_000, None, None)]
    files = warc.write(warc.deduplicated(pages(spark, rows)), f"file://{tmp_path}/out")
    got = warc.read(files).collect()
    assert len(got) == len(rows) == sum(r.n_records for r in files.collect())
    by = {(r.record_id, r.record_type): r for r in got}
    assert by["urn:page:2", "revisit"].refers_to == "urn:page:3" and by["urn:page:2", "revisit"].payload == b""
    assert by["urn:page:2", "revisit"].payload_bytes == 1200
    assert by["urn:page:3", "response"].payload.decode() == same
    assert by["urn:page:2", "revisit"].target_uri == "u%0D%0AX: y" and by["urn:page:1", "response"].target_uri is None
    assert sum(r.record_type == "response" and r.record_id == "urn:page:5" for r in got) == 2
    assert by["urn:page:6", "response"].payload == by["urn:page:7", "response"].payload == b"short"
    assert by["urn:page:8", "response"].payload_bytes == 1_200_000
    assert sum(r.record_id.startswith("urn:page:none") and r.refers_to == "urn:page:3" for r in got) == 1


def test_empty_table(spark, tmp_path):
    files = warc.write(warc.deduplicated(pages(spark, [])), f"file://{tmp_path}/out")
    assert warc.read(files).count() == 0


def test_broken_files(tmp_path):
    good = warc._member(warc.record_bytes("urn:page:1", "u", b"payload" * 40, None))
    record = warc.record_bytes("urn:page:1", "u", b"payload", None)

    def read(data):
        path = tmp_path / "f.warc.gz"
        path.write_bytes(data)
        return list(warc.read_file(str(path)))
    assert len(read(good * 3)) == 3 and [r[1] for r in read(good * 3)] == [0, len(good), 2 * len(good)]
    assert read(b"") == []
    for bad in (good[:-5], good + b"junk", warc._member(record.replace(b"payload", b"paxload")), warc._member(record[:-4]),
                warc._member(record + b"x"), warc._member(b"no record"), warc._member(record.replace(b"Content-Length: 9", b"Content-Length: x"))):
        if bad == warc._member(record):
            continue
        with pytest.raises(warc.WarcError):
            read(bad)


def test_members_across_reads(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 7)
    data = b"".join(warc._member(warc.record_bytes(f"urn:page:{i}", None, b"x" * i, None)) for i in range(20))
    (tmp_path / "f.warc.gz").write_bytes(data)
    assert [r[6] for r in warc.read_file(str(tmp_path / "f.warc.gz"))] == list(range(20))
    assert zlib.decompressobj(31).decompress(data)
