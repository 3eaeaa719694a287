import struct

import pytest
import zstandard

from tabloom.llm import warc
from tabloom.storage import new_path

PAGES = "page_id long, url string, html string, payload string, head long"


def pages(spark):
    long = "é<html>" * 300
    rows = [(1, "http://a/x y\r\nZ: 1", long), (2, "http://b", long), (3, None, long), (3, None, long), (4, "u", "short"), (5, "u", "short"),
            (6, "u", None), (7, "u", ""), (None, "u", long), (8, "big", "\x00WARC/1.1\r\n\r\n" * 150_000), (9, "x", "y" * 999), (10, "x", "y" * 999),
            (11, "x", "y" * 1000), (12, "x", "y" * 1000), (None, "n", "only" * 400)]
    return spark.createDataFrame([(*r, "p", 1) for r in rows], PAGES)


def test_round_trip_equals_the_marks(spark):
    df = pages(spark)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = sorted(map(tuple, warc.round_trip(df).select(columns).collect()), key=repr)
    assert got == sorted(map(tuple, warc.marked(df).select(columns).collect()), key=repr) and len(got) == 15
    by = {r[0]: r for r in got if r[0] is not None}
    assert by[1][3:] == by[2][3:] == ("revisit", 3) and by[3][3:] == ("response", None) and by[11][3:] == ("revisit", 12)
    assert [by[i][3] for i in (4, 5, 6, 7, 9, 10)] == ["response"] * 6 and by[6][1] == 0


def test_files_and_payloads(spark):
    folder = new_path(spark, "warc-test")
    warc._make_folder(spark, folder)
    df = warc.marked(pages(spark))
    assert warc.write(df, folder, archive_bytes=100_000) == 15
    assert warc.write(df, folder, archive_bytes=100_000) == 15  # tasks that run again replace their files
    files = spark.read.format("binaryFile").load(folder).collect()
    assert all(f["path"].endswith(".warc.zst") for f in files)
    for f in files:
        assert [m == warc.FRAME for m, _, _ in warc.frames(f["content"])][0] is False
    read = {r["page_id"]: r for r in warc.read(spark, folder).collect() if r["page_id"] is not None}
    assert bytes(read[3]["payload"]).decode() == "é<html>" * 300 and bytes(read[1]["payload"]) == b""
    assert read[1]["url"] == "http://a/x%20y%0D%0AZ:%201"


def records():
    return [warc.record(i, f"http://h/{i}", b"x" * i * 10, __import__("hashlib").sha1(b"x" * i * 10).hexdigest(), "response", None) for i in range(60)]


def test_dictionaries(spark):
    data = warc.archive(records())
    assert [r["page_id"] for r in warc.records(data)] == list(range(60))
    size = struct.unpack_from("<I", data, 4)[0]
    packed = zstandard.ZstdCompressor().compress(data[8:8 + size])  # the dictionary may be compressed itself
    again = struct.pack("<II", warc.DICTIONARY_FRAME, len(packed)) + packed + data[8 + size:]
    assert [r["payload_bytes"] for r in warc.records(again)] == [10 * i for i in range(60)]
    plain = b"".join(zstandard.ZstdCompressor().compress(r) for r in records())
    assert len(list(warc.records(plain))) == 60
    raw = struct.pack("<II", warc.DICTIONARY_FRAME, 3) + b"abc" + plain
    assert len(list(warc.records(raw))) == 60 and list(warc.records(b"")) == []


@pytest.mark.parametrize("change", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.1", 1), lambda r: r[:-1], lambda r: r + b"x", lambda r: r.replace(b"Content-Length: ", b"Content-Length: 1", 1),
    lambda r: r.replace(b"xxxx", b"xxyx", 1), lambda r: r.replace(b"WARC-Type: response", b"WARC-Type revisit", 1),
    lambda r: r.replace(b"WARC-Date", b"WARC-Dato", 1), lambda r: b"", lambda r: r.replace(b"\r\n\r\n", b"\r\n", 2)])
def test_bad_records_are_found(change):
    frames = [zstandard.ZstdCompressor().compress(r if i != 30 else change(r)) for i, r in enumerate(records())]
    with pytest.raises(ValueError):
        list(warc.records(b"".join(frames)))
    got = list(warc.records(b"".join(frames), strict=False))
    assert len(got) == 60 and [i for i, r in enumerate(got) if r["error"]] == [30]


def test_cut_archives_raise():
    data = warc.archive(records())
    for cut in (3, 9, len(data) - 1, len(data) - 30):
        with pytest.raises(ValueError):
            list(warc.records(data[:cut]))


def test_no_pages(spark):
    assert warc.round_trip(pages(spark).where("false")).collect() == []
