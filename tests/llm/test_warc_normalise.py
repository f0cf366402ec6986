import gzip
import json
import zlib

import pytest

from synthcurate.llm import warc_normalise as w
from synthcurate.session import scratch_path


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a/ü\r\nx", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "same"), (9, "u", "same"), (5, "u", "same"), (None, "u", "same"),
            (6, "u", "WARC/1.1\r\n\r\n" * 9), (7, "u", "y" * 3_000_000), (None, "u", "lonely"), (8, "u", "twice"), (8, "u", "twice")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as digest", "1 as of", "2 as n", "3 as record_id")


def test_round_trip(spark, pages):
    archives = w.round_trip(pages)
    got = {(r.record_id, r.uri, r.record_type, r.refers_to, r.payload_bytes, bytes(r.payload)) for r in w.read_members(archives).collect()}
    expected = {
        (1, "http://a/ü\r\nx", "response", None, 9, "<p>é</p>".encode()), (2, None, "revisit", 3, 0, b""), (3, "u", "response", None, 0, b""),
        (4, "u", "revisit", 9, 4, b""), (9, "u", "response", None, 4, b"same"), (5, "u", "revisit", 9, 4, b""), (None, "u", "revisit", 9, 4, b""),
        (6, "u", "response", None, 108, b"WARC/1.1\r\n\r\n" * 9), (7, "u", "response", None, 3_000_000, b"y" * 3_000_000),
        (None, "u", "response", None, 6, b"lonely"), (8, "u", "response", None, 5, b"twice"),
    }
    assert got == expected
    assert sum(r.records for r in archives.collect()) == 12


def test_members_stand_alone_and_the_source_is_one_stream(spark, pages):
    folder = scratch_path(spark, "warc-test")
    whole = w.write_monolithic(w.revisits(pages, "page_id", "url", "html").coalesce(1), folder, archive_bytes=1000).collect()
    assert len(whole) > 1  # archives are rolled
    for row in whole:
        path = row.path.removeprefix("file:")
        inflate = zlib.decompressobj(31)
        text = inflate.decompress(open(path, "rb").read())
        assert inflate.eof and not inflate.unused_data and text.count(b"WARC-Record-ID") == row.records
        target = f"{path}.members.gz"
        assert w.normalise_archive(path, target) == row.records
        data, index = open(target, "rb").read(), [json.loads(x) for x in open(f"{target}.idx")]
        assert b"".join(zlib.decompress(data[e["offset"] : e["offset"] + e["length"]], 31) for e in index) == text
        assert gzip.decompress(data) == text


def test_broken_archives_name_the_file(tmp_path):
    for name, body in {"cut": w.encode_record(1, "u", "response", None, b"abcdef")[:-8], "odd": b"no archive", "head": b"WARC/1.1\r\nX: y"}.items():
        path = tmp_path / f"{name}.warc.gz"
        path.write_bytes(gzip.compress(body))
        with pytest.raises(ValueError, match=name):
            w.normalise_archive(str(path), str(tmp_path / "out.gz"))


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert w.read_members(w.round_trip(empty)).count() == 0


def test_digest():
    assert w.payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_a_damaged_payload_is_an_error(tmp_path):
    js = json
    good = w.encode_record(7, "http://a.example/", "response", None, b"<p>hello</p>")
    bad = good.replace(b"hello", b"jello")
    for name, record in (("good", good), ("bad", bad)):
        z = zlib.compressobj(9, zlib.DEFLATED, 31)
        member = z.compress(record) + z.flush()
        (tmp_path / name).write_bytes(member)
        (tmp_path / f"{name}.idx").write_bytes(js.dumps({"offset": 0, "length": len(member)}).encode() + b"\n")
    assert [r[-1] for r in w.read_archive(str(tmp_path / "good"))] == [b"<p>hello</p>"]
    with pytest.raises(ValueError, match="differs"):
        list(w.read_archive(str(tmp_path / "bad")))
