import gzip
import hashlib
import io

import pytest

from kpiweave.llm import warc
from kpiweave.llm.common import scratch

SCHEMA = "page_id bigint, url string, html string, payload string"


def round_trip(spark, rows, **options):
    path = scratch(spark, "warc-test")
    warc.write(spark.createDataFrame(rows, SCHEMA), path, **options)
    return path, [r.asDict() for r in warc.read(spark, path).collect()]


def test_round_trip_with_revisits_nulls_and_clashing_columns(spark):
    long = "ä<p>" * 40
    rows = [(7, "u7", long, "x"), (3, None, long, "x"), (9, "a\nb", long, None)]
    rows += [(1, "u", "tiny", "x"), (2, "u", "tiny", "x"), (4, "u", None, "x")]
    rows += [(5, "u", "\r\n\r\n" * 30, "x"), (None, "n", long, "x"), (3, None, long, "x")]
    path, got = round_trip(spark, rows)
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    assert (by_id[7]["record_type"], by_id[7]["refers_to"]) == ("revisit", 3)
    assert by_id[7]["payload_bytes"] == len(long.encode())
    assert by_id[7]["payload_digest"] == hashlib.sha256(long.encode()).hexdigest()
    assert [r["record_type"] for r in got if r["page_id"] == 3] == ["response"] * 2
    assert by_id[None]["record_type"] == "response"
    assert by_id[1]["record_type"] == by_id[2]["record_type"] == "response"
    assert by_id[4]["payload"] == b"" and by_id[4]["payload_bytes"] == 0
    assert by_id[5]["payload"].decode() == "\r\n\r\n" * 30
    assert by_id[9]["url"] == "a b"
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    plain = b"".join(gzip.decompress(f) for f in files)  # any gzip reader can open them
    assert plain.count(b"WARC/1.1\r\n") == len(rows)


def test_records_of_over_16_mib_and_small_files(spark):
    big = "q" * (17 << 20)
    _, got = round_trip(spark, [(1, "u", big, ""), (2, "u", "a", ""), (3, "u", "b", "")], per_file=1)
    assert sorted((r["page_id"], r["payload_bytes"]) for r in got) == [(1, len(big)), (2, 1), (3, 1)]


def test_empty_table(spark):
    assert round_trip(spark, [])[1] == []


def test_damage_is_reported():
    data = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    packed = warc.member(data)
    assert [warc.parse(d)[0] for d in warc.inflate(packed + packed)] == [1, 1]
    with pytest.raises(warc.WarcError):
        list(warc.inflate(packed[:-3]))
    with pytest.raises(warc.WarcError):
        warc.parse(data.replace(b"payload\r", b"pAyload\r"))
    with pytest.raises(warc.WarcError):
        warc.parse(data[:-1])


def test_archives_are_bounded_by_bytes(spark):
    rows = [(i, "u", hashlib.sha256(str(i).encode()).hexdigest() * 40, "") for i in range(60)]
    path, got = round_trip(spark, rows, file_bytes=1000)
    assert sorted(r["page_id"] for r in got) == list(range(60))
    sizes = [r.length for r in spark.read.format("binaryFile").load(path).collect()]
    one = len(warc.member(warc.record(10, "u", rows[10][2].encode(), "0" * 64, None)))
    assert len(sizes) > 20 and max(sizes) < max(1000, one + 200)


class Counted(io.BytesIO):
    most = 0

    def read(self, n=-1):
        Counted.most = max(Counted.most, n)
        assert n > 0
        return super().read(n)


def test_a_stream_is_read_in_pieces():
    pages = [b"", b"x" * 100, bytes(range(256)) * 5000, b"\r\n\r\n" * 70000, b"z" * (3 << 20)]
    data = b""
    for i, page in enumerate(pages):
        digest = hashlib.sha256(page).hexdigest()
        data += warc.member(warc.record(i, "u" * 200_000 * (i == 1), page, digest, None)) + warc.member(b"")
    got = list(warc.records(Counted(data)))
    assert [(r[0], r[6]) for r in got] == list(enumerate(pages))
    assert Counted.most <= warc.CHUNK
    short = list(warc.records(io.BytesIO(data), keep=False))
    assert [r[:6] for r in short] == [r[:6] for r in got] and not any(r[6] for r in short)


def test_every_cut_of_an_archive_is_reported():
    page = b"some payload " * 9
    record = warc.record(1, "u", page, hashlib.sha256(page).hexdigest(), None)
    whole = warc.member(record)
    for n in range(1, len(whole)):
        if whole[:n] != warc._gzip(record, 6):  # what is cut may be the empty member alone
            with pytest.raises(warc.WarcError):
                list(warc.records(io.BytesIO(whole[:n])))
    for n in range(len(record)):
        with pytest.raises(warc.WarcError):
            warc.parse(record[:n] + b"!" * (n % 2))
    with pytest.raises(warc.WarcError):
        warc.parse(record + b"\r\n")
