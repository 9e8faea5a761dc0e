import base64
import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from basketry.llm import warc_zip as W

SCHEMA = "page_id long, url string, html string, path string"


def expected(rows, least=0):
    body = {i: (h or "").encode() for i, (_, _, h) in enumerate(rows)}
    out = []
    for i, (p, _, _) in enumerate(rows):
        same = [rows[j][0] for j in body if body[j] == body[i] and rows[j][0] is not None]
        top = max(same) if same and len(body[i]) >= least else p
        again = top != p
        out.append((p, len(body[i]), base64.b32encode(hashlib.sha1(body[i]).digest()).decode(),
                    "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/x y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://b\n/", None), (4, "u", ""),
        (5, "u", "x" * 200_000), (None, "n", "only"), (None, "n", "<p>é</p>"), (7, "u", "a\r\n\r\nb"), (7, "u", "a\r\n\r\nb")]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    df = spark.createDataFrame([(*r, "clash") for r in ROWS], SCHEMA)
    got = [tuple(r) for r in W.archive_round_trip(df, least_bytes=least).collect()]
    assert sorted(got, key=str) == expected(ROWS, least)


def test_payloads_come_back_from_small_packages(spark):
    rows = [(i, f"http://x/{i}", f"page {i} " * (i % 50)) for i in range(300)]
    df = spark.createDataFrame([(*r, "c") for r in rows], SCHEMA).repartition(3)
    manifest = W.write_packages(df, package_bytes=4000)
    assert manifest.count() > 3
    assert manifest.agg(F.sum("records")).first()[0] == 300
    got = {int(r.record_id): r for r in W.read_packages(manifest, per_task=1000).collect()}
    for i, url, html in rows:
        assert got[i].url == url
        if got[i].record_type == "response":
            assert bytes(got[i].payload) == html.encode()
        else:
            assert rows[int(got[i].refers_to)][2] == html


def test_standard_tools_read_a_package(spark):
    df = spark.createDataFrame([(*r, "c") for r in ROWS], SCHEMA).coalesce(1)
    path = W.write_packages(df).first().path.removeprefix("file:")
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and sorted(z.namelist()) == [W.ARCHIVE, W.INDEX]
        text = gzip.decompress(z.read(W.ARCHIVE))
        assert text.count(b"WARC/1.1\r\n") == len(ROWS)


class Source(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def zip64(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = Source()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/a", b"0123456789" * 5)
        z.writestr("indexes/b", b"second member")
        z.comment = b"PK\x05\x06 in a comment"
    return raw


def test_zip64_directory(monkeypatch):
    raw = zip64(monkeypatch)
    assert b"PK\x06\x06" in raw.getvalue() and b"PK\x06\x07" in raw.getvalue()
    a, b = W.central_directory(raw, raw.size())
    assert W.read_at(raw, W.data_start(raw, a), a.size) == b"0123456789" * 5
    assert W.read_at(raw, W.data_start(raw, b), b.size) == b"second member"


def test_damage_is_an_error():
    raw = Source()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a", b"0" * 100)
    member, = W.central_directory(raw, raw.size())
    with pytest.raises(ValueError, match="compressed"):
        W.data_start(raw, member)
    short = Source(raw.getvalue()[:-5])
    with pytest.raises(ValueError):
        W.central_directory(short, short.size())
    bad = gzip.compress(W.warc_record(1, "u", b"abc", None)[0].replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match="digest"):
        W.parse_record(gzip.decompress(bad))


def test_empty_table(spark):
    assert W.archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
