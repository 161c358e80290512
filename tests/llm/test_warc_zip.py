import base64
import hashlib
import io
import random
import zipfile

import pyarrow as pa
import pytest

from lookout.llm import warc_zip as Z
from lookout.llm.frames import work_dir
from tests.conftest import SF001


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def brute(rows):
    """(id, bytes, digest, type, refers_to) of every row."""
    first = {}
    for d, _, t in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    out = []
    for d, _, t in rows:
        raw = (t or "").encode()
        head = first.get(t or "")
        kind = ("response", None) if d == head else ("revisit", head)
        out.append((d, len(raw), digest(raw), *kind))
    return sorted(out, key=repr)


PAGES = [
    (1, "http://a/ü", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (3, "http://x\r\nWARC-Type: bad", "two \r\n\r\n WARC/1.1\r\n"),
    (4, "u", None),
    (5, "u", ""),
    (6, "u", "é中" * 50_000),
    (None, "u", "<p>one</p>"),
    (None, "u", "only here"),
    (7, "u", "same"),
    (7, "u", "same"),
]


@pytest.mark.parametrize("size", [1, 1 << 28])
def test_round_trip(spark, size):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    packages = Z.write_packages(df, "page_id", "url", "html", work_dir(spark, "test-warc"), size)
    records = Z.read_packages(packages).collect()
    as_id = lambda v: None if v is None else int(v)
    got = [(as_id(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, as_id(r.refers_to)) for r in records]
    assert sorted(got, key=repr) == brute(PAGES)
    assert all(r.digest_ok for r in records if r.record_type == "response")
    texts = {r.payload.decode() for r in records if r.payload is not None}
    assert texts == {t or "" for _, _, t in PAGES}
    assert {r.url for r in records if r.record_id == "1"} == {"http://a/ü"}
    assert {r.url for r in records if r.record_id == "3"} == {"http://x%0D%0AWARC-Type: bad"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    packages = Z.write_packages(df, "page_id", "url", "html", work_dir(spark, "test-warc"))
    assert packages.collect() == [] and Z.read_packages(packages).collect() == []


def package(members, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members:
            with z.open(name, "w", force_zip64=True) as f:
                f.write(data)
        z.comment = comment
    return out.getvalue()


def places(raw):
    return Z.directory(pa.BufferReader(raw), len(raw))


def test_directory_of_stored_members():
    members = [("archive/a.warc.gz", b"abc"), ("indexes/index.json", b"{}"), ("x/é.txt", b""), ("pk", b"PK\x05\x06" * 9)]
    for comment in (b"", b"a comment"):
        raw = package(members, comment)
        found = places(raw)
        assert {n: raw[a : a + m] for n, (a, m) in found.items()} == dict(members)
    assert places(package(members, method=zipfile.ZIP_DEFLATED)) == {}
    with pytest.raises(ValueError):
        places(b"no zip at all")


def test_zip64_directory(monkeypatch):
    """With lower limits the writer keeps sizes, offsets and the end record in
    their ZIP64 forms."""
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    members = [(f"m{i}", bytes([65 + i]) * (5 + 10 * i)) for i in range(5)]
    raw = package(members)
    assert b"PK\x06\x06" in raw and b"PK\x06\x07" in raw
    assert {n: raw[a : a + m] for n, (a, m) in places(raw).items()} == dict(members)


def test_archive_without_index_is_scanned(tmp_path):
    rng = random.Random(4)
    raws = [Z.record(str(i), "u", rng.randbytes(rng.randrange(3000)), None) for i in range(40)]
    data = [Z.gzip.compress(r) for r in raws]
    raw = package([(Z.ARCHIVE, b"".join(data))])
    start, length = places(raw)[Z.ARCHIVE]
    got = list(Z._scan(pa.BufferReader(raw), start, length))
    assert [n for _, n in got] == [len(d) for d in data]
    path = tmp_path / "p.zip"
    path.write_bytes(raw)
    rows = next(Z._ranges([pa.record_batch([pa.array([path.as_uri()])], names=["package"])]))
    records = [r for b in Z._read([rows]) for r in b.to_pylist()]
    assert [r["record_id"] for r in records] == [str(i) for i in range(40)] and all(r["digest_ok"] for r in records)


def test_query_on_pages(spark):
    from lookout.llm.queries import op2

    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in op2(spark, SF001).collect()), key=repr) == brute(rows)
