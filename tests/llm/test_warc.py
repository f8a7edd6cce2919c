import gzip
import hashlib
import io
import random
import zlib

import pyarrow as pa
import pytest

from rillflow.llm import store, warc


class File(io.BytesIO):
    pass


def archive(seed=1, n=40):
    rng = random.Random(seed)
    raws = [warc.record(i, f"http://h/{i}", bytes(rng.choice(b"abc<>\x1f\x8b\x08") for _ in range(rng.choice([0, 5, 300, 30_000]))), "d" * 64, None) for i in range(n)]
    return raws, [warc.member(r) for r in raws]


@pytest.mark.parametrize("size", [1, 7, 100, 4096, 10**9])
def test_ranges_own_each_record_once(size):
    _, members = archive(n=12 if size < 50 else 40)
    data = b"".join(members)
    if size < 50:
        data = data[: sum(map(len, members[:4]))]
    found = []
    for start in range(0, len(data), size):
        found += [r["page_id"] for r in warc.records(File(data), start, min(len(data), start + size), len(data))]
    assert found == list(range(4 if size < 50 else len(members)))


def test_false_magic_and_damage():
    _, members = archive(2)
    noise = warc.MAGIC + b"\x00" * 20
    odd = gzip.compress(b"not a record at all")
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    inner = stored.compress(warc.record(99, "u", b"x" * 50 + warc.MAGIC + b"y" * 50, "d", None)) + stored.flush()
    data = noise + members[0] + odd + noise + inner + members[1][:-20] + members[2]
    got = [r["page_id"] for r in warc.records(File(data), 0, len(data), len(data))]
    assert got[:3] == [0, 99, 2]
    assert warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc") is None and warc.parse(b"hello") is None


def test_any_gzip_reader_reads_them():
    raws, members = archive(3)
    assert gzip.decompress(b"".join(members)) == b"".join(raws)


def test_round_trip(spark):
    big = "<p>é</p>" * 100
    rows = [(1, "http://a/ b\r\nX: y", big), (2, None, big), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (0, "u", "z" * 200_000 + "\r\n\r\nWARC/1.1\r\n"), (7, "u", "z" * 200_000 + "\r\n\r\nWARC/1.1\r\n"), (None, "u", big), (None, "u", "alone" * 30), (8, "u", "é" * 49 + "a"), (9, "u", "é" * 49 + "a"), (10, "u", "é" * 50), (11, "u", "é" * 50), (1, "http://a", big)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    for size in (1000, 16 << 20):
        got = sorted(((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df, size).collect()), key=str)
        first = {}
        for i, _, h in rows:
            b = (h or "").encode()
            if len(b) >= 100 and i is not None:
                first[b] = min(first.get(b, i), i)
        want = []
        for i, _, h in rows:
            b = (h or "").encode()
            again = b in first and first[b] != i
            want.append((-1 if i is None else i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
        assert got == sorted(want, key=str)
    assert warc.round_trip(df.where("false")).count() == 0


def test_only_reported_files_are_read(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"{i}" * 200) for i in range(20)], "page_id long, url string, html string")
    folder = store.new_path(spark, "warc")
    done = warc.write(warc.plan(df), folder)
    place = folder.removeprefix("file://")
    with open(f"{place}/part-999999-left-over.warc.gz", "wb") as f:
        f.write(archive(4)[1][0])
    assert warc.read(done).count() == 20
    assert isinstance(done.toArrow(), pa.Table)
