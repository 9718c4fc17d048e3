import gzip
import hashlib
import io

import pytest

from scorewell.llm import warc
from scorewell.llm.warc import archive_table, read_archives, read_records, records, write_archives
from scorewell.session import scratch_location

BIG = "é" * 700_000  # several chunks
ROWS = [
    (1, "http://a", "x" * 1000), (2, "http://b", "x" * 1000), (3, "http://c", "x" * 999), (4, "http://d", "x" * 999),
    (5, "http://e", None), (6, None, ""), (7, "http://g\r\nWARC/1.1", BIG), (8, "u", BIG), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 100),
    (10, "u", "<p>\x00퟿ ü</p>"), (11, "u", "x" * 1000), (11, "u", "x" * 1000), (None, "u", "x" * 1000), (None, "u", "short"),
]


def brute(rows):
    payload = [(r[2] or "").encode() for r in rows]
    out = []
    for (i, _, _), p in zip(rows, payload):
        keeper = max((r[0] for r, q in zip(rows, payload) if q == p and r[0] is not None), default=None)
        revisit = len(p) >= 1000 and keeper is not None and i != keeper
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id bigint, url string, html string").selectExpr("*", "'x' AS digest", "1 AS salt").repartition(3)


def test_table_equals_brute_force(pages):
    got = sorted((tuple(r) for r in archive_table(pages).collect()), key=str)
    assert got == brute(ROWS)


def test_chunks_carry_the_payload_and_its_digest_so_far(spark, pages):
    manifest = write_archives(pages, scratch_location(spark, "warc-test"))
    rows = read_archives(spark, manifest).where("page_id = 8").orderBy("chunk_no").collect()
    assert len(rows) == -(-len(BIG.encode()) // warc.CHUNK) and [r.is_last for r in rows] == [False] * (len(rows) - 1) + [True]
    sha, at = hashlib.sha1(), 0
    for r in rows:
        assert len(r.chunk) <= warc.CHUNK
        sha.update(r.chunk)
        at += len(r.chunk)
        assert r.sha1_so_far == sha.hexdigest() and r.bytes_so_far == at
    assert b"".join(r.chunk for r in rows) == BIG.encode()
    assert {r.record_type for r in read_archives(spark, manifest).where("page_id = 7").collect()} == {"revisit"}


def test_archives_are_gzip_members_that_any_reader_takes(spark, pages):
    manifest = write_archives(pages, scratch_location(spark, "warc-test"))
    text = b"".join(gzip.open(f.file.removeprefix("file:")).read() for f in manifest.collect())
    assert text.count(b"WARC-Record-ID: ") == len(ROWS)


@pytest.mark.parametrize("piece", [1, 7, 1 << 16])
def test_reader_takes_any_split_of_the_stream(piece):
    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, piece) if n >= 0 else piece)

    out = io.BytesIO()
    for i, p in enumerate([b"", b"abc" * 500, b"\r\n"]):
        row = {"page_id": i, "url": "u", "digest": hashlib.sha1(p).hexdigest(), "n_bytes": len(p), "refers_to": None}
        warc.write_record(out, row, memoryview(p))
    got = [r for r in read_records(Slow(out.getvalue()), size=100) if r["is_last"]]
    assert [(r["page_id"], r["bytes_so_far"], r["sha1_so_far"] == r["header_sha1"]) for r in got] == [(0, 0, True), (1, 1500, True), (2, 2, True)]


def test_damage_is_found(spark, pages):
    manifest = write_archives(pages.where("page_id = 1"), scratch_location(spark, "warc-test"))
    path = manifest.first().file.removeprefix("file:")
    raw = gzip.open(path).read().replace(b"xxxx", b"xxxy", 1)
    with open(path, "wb") as f:
        f.write(gzip.compress(raw))
    with pytest.raises(Exception, match="damaged record"):
        records(read_archives(spark, manifest)).collect()


def test_empty_table(pages):
    assert archive_table(pages.where("false")).count() == 0


def test_registered_query_equals_its_sql(spark):
    from scorewell.llm.queries import QUERIES, oracles
    from tests.conftest import SF_SMALL
    from tests.oracle_util import compare, duck

    con = duck(SF_SMALL)
    for name, sql in oracles().items():
        got, want = compare(QUERIES[name](spark, SF_SMALL), con, sql)
        assert got == want


def test_damage_shows_whichever_columns_are_asked_for(spark, pages):
    """A stored payload that isn't its header's fails a count and a selection that leaves the sizes out."""
    chunks = read_archives(spark, write_archives(pages, scratch_location(spark, "warc-test")))
    sound = records(chunks)
    assert sound.count() == len(ROWS) and sound.select("page_id", "record_type").count() == len(ROWS)
    for change in ({"sha1_so_far": "'0'"}, {"bytes_so_far": "bytes_so_far + 1"}):
        bad = records(chunks.selectExpr(*[f"{change.get(c, c)} AS {c}" for c in chunks.columns]))
        for look in (lambda: bad.count(), lambda: bad.select("page_id", "record_type").collect()):
            with pytest.raises(Exception, match="damaged record"):
                look()


def test_payloads_are_shuffled_only_beyond_the_measured_bound(pages, monkeypatch):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    few = warc.with_roles(pages)
    assert "broadcast" in plan(few) and "salt" not in few.columns
    monkeypatch.setattr(warc, "BROADCAST_COPIES", 0)
    many = warc.with_roles(pages)
    assert "strategy=broadcast" not in plan(many)
    key = lambda df: sorted(map(str, df.drop("html").collect()))
    assert key(few) == key(many)
