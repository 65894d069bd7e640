"""WARC round trip, secret scan and the registered SQL."""

import base64
import gzip
import hashlib
import io
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In

import check
from tabloom.llm import catalogue, secrets, warc

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_sql(spark, name):
    df = catalogue.queries()[name](spark, FOLDER)
    cursor = check.duck(FOLDER).execute(catalogue.oracle_sql()[name])
    assert check.canonical(df.columns, [tuple(r) for r in df.collect()]) == check.canonical([d[0] for d in cursor.description], cursor.fetchall())


def test_warc_rows(spark, tmp_path):
    schema = "page_id bigint, url string, html string, refers_to string"
    long = "WARC/1.1\r\n\r\n" + "é" * 300_000
    rows = [(1, "u", "a"), (5, None, "a"), (3, "x\r\ny", "a"), (7, "u", None), (8, "u", ""), (9, "u", long), (9, "u", long), (None, "u", "a"), (None, "u", "alone")]
    for least in (0, 2):
        found = warc.archive_pages(spark.createDataFrame([(*r, "clash") for r in rows], schema), str(tmp_path / f"w{least}"), least).collect()
        wanted = []
        for i, _, h in rows:
            data = (h or "").encode()
            same = [j for j, _, g in rows if (g or "").encode() == data and j is not None]
            revisit = bool(same) and i != max(same) and len(data) >= least
            wanted.append((str(i), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", max(same) if revisit else None))
        assert sorted(map(str, wanted)) == sorted(str((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in found)
    empty = spark.createDataFrame([], schema)
    assert warc.archive_pages(empty, str(tmp_path / "none")).count() == 0


def test_warc_headers_first():
    record = b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:x:%d>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    archive = record % (b"response", 1) + record % (b"revisit", 2) + record % (b"response", 3)

    class Counting(io.BytesIO):
        got = 0

        def read(self, n=-1):
            self.got += n
            return super().read(n)

    file = Counting(archive)
    found = list(warc.scan(file, lambda h: h["warc-type"] == "response"))
    assert [(h["warc-record-id"], p) for h, p in found] == [("<urn:x:1>", b"hello"), ("<urn:x:3>", b"hello")] and file.got == 10
    assert [p for _, p in warc.scan(Counting(archive), payload=False)] == [None] * 3
    with pytest.raises(ValueError):
        list(warc.scan(io.BytesIO(archive[:-8])))
    for cut in (archive[:-8], archive[:-5]):  # also when the record that is cut is skipped
        for left in (dict(payload=False), dict(wanted=lambda h: False)):
            with pytest.raises(ValueError):
                list(warc.scan(io.BytesIO(cut), **left))
    assert [p for _, p in warc.scan(io.BytesIO(archive[:-4]))] == [b"hello"] * 3


def test_compressed_archives(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: {}\r\nWARC-Record-ID: <urn:x:{}>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    members = [gzip.compress(record.format("response" if k % 2 else "request", k, 1000 + k, "x" * (1000 + k)).encode()) for k in range(50)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    (tmp_path / "b.warc").write_bytes(record.format("response", 99, 2, "ok").encode())
    found = warc.read_warc(spark, str(tmp_path)).filter("record_type = 'response'").collect()
    assert sorted((r["record_id"], len(r["payload"])) for r in found) == sorted([(f"<urn:x:{k}>", 1000 + k) for k in range(1, 50, 2)] + [("<urn:x:99>", 2)])
    assert warc.read_warc(spark, str(tmp_path), payload=False).count() == 51
    for cut in (b"".join(members)[:-30], gzip.compress(record.format("request", 1, 500, "short").encode())):
        with pytest.raises((ValueError, EOFError)):
            list(warc.scan(warc.plain(io.BytesIO(cut)), payload=False))


def test_warc_takes_header_predicates():
    reader = warc.WarcReader({"files": "[]"})
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("record_id",), ("a", "b")), GreaterThan(("payload_length",), "3")]))
    assert [type(f) for f in left] == [GreaterThan] and reader.equal == {"warc-type": {"response"}, "warc-record-id": {"a", "b"}}


@pytest.fixture(scope="module")
def forest(spark):
    docs = secrets.table(spark, "/root/testdata/sf0.01", "documents")
    return secrets.fit_forest(secrets.labelled_findings(docs))


def test_secret_scan_finds_tokens_and_leaves_others(spark, forest):
    hexes = hashlib.sha1(b"x").hexdigest()
    text = f'some words token = "{hexes}" more words; commit {hexes[::-1]} was made. password = "changeme-changeme-1" ok 9807915762804490 and unbrokenwordsofletters'
    rows = [(1, text, "src/app.py", "c"), (1, text, "src/app.py", "c"), (2, None, None, None), (None, "", "x", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, candidate string")
    found = secrets.scan_secrets(docs, forest).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    verdict = {r.candidate_sha256: r.is_secret for r in found}
    assert len(found) == 8 and verdict[sha(hexes)] and not verdict[sha(hexes[::-1])] and not verdict[sha("changeme-changeme-1")] and not verdict[sha("9807915762804490")]
    assert secrets.scan_secrets(docs.limit(0), forest).count() == 0
    assert secrets.fit_forest(secrets.labelled_findings(docs.limit(0))) is None
    assert {r.score for r in secrets.scan_secrets(docs, None).collect()} == {1.0}


def test_secret_forest_on_held_out_findings(spark, forest):
    docs = secrets.table(spark, "/root/testdata/sf0.01", "documents").selectExpr("doc_id + 1000000 AS doc_id", "text")
    findings = secrets.labelled_findings(docs)
    scored = secrets.scan_secrets(findings.select("doc_id", "text", "path"), forest, path_column="path").collect()
    labels = {(r.doc_id, hashlib.sha256((r.planted or "").encode()).hexdigest()): r.label for r in findings.collect()}
    pairs = [(r.is_secret, labels[r.doc_id, r.candidate_sha256] == 1) for r in scored if (r.doc_id, r.candidate_sha256) in labels]
    assert len(pairs) > 500 and sum(a == b for a, b in pairs) / len(pairs) > 0.97


def test_candidates_against_python(spark):
    found = {(r.doc_id, r.occurrence): r.candidate for r in secrets.candidates(secrets.table(spark, "/root/testdata/sf0.01", "documents")).collect()}
    run = re.compile(r"[A-Za-z0-9+/_\-]+")
    for i, text in duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall():
        long = [m.group() for m in run.finditer(text or "") if len(m.group()) >= 16 and re.search("[0-9]", m.group())]
        mine = [c.rstrip("=") for (d, _), c in found.items() if d == i]
        assert not [x for x in long if x not in mine]


WHOLE = {
    'password = "S3cr3t!Pa$$w0rd"': "S3cr3t!Pa$$w0rd",
    '{"token":"abc.def.ghi-jkl"}': "abc.def.ghi-jkl",
    'password  =   "abcdEFGH123"': "abcdEFGH123",
    "config:\n  password:     S3cr3t!Pa$$w0rd, x": "S3cr3t!Pa$$w0rd",
    "aws_secret_key_no_2='it~is&so#me'": "it~is&so#me",
    "token: Bearer QwErTyUiOpAsDfGhJkLz": "QwErTyUiOpAsDfGhJkLz",
    "curl -H Authorization:Basic QWxhZGRpbjpvcGVu== more": "QWxhZGRpbjpvcGVu==",
    "use SG.abcdefghij.klmnopqr12 here": "SG.abcdefghij.klmnopqr12",
    'dsn = "Server=x;Password=S3cr3t!Pa$$w0rd;Db=y"': "S3cr3t!Pa$$w0rd",
    "'secret' => 'two words!x'": "two words!x",
    'see {"n":1,"key":"S3cr3t!Pa$$w0rd"}': "S3cr3t!Pa$$w0rd",
    "QwErTyUiOpAsDfGh1234== someword": "QwErTyUiOpAsDfGh1234==",
}


def test_candidates_are_whole_values(spark):
    found = secrets.candidates(spark.createDataFrame(list(enumerate(WHOLE)), "doc_id long, text string"), path_column=None).collect()
    by_doc = {k: [r.candidate for r in found if r.doc_id == k] for k in range(len(WHOLE))}
    assert not [(t, by_doc[k]) for k, (t, wanted) in enumerate(WHOLE.items()) if wanted not in by_doc[k]]
    row = next(r for r in found if r.doc_id == 3 and r.candidate == "S3cr3t!Pa$$w0rd")
    assert row.left.endswith("\n  password:     ") and row.right.startswith(", x")
    long = 'x = "' + "a!" * 300_000 + '" ' + "b=c&" * 100_000 + ' "k":1,' * 50_000
    assert secrets.candidates(spark.createDataFrame([(1, long)], "doc_id long, text string"), path_column=None).filter("length(candidate) = 600000").count() == 1


def test_forest_judges_whole_values(spark, forest):
    rows = [(k, t) for k, t in enumerate(WHOLE) if k in (0, 2, 5)] + [(100, 'title: "Something of everything, again." Note: afterwards, basic understanding')]
    found = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"), forest, path_column=None).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    secret = {r.candidate_sha256 for r in found if r.is_secret}
    assert {sha(list(WHOLE.values())[k]) for k in (0, 2, 5)} <= secret and not [r for r in found if r.doc_id == 100 and r.is_secret]


@pytest.mark.parametrize("text, many", [("." * 2_000_000, 0), ("a." * 1_000_000, 0), ("..a" * 700_000, 0), ("a.b-" * 500_000 + "7", 1), ("abC." * 500_000, 1)])
def test_long_dotted_texts_take_linear_time(spark, text, many):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    secrets.candidates(docs.select("doc_id", F.left("text", F.lit(100)).alias("text")), path_column=None).collect()
    begin = time.time()
    assert secrets.candidates(docs, path_column=None).filter("occurrence = 0").count() == many
    assert time.time() - begin < 10
