"""Filter audit: the stream with retractions against SQL and against counting document by document."""

import itertools
import re

import check
import pytest

from tabloom.llm import filter_audit as fa

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, source string, quality string, mask int"
LABELS = "doc_id bigint, quality int, toxic int, part int"


def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def by_counting(docs, labels):
    """{(part, order, step): (kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)}."""
    good = {i for i, q, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, *_ in labels if t == 1 and i is not None}
    seen = []
    for doc_id, text, source, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, *_ in docs),
        }
        seen.append((doc_id, source or "", {k for k, v in fails.items() if v}))
    out = {}
    for part in {p for _, p, _ in seen}:
        own = [(i, f) for i, p, f in seen if p == part]
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [i for i, f in own if letter in f and not f & before]
                out[part, "".join(order), step] = [
                    sum(not f & (before | {letter}) for _, f in own),
                    len(removed),
                    sum(letter in f and bool(f & before) for _, f in own),
                    sum(f == {letter} for _, f in own),
                    sum(i in good for i in removed),
                    sum(i in toxic for i in removed),
                ]
    for part in {p for _, p, _ in seen}:
        for letter in "ABCDE":
            keys = [k for k in out if k[0] == part and k[1][k[2] - 1] == letter]
            total = sum(out[k][1] for k in keys)
            for k in keys:
                out[k].append(total)
    return {k: tuple(v) for k, v in out.items()}


def as_dict(rows):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows}


def test_query_against_sql(spark):
    cursor = check.duck(FOLDER).execute(fa.SQL["op12_filter_audit"])
    names = [d[0] for d in cursor.description]
    found = fa.op12_filter_audit(spark, FOLDER)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(cursor.fetchall())


def test_later_batches_retract(spark, tmp_path):
    """Each file is one micro-batch; ids of a text come in falling, rising and mixed order, also in a second call."""
    long = " ".join(f"w{k}" for k in range(250))
    batches = [
        [(50, long, "a"), (51, long, "b"), (7, "AB # x", "a"), (None, long, "a"), (60, None, None)],
        [(40, long, "b"), (60, long, "a"), (7, "AB # x", "c"), (8, "AB # x", "a"), (59, "", "")],
        [(45, long, "a"), (6, "AB # x", "b"), (70, "a a " * 200, "a"), (None, long, None)],
        [(1, long, "c"), (1, long, "c"), (1, long, "d"), (69, "a a " * 200, "a"), (61, "", "z")],
    ]
    labels = [(1, 1, 0, 5), (40, 1, 1, 5), (40, 0, None, 5), (7, None, 1, 5), (8, 1, 7, 5), (70, 1, 1, 5), (None, 1, 1, 5), (999, 1, 1, 5)]
    known = spark.createDataFrame(labels, LABELS)
    path, folder = tmp_path / "docs", str(tmp_path / "state")
    rows = []
    for number, batch in enumerate(batches):
        write(spark, path, [(*r, "x", 3) for r in batch], DOCS)
        rows += batch
        if number in (0, 2, 3):  # the second call reads two files, in two micro-batches
            found = fa.filter_audit(spark, str(path), known, batches=10, folder=folder)
            assert as_dict(found.collect()) == by_counting(rows, labels), number
    counters = fa.stream_counters(spark, str(path), known, batches=10, folder=folder)
    shuffled = fa.stream_counters(spark, str(path), known, broadcast_labels=0)
    assert sorted(map(tuple, counters.collect())) == sorted(map(tuple, shuffled.collect())) and counters.filter("n < 1").isEmpty()
    assert as_dict(fa.filter_audit(spark, str(path), known, batches=1, texts_per_state=1).collect()) == by_counting(rows, labels)


def test_repeats_are_reduced_before_the_shuffle(spark):
    rows = spark.range(5_000).selectExpr("id", "'p' AS part", "unhex('00ff') AS key", "0 AS mask", "0 AS quality", "0 AS toxic").coalesce(2)
    sent = rows.mapInPandas(fa._by_text, fa._TEXTS).collect()
    assert len(sent) <= 4 and sorted(r["id"] for r in sent)[0] == 0


def test_empty_table(spark, tmp_path):
    write(spark, tmp_path / "docs", [], DOCS)
    assert fa.filter_audit(spark, str(tmp_path / "docs"), spark.createDataFrame([], LABELS)).collect() == []


@pytest.mark.parametrize("text, bits", [("A", "AC"), ("x y " * 150, "AB"), ("é " * 101 + "É", "AB"), ("a|b", "AD"), ("", "A")])
def test_filters(spark, text, bits):
    seen = fa.Text(text)
    assert "".join(k for k, fails in fa.FILTERS.items() if fails(seen)) == bits
