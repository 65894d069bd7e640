import json

from pyspark.sql import functions as F

from tabloom.operators.flatten import flatten_qa
from tabloom.plans import qa_job
from tabloom.sources import readers, writers

DOCUMENT = {
    "data": [
        {
            "title": f"t{i}",
            "paragraphs": [
                {
                    "context": f"{i} abc déf " * 30,
                    "qas": [
                        {"question": "q", "is_impossible": i == 0, "answers": [] if i == 0 else [{"text": "abc", "answer_start": 2}]}
                    ],
                }
            ],
        }
        for i in range(3)
    ]
}


def test_nested_json_both_ways(spark, tmp_path):
    lines, whole = tmp_path / "lines.json", tmp_path / "whole.json"
    lines.write_text(json.dumps(DOCUMENT) + "\n")
    whole.write_text(json.dumps(DOCUMENT, indent=2))
    a = flatten_qa(readers.read_nested_qa(spark, str(lines))).collect()
    b = flatten_qa(readers.read_nested_qa(spark, str(whole), multiline=True)).collect()
    assert a == b and len(a) == 3
    assert [r.is_impossible for r in a] == [True, False, False]


def test_job_writes_samples(spark, tmp_path):
    source, target = tmp_path / "in.json", tmp_path / "out"
    source.write_text(json.dumps(DOCUMENT) + "\n")
    qa_job.run(spark, str(source), str(target), size=64, stride=32)
    rows = spark.read.json(str(target))
    assert sorted(rows.columns) == ["answer_end", "answer_start", "question", "source"]
    assert rows.filter("answer_end > 0").count() == 2
    assert rows.filter("answer_end = 0").count() >= 1


def test_csv_round_trip(spark, tmp_path):
    schema = "id long, job string, y int"
    df = spark.createDataFrame([(1, "a,b", 0), (2, None, 1)], schema)
    writers.write_predictions_csv(df, str(tmp_path / "c"))
    back = readers.read_csv(spark, str(tmp_path / "c"), schema)
    assert sorted(map(tuple, back.collect())) == [(1, "a,b", 0), (2, None, 1)]


def test_samples_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("é\n", "q", 0, 2)], "source string, question string, answer_start long, answer_end long")
    writers.write_samples_json(df, str(tmp_path / "j"))
    assert spark.read.schema(df.schema).json(str(tmp_path / "j")).collect() == df.collect()


def test_tag_lines_are_numbered_over_blocks(spark, tmp_path):
    path = tmp_path / "tags.txt"
    tags = [f"T{i}  NOUN" for i in range(2000)]
    path.write_text("\n".join(tags) + "\n")
    (tmp_path / "other.txt").write_text("A B\nC\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = readers.read_tag_lines(spark, [str(path), str(tmp_path / "other.txt")]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    big = sorted((r.line_no, r.tags) for r in rows if r.file.endswith("tags.txt"))
    assert big == [(i, [f"T{i}", "", "NOUN"]) for i in range(2000)]
    small = sorted((r.line_no, r.tags) for r in rows if r.file.endswith("other.txt"))
    assert small == [(0, ["A", "B"]), (1, ["C"])]


def test_pages(spark):
    pages = readers.read_pages(spark, "/root/testdata/sf0.001/pages.parquet")
    assert pages.columns == ["page_id", "url", "html"] and pages.filter(F.col("html").isNull()).count() == 0
