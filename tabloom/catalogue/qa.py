"""Windows, answer spans, balancing and QA samples on the documents table.

Mapping: title = source, question = lang, context = text. A document whose text
opens with a plain capital vowel counts as unanswerable. Every other document
has two answers of 120 characters, at (doc_id * 997) % n and (doc_id * 131) % n
for a text of n characters, cut at the end of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.catalogue.common import spread_table
from tabloom.operators import grouping, windows
from tabloom.operators.flatten import explode_answers, flatten_qa, split_answerable
from tabloom.operators.ranking import first_n_per_group
from tabloom.plans import qa_samples
from tabloom.session import cut_lineage

SIZE, STRIDE = 512, 256


def nested_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents in the nested question-answer shape, one `data` entry each."""
    docs = spread_table(spark, folder, "documents", "doc_id")
    length = F.length("text")

    def answer(factor: int):
        start = (F.col("doc_id") * factor) % length
        return F.struct(
            F.substring("text", start.cast("int") + 1, F.lit(120)).alias("text"),
            start.cast("long").alias("answer_start"),
        )

    question = F.struct(
        F.col("lang").alias("question"),
        F.substring("text", 1, 1).isin("A", "E", "I", "O", "U").alias("is_impossible"),
        F.array(answer(997), answer(131)).alias("answers"),
    )
    paragraph = F.struct(F.col("text").alias("context"), F.array(question).alias("qas"))
    entry = F.struct(F.col("source").alias("title"), F.array(paragraph).alias("paragraphs"))
    return docs.select(F.array(entry).alias("data"))


def document_qa(spark: SparkSession, folder: str) -> DataFrame:
    return flatten_qa(nested_documents(spark, folder), (SIZE, STRIDE, True))


def _doc_windows(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "doc_id", "text")
    return windows.char_windows(docs, "text", SIZE, STRIDE)


def _whole_windows(spark, folder):
    """Only windows that a character follows: the end of a text is left out, as an option."""
    docs = spread_table(spark, folder, "documents", "doc_id", "doc_id", "text")
    return windows.char_windows(docs, "text", SIZE, STRIDE, keep_tail=False)


def _span_pairs(spark, folder):
    """(answer, window) pairs of the answerable questions, offsets only."""
    answerable, _ = split_answerable(document_qa(spark, folder))
    answers = explode_answers(answerable.withColumn("n", F.length("context"))).drop("context", "text")
    return windows.label_spans(windows.window_bounds(answers, "n", SIZE, STRIDE))


def qa_flatten(spark, folder):
    qa = document_qa(spark, folder)
    return qa.select(
        "title",
        "context",
        "question",
        "is_impossible",
        F.element_at("answers", 1)["answer_start"].alias("first_start"),
        F.element_at("answers", 2)["answer_start"].alias("second_start"),
        F.element_at("answers", 2)["text"].alias("second_text"),
    )


def qa_answerable_split(spark, folder):
    yes, no = split_answerable(document_qa(spark, folder))
    return grouping.group_count(
        yes.withColumn("part", F.lit("answerable")).unionByName(no.withColumn("part", F.lit("unanswerable"))),
        ["part", "question"],
        "questions",
    )


def span_label(spark, folder):
    return _span_pairs(spark, folder).select("title", "question", "span_start", "win_start", "win_end", "type")


def span_clip(spark, folder):
    clipped = windows.clip_spans(_span_pairs(spark, folder))
    return clipped.select("title", "question", "span_start", "win_start", "type", "answer_start", "answer_end")


def group_count(spark, folder):
    positives = qa_samples.positive_samples(document_qa(spark, folder), SIZE, STRIDE)
    return grouping.group_count(positives, ["title", "question"], "positives")


def group_count_distinct(spark, folder):
    positives = qa_samples.positive_samples(document_qa(spark, folder), SIZE, STRIDE)
    return grouping.group_count_distinct(positives, ["question"], "title", "titles")


def question_quota(spark, folder):
    return qa_samples.question_quota(qa_samples.positive_counts(document_qa(spark, folder), SIZE, STRIDE))


def _negatives(spark, folder, impossible):
    qa = document_qa(spark, folder)
    counts = cut_lineage(qa_samples.positive_counts(qa, SIZE, STRIDE))
    wanted = qa.filter(F.col("is_impossible") == impossible)
    return qa_samples.cut_negatives(qa, qa_samples.choose_negatives(wanted, counts, SIZE, STRIDE), SIZE, STRIDE)


def balance_impossible(spark, folder):
    return _negatives(spark, folder, True)


def balance_possible(spark, folder):
    return _negatives(spark, folder, False)


def samples(spark, folder):
    return qa_samples.build_samples(document_qa(spark, folder), SIZE, STRIDE)


def first_n(spark, folder):
    """Up to five windows of each document, by the hash order of their texts."""
    distinct = _doc_windows(spark, folder).select("doc_id", "source").distinct()
    return first_n_per_group(distinct, ["doc_id"], ["source"], 5)



_DOCS = """
docs AS (
  SELECT doc_id, source AS title, lang AS question, text AS context, length(text) AS n,
         substr(text, 1, 1) IN ('A', 'E', 'I', 'O', 'U') AS is_impossible
  FROM documents),
wins AS (
  SELECT doc_id, title, question, is_impossible, n, k, k * 256 AS win_start, least(k * 256 + 512, n) AS win_end,
         substr(context, k * 256 + 1, 512) AS source
  FROM (SELECT *, unnest(range(CASE WHEN n > 512 THEN (n - 512 + 255) // 256 + 1 WHEN n > 0 THEN 1 ELSE 0 END)) AS k FROM docs)),
answers AS (
  SELECT doc_id, (doc_id * 997) % n AS a, least((doc_id * 997) % n + 120, n) AS b FROM docs WHERE NOT is_impossible
  UNION ALL
  SELECT doc_id, (doc_id * 131) % n AS a, least((doc_id * 131) % n + 120, n) AS b FROM docs WHERE NOT is_impossible),
pairs AS (
  SELECT w.*, a, b, a < win_end AND b > win_start AS hit FROM wins w JOIN answers USING (doc_id)),
pair_counts AS (
  SELECT title, question, count(*) AS positives FROM pairs WHERE hit GROUP BY ALL),
quota AS (
  SELECT question, CAST(sum(positives) AS BIGINT) AS question_count, count(*) AS title_count,
         CAST(round(sum(positives) / count(*), 0) AS INTEGER) AS quota
  FROM pair_counts GROUP BY question),
impossible AS (
  SELECT title, question, source FROM (
    SELECT *, row_number() OVER (PARTITION BY title, question ORDER BY md5(md5(source))) AS r
    FROM (SELECT DISTINCT title, question, source FROM wins WHERE is_impossible))
  JOIN quota USING (question) WHERE r <= quota),
possible AS (
  SELECT title, question, source FROM (
    SELECT *, row_number() OVER (PARTITION BY title, question ORDER BY md5(md5(source))) AS r
    FROM (SELECT DISTINCT title, question, source FROM pairs WHERE NOT hit))
  JOIN pair_counts USING (title, question) WHERE r <= positives),
positive AS (
  SELECT title, question, source, greatest(a, win_start) - win_start AS answer_start,
         least(b, win_end) - win_start AS answer_end
  FROM pairs WHERE hit)
"""

QUERIES = {
    "qa_flatten": qa_flatten,
    "qa_answerable_split": qa_answerable_split,
    "char_windows": _doc_windows,
    "char_windows_whole_only": _whole_windows,
    "span_label": span_label,
    "span_clip": span_clip,
    "group_count": group_count,
    "group_count_distinct": group_count_distinct,
    "question_quota": question_quota,
    "first_n_per_group": first_n,
    "balance_impossible": balance_impossible,
    "balance_possible": balance_possible,
    "qa_samples": samples,
}

SQL = {
    "qa_flatten": """
        SELECT source AS title, text AS context, lang AS question,
               substr(text, 1, 1) IN ('A', 'E', 'I', 'O', 'U') AS is_impossible,
               (doc_id * 997) % length(text) AS first_start, (doc_id * 131) % length(text) AS second_start,
               substr(text, (doc_id * 131) % length(text) + 1, 120) AS second_text
        FROM documents""",
    "qa_answerable_split": f"""
        WITH {_DOCS} SELECT CASE WHEN is_impossible THEN 'unanswerable' ELSE 'answerable' END AS part, question,
        count(*) AS questions FROM docs GROUP BY ALL""",
    "char_windows": f"WITH {_DOCS} SELECT doc_id, CAST(k AS INTEGER) AS window_no, win_start, win_end, source FROM wins",
    "char_windows_whole_only": """
        SELECT doc_id, CAST(k AS INTEGER) AS window_no, k * 256 AS win_start, k * 256 + 512 AS win_end,
               substr(text, k * 256 + 1, 512) AS source
        FROM (SELECT *, unnest(range(CASE WHEN length(text) > 512 THEN (length(text) - 513) // 256 + 1 ELSE 0 END)) AS k FROM documents)""",
    "span_label": f"""
        WITH {_DOCS} SELECT title, question, a AS span_start, win_start, win_end,
        CASE WHEN hit THEN 'positive' ELSE 'possible negative' END AS type FROM pairs""",
    "span_clip": f"""
        WITH {_DOCS} SELECT title, question, a AS span_start, win_start,
        CASE WHEN hit THEN 'positive' ELSE 'possible negative' END AS type,
        CASE WHEN hit THEN greatest(a, win_start) - win_start ELSE 0 END AS answer_start,
        CASE WHEN hit THEN least(b, win_end) - win_start ELSE 0 END AS answer_end FROM pairs""",
    "group_count": f"WITH {_DOCS} SELECT title, question, positives FROM pair_counts",
    "group_count_distinct": f"WITH {_DOCS} SELECT question, count(DISTINCT title) AS titles FROM positive GROUP BY question",
    "question_quota": f"WITH {_DOCS} SELECT * FROM quota",
    "first_n_per_group": f"""
        WITH {_DOCS} SELECT doc_id, source FROM (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY md5(source)) AS r
          FROM (SELECT DISTINCT doc_id, source FROM wins)) WHERE r <= 5""",
    "balance_impossible": f"""
        WITH {_DOCS} SELECT title, question, source, CAST(0 AS BIGINT) AS answer_start,
        CAST(0 AS BIGINT) AS answer_end FROM impossible""",
    "balance_possible": f"""
        WITH {_DOCS} SELECT title, question, source, CAST(0 AS BIGINT) AS answer_start,
        CAST(0 AS BIGINT) AS answer_end FROM possible""",
    "qa_samples": f"""
        WITH {_DOCS} SELECT source, question, answer_start, answer_end FROM positive
        UNION ALL SELECT source, question, 0, 0 FROM impossible
        UNION ALL SELECT source, question, 0, 0 FROM possible""",
}
