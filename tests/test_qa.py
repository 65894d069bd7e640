import random

import pytest
from pyspark.sql import functions as F

from tabloom.functions import spans
from tabloom.operators import flatten, windows
from tabloom.operators.flatten import NESTED_QA, flatten_qa
from tabloom.plans import qa_samples


def text_of(n, seed=0):
    source = random.Random(seed)
    return "".join(source.choice("abcdé 𝄞\n") for _ in range(n))


def followed_windows(text, size, stride):
    """All windows that end before the last character, from the definition."""
    starts = [s for s in range(0, len(text), stride) if s + size < len(text)]
    return [(s, s + size, text[s : s + size]) for s in starts]


@pytest.mark.parametrize("length, expected", [(4096, 0), (4097, 1), (6144, 1), (6145, 2), (8193, 3), (0, 0), (1, 0)])
def test_window_counts(spark, length, expected):
    df = spark.createDataFrame([(length,)], "n int")
    assert df.select(spans.window_count(F.col("n"), keep_tail=False).alias("c")).first().c == expected


@pytest.mark.parametrize("size, stride", [(8, 4), (7, 3), (5, 5), (4, 6)])
def test_windows_without_the_tail(spark, size, stride):
    texts = [(i, text_of(n, i)) for i, n in enumerate([0, 1, 3, 4, 5, 7, 8, 9, 12, 13, 20, 41, 64, 65])]
    df = spark.createDataFrame(texts, "id long, text string")
    got = windows.char_windows(df, "text", size, stride, keep_tail=False).orderBy("id", "window_no").collect()
    expected = [(i, *w) for i, t in texts for w in followed_windows(t, size, stride)]
    assert [(r.id, r.win_start, r.win_end, r.source) for r in got] == expected


def test_keep_tail_covers_the_text(spark):
    texts = [(i, text_of(n, i)) for i, n in enumerate([0, 1, 7, 8, 9, 12, 13, 30])]
    df = spark.createDataFrame(texts, "id long, text string")
    rows = windows.char_windows(df, "text", 8, 4, keep_tail=True).collect()
    for i, text in texts:
        covered = set()
        for r in rows:
            if r.id == i:
                assert text[r.win_start : r.win_end] == r.source
                covered |= set(range(r.win_start, r.win_end))
        assert covered == set(range(len(text)))
    bounds = windows.window_bounds(df.withColumn("n_chars", F.length("text")), size=8, stride=4, keep_tail=True)
    assert {(r.id, r.win_start, r.win_end) for r in bounds.collect()} == {(r.id, r.win_start, r.win_end) for r in rows}


@pytest.mark.parametrize(
    "answer, expected",
    [
        ((5, 12), (0, 2)),
        ((5, 25), (0, 10)),
        ((12, 15), (2, 5)),
        ((15, 25), (5, 10)),
        ((10, 14), (0, 4)),
        ((5, 20), (0, 10)),
        ((5, 10), None),
        ((20, 22), None),
    ],
)
def test_label_and_clip(spark, answer, expected):
    df = spark.createDataFrame([(*answer, 10, 20)], "span_start long, span_end long, win_start long, win_end long")
    row = windows.clip_spans(windows.label_spans(df)).first()
    assert row.type == (windows.POSITIVE if expected else windows.POSSIBLE_NEGATIVE)
    assert (row.answer_start, row.answer_end) == (expected or (0, 0))


def nested(spark, entries):
    return spark.createDataFrame([(entries,)], flatten.NESTED_QA)


def paragraph(context, *questions):
    return (context, [(q, impossible, answers) for q, impossible, answers in questions])


def test_flatten_keeps_questions_with_their_paragraph(spark):
    df = nested(
        spark,
        [("t", [paragraph("one", ("q1", True, [])), paragraph("two", ("q2", False, [("w", 1)]))]), ("empty", [])],
    )
    rows = flatten.flatten_qa(df).orderBy("context").collect()
    assert [(r.title, r.context, r.question, r.is_impossible) for r in rows] == [
        ("t", "one", "q1", True),
        ("t", "two", "q2", False),
    ]


def test_null_flag_is_in_neither_branch(spark):
    qa = flatten.flatten_qa(nested(spark, [("t", [paragraph("c", ("q", None, []))])]))
    yes, no = flatten.split_answerable(qa)
    assert yes.count() == 0 and no.count() == 0


def test_quota_rounds_half_up(spark):
    counts = spark.createDataFrame([("a", "q", 2), ("b", "q", 3)], "title string, question string, positives long")
    row = qa_samples.question_quota(counts).first()
    assert (row.question_count, row.title_count, row.quota) == (5, 2, 3)


def covering_windows(text, size, stride):
    """Windows from the definition: as few as reach the last character, the last one cut there."""
    count = 0 if not text else 1 + max(0, -(-(len(text) - size) // stride))
    return [(k * stride, min(k * stride + size, len(text)), text[k * stride : k * stride + size]) for k in range(count)]


def brute_samples(qa, size, stride):
    """(positives, impossible counts, possible counts) by plain loops over the collected rows."""
    positives, pair_counts = [], {}
    for r in qa:
        if r.is_impossible is False:
            for answer in r.answers:
                a, b = answer.answer_start, answer.answer_start + len(answer.text)
                for s, e, source in covering_windows(r.context, size, stride):
                    if a < e and b > s:
                        positives.append((source, r.question, max(a, s) - s, min(b, e) - s))
                        pair_counts[(r.title, r.question)] = pair_counts.get((r.title, r.question), 0) + 1
    quota = {}
    for question in {q for _, q in pair_counts}:
        counts = [n for (_, q), n in pair_counts.items() if q == question]
        quota[question] = int(sum(counts) / len(counts) + 0.5)
    impossible, possible = {}, {}
    for r in qa:
        for s, e, source in covering_windows(r.context, size, stride):
            if r.is_impossible and r.question in quota:
                impossible.setdefault((r.title, r.question), set()).add(source)
            if r.is_impossible is False and (r.title, r.question) in pair_counts:
                for answer in r.answers:
                    a, b = answer.answer_start, answer.answer_start + len(answer.text)
                    if not (a < e and b > s):
                        possible.setdefault((r.title, r.question), set()).add(source)
    wanted = [(v, min(len(v), quota[k[1]]), k) for k, v in impossible.items()]
    wanted += [(v, min(len(v), pair_counts[k]), k) for k, v in possible.items()]
    return positives, wanted


def test_samples_equal_plain_loops(spark):
    source = random.Random(3)
    entries = []
    for t in range(4):
        paragraphs = []
        for p in range(3):
            context = text_of(source.choice([5, 20, 60, 90]), t * 10 + p)
            questions = []
            for q in range(3):
                answers = []
                for _ in range(source.choice([0, 1, 2])):
                    start = source.randrange(len(context))
                    answers.append((context[start : start + source.choice([0, 1, 4, 30])], start))
                questions.append((f"q{q}", source.random() < 0.4, answers))
            paragraphs.append(paragraph(context, *questions))
        entries.append((f"t{t % 3}", paragraphs))
    qa = flatten.flatten_qa(nested(spark, entries))
    size, stride = 16, 8
    positives, wanted = brute_samples(qa.collect(), size, stride)
    assert positives
    got = qa_samples.positive_samples(qa, size, stride)
    assert sorted(map(tuple, got.select(*qa_samples.SAMPLE_COLUMNS).collect())) == sorted(positives)
    counts = qa_samples.positive_counts(qa, size, stride)
    chosen = qa_samples.choose_negatives(qa, counts, size, stride)
    negatives = qa_samples.cut_negatives(qa, chosen, size, stride).collect()
    assert len(negatives) == sum(n for _, n, _ in wanted)
    for row in negatives:
        assert (row.answer_start, row.answer_end) == (0, 0)
        assert any(row.source in texts for texts, _, key in wanted if key == (row.title, row.question))
    whole = qa_samples.build_samples(qa, size, stride)
    assert whole.count() == len(positives) + len(negatives)


def test_flagship_plan_has_no_python_and_no_cross_join(spark):
    import __spark_entry__ as contract

    plan = contract.entry(spark)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def forty_questions(spark):
    questions = [
        (f"q{k}", k % 3 == 0, [(f"a{k}", 7 * k), ("z", 40)] if k % 3 else []) for k in range(40)
    ]
    entries = [([(f"t{n % 2}", [("lorem ipsum %d " % n * 30, questions), ("short", questions[:3])])],) for n in range(4)]
    return spark.createDataFrame(entries, NESTED_QA)


def test_windows_are_hashed_once_per_paragraph(spark):
    """The digests stand below the node that opens the questions, and nowhere above it."""
    qa = flatten_qa(forty_questions(spark), (64, 32, True))
    plan = qa_samples.negative_candidates(qa, 64, 32)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    hashing = [n for n, line in enumerate(plan) if "md5" in line and "regexp_extract_all" in line]
    opening = [n for n, line in enumerate(plan) if "inline(qas" in line]
    assert len(hashing) == 1 and len(opening) == 1 and hashing[0] > opening[0]  # children are printed below


@pytest.mark.parametrize("keep_tail", [True, False])
def test_same_candidates_with_digests_made_before(spark, keep_tail):
    nested = forty_questions(spark)
    before, after = flatten_qa(nested, (64, 32, keep_tail)), flatten_qa(nested)
    rows = [sorted(map(str, qa_samples.negative_candidates(qa, 64, 32, keep_tail).collect())) for qa in (before, after)]
    assert rows[0] == rows[1] and len(rows[0]) > 200
    samples = [sorted(map(str, qa_samples.build_samples(qa, 64, 32, keep_tail).collect())) for qa in (before, after)]
    assert samples[0] == samples[1]


def test_candidates_are_joined_with_their_limits_once(spark):
    qa = flatten_qa(forty_questions(spark), (64, 32, True))
    counts = qa_samples.cut_lineage(qa_samples.positive_counts(qa, 64, 32))
    limits = qa_samples.pair_limits(qa, counts)
    rows = {(r["title"], r["question"]): (r["quota"], r["positives"]) for r in limits.collect()}
    assert all(q is not None for q, _ in rows.values())
    assert "BroadcastHashJoin" in qa_samples.choose_negatives(qa, counts, 64, 32)._jdf.queryExecution().executedPlan().toString()
