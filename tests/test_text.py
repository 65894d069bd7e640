import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tabloom.functions import text, vectors
from tabloom.operators import vocabulary as voc


def one(spark, value, rule):
    return spark.createDataFrame([(value,)], "t string").select(rule(F.col("t")).alias("r")).first().r


def capped(word):
    return "".join(c * min(3, len(list(run))) for c, run in groupby(word))


def test_cap_runs_keeps_three_of_each_run(spark):
    source = random.Random(1)
    words = ["wowwwwwwww"] + ["".join(source.choice("ab\n𝄞") for _ in range(source.randrange(30))) for _ in range(200)]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    got = [r.r for r in df.select(text.cap_runs(F.col("t")).alias("r")).collect()]
    assert got == [capped(w) for w in words]
    assert got[0] == "wowww"


def test_strip_equals_python(spark):
    source = random.Random(2)
    alphabet = "ab \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0    　​"
    words = ["".join(source.choice(alphabet) for _ in range(source.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    rows = df.select(
        text.strip(F.col("t")).alias("s"), text.split_words(F.col("t")).alias("w"), text.split_spaces(F.col("t")).alias("p")
    ).collect()
    assert [r.s for r in rows] == [w.strip() for w in words]
    assert [r.w for r in rows] == [w.split() for w in words]
    assert [r.p for r in rows] == [w.split(" ") for w in words]


@pytest.mark.parametrize(
    "page, words",
    [
        ("<b>Bold</b> text", ["bold", "text"]),
        ("a<br>b", ["ab"]),
        ("one < two and three > four", ["one", "four"]),
        ("x<>y", ["x", "y"]),
        ("It's Nature's", ["it", "nature"]),
        ("one\ntwo\tthree", ["onetwothree"]),
        ("menu Gameplay[]Playstyle real words", ["real", "words"]),
        ("room 101 b2b", ["room", "bb"]),
        ("History[edit] kept", ["history", "edit", "kept"]),
        ("History[] kept", ["kept"]),
        ("well-known", ["wellknown"]),
        ("stop! go, now?", ["stop", "go", "now"]),
        ("snake_case", ["snake_case"]),
        ("body NewPP limit report", ["body"]),
        ("Été ß", ["été", "ß"]),
        ("<i>A</i>  -  <i>B's</i> [] 7 end", ["a", "b", "end"]),
        ("", [""]),
        ("<p></p>", [""]),
    ],
)
def test_page_words(spark, page, words):
    assert one(spark, page, text.html_words) == words


def test_small_rules(spark):
    assert one(spark, "a  b", text.tag_list) == ["a", "", "b"]
    assert one(spark, "Nature's Prophet", text.slug) == "Nature%27s_Prophet"
    assert one(spark, "abcabc", lambda c: text.position_of(c, "ca")) == 2
    assert one(spark, "abc", lambda c: text.position_of(c, "x")) is None
    assert one(spark, "the cat the", lambda c: text.remove_words(F.split(c, " "), ["the"])) == ["cat"]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    row = df.select(
        vectors.dot(a, b).alias("d"), vectors.scaled_dot(a, b).alias("s"), vectors.cosine(a, b).alias("c"),
        vectors.one_hot(F.lit(1), 3).alias("h"),
    ).first()
    assert (row.d, round(row.s, 6), round(row.c, 6), row.h) == (24.0, round(24 / 2**0.5, 6), 0.96, [0.0, 1.0, 0.0])


def words_frame(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def known_frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, freq long")


def test_spelling_examples(spark):
    known = known_frame(spark, {"cheese": 2})
    got = dict(voc.spelling_fixes(words_frame(spark, ["ccheese", "chesee", "cheesf", "chese", "xy"]), known).collect())
    assert got == {"ccheese": "cheese", "chesee": "cheese", "chese": "cheese"}
    assert voc.spelling_fixes(words_frame(spark, ["chee", "hee"]), known_frame(spark, {"che": 1, "he": 1})).collect() == [
        ("chee", "che")
    ]


def one_edit(a, b):
    """One insertion, one deletion or one swap of neighbours apart."""
    if len(a) == len(b):
        places = [i for i in range(len(a)) if a[i] != b[i]]
        return len(places) == 2 and places[1] == places[0] + 1 and a[places[0]] == b[places[1]] and a[places[1]] == b[places[0]]
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def test_spelling_equals_comparing_every_pair(spark):
    source = random.Random(5)

    def short():
        return "".join(source.choice("abc") for _ in range(source.choice([3, 4, 5])))

    def long():
        letters, i = list("ab" * 20), source.randrange(39)
        edit = source.choice(["cut", "put", "swap", "change"])
        if edit == "cut":
            del letters[i]
        elif edit == "put":
            letters.insert(i, "c")
        else:
            letters[i : i + 2] = [letters[i + 1], letters[i]] if edit == "swap" else ["c", letters[i + 1]]
        return "".join(letters)

    known = {short(): source.randrange(5) for _ in range(40)} | {"ab" * 20: 1, long(): 2}
    strange = {short() for _ in range(100)} | {long() for _ in range(60)}
    strange -= set(known)
    expected = {}
    for w in strange:
        fits = sorted((-n, k) for k, n in known.items() if one_edit(w, k)) if len(w) > 3 else []
        if fits:
            expected[w] = fits[0][1]
    assert any(len(w) > 32 for w in expected)
    got = dict(voc.spelling_fixes(words_frame(spark, list(strange) + list(known)), known_frame(spark, known)).collect())
    assert got == expected


def test_spelling_compares_no_pairs(spark):
    fixes = voc.spelling_fixes(words_frame(spark, ["abcd"]), known_frame(spark, {"abc": 1}))
    plan = fixes._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_first_seen(spark):
    rows = [(0, 0, "NOUN"), (0, 1, "PRN"), (1, 0, "VERB"), (1, 1, "NOUN")]
    df = spark.createDataFrame(rows, "doc long, pos int, mark string")
    assert dict(voc.first_seen_index(df, "mark", ["doc", "pos"]).collect()) == {"NOUN": 0, "PRN": 1, "VERB": 2}
    fixed = dict(voc.first_seen_index(df, "mark", ["doc", "pos"], (voc.START, voc.STOP)).collect())
    assert fixed == {"<START>": 0, "<STOP>": 1, "NOUN": 2, "PRN": 3, "VERB": 4}


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_token_index_with_a_word_that_is_most_of_the_text(spark, broadcast):
    sentences = [(i, ["the"] * (i % 7 + 1) + [f"w{i % 50}"] + (["new"] if i % 3 == 0 else [])) for i in range(300)]
    df = spark.createDataFrame(sentences, "id long, tokens array<string>")
    tokens = voc.token_rows(df, F.col("tokens"), ["id"])
    dictionary = voc.vocabulary(tokens.filter("word <> 'new'")).cache()
    ids = {r.word: r.ix for r in dictionary.collect()}
    assert sorted(ids.values()) == list(range(len(ids))) and {"[PAD]", "[UNKNOWN]"} <= set(ids)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = voc.gather(voc.token_index(tokens, dictionary, ["id"]), ["id"], {"ixs": "ix"}).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {r.id: r.ixs for r in found} == {i: [ids.get(w, ids["[UNKNOWN]"]) for w in ws] for i, ws in sentences}
    dictionary.unpersist()


def test_embed_fills_missing_words(spark):
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    first = spark.createDataFrame([("a", [1.0, 2.0])], "word string, vec array<double>")
    second = spark.createDataFrame([("b", [3.0])], "word string, vec array<float>")
    got = {r.word: r.vector for r in voc.embed(words, "word", [(first, 2), (second, 1)]).collect()}
    assert got == {"a": [1.0, 2.0, 0.0], "b": [0.0, 0.0, 3.0]}


def test_one_vocabulary_over_splits(spark):
    from tabloom.operators import vocabulary as voc

    train = spark.createDataFrame([("a",), ("b",), ("a",)], "word string")
    valid = spark.createDataFrame([("b", 1), ("c", 2)], "word string, more int")
    both = voc.stack_splits({"train": train, "valid": valid})
    assert set(both.columns) == {"word", "split", "more"}
    rows = {r["word"]: r for r in voc.split_vocabulary(both, ["train", "valid"]).collect()}
    assert {w: (r["freq"], r["in_train"], r["in_valid"]) for w, r in rows.items()} == {
        "a": (2, 2, 0), "b": (2, 1, 1), "c": (1, 0, 1), voc.PAD: (0, 0, 0), voc.UNKNOWN: (0, 0, 0)
    }
    assert sorted(r["ix"] for r in rows.values()) == list(range(5))


def test_spelling_reads_the_texts_once_and_moves_short_keys(spark):
    """The unknown words are stored, not counted anew by each join, and variants meet by eight bytes."""
    words = spark.createDataFrame([("hose",), ("huose",), ("housee",), ("tree",)], "word string")
    known = spark.createDataFrame([("house", 3), ("tree", 2), ("horse", 1)], "word string, freq long")
    found = voc.spelling_fixes(words, known)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "md5" not in plan
    assert sorted(tuple(r) for r in found.collect()) == [("hose", "house"), ("housee", "house"), ("huose", "house")]
