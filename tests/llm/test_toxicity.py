"""Toxicity: held-out accuracy, located sentences, odd rows."""

import numpy as np
import pytest

from tabloom.llm import toxicity as tox
from tabloom.llm.common import table

FOLDER = "/root/testdata/sf0.1"
SCHEMA = "doc_id bigint, text string, score string, toxic int"


def test_noisy_or_is_the_product_of_the_others():
    logits = np.array([-3.0, 0.2, 1.7])
    assert np.isclose(tox.noisy_or(logits), 1 - np.prod(1 - 1 / (1 + np.exp(-logits))))
    assert 0 < tox.noisy_or(np.array([-30.0])) < 1e-12
    assert tox.noisy_or(np.array([500.0, 500.0])) == 1.0


def test_words_fall_into_the_sentences_of_the_text():
    text = "One two. Three!\n\nfour 5 FIVE"
    assert tox.sentence_words(text) == [["one", "two"], ["three"], [], [], ["four", "five"]]
    pieces = [m.group() for m in tox._SENTENCE.finditer(text)]
    assert "".join(pieces) == text and len(pieces) == 5


def test_sentence_scores_are_sums_of_word_weights():
    model = tox.SentenceModel(np.zeros(tox.DIMENSIONS, np.float32), -2.0, -9.0)
    for feature in tox.word_features("horrid"):
        model.weights[feature] += 1.5
    logits = model.sentence_logits("nice day. Horrid day, horrid!", model.words())
    each = 1.5 * len(tox.word_features("horrid"))
    assert np.allclose(logits, [-9, -2 + 2 * each, -9])


def test_slope_of_the_noisy_or_likelihood():
    """The step of the fit follows the numeric derivative of the negative log-likelihood in the sentence logits."""
    z = np.array([-1.0, 0.5, -2.0])
    for toxic in (0, 1):
        def loss(v):
            p = tox.noisy_or(v)
            return -np.log(p) if toxic else -np.log1p(-p)

        total = tox._softplus(z).sum()
        own = (-1 / np.expm1(total) if toxic else 1.0) * tox._sigmoid(z)
        step = np.array([(loss(z + d) - loss(z - d)) / 2e-6 for d in 1e-6 * np.eye(3)])
        assert np.allclose(own, step, atol=1e-6)


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    found = tox.toxicity_scores(docs, labels)
    return found.join(docs.select("doc_id", "text"), "doc_id").join(labels, "doc_id", "left").toPandas()


def test_held_out_documents(scored):
    assert len(scored) == 10_000 and scored["score"].between(0, 1).all()
    held = scored[scored["held_out"] & scored["toxic"].notna()]
    toxic, clean = held[held["toxic"] == 1], held[held["toxic"] == 0]
    assert len(toxic) > 80 and (toxic["predicted"] == 1).mean() > 0.85
    assert (clean["predicted"] == 0).mean() > 0.985
    wins = (toxic["score"].to_numpy()[:, None] > clean["score"].to_numpy()[None, :]).mean()
    assert wins > 0.97


def test_located_sentences_hold_the_offence(scored):
    found = scored[(scored["sentences"].map(len) > 0) & (scored["toxic"] == 1) & scored["held_out"]]
    assert len(found) > 30
    words = []
    for text, sentences in zip(found["text"], found["sentences"]):
        for s in sentences:
            piece = text[s["start"] : s["start"] + s["length"]]
            assert piece and s["score"] >= tox.DECISION
            words.append(len(piece.split()))
    assert np.median(words) < 40  # sentences, not documents


def test_odd_rows(spark):
    rows = [(1, None, "a", 9), (2, "", "b", 9), (None, "Quite nice.", "c", 9), (3, "x " * 300_000 + "awful thing.", None, 9), (3, "same", "d", 1), (3, "same", "d", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    known = [(k, k % 2, k % 2) for k in range(10, 200)]
    train = spark.createDataFrame([(k, "awful thing here." if k % 2 else "good thing here.", "e", 0) for k, _, _ in known], SCHEMA)
    labels = spark.createDataFrame([*known, (None, 1, 1), (11, 0, None), (12, 0, 5)], "doc_id bigint, quality int, toxic int")
    found = tox.toxicity_scores(docs.unionByName(train), labels).toPandas()
    assert len(found) == 196 and found["score"].notna().all()
    by_id = {r.doc_id: r for r in found[found["doc_id"] < 5].itertuples()}
    assert by_id[1].score == by_id[2].score < 0.1
    assert found[found["doc_id"].isna()]["held_out"].tolist() == [True]
    assert sorted(found[found["doc_id"] == 3]["predicted"]) == [0, 0, 1]
    hit = found[(found["doc_id"] == 3) & (found["predicted"] == 1)]["sentences"].iloc[0]
    assert len(hit) == 1 and hit[0]["length"] == 600_012


def test_empty_tables_and_missing_labels(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert tox.toxicity_scores(docs, labels).count() == 0
    some = spark.createDataFrame([(1, "text", "", 0)], SCHEMA)
    row = tox.toxicity_scores(some, labels).first()
    assert row["score"] < 0.001 and row["predicted"] == 0
