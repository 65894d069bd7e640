"""Tag sequences over the chat messages.

A sentence is one message; its tokens are the words in lower case. The tag of a
word is read off its form: ends in punctuation, opens with a capital, long, short.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalogue.common import SQL_SPACE, rounded, sql_strip, spread_table
from tabloom.functions import text
from tabloom.operators import features, learned_tags, sequence
from tabloom.session import cut_lineage

KEYS = ["conv_id", "turn"]


def tagged_messages(spark, folder):
    words = spread_table(spark, folder, "conversations", "conv_id").select(*KEYS, text.split_words(F.col("text")).alias("words"))

    def tag(w):
        return (
            F.when(w.endswith(".") | w.endswith(","), "PUNCT")
            .when(F.substring(w, 1, 1) != F.lower(F.substring(w, 1, 1)), "CAP")
            .when(F.length(w) > 6, "LONG")
            .otherwise("SHORT")
        )

    return words.filter(F.size("words") > 0).select(
        *KEYS, F.transform("words", lambda w: F.lower(w)).alias("tokens"), F.transform("words", tag).alias("tags")
    )


def _scored(spark, folder):
    """Messages with the scores of a tagger that was fitted on the same messages."""
    sentences = cut_lineage(tagged_messages(spark, folder))  # read by the counts of the tagger and twice by the look-up
    seen = cut_lineage(sequence.emissions(sentences))
    model = sequence.tagger(cut_lineage(sequence.transitions(sentences)), seen)
    return sequence.with_emissions(sentences, KEYS, seen, model)


def tag_transitions(spark, folder):
    found = sequence.transitions(tagged_messages(spark, folder))
    return found.select("prev", "tag", "n", rounded(F.col("score"), "score"))


def tag_emissions(spark, folder):
    found = sequence.emissions(tagged_messages(spark, folder))
    return found.select("tag", "word", "n", rounded(F.col("score"), "score"))


def path_score(spark, folder):
    return sequence.score_paths(_scored(spark, folder), KEYS).select(*KEYS, rounded(F.col("score"), "score", 4))


def viterbi_path(spark, folder):
    found = sequence.decode_paths(_scored(spark, folder), KEYS)
    return found.select(*KEYS, rounded(F.col("score"), "score", 4), F.array_join("path", " ").alias("path"))


def sequence_nll(spark, folder):
    found = sequence.negative_log_likelihood(_scored(spark, folder), KEYS)
    return found.select(*KEYS, rounded(F.col("nll"), "nll", 4))


def expected_tags(spark, folder):
    """Expected number of tokens under each tag, message by message, from the chances of the tagger."""
    scored = _scored(spark, folder)
    found = learned_tags.tag_marginals(scored, KEYS)
    by_tag = found.select(*KEYS, F.explode("marginals").alias("m")).select(*KEYS, F.posexplode("m").alias("at", "chance"))
    sums = by_tag.groupBy(*KEYS, "at").agg(F.sum("chance").alias("expected"))
    names = tagged_messages(spark, folder).select(F.explode("tags").alias("tag")).distinct().agg(F.array_sort(F.collect_list("tag")).alias("all"))
    return sums.withColumn("names", names.scalar()).select(*KEYS, F.get("names", F.col("at")).alias("tag"), rounded(F.col("expected"), "expected", 4))


def learned_tagger(spark, folder):
    """Tags and negative log-likelihood of every message by scores learned on the training messages."""
    messages = cut_lineage(features.hash_split(tagged_messages(spark, folder), "conv_id"))
    model = learned_tags.fit_tags(messages.filter("part = 'train'"), steps=15)
    scored = cut_lineage(learned_tags.with_learned_emissions(messages.withColumn("features", learned_tags.token_features("tokens")), model))
    kept = [*KEYS, "part"]
    nll = sequence.negative_log_likelihood(scored, kept)
    paths = sequence.decode_paths(scored, KEYS).select(*KEYS, F.array_join("path", " ").alias("path"))
    return nll.join(paths, KEYS).select(*kept, rounded(F.col("nll"), "nll", 2), "path")


QUERIES = {
    "tag_transitions": tag_transitions,
    "tag_emissions": tag_emissions,
    "path_score": path_score,
    "viterbi_path": viterbi_path,
    "sequence_nll": sequence_nll,
    "expected_tags": expected_tags,
    "learned_tagger": learned_tagger,
}

_BASE = f"""
    msgs AS (
      SELECT conv_id, turn, words FROM (
        SELECT conv_id, turn, list_filter(regexp_split_to_array({sql_strip('text')}, '{SQL_SPACE}+'), lambda t: t <> '') AS words
        FROM conversations) WHERE len(words) > 0),
    toks AS (
      SELECT conv_id, turn, pos, lower(w) AS word,
             CASE WHEN w LIKE '%.' OR w LIKE '%,' THEN 'PUNCT' WHEN w[1] <> lower(w[1]) THEN 'CAP'
                  WHEN length(w) > 6 THEN 'LONG' ELSE 'SHORT' END AS tag
      FROM (SELECT conv_id, turn, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS pos FROM msgs)),
    grams AS (
      SELECT *, lag(tag, 1, '<START>') OVER s AS prev, lead(tag) OVER s IS NULL AS final
      FROM toks WINDOW s AS (PARTITION BY conv_id, turn ORDER BY pos)),
    step_counts AS (
      SELECT prev, tag, count(*) AS n FROM (
        SELECT prev, tag FROM grams UNION ALL SELECT tag, '<STOP>' FROM grams WHERE final) GROUP BY ALL),
    inventory AS (SELECT DISTINCT tag FROM toks),
    steps AS (
      SELECT p.prev, t.tag, coalesce(n, 0) AS n,
             ln((coalesce(n, 0) + 1) / (coalesce(total, 0) + (SELECT count(*) + 1 FROM inventory))) AS score
      FROM (SELECT '<START>' AS prev UNION ALL SELECT tag FROM inventory) p,
           (SELECT '<STOP>' AS tag UNION ALL SELECT tag FROM inventory) t
      LEFT JOIN step_counts c ON c.prev = p.prev AND c.tag = t.tag
      LEFT JOIN (SELECT prev, sum(n) AS total FROM step_counts GROUP BY prev) s ON s.prev = p.prev),
    word_counts AS (SELECT tag, word, count(*) AS n FROM toks GROUP BY ALL),
    sizes AS (SELECT tag, sum(n) AS total, (SELECT count(DISTINCT word) + 1 FROM toks) AS v FROM word_counts GROUP BY tag),
    seen AS (SELECT tag, word, n, ln((n + 1) / (total + v)) AS score FROM word_counts JOIN sizes USING (tag))"""

_FOLD = f"""{_BASE},
    tag_list AS (SELECT list(tag ORDER BY tag) AS tags FROM inventory),
    model AS (
      SELECT tags,
        (SELECT list(score ORDER BY tag) FROM steps WHERE prev = '<START>' AND tag <> '<STOP>') AS start,
        (SELECT list(score ORDER BY prev) FROM steps WHERE tag = '<STOP>' AND prev <> '<START>') AS stop,
        (SELECT list(row ORDER BY tag) FROM (SELECT tag, list(score ORDER BY prev) AS row FROM steps
           WHERE prev <> '<START>' AND tag <> '<STOP>' GROUP BY tag)) AS step FROM tag_list),
    emits AS (
      SELECT conv_id, turn, pos, list(coalesce(seen.score, ln(1 / (total + v))) ORDER BY sizes.tag) AS e
      FROM (SELECT conv_id, turn, pos, word FROM toks) k CROSS JOIN sizes
      LEFT JOIN seen ON seen.word = k.word AND seen.tag = sizes.tag GROUP BY conv_id, turn, pos),
    ends AS (SELECT conv_id, turn, max(pos) AS last FROM toks GROUP BY ALL)"""

_SUMS = "list_transform(step, lambda row: list_transform(list_zip(row, score), lambda z: z[2] + z[1]))"

_LSE = "list_max({0}) + ln(list_sum(list_transform({0}, lambda x: exp(x - list_max({0})))))"

SQL = {
    "expected_tags": f"""
        WITH RECURSIVE {_FOLD},
        leaving AS (SELECT list(row ORDER BY prev) AS ahead FROM (SELECT prev, list(score ORDER BY tag) AS row FROM steps
                    WHERE prev <> '<START>' AND tag <> '<STOP>' GROUP BY prev)),
        walk AS (
          SELECT conv_id, turn, pos, list_transform(list_zip(start, e), lambda z: z[1] + z[2]) AS score
          FROM emits, model WHERE pos = 1
          UNION ALL
          SELECT conv_id, turn, pos, list_transform(list_zip(sums, e), lambda z: {_LSE.format("z[1]")} + z[2])
          FROM (SELECT w.conv_id, w.turn, n.pos, n.e, {_SUMS} AS sums
                FROM walk w JOIN emits n ON n.conv_id = w.conv_id AND n.turn = w.turn AND n.pos = w.pos + 1, model)),
        back AS (
          SELECT conv_id, turn, pos, e, stop AS beta FROM emits JOIN ends USING (conv_id, turn), model WHERE pos = last
          UNION ALL
          SELECT conv_id, turn, pos, e, list_transform(sums, lambda s: {_LSE.format("s")})
          FROM (SELECT b.conv_id, b.turn, n.pos, n.e, list_transform(ahead, lambda row: list_transform(list_zip(row, b.e, b.beta), lambda z: z[1] + z[2] + z[3])) AS sums
                FROM back b JOIN emits n ON n.conv_id = b.conv_id AND n.turn = b.turn AND n.pos = b.pos - 1, leaving)),
        ways AS (
          SELECT conv_id, turn, tags, list_transform(list_zip(w.score, b.beta), lambda z: z[1] + z[2]) AS s
          FROM walk w JOIN back b USING (conv_id, turn, pos), model),
        chances AS (SELECT conv_id, turn, unnest(tags) AS tag, unnest(list_transform(s, lambda x: exp(x - ({_LSE.format("s")})))) AS chance FROM ways)
        SELECT conv_id, turn, tag, round(sum(chance), 4) AS expected FROM chances GROUP BY conv_id, turn, tag""",
    "tag_transitions": f"WITH {_BASE} SELECT prev, tag, n, round(score, 6) AS score FROM steps",
    "tag_emissions": f"WITH {_BASE} SELECT tag, word, n, round(score, 6) AS score FROM seen",
    "path_score": f"""
        WITH {_BASE}
        SELECT conv_id, turn, round(sum(s.score + e.score + CASE WHEN final THEN f.score ELSE 0 END), 4) AS score
        FROM grams g JOIN steps s ON s.prev = g.prev AND s.tag = g.tag
        JOIN seen e ON e.tag = g.tag AND e.word = g.word
        JOIN steps f ON f.prev = g.tag AND f.tag = '<STOP>'
        GROUP BY conv_id, turn""",
    "viterbi_path": f"""
        WITH RECURSIVE {_FOLD},
        walk AS (
          SELECT conv_id, turn, pos, list_transform(list_zip(start, e), lambda z: z[1] + z[2]) AS score, tags AS path
          FROM emits, model WHERE pos = 1
          UNION ALL
          SELECT conv_id, turn, pos,
                 list_transform(list_zip(sums, e), lambda z: list_max(z[1]) + z[2]),
                 list_transform(list_zip(sums, tags), lambda z: path[list_position(z[1], list_max(z[1]))] || ' ' || z[2])
          FROM (SELECT w.conv_id, w.turn, n.pos, n.e, w.path, tags, {_SUMS} AS sums
                FROM walk w JOIN emits n ON n.conv_id = w.conv_id AND n.turn = w.turn AND n.pos = w.pos + 1, model))
        SELECT conv_id, turn, round(list_max(f), 4) AS score, path[list_position(f, list_max(f))] AS path
        FROM (SELECT w.*, list_transform(list_zip(score, stop), lambda z: z[1] + z[2]) AS f FROM walk w, model)
        JOIN ends USING (conv_id, turn) WHERE pos = last""",
    "sequence_nll": f"""
        WITH RECURSIVE {_FOLD},
        walk AS (
          SELECT conv_id, turn, pos, list_transform(list_zip(start, e), lambda z: z[1] + z[2]) AS score
          FROM emits, model WHERE pos = 1
          UNION ALL
          SELECT conv_id, turn, pos, list_transform(list_zip(sums, e), lambda z: list_max(z[1])
                   + ln(list_sum(list_transform(z[1], lambda x: exp(x - list_max(z[1]))))) + z[2])
          FROM (SELECT w.conv_id, w.turn, n.pos, n.e, {_SUMS} AS sums
                FROM walk w JOIN emits n ON n.conv_id = w.conv_id AND n.turn = w.turn AND n.pos = w.pos + 1, model)),
        gold AS (
          SELECT conv_id, turn, sum(s.score + e.score + CASE WHEN final THEN f.score ELSE 0 END) AS score
          FROM grams g JOIN steps s ON s.prev = g.prev AND s.tag = g.tag
          JOIN seen e ON e.tag = g.tag AND e.word = g.word
          JOIN steps f ON f.prev = g.tag AND f.tag = '<STOP>' GROUP BY conv_id, turn)
        SELECT conv_id, turn, round(list_max(f) + ln(list_sum(list_transform(f, lambda x: exp(x - list_max(f))))) - gold.score, 4) AS nll
        FROM (SELECT w.*, list_transform(list_zip(w.score, stop), lambda z: z[1] + z[2]) AS f FROM walk w, model)
        JOIN ends USING (conv_id, turn) JOIN gold USING (conv_id, turn) WHERE pos = last""",
}
