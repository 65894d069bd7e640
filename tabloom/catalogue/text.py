"""Text cleaning, vocabularies and look-ups over documents, conversations, pages and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalogue.common import SQL_SPACE, rounded, sql_cap, sql_normalise, sql_strip, spread_table, table
from tabloom.functions import text, vectors
from tabloom.operators import vocabulary as voc
from tabloom.session import cut_lineage

LINK = 'href="([^"]*)"'
STOPWORDS = ["the", "and", "of", "to", "in", "that", "is", "for", "la", "le", "les", "de", "der", "die", "und", "el"]
CHAT_KEYS = ["conv_id", "turn"]


def text_normalise(spark, folder):
    chat = spread_table(spark, folder, "conversations", "conv_id")
    return chat.select(*CHAT_KEYS, text.strip(text.collapse_spaces(F.lower("text"))).alias("text"))


def cap_runs(spark, folder):
    return spread_table(spark, folder, "documents", "doc_id").select("doc_id", text.cap_runs(F.col("text")).alias("text"))


def tokenise(spark, folder):
    chat = spread_table(spark, folder, "conversations", "conv_id")
    return chat.select(
        *CHAT_KEYS,
        F.array_join(text.split_spaces(text.normalise(F.col("text"))), "|").alias("tokens"),
        F.array_join(text.split_words(F.col("text")), "|").alias("words"),
    )


def substring_position(spark, folder):
    return spread_table(spark, folder, "documents", "doc_id").select("doc_id", text.position_of(F.col("text"), "the ").alias("place"))


def slugify(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", text.page_url(F.col("p_name"), "https://example.org/wiki/", "/Guide").alias("url")
    )


def page_links(spark, folder):
    pages = spread_table(spark, folder, "pages", "page_id")
    return pages.select("page_id", F.posexplode(text.all_matches(F.col("html"), LINK)).alias("pos", "link"))


def html_words(spark, folder):
    return voc.token_rows(spread_table(spark, folder, "pages", "page_id"), text.html_words(F.col("html")), ["page_id"])


def stopword_filter(spark, folder):
    chat = spread_table(spark, folder, "conversations", "conv_id")
    kept = text.remove_words(text.split_spaces(text.normalise(F.col("text"))), STOPWORDS)
    return chat.select(*CHAT_KEYS, F.array_join(kept, " ").alias("text"))


def _document_words(spark, folder):
    tokens = text.split_spaces(text.normalise(F.col("text")))
    return voc.token_rows(spread_table(spark, folder, "documents", "doc_id"), tokens, ["doc_id"])


def _chat_words(spark, folder):
    tokens = text.split_spaces(text.normalise(F.col("text")))
    return voc.token_rows(spread_table(spark, folder, "conversations", "conv_id"), tokens, CHAT_KEYS)


def document_vocabulary(spark, folder):
    return voc.vocabulary(_document_words(spark, folder))


def split_vocabulary(spark, folder):
    """One vocabulary over training texts (documents) and validation texts (messages)."""
    words = voc.stack_splits({"train": _document_words(spark, folder).select("word"), "valid": _chat_words(spark, folder).select("word")})
    return voc.split_vocabulary(words, ["train", "valid"])


def oov_tokens(spark, folder):
    known = _document_words(spark, folder).select("word").distinct()
    return voc.out_of_vocabulary(_chat_words(spark, folder), known)


def _event_tags(spark, folder):
    return table(spark, folder, "events").select(
        "user_id", F.to_date("ts").alias("day"), "ts", "event_id", F.col("event_type").alias("tag"),
        F.floor(F.col("value") / 10).alias("token"),
    )


def _tag_index(spark, folder):
    order = ["user_id", "day", "ts", "event_id"]
    return voc.first_seen_index(_event_tags(spark, folder), "tag", order, (voc.START, voc.STOP))


def first_seen_index(spark, folder):
    return _tag_index(spark, folder)


def mark_index(spark, folder):
    """First-seen index without fixed entries, over an open set of marks."""
    return voc.first_seen_index(_event_tags(spark, folder), "token", ["user_id", "day", "ts", "event_id"])


def token_index(spark, folder):
    dictionary = cut_lineage(document_vocabulary(spark, folder))
    indexed = voc.token_index(_chat_words(spark, folder), dictionary, CHAT_KEYS)
    arrays = voc.gather(indexed, CHAT_KEYS, {"indices": "ix"})
    return arrays.select(*CHAT_KEYS, F.array_join(F.col("indices").cast("array<string>"), " ").alias("indices"))


def decode_labels(spark, folder):
    names = cut_lineage(_tag_index(spark, folder))
    events = table(spark, folder, "events").select("event_id", F.col("event_type").alias("tag"))
    coded = events.join(names, "tag").select("event_id", "ix")
    return voc.decode(coded, names, "ix", "tag")


def spell_fix(spark, folder):
    known = cut_lineage(document_vocabulary(spark, folder))
    return voc.spelling_fixes(_chat_words(spark, folder), known)


def spell_apply(spark, folder):
    known = cut_lineage(document_vocabulary(spark, folder))
    tokens = _chat_words(spark, folder)
    fixed = voc.apply_fixes(tokens, voc.spelling_fixes(tokens, known), CHAT_KEYS)
    texts = voc.gather(fixed, CHAT_KEYS, {"words": "word"})
    return texts.select(*CHAT_KEYS, F.array_join("words", " ").alias("text"))


def embed_concat(spark, folder):
    """Document vectors: 64 numbers from embeddings, 2 from labels, zeros where a source has none."""
    docs = table(spark, folder, "documents").select("doc_id")
    first = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"))
    second = table(spark, folder, "labels").select("doc_id", F.array("quality", "toxic").alias("vec"))
    found = voc.embed(docs, "doc_id", [(first, 64), (second, 2)])
    return found.select("doc_id", F.posexplode("vector").alias("dim", "value"))


def one_hot_array(spark, folder):
    index = cut_lineage(_tag_index(spark, folder))
    sized = index.withColumn("width", index.agg(F.count(F.lit(1))).scalar())
    return sized.select("tag", F.posexplode(vectors.one_hot(F.col("ix"), F.col("width"))).alias("dim", "value"))


def array_prefix(spark, folder):
    found = table(spark, folder, "embeddings").select(
        "vec_id", F.size("embedding").alias("width"), vectors.doubles(vectors.prefix(F.col("embedding"), 3)).alias("p")
    )
    return found.select("vec_id", "width", F.posexplode("p").alias("dim", "value"))


def vector_similarity(spark, folder):
    """Every vector with the one that follows it."""
    here = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    following = table(spark, folder, "embeddings").select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")
    )
    a, b = F.col("a"), F.col("b")
    return here.join(following, "vec_id").select(
        "vec_id",
        rounded(vectors.dot(a, b), "dot"),
        rounded(vectors.scaled_dot(a, b), "scaled"),
        rounded(vectors.cosine(a, b), "cosine"),
    )


QUERIES = {
    "text_normalise": text_normalise,
    "cap_runs": cap_runs,
    "tokenise": tokenise,
    "substring_position": substring_position,
    "slugify": slugify,
    "page_links": page_links,
    "html_words": html_words,
    "stopword_filter": stopword_filter,
    "vocabulary": document_vocabulary,
    "split_vocabulary": split_vocabulary,
    "oov_tokens": oov_tokens,
    "first_seen_index": first_seen_index,
    "mark_index": mark_index,
    "token_index": token_index,
    "decode_labels": decode_labels,
    "spell_fix": spell_fix,
    "spell_apply": spell_apply,
    "embed_concat": embed_concat,
    "one_hot_array": one_hot_array,
    "array_prefix": array_prefix,
    "vector_similarity": vector_similarity,
}


def _replaces(start: str, *steps: tuple[str, str]) -> str:
    expression = start
    for pattern, put in steps:
        quoted = pattern.replace("'", "''")
        expression = f"regexp_replace({expression}, '{quoted}', '{put}', 'g')"
    return expression


_SPACES = SQL_SPACE[1:-1]
_PAGE = _replaces(
    "html",
    (r"<[^\n][^>\n]*>", ""),
    (r"\n|\t|'s|'", ""),
    (r"^.*?Gameplay\[\]Playstyle", ""),
    (r"\p{Nd}+", ""),
    (rf"[^{_SPACES}]*\[\]", ""),
    ("-", ""),
    (rf"[^\p{{L}}\p{{N}}_{_SPACES}]", " "),
    ("(?s)NewPP.*", ""),
)
_PAGE_WORDS = f"str_split(lower(regexp_replace({sql_strip(_PAGE)}, ' +', ' ', 'g')), ' ')"
_CHAT = f"SELECT conv_id, turn, str_split({sql_normalise('text')}, ' ') AS words FROM conversations"
_VOCABULARY = f"""
    doc_words AS (SELECT unnest(str_split({sql_normalise('text')}, ' ')) AS word FROM documents),
    vocabulary AS (
      SELECT word, CAST(sum(n) AS BIGINT) AS freq,
             row_number() OVER (ORDER BY substr(md5(word), 1, 3), word) - 1 AS ix
      FROM (SELECT word, 1 AS n FROM doc_words UNION ALL SELECT '[PAD]', 0 UNION ALL SELECT '[UNKNOWN]', 0)
      GROUP BY word),
    chat AS ({_CHAT}),
    chat_words AS (SELECT conv_id, turn, unnest(words) AS word, unnest(range(len(words))) AS pos FROM chat)"""
_FIXES = f"""{_VOCABULARY},
    strange AS (
      SELECT DISTINCT word FROM chat_words ANTI JOIN vocabulary USING (word) WHERE length(word) > 3),
    edits AS (
      SELECT word, substr(word, 1, i - 1) || substr(word, i + 1) AS edit
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM strange)
      UNION
      SELECT word, substr(word, 1, i - 1) || substr(word, i + 1, 1) || substr(word, i, 1) || substr(word, i + 2) AS edit
      FROM (SELECT word, unnest(range(1, length(word))) AS i FROM strange)),
    known_cuts AS (
      SELECT DISTINCT word AS fixed, freq, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
      FROM (SELECT word, freq, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
    fixes AS (
      SELECT word, fixed FROM (
        SELECT word, fixed, row_number() OVER (PARTITION BY word ORDER BY freq DESC, fixed) AS r FROM (
          SELECT e.word, v.word AS fixed, v.freq FROM edits e JOIN vocabulary v ON v.word = e.edit
          UNION SELECT s.word, k.fixed, k.freq FROM strange s JOIN known_cuts k ON k.cut = s.word))
      WHERE r = 1)"""
_TAGS = """
    tags AS (
      SELECT '<START>' AS tag, 0 AS ix UNION ALL SELECT '<STOP>', 1 UNION ALL
      SELECT tag, row_number() OVER (ORDER BY first) + 1 FROM (
        SELECT event_type AS tag, min(row(user_id, CAST(ts AS DATE), ts, event_id)) AS first FROM events GROUP BY 1))"""
_DOT = "list_dot_product(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[]))"

SQL = {
    "text_normalise": f"""
        SELECT conv_id, turn, {sql_strip("regexp_replace(lower(text), ' +', ' ', 'g')")} AS text FROM conversations""",
    "cap_runs": f"SELECT doc_id, {sql_cap('text')} AS text FROM documents",
    "tokenise": f"""
        SELECT conv_id, turn, array_to_string(str_split({sql_normalise('text')}, ' '), '|') AS tokens,
               array_to_string(list_filter(regexp_split_to_array({sql_strip('text')}, '{SQL_SPACE}+'),
                                           lambda t: t <> ''), '|') AS words
        FROM conversations""",
    "substring_position": """
        SELECT doc_id, CASE WHEN contains(text, 'the ') THEN CAST(strpos(text, 'the ') - 1 AS INTEGER) END AS place
        FROM documents""",
    "slugify": """
        SELECT p_partkey, 'https://example.org/wiki/' || replace(replace(p_name, ' ', '_'), '''', '%27') || '/Guide' AS url
        FROM part""",
    "page_links": f"""
        SELECT page_id, unnest(links) AS link, CAST(unnest(range(len(links))) AS INTEGER) AS pos
        FROM (SELECT page_id, regexp_extract_all(html, '{LINK}', 1) AS links FROM pages)""",
    "html_words": f"""
        SELECT page_id, unnest(words) AS word, CAST(unnest(range(len(words))) AS INTEGER) AS pos
        FROM (SELECT page_id, {_PAGE_WORDS} AS words FROM pages)""",
    "stopword_filter": f"""
        SELECT conv_id, turn, array_to_string(list_filter(words, lambda w: w NOT IN ({", ".join(f"'{w}'" for w in STOPWORDS)})),
        ' ') AS text FROM ({_CHAT})""",
    "vocabulary": f"WITH {_VOCABULARY} SELECT word, freq, ix FROM vocabulary",
    "split_vocabulary": f"""
        WITH {_VOCABULARY},
        every AS (SELECT word, 1 AS t, 0 AS v, 1 AS n FROM doc_words UNION ALL SELECT word, 0, 1, 1 FROM chat_words
                  UNION ALL SELECT '[PAD]', 0, 0, 0 UNION ALL SELECT '[UNKNOWN]', 0, 0, 0)
        SELECT word, CAST(sum(n) AS BIGINT) AS freq, row_number() OVER (ORDER BY substr(md5(word), 1, 3), word) - 1 AS ix,
               CAST(sum(t) AS BIGINT) AS in_train, CAST(sum(v) AS BIGINT) AS in_valid
        FROM every GROUP BY word""",
    "oov_tokens": f"WITH {_VOCABULARY} SELECT DISTINCT word FROM chat_words ANTI JOIN doc_words USING (word)",
    "first_seen_index": f"WITH {_TAGS} SELECT tag, ix FROM tags",
    "mark_index": """
        SELECT token, row_number() OVER (ORDER BY first) - 1 AS ix FROM (
          SELECT CAST(floor(value / 10) AS BIGINT) AS token,
                 min(row(user_id, CAST(ts AS DATE), ts, event_id)) AS first FROM events GROUP BY 1)""",
    "token_index": f"""
        WITH {_VOCABULARY}
        SELECT conv_id, turn, string_agg(CAST(coalesce(v.ix, u.ix) AS VARCHAR), ' ' ORDER BY pos) AS indices
        FROM chat_words LEFT JOIN vocabulary v USING (word), (SELECT ix FROM vocabulary WHERE word = '[UNKNOWN]') u
        GROUP BY conv_id, turn""",
    "decode_labels": f"""
        WITH {_TAGS} SELECT event_id, ix, tag FROM events JOIN tags ON tag = event_type""",
    "spell_fix": f"WITH {_FIXES} SELECT word, fixed FROM fixes",
    "spell_apply": f"""
        WITH {_FIXES} SELECT conv_id, turn, string_agg(coalesce(fixed, word), ' ' ORDER BY pos) AS text
        FROM chat_words LEFT JOIN fixes USING (word) GROUP BY conv_id, turn""",
    "embed_concat": """
        SELECT doc_id, CAST(unnest(range(66)) AS INTEGER) AS dim, unnest(list_concat(
                 coalesce(CAST(embedding AS DOUBLE[]), list_transform(range(64), lambda i: CAST(0 AS DOUBLE))),
                 CASE WHEN quality IS NULL THEN [0.0::DOUBLE, 0.0::DOUBLE] ELSE [quality::DOUBLE, toxic::DOUBLE] END)) AS value
        FROM documents LEFT JOIN embeddings ON vec_id = doc_id LEFT JOIN labels USING (doc_id)""",
    "one_hot_array": f"""
        WITH {_TAGS} SELECT t.tag, CAST(d.ix AS INTEGER) AS dim, CASE WHEN t.ix = d.ix THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
        FROM tags t, tags d""",
    "array_prefix": """
        SELECT vec_id, CAST(len(embedding) AS INTEGER) AS width, CAST(unnest(range(3)) AS INTEGER) AS dim,
               CAST(unnest(embedding[1:3]) AS DOUBLE) AS value FROM embeddings""",
    "vector_similarity": f"""
        SELECT x.vec_id, round({_DOT}, 6) AS dot, round({_DOT} / sqrt(len(x.embedding)), 6) AS scaled,
               round(list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])), 6) AS cosine
        FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1""",
}
