"""Secret scan: candidate strings judged by a random forest.

Only DataFrame functions and Spark's own forest. Candidates are whole assigned
or quoted values, values of authorization schemes, and runs of token characters
and dots, with the parts that stand out inside them; the features are their length, the transitions between character
classes, how much of them common words cover, the path of the document and the
words on both sides. The forest is trained on labelled findings and takes the
false positives out.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import hash_prefix, table
from tabloom.session import cut_lineage

_RUN = r"A-Za-z0-9+/_\-"
# A dotted run is looked at from its start alone, and up to its first digit or change of case: linear in the text.
_START = rf"(?<![{_RUN}]|[{_RUN}]\.)"
_STEP = rf"(?:(?![a-z][A-Z])(?:[A-Za-z+/_\-]|\.(?=[{_RUN}])))"
_MIXED = rf"(?=[{_RUN}][{_RUN}.]{{15}})(?={_STEP}*+(?:[0-9]|[a-z][A-Z]))"
#: What stands before a value: a sign of assignment with any blanks, or the name of an authorization scheme.
BEFORE = r"""(?:(?:[=:]++>?+\s*+|(?i:\b(?:bearer|basic))\s++)["'`]?+)"""
# A sign at the end of a value, or before a scheme, is left for the value that follows.
_NEXT = r"(?![=:]++(?:\s|$|(?i:bearer|basic)\s))"
#: A quoted value up to its closing quote, any other up to white space or a quote that does not stand inside a word, and a
#: run of 16 or more token characters and dots with a digit or a change of case in it; padding is added from what follows.
CANDIDATE = (
    rf"{BEFORE}(?:"
    r"""(?<=")(?:[^"\\\r\n]|\\.){8,}+(?=")|(?<=')(?:[^'\\\r\n]|\\.){8,}+(?=')|(?<=`)(?:[^`\\\r\n]|\\.){8,}+(?=`)"""
    rf"""|(?!["'`=:])(?:{_NEXT}[^\s"'`]|(?<=\w)["'`](?=\w)){{8,}}+)"""
    rf"|{_START}{_MIXED}[{_RUN}]++(?:\.[{_RUN}]++)*+"
)
#: What is judged inside a value as well: runs, dotted runs, and what is assigned in it or starts it, up to a separator.
_RUNS = rf"(?<![{_RUN}])(?=[A-Za-z+/_\-]*+[0-9])[{_RUN}]{{16,}}+"
_DOTTED = rf"{_START}{_MIXED}[{_RUN}]++(?:\.[{_RUN}]++)++"
_ASSIGNED = rf"""(?:^|{BEFORE})[^\s&;,=:"'`]{{7,}}[^\s&;,=:"'`.!?)\]}}>]"""
NEAR = 64
TRAINING_DOCUMENTS = 6_000
TREES, LEVELS = 40, 7
THRESHOLD = 0.5
SEED = 11

# Common words and word parts of prose and code.
DICTIONARY = (
    "the and ing tion for with this that from are was have not but you all can her one our out day get has him his how new now see two "
    "who did its let put say she too use ment ness able less ship ward time year work word name file path text data user test code type "
    "list item page link home main base info part line read open save load send call back next last first second example sample dummy "
    "change change-me your here goes placeholder replace insert value string number default none null true false enter token secret key "
    "password passwd api auth access der die das und ein ich ist sch ung keit heit lich les des est que ent eur aux une pour por para los "
    "las del con ado ida mente"
).split()
# Words that stand before real secrets, and words that announce something else.
SECRET_WORDS = "token secret key passwd password pwd api auth bearer credential access private"
HARMLESS_WORDS = "example sample dummy placeholder commit sha sha1 sha256 md5 hash digest checksum uuid guid revision etag build id isbn"
TEST_PATHS = "test tests example examples sample samples doc docs fixture fixtures mock mocks demo vendor"


def _any(words: str) -> str:
    return "(?i)(?<![A-Za-z])(" + "|".join(words.split()) + ")(?![A-Za-z])"


def _rows(found: Column, parts: Column, left: Column, right: Column) -> Column:
    """Array of (candidate, left, right) of the matches `found` between `parts` of a text that stands between `left` and `right`."""

    def row(m: Column) -> Column:
        before = F.regexp_extract(m["match"], f"^{BEFORE}", 0)
        follows = F.concat(F.left(m["after"], F.lit(NEAR + 2)), F.left(F.coalesce(m["next"], right), F.lit(NEAR + 2)))
        padding = F.regexp_extract(follows, "^={1,2}", 0)
        return F.struct(
            F.concat(F.substring(m["match"], F.length(before) + 1, F.length(m["match"])), padding).alias("candidate"),
            F.right(F.concat(F.right(F.coalesce(m["last"], left), F.lit(NEAR)), F.right(m["part"], F.lit(NEAR)), before), F.lit(NEAR)).alias("left"),
            F.substring(follows, F.length(padding) + 1, F.lit(NEAR)).alias("right"),
        )

    n, none = F.size(found), F.array(F.lit(None).cast("string"))
    columns = {
        "match": found, "part": parts, "after": F.slice(parts, F.lit(2), n), "next": F.concat(F.slice(found, F.lit(2), n), none), "last": F.concat(none, found)
    }
    return F.transform(F.arrays_zip(*[F.slice(c, F.lit(1), n).alias(k) for k, c in columns.items()]), row)


def _with_inner(row: Column) -> Column:
    """Array of a candidate and the candidates inside it, each string at a place once."""
    rows = [F.array(row)]
    for pattern in (_RUNS, _DOTTED, _ASSIGNED):
        inner = _rows(F.regexp_extract_all(row["candidate"], F.lit(pattern), F.lit(0)), F.split(row["candidate"], pattern, -1), row["left"], row["right"])
        known = f"^(?:{_RUNS}|{_DOTTED})={{0,2}}$" if pattern is _ASSIGNED else "^$"
        rows.append(F.filter(inner, lambda r: (r["candidate"] != row["candidate"]) & ~r["candidate"].rlike(known)))  # noqa: B023
    return F.concat(*rows)


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path_column: str | None = "source") -> DataFrame:
    """(doc_id, occurrence, path, candidate, left, right): every candidate with up to 64 characters on both sides.

    A candidate is a whole match of CANDIDATE, followed by what stands out
    inside it; `occurrence` numbers them from 0.
    """
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    path = F.coalesce(docs[path_column].cast("string"), F.lit("")) if path_column else F.lit("")
    found = docs.select(
        docs[id_column].alias("doc_id"),
        path.alias("path"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"),
        text.alias("text"),
    ).filter(F.size("found") > 0)
    parts = found.select("doc_id", "path", "found", F.split("text", CANDIDATE, -1).alias("parts"))
    rows = F.flatten(F.transform(_rows(F.col("found"), F.col("parts"), F.lit(""), F.lit("")), _with_inner))
    opened = parts.select("doc_id", "path", F.posexplode(rows).alias("occurrence", "row"))
    return opened.select("doc_id", "occurrence", "path", "row.candidate", "row.left", "row.right")


def feature_columns() -> dict[str, Column]:
    """Name to expression over (candidate, left, right, path)."""
    c, n = F.col("candidate"), F.length("candidate")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    def near(column: str, words: str) -> Column:
        return F.col(column).rlike(_any(words)).cast("double")

    uncovered = F.regexp_replace(F.lower(c), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")
    last_words = F.regexp_extract("left", r"(\S+\s*[:=]?\s*[\"']?)$", 1)
    return {
        "length": n.cast("double"),
        "lower_lower": share("[a-z](?=[a-z])"),
        "letter_digit": share("[A-Za-z](?=[0-9])"),
        "digit_letter": share("[0-9](?=[A-Za-z])"),
        "digit_digit": share("[0-9](?=[0-9])"),
        "lower_upper": share("[a-z](?=[A-Z])"),
        "upper_lower": share("[A-Z](?=[a-z])"),
        "upper_upper": share("[A-Z](?=[A-Z])"),
        "to_mark": share("[A-Za-z0-9](?=[+/_=-])"),
        "vowel_turn": share("(?i)[aeiou](?=[bcdfghjklmnpqrstvwxyz])"),
        "repeated": share(r"(.)(?=\1)"),
        "kinds": F.size(F.array_distinct(F.split(c, ""))) / n,
        "hexadecimal": c.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "known_format": c.rlike("^(AKIA|ASIA|gh[pousr]_|sk[-_]|xox[abp]-|glpat-|AIza|eyJ)").cast("double"),
        "uuid": c.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$").cast("double"),
        "marks": share(r"[^A-Za-z0-9+/_=\-\s]"),
        "blanks": share(r"\s"),
        "address": c.rlike(r"^([a-z]+:)?//|^www\.").cast("double"),
        "coverage": 1 - F.length(uncovered) / n,
        "path_depth": F.regexp_count(F.col("path"), F.lit("/")).cast("double"),
        "path_test": near("path", TEST_PATHS),
        "left_secret": near("left", SECRET_WORDS),
        "left_harmless": near("left", HARMLESS_WORDS),
        "name_secret": last_words.rlike("(?i)(" + SECRET_WORDS.replace(" ", "|") + ")").cast("double"),
        "assigned": F.col("left").rlike(r"[=:]\s*[\"']?$").cast("double"),
        "quoted": (F.col("left").rlike("[\"']$") & F.col("right").rlike("^[\"']")).cast("double"),
        "right_harmless": near("right", HARMLESS_WORDS),
    }


def labelled_findings(docs: DataFrame, rows: int = TRAINING_DOCUMENTS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, path, text, planted, label): findings set into the text of at most `rows` documents.

    The documents are the first by a hash of their id; each gets one finding of
    one kind, a value drawn from a hash in the words that usually surround it.
    Label 1: keys of known formats, dotted keys, random strings with and without
    marks assigned to a telling name or after the name of a scheme.
    Label 0: placeholders, digests and identifiers named as such, counters,
    long words, quoted prose, addresses, file names and versions, and values in
    test paths that are named examples.
    """
    text = F.regexp_replace(F.substring(F.coalesce(docs[text_column].cast("string"), F.lit("")), 1, 400), "[=:\"']", " ")
    order = F.xxhash64("doc_id", F.lit(SEED))
    hosts = docs.select(docs[id_column].cast("string").alias("doc_id"), text.alias("host"))
    some = hash_prefix(hosts, docs.count(), rows, order).orderBy(order, "doc_id", "host").limit(rows)
    draw = lambda k: F.sha2(F.concat(F.coalesce("doc_id", F.lit("")), F.lit(f"/{k}")), 256)
    pick = lambda k, *options: F.element_at(F.array(*map(F.lit, options)), (F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(len(options))) + 1).cast("int"))
    base64 = F.translate(F.base64(F.unhex(draw(1))), "=", "")
    names = pick(2, "token", "secret", "api_key", "password", "auth_token", "access_key", "TOKEN", "client_secret", "apiKey", "private_key")
    sign = pick(3, " = \"", "=\"", ": \"", " = '", "=", ": ")
    close = F.when(sign.contains('"'), F.lit('"')).when(sign.contains("'"), F.lit("'")).otherwise(F.lit(""))
    hexes = F.substring(draw(4), 1, 40)
    named = F.concat(names, sign)
    uuid = F.regexp_replace(F.substring(draw(5), 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    harmless = pick(6, "commit ", "sha256: ", "md5=", "checksum: ", "hash: ", "revision ", "etag: \"", "digest=")
    letters = F.translate(base64, "0123456789+/", "abCDefGHij")
    mark = pick(13, "!", "$$", "#", "@", "%", "~", "&", ".")
    marked = F.concat(F.substring(base64, 1, 5), mark, F.substring(base64, 7, 4), mark, F.substring(draw(14), 1, 3))
    wide = pick(15, "  =  \"", "   = '", ":    \"", " =   ", "\t:\t\t")
    prose = F.regexp_extract("host", "([A-Za-z]{12,})", 1)
    kinds: list[tuple[int, Column, Column, Column]] = [
        (1, named, hexes, F.lit("")),
        (1, named, F.upper(hexes), F.lit("")),
        (1, named, F.substring(base64, 1, 32), F.lit("")),
        (1, named, F.concat(F.lit("ghp_"), F.substring(base64, 1, 36)), F.lit("")),
        (1, F.lit("key "), F.concat(F.lit("AKIA"), F.upper(F.substring(draw(7), 1, 16))), F.lit("")),
        (1, F.lit("Authorization: Bearer "), F.substring(base64, 1, 40), F.lit("")),
        (1, named, F.concat(marked, F.substring(draw(16), 1, 2)), F.lit("")),
        (1, F.concat(names, wide), F.substring(base64, 5, 11), F.lit("")),
        (1, F.lit("token: Bearer "), F.substring(letters, 1, 24), F.lit("")),
        (1, F.lit("Authorization: Basic "), F.concat(F.substring(base64, 1, 22), F.lit("==")), F.lit("")),
        (1, pick(17, "key ", "use ", "mail key: ", "token=\""), F.concat(pick(18, "SG.", "eyJ", "v1."), F.substring(base64, 1, 12), F.lit("."), F.substring(base64, 13, 24)), F.lit("")),
        (0, pick(19, "link: ", "url = \"", "see: "), F.concat(F.lit("https://www."), F.lower(prose), F.lit(".com/page/2024?id="), F.substring(draw(20), 1, 3)), F.lit("")),
        (0, pick(21, "title: \"", "label = \"", "message: \""), F.concat(prose, F.lit(" of "), prose, F.lit(", again.")), F.lit("")),
        (0, pick(22, "Note: ", "bearer ", "basic ", "namely: ", "is = "), F.concat(prose, pick(23, "", ",", ".", ")")), F.lit("")),
        (0, pick(24, "file ", "open ", "version: "), F.concat(F.lower(prose), F.lit("-1.20."), F.substring(F.translate(draw(25), "abcdef", "123456"), 1, 2), F.lit(".tar")), F.lit("")),
        (0, harmless, hexes, F.lit("")),
        (0, F.lit("id: \""), uuid, F.lit("")),
        (0, named, pick(8, "your-token-goes-here-1", "changeme-changeme-1", "xxxxxxxxxxxxxxxxxxxx1", "insert_your_key_here_2", "example-password-123"), F.lit("")),
        (0, named, pick(9, "00000000000000000000", "1234567890123456789", "0123456789abcdef0123", "aaaaaaaaaaaaaaaaaaa1"), F.lit("")),
        (0, pick(10, "name = \"", "title: \"", "word: "), F.concat(prose, F.lit("likely")), F.lit("")),
        (0, F.lit("build "), F.concat(prose, F.lit("-2024-01-"), prose, F.lit("-release")), F.lit("")),
        (0, F.concat(F.lit("example "), named), hexes, F.lit("tests/fixtures/data")),
    ]
    kind = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(len(kinds)))

    def of(part: int) -> Column:
        chosen = F.lit(None)
        for k, made in enumerate(kinds):
            value = F.lit(made[0]) if part == 0 else made[part]
            chosen = F.when(kind == k, value).otherwise(chosen)
        return chosen

    half = F.floor(F.length("host") / 2).cast("int")
    whole = F.concat(F.substring("host", F.lit(1), half), F.lit(" "), of(1), of(2), F.when(of(1).endswith('"') | of(1).endswith("'"), close).otherwise(F.lit("")), F.lit(" "), F.expr("substring(host, cast(floor(length(host) / 2) as int) + 1)"))
    return some.select("doc_id", of(3).alias("path"), whole.alias("text"), of(2).alias("planted"), of(0).alias("label"))


def fit_forest(findings: DataFrame, trees: int = TREES, levels: int = LEVELS) -> PipelineModel | None:
    """Forest on labelled findings (doc_id, path, text, planted, label); None when not both labels are there.

    Other candidates in the text of a finding are not used: only what is
    labelled is learned.
    """
    found = candidates(findings.select("doc_id", "text", "path"), path_column="path")
    planted = findings.select(F.col("doc_id").alias("__id"), F.col("planted"), F.col("label").cast("double").alias("label"))
    labelled = found.join(planted, (F.col("doc_id") == F.col("__id")) & (F.col("candidate") == F.col("planted")))
    columns = feature_columns()
    rows = cut_lineage(labelled.select("label", *[e.alias(n) for n, e in columns.items()]))
    if rows.select("label").distinct().count() < 2:
        return None
    vector = VectorAssembler(inputCols=list(columns), outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=levels, seed=SEED, labelCol="label", featuresCol="features")
    return Pipeline(stages=[vector, forest]).fit(rows)


def scan_secrets(
    docs: DataFrame, model: PipelineModel | None, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text", path_column: str | None = "source"
) -> DataFrame:
    """(doc_id, occurrence, n_chars, candidate_sha256, score, is_secret): one row per candidate in the whole texts.

    The string itself is not returned, only its digest. Without a model every
    candidate has score 1. Null and empty texts have no candidates, a null path
    counts as empty, a null id stays null; a repeated row gives its candidates
    again. Other columns are not looked at; an empty table gives no rows.
    """
    found = candidates(docs, id_column, text_column, path_column)
    wide = found.select("doc_id", "occurrence", "candidate", *[e.alias(n) for n, e in feature_columns().items()])
    score = F.lit(1.0)
    if model is not None:
        wide = model.transform(wide)
        score = vector_to_array("probability")[1]
    return wide.select(
        "doc_id",
        "occurrence",
        F.length("candidate").cast("bigint").alias("n_chars"),
        F.sha2("candidate", 256).alias("candidate_sha256"),
        F.round(score, 6).alias("score"),
    ).withColumn("is_secret", F.col("score") >= threshold)


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return scan_secrets(docs, fit_forest(labelled_findings(docs)))


QUERIES = {"op10_secret_scan": op10_secret_scan}
SQL: dict[str, str] = {}
