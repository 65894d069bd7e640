"""Filter interaction audit by an incremental stream with retractions.

The files of a corpus are read as available-now micro-batches. What a filter
decides of a text alone becomes a bit of a mask at once. Whether a text repeats
an earlier one is known only in the end: the state keeps, per text digest, the
smallest id so far. A row that comes later than a smaller id counts with the
bit of the repeat filter; when a smaller id comes, the row that counted as the
first is retracted and counted again with the bit. The stream gives changes of
counters (part, mask, labels), summed in its tasks; every order of the filters
is then read off the counters, without the texts.

The digests are dealt by their hash into groups of about TEXTS_PER_STATE, and
the state is keyed by the group, because a call per text would cost more than
the rest of the audit.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tabloom.llm.common import shared_folder, table, whole_batches

LETTERS = "ABCDE"
REPEATED = "E"
REPEAT_BIT = 1 << LETTERS.index(REPEATED)
BATCHES = 4
BROADCAST_LABELS = 1_000_000
TEXTS_PER_STATE = 512
HELD_TEXTS = 50_000

_DELTA = "part string, mask int, quality int, toxic int, n bigint"
_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"


class Text:
    """What the filters see of one text; words are what blanks, tabs and line ends separate."""

    __slots__ = ("data", "length", "words")

    def __init__(self, text: str):
        self.data = text.encode("utf-8", "surrogatepass")
        self.length = len(text)
        self.words = self.data.split()  # on bytes these are just the six ASCII blanks

    def holds(self, some: bytes) -> int:
        """How many of its characters are among `some`, which are ASCII."""
        return len(self.data) - len(self.data.translate(None, some))


#: The filters that look at one text alone: a letter and the condition under which it removes the text.
FILTERS: dict[str, Callable[[Text], bool]] = {
    "A": lambda t: len(t.words) < 200,
    "B": lambda t: 100 * len(set(t.words)) < 50 * len(t.words),
    "C": lambda t: 100 * t.holds(_UPPER) > 2 * t.length,
    "D": lambda t: t.holds(_SYMBOLS) > 0,
}


def masked(docs: DataFrame, filters: dict[str, Callable[[Text], bool]] = FILTERS) -> DataFrame:
    """(id, part, key, mask): one row per document with a bit per filter that it fails; texts go no further.

    `key` is the first 16 bytes of the SHA-256 of the text.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, masks = [], []
            for text in frame["text"]:
                seen = Text(text)
                keys.append(hashlib.sha256(seen.data).digest()[:16])
                masks.append(sum(1 << LETTERS.index(letter) for letter, fails in filters.items() if fails(seen)))
            yield pd.DataFrame({"id": frame["id"], "part": frame["part"], "key": keys, "mask": masks})

    wanted = docs.select(
        docs["doc_id"].cast("bigint").alias("id"),
        F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )
    return wanted.mapInPandas(run, "id bigint, part string, key binary, mask int")


def label_flags(labels: DataFrame) -> DataFrame:
    """(label_id, quality, toxic): 1 where any label row of the document says so, else 0."""
    says = [F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c) for c in ("quality", "toxic")]
    return labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(*says)


Counts = dict[tuple, int]


def _merge(into: Counts, more: Counts) -> None:
    for fact, n in more.items():
        into[fact] = into.get(fact, 0) + n


def _packed(counts: Counts) -> str:
    return json.dumps([[*fact, n] for fact, n in sorted(counts.items())])


def _unpacked(text: str) -> Counts:
    return {(part, quality, toxic): n for part, quality, toxic, n in json.loads(text)}


class _Seen:
    """What is known of one text: its smallest id, the rows with that id, and the rows that repeat it."""

    __slots__ = ("first", "id", "later")

    def __init__(self, identity: int | None = None, first: Counts | None = None):
        self.id, self.first, self.later = identity, first or {}, {}

    def add(self, identity: int, facts: Counts) -> None:
        """Rows of one id; those of the larger of two ids become repeats."""
        if self.id is None or identity < self.id:
            _merge(self.later, self.first)
            self.id, self.first = identity, {}
        _merge(self.first if identity == self.id else self.later, facts)


_TEXTS = "key binary, mask int, id bigint, first string, later string"


def _by_text(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per text and portion of a task, so that a text that many rows share is reduced before the shuffle.

    Rows without an id are neither first nor repeats and stay apart, with a null id.
    """

    def rows() -> pd.DataFrame:
        out = [(key, mask, seen.id, _packed(seen.first), _packed(seen.later)) for (key, mask, _), seen in held.items()]
        return pd.DataFrame(out, columns=["key", "mask", "id", "first", "later"]).astype({"id": "Int64"})

    held: dict[tuple, _Seen] = {}
    for frame in frames:
        known = frame["id"].notna().tolist()
        ids = frame["id"].fillna(0).astype("int64").tolist()
        flags = zip(frame["part"].tolist(), frame["quality"].tolist(), frame["toxic"].tolist())
        for has_id, identity, key, mask, fact in zip(known, ids, frame["key"].tolist(), frame["mask"].tolist(), flags):
            at = (bytes(key), mask, has_id)
            seen = held.get(at)
            if seen is None:
                seen = held[at] = _Seen()
            if has_id:
                seen.add(identity, {fact: 1})
            else:
                _merge(seen.first, {fact: 1})
        if len(held) >= HELD_TEXTS:
            yield rows()
            held.clear()
    yield rows()


def _changes(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counter changes of the texts of one group in one micro-batch.

    The state holds, per text, its smallest id and the rows that count as first.
    """
    stored: dict[str, list] = json.loads(state.get[0]) if state.exists else {}
    change: dict[tuple, int] = {}
    touched: dict[tuple, tuple[_Seen, Counts]] = {}
    for frame in frames:
        known, ids = frame["id"].notna().tolist(), frame["id"].fillna(0).astype("int64").tolist()
        for text, mask, has_id, identity, first, later in zip(
            frame["key"].tolist(), frame["mask"].tolist(), known, ids, frame["first"].tolist(), frame["later"].tolist()
        ):
            if not has_id:
                for fact, n in _unpacked(first).items():
                    change[mask, fact] = change.get((mask, fact), 0) + n
                continue
            at = (bytes(text).hex(), mask)
            if at not in touched:
                identity_before, facts = stored.get(at[0], (None, "[]"))
                before = _unpacked(facts)
                touched[at] = _Seen(identity_before, dict(before)), before
            seen = touched[at][0]
            seen.add(identity, _unpacked(first))
            _merge(seen.later, _unpacked(later))
    for (text, mask), (seen, before) in touched.items():
        stored[text] = [seen.id, _packed(seen.first)]
        # what counted as first before is retracted; it stands in `first` or `later` anew
        for counts, bit, sign in ((before, 0, -1), (seen.first, 0, 1), (seen.later, REPEAT_BIT, 1)):
            for fact, n in counts.items():
                change[mask | bit, fact] = change.get((mask | bit, fact), 0) + sign * n
    if touched:
        state.update((json.dumps(stored),))
    rows = [(part, mask, quality, toxic, n) for (mask, (part, quality, toxic)), n in change.items() if n]
    yield pd.DataFrame(rows, columns=["part", "mask", "quality", "toxic", "n"])


def _added_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counter changes of a task, one row per counter: parts x masks x labels at most."""
    total: dict[tuple, int] = {}
    for frame in frames:
        for *counter, n in frame.itertuples(index=False, name=None):
            total[tuple(counter)] = total.get(tuple(counter), 0) + n
    yield pd.DataFrame([(*counter, n) for counter, n in total.items()], columns=["part", "mask", "quality", "toxic", "n"])


def counter_changes(rows: DataFrame, states: int) -> DataFrame:
    """(part, mask, quality, toxic, n): changes of the counters by a stream of (id, part, key, mask, quality, toxic)."""
    texts = rows.mapInPandas(_by_text, _TEXTS).withColumn("group", F.pmod(F.xxhash64("key"), F.lit(states)))
    changes = texts.groupBy("group").applyInPandasWithState(_changes, _DELTA, "texts string", "append", GroupStateTimeout.NoTimeout)
    return changes.mapInPandas(_added_up, _DELTA)


def stream_counters(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    batches: int = BATCHES,
    folder: str | None = None,
    texts_per_state: int = TEXTS_PER_STATE,
    broadcast_labels: int = BROADCAST_LABELS,
) -> DataFrame:
    """(part, mask, quality, toxic, n): how many documents of the Parquet files at `path` fail just the filters of `mask`.

    The files are dealt into about `batches` available-now micro-batches. State,
    progress and changes are kept in `folder`, a new one in the shared folder by
    default: given the same folder again, only files that came since are read
    and the counters cover all of them. The number of state groups is fixed by
    the rows of the first call. A micro-batch that is repeated after a loss
    writes its changes once. Labels of up to `broadcast_labels` documents (three
    numbers each) are broadcast, more are joined by a shuffle of ids and masks.
    """
    whole_batches(spark)
    folder = folder or f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
    path = path.rstrip("/")
    listed = spark.read.parquet(path)
    per_batch = max(1, -(-len(listed.inputFiles()) // batches))
    setting = spark.range(1).select(F.lit(max(1, -(-listed.count() // texts_per_state))).cast("bigint").alias("states"))
    setting.write.mode("ignore").parquet(f"{folder}/setting")
    states = spark.read.parquet(f"{folder}/setting").first()["states"]
    label_flags(labels).write.mode("overwrite").parquet(f"{folder}/labels")
    flags = spark.read.parquet(f"{folder}/labels")
    if flags.count() <= broadcast_labels:
        flags = F.broadcast(flags)
    # as a pattern, since a stream takes a single file only so
    docs = spark.readStream.schema(listed.schema).option("maxFilesPerTrigger", per_batch).parquet(f"{path[:-1]}[{path[-1]}]")
    rows = masked(docs).join(flags, F.col("id") == F.col("label_id"), "left").select(
        "id", "part", "key", "mask", F.coalesce("quality", F.lit(0)).alias("quality"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )
    writer = counter_changes(rows, states).writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    query = writer.option("checkpointLocation", f"{folder}/progress").start(f"{folder}/changes")
    query.awaitTermination()
    changes = spark.read.schema(_DELTA).parquet(f"{folder}/changes")
    return changes.groupBy("part", "mask", "quality", "toxic").agg(F.sum("n").alias("n")).filter("n <> 0")


def audit(counters: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row per part, order of the filters and step, read off the counters: a
    document is removed by the first filter of the order whose bit it has. Each
    counter is met with the fixed list of orders and steps.
    """
    steps = []
    for order in itertools.permutations(letters):
        for k, letter in enumerate(order):
            before = sum(1 << letters.index(x) for x in order[:k])
            steps.append({"filter_order": "".join(order), "step": k + 1, "bit": 1 << letters.index(letter), "before": before})
    orders = len(steps) // len(letters)
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    masks = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("quality") == 1, F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic")
    )
    met = masks.select("*", F.explode(listed).alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(when: Column, what: str | Column, name: str) -> Column:
        return F.sum(F.when(when, what if isinstance(what, Column) else F.col(what)).otherwise(0)).cast("bigint").alias(name)

    first_of = F.lit(orders) / F.bit_count("mask")  # of the filters that a document fails each comes first as often
    return met.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone, "n", "kept"),
        total(fails & ~gone, "n", "removed"),
        total(fails & gone, "n", "redundant"),
        total(F.col("mask") == F.col("bit"), "n", "unique_fails"),
        total(fails & ~gone, "good", "good_lost"),
        total(fails & ~gone, "toxic", "toxic_lost"),
        total(fails, (F.col("n") * first_of).cast("bigint"), "shapley"),
    )


def filter_audit(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    batches: int = BATCHES,
    folder: str | None = None,
    texts_per_state: int = TEXTS_PER_STATE,
) -> DataFrame:
    """The rows of `audit` for the documents in the Parquet files at `path`, by the stream of `stream_counters`.

    A null text counts as empty and a null source as the part with the empty
    name. E fails where a smaller id has the identical text; rows that repeat id
    and text are one document each and none is the other's repeat. A row with a
    null id fails E never and makes no other row fail it. A document counts as
    good or toxic when any of its label rows says 1. An empty table gives no
    rows; columns other than doc_id, text, source (and doc_id, quality, toxic of
    the labels) are not looked at. Ids must be integers.
    """
    return audit(stream_counters(spark, path, labels, batches, folder, texts_per_state))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(spark, f"{folder}/documents.parquet", table(spark, folder, "labels"))


QUERIES = {"op12_filter_audit": op12_filter_audit}

SQL = {
    "op12_filter_audit": r"""
        WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS x
              FROM labels GROUP BY doc_id),
        m AS (SELECT part, coalesce(q, 0) AS q, coalesce(x, 0) AS x,
                     CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
                     + CASE WHEN 100 * list_unique(words) < 50 * len(words) THEN 2 ELSE 0 END
                     + CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) THEN 4 ELSE 0 END
                     + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                     + CASE WHEN min(w.doc_id) OVER (PARTITION BY t) < w.doc_id THEN 16 ELSE 0 END AS mask
              FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
        c AS (SELECT part, mask, count(*) AS n, sum(q) AS good, sum(x) AS toxic FROM m GROUP BY part, mask),
        f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
        o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
              FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit)
              JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
        s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
              FROM o, (SELECT unnest(range(1, 6)) AS step) AS steps),
        r AS (SELECT part, filter_order, step, bit,
                     sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                     sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
                     sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                     sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
                     sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
                     sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
              FROM c, s GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM r"""
}
