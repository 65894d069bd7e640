"""Repeated byte strings by a sparse suffix order.

Every string of LENGTH bytes holds an anchor, the leftmost smallest k-gram hash
among its k-grams, which depends on the string alone. So equal strings have
their anchor at the same place, and only the suffixes that start at anchors
need to be ordered. They are range-partitioned by their leading bytes with
sampled splitters; each bucket is sorted locally by multikey quicksort (by the
leading eight bytes, and by what follows only where these are equal), and the
first and last of each bucket are compared with those of the other buckets.
What is tied goes on with the bytes on both sides of the anchor: groups of
bounded size are finished in one task; a larger one is split as by a quicksort
step, against its earliest row as pivot, into what equals the pivot and what
differs from it in a first byte, which is grouped again.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import BROADCAST_IDS, counted, hash_prefix, shared_folder, table, whole_batches
from tabloom.llm.heavy import group_winners
from tabloom.session import cut_lineage

LENGTH = 100
GRAM = 24
WINDOW = LENGTH - GRAM + 1
LEFT = WINDOW - 1
CHUNK = 1 << 20
BUCKET_ROWS = 250_000
SAMPLED_DOCUMENTS = 2_000
SAMPLED_ANCHORS = 64
GROUP_ROWS = 16_384

_KINDS = (np.int64, np.int32, np.int64, np.int32)  # lead, rest, id, at

_U = np.uint64
_INDEX = _U(CHUNK - 1)
_ODD = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)]
_TABLE = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64)
_BASE = _U(0xD6E8FEB86659FD93)
_POWER = _U(pow(int(_BASE), LENGTH, 1 << 64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _ODD[0]
    h = (h ^ (h >> _U(29))) * _ODD[1]
    return h ^ (h >> _U(32))


def _at_every_byte(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    return np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the k-grams at all positions of a byte array of at least GRAM bytes."""
    words = _at_every_byte(data)
    last = len(data) - GRAM + 1
    return _mix((words[:last] * _ODD[0]) ^ (words[8 : last + 8] * _ODD[1]) ^ (words[16 : last + 16] * _ODD[2]))


class Texts:
    """Texts one after the other as one byte array; `doc` is the number of the text at each byte, `start` where it begins."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.start = np.cumsum(sizes) - sizes
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)


def anchors(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, first, last) in the joined array: each anchor with the first and last start of the strings that have
    it; strings lie in one text."""
    data, doc = texts.data, texts.doc
    found: list[tuple] = []
    for start in range(0, len(data) - LENGTH + 1, CHUNK // 2):
        part = data[start : start + CHUNK // 2 + LENGTH - 1]
        keys = (gram_hashes(part) & ~_INDEX) | np.arange(len(part) - GRAM + 1, dtype=np.uint64)
        size = 1
        while size * 2 <= WINDOW:
            keys = np.minimum(keys[:-size], keys[size:])
            size *= 2
        if WINDOW > size:
            keys = np.minimum(keys[: len(keys) - (WINDOW - size)], keys[WINDOW - size :])
        inside = start + np.flatnonzero(doc[start : start + len(keys)] == doc[start + LENGTH - 1 : start + LENGTH - 1 + len(keys)])
        at = (keys & _INDEX).astype(np.int64)[inside - start] + start
        if len(at):
            first = np.flatnonzero(np.diff(at, prepend=-1))
            last = np.append(first[1:], len(at)) - 1
            found.append((at[first], inside[first], inside[last]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _bytes_of(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def suffix_keys(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lead, rest) of the suffixes at `at`: the leading eight bytes in byte order, and a 32-bit hash of the k-gram.

    Two k-grams that only look alike cost work and change no result.
    """
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int32)
    words = _at_every_byte(data)
    lead = (words[at].byteswap() ^ _U(1 << 63)).view(np.int64)  # signed numbers in the order of the bytes
    gram = gram_keys(data, at).view(np.uint64)
    return lead, (gram >> _U(32)).astype(np.uint32).view(np.int32)


def gram_keys(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the k-grams at `at`: what groups the tied rows."""
    words = _at_every_byte(data)
    return _mix((words[at] * _ODD[0]) ^ (words[at + 8] * _ODD[1]) ^ (words[at + 16] * _ODD[2])).view(np.int64)


def _suffixes(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """(lead, rest, id, position in the text) of the anchors of all texts of a frame."""
    texts = Texts([_bytes_of(t) for t in frame["text"]])
    at = anchors(texts)[0]
    doc = texts.doc[at]
    return (*suffix_keys(texts.data, at), frame["id"].to_numpy()[doc], at - texts.start[doc])


def _buckets_of(splitters: list[tuple], firsts: np.ndarray, lead, rest, doc, at) -> np.ndarray:
    """Number of the splitters below each row; rows whose leading bytes are those of a splitter are compared whole."""
    bucket = np.searchsorted(firsts, lead, "left")
    equal = bucket < len(firsts)
    equal[equal] = firsts[bucket[equal]] == lead[equal]
    for k in np.flatnonzero(equal):
        bucket[k] = bisect_left(splitters, (int(lead[k]), int(rest[k]), int(doc[k]), int(at[k])))
    return bucket


def _planes(column: np.ndarray) -> bytes:
    """The bytes of a column of numbers plane by plane: what sorted numbers have in common stands together."""
    return column.view(np.uint8).reshape(len(column), column.itemsize).T.tobytes()


def packed_suffixes(bucket: np.ndarray, columns: list[np.ndarray]) -> pd.DataFrame:
    """(bucket, n, zipped, rows): the rows (lead, rest, id, at) of each bucket as one block, in the order of lead, rest and
    place, compressed where that makes it smaller."""
    packer = zstandard.ZstdCompressor(level=3)
    order = np.lexsort((columns[3], columns[2], columns[1], columns[0], bucket))
    bucket, columns = bucket[order], [c[order] for c in columns]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
    out = []
    for begin, end in zip(first.tolist(), [*first[1:].tolist(), len(bucket)]):
        plain = b"".join(_planes(c[begin:end].astype(kind)) for c, kind in zip(columns, _KINDS))
        small = packer.compress(plain) if end - begin > 4 else plain
        zipped = len(small) < len(plain)
        out.append((bucket[begin], end - begin, zipped, small if zipped else plain))
    return pd.DataFrame(out, columns=["bucket", "n", "zipped", "rows"])


def unpacked_suffixes(n: int, zipped: bool, rows: bytes) -> list[np.ndarray]:
    data, out, at = np.frombuffer(zstandard.decompress(rows) if zipped else rows, np.uint8), [], 0
    for kind in _KINDS:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at : at + n * width].reshape(width, n).T).view(kind)[:, 0])
        at += n * width
    return out


def sampled_splitters(docs: DataFrame, total: int, buckets: int) -> list[tuple]:
    """At most `buckets` - 1 splitters (lead, rest, id, position) of nearly equal steps in a sample of the `total` documents.

    The sample is at most SAMPLED_DOCUMENTS documents, the first by a hash of
    their id, with at most SAMPLED_ANCHORS spread anchors each. It only evens
    out the buckets; results do not depend on it.
    """
    order = F.xxhash64("id")
    some = hash_prefix(docs, total, SAMPLED_DOCUMENTS, order).orderBy(order, "id").limit(SAMPLED_DOCUMENTS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = pd.DataFrame(dict(zip(("lead", "rest", "id", "at"), _suffixes(frame))))
            yield found[found.groupby("id").cumcount() % np.ceil(found.groupby("id")["at"].transform("size") / SAMPLED_ANCHORS) == 0]

    rows = some.mapInPandas(run, "lead bigint, rest int, id bigint, at bigint").toPandas()
    rows = sorted(zip(rows["lead"].tolist(), rows["rest"].tolist(), rows["id"].tolist(), rows["at"].tolist()))
    return sorted({rows[len(rows) * k // buckets] for k in range(1, buckets)}) if rows else []


def _multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order by the first column; rows that it leaves equal by the next one, and so on."""
    order = np.argsort(columns[0], kind="stable")
    tied = columns[0][order]
    run = np.concatenate([[0], np.cumsum(tied[1:] != tied[:-1])])
    for column in columns[1:]:
        open_ = np.bincount(run)[run] > 1
        if not open_.any():
            break
        rows = order[open_]
        order[open_] = rows[np.lexsort((column[rows], run[open_]))]
        value = column[order]
        run = np.concatenate([[0], np.cumsum((run[1:] != run[:-1]) | (value[1:] != value[:-1]))])
    return order


def tied_suffixes(docs: DataFrame, total: int, buckets: int, folder: str) -> DataFrame:
    """(rest, id, at): the anchors whose k-gram another anchor has too; kept as a table in `folder`."""
    splitters = sampled_splitters(docs, total, buckets)
    shipped = docs.sparkSession.sparkContext.broadcast((splitters, np.array([s[0] for s in splitters], np.int64)))

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = _suffixes(frame)
            yield packed_suffixes(_buckets_of(*shipped.value, *found), list(found))

    def sort(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for frame in frames:
            for bucket, n, zipped, rows in frame.itertuples(index=False, name=None):
                held.setdefault(bucket, []).append(unpacked_suffixes(n, zipped, rows))
        for bucket in sorted(held):
            lead, rest, doc, at = (np.concatenate(parts) for parts in zip(*held.pop(bucket)))
            order = _multikey_order([lead, rest])
            lead, rest, doc, at = (c[order] for c in (lead, rest, doc, at))
            step = (lead[1:] != lead[:-1]) | (rest[1:] != rest[:-1])
            run = np.concatenate([[0], np.cumsum(step)])
            edge = (run == 0) | (run == run[-1])
            keep = edge | (np.bincount(run)[run] > 1)
            # only the rows at the edges are compared with other buckets, by their leading bytes too
            yield pd.DataFrame({"lead": np.where(edge, lead, 0)[keep], "rest": rest[keep], "id": doc[keep], "at": at[keep], "edge": edge[keep]})

    emitted = docs.mapInPandas(emit, "bucket int, n int, zipped boolean, rows binary")
    ordered = emitted.repartition(buckets, "bucket").mapInPandas(sort, "lead bigint, rest int, id bigint, at int, edge boolean")
    ordered.write.parquet(folder)
    stored = docs.sparkSession.read.parquet(folder)
    edges = stored.filter("edge")
    met = edges.groupBy("lead", "rest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return stored.filter("NOT edge").select("rest", "id", "at").unionByName(edges.join(met, ["lead", "rest"]).select("rest", "id", "at"))


ROWS = "key bigint, id bigint, at int, low int, high int, around binary"


def tied_rows(packed: DataFrame, tied: DataFrame) -> DataFrame:
    """(key, id, at, low, high, around) of the tied anchors: x in [low, high] are the distances of the anchor from the
    starts of its strings; `around` are the bytes that these strings cover.

    Rows that cover the same bytes as an earlier one of the same batch are
    answered at once, so that a text that repeats itself, or a passage that
    many texts share, is reduced before the shuffle (see `_done_rows`).
    """
    places = tied.groupBy("id").agg(F.collect_list("at").alias("ats"))  # bounded by the length of the document

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = Texts([unzipped(z) for z in frame["zip"]])
            at, first, last = anchors(texts)
            doc = texts.doc[at]
            counts = [len(a) for a in frame["ats"]]
            wanted = np.isin(at, np.concatenate(frame["ats"].to_list()) + np.repeat(texts.start, counts))
            at, first, last, doc = at[wanted], first[wanted], last[wanted], doc[wanted]
            padded = np.concatenate([np.zeros(LEFT, np.uint8), texts.data, np.zeros(LENGTH, np.uint8)])
            windows = np.lib.stride_tricks.sliding_window_view(padded, LEFT + LENGTH)
            ids, place = frame["id"].to_numpy()[doc], at - texts.start[doc]
            order = np.lexsort((place, ids))  # the earliest first
            seen: dict[tuple, tuple] = {}
            gone = np.zeros(len(order), bool)
            for k in range(0, len(order), 10_000):
                some = order[k : k + 10_000]
                around = windows[at[some]].tobytes()
                low, high = at[some] - last[some], at[some] - first[some]
                begin = np.arange(len(low)) * (LEFT + LENGTH) + LEFT - high
                covered = [around[i : i + n] for i, n in zip(begin.tolist(), (high - low + LENGTH).tolist())]
                own = zip(ids[some].tolist(), place[some].tolist())
                again = np.array([seen.setdefault((h, c), here) != here for h, c, here in zip(high.tolist(), covered, own)], bool)
                gone[k : k + len(some)] = again
                yield pd.DataFrame(
                    {
                        "key": gram_keys(texts.data, at[some]),
                        "id": ids[some],
                        "at": place[some],
                        "low": low,
                        "high": high,
                        "around": covered,
                    }
                )[~again]
            rows = order[gone]
            yield _done_rows(ids[rows], place[rows] - (at - first)[rows], place[rows] - (at - last)[rows])

    return packed.join(places, "id").mapInPandas(run, ROWS)


def _done_rows(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pd.DataFrame:
    """Rows of ROWS without `around`: all strings that start from `at` to `at` + `high` also start earlier.

    Neighbouring runs are joined; the key only spreads the rows over the tasks.
    """
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1] + 1)])) if len(doc) else np.empty(0, int)
    end = stop[np.append(new[1:], len(doc)) - 1] if len(doc) else stop
    doc, start = doc[new], start[new]
    key = _mix(doc.astype(np.uint64) * _ODD[0] + start.astype(np.uint64)).view(np.int64)
    return pd.DataFrame({"key": key, "id": doc, "at": start, "low": 0, "high": end - start, "around": None})


def zipped(docs: DataFrame) -> DataFrame:
    """(id, zip): texts as compressed UTF-8, for the shuffles that bring them together with what was found in them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=3)
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"], "zip": [packer.compress(_bytes_of(t)) for t in frame["text"]]})

    return docs.select("id", "text").mapInPandas(run, "id bigint, zip binary")


def unzipped(data: bytes) -> bytes:
    return zstandard.decompress(data)


def _around(column: pd.Series, high: np.ndarray) -> np.ndarray:
    """A row each with the anchor at column LEFT; zeros where the strings of a row do not reach."""
    width = LEFT + LENGTH
    sizes = column.str.len().to_numpy()
    out = np.zeros(len(column) * width, np.uint8)
    begin = np.arange(len(column)) * width + LEFT - high
    step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(begin, sizes) + step] = np.frombuffer(b"".join(column), np.uint8)
    return out.reshape(len(column), width)


def _spans(doc: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    """Starts of removed strings as runs (id, start, stop)."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)]) if len(doc) else np.empty(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1 if len(doc) else first
    return pd.DataFrame({"id": doc[first], "start": start[first], "stop": start[last]})


def _later_strings(rows: pd.DataFrame) -> pd.DataFrame:
    """Runs of starts of strings that a row before has, by (id, at), in the same group; groups are whole.

    Hashes find the earliest row with a string, its bytes decide.
    """
    rows = rows.sort_values(["id", "at"], kind="stable")
    doc, place = rows["id"].to_numpy(), rows["at"].to_numpy()
    low, high = rows["low"].to_numpy(), rows["high"].to_numpy()
    group = rows["key"].to_numpy().view(np.uint64)
    parts = []
    for begin in range(0, len(rows), 8_192):
        some = slice(begin, begin + 8_192)
        around = _around(rows["around"].iloc[some], high[some])
        sums = np.zeros((len(around), LEFT + LENGTH + 1), np.uint64)
        for k in range(LEFT + LENGTH):
            sums[:, k + 1] = sums[:, k] * _BASE + _TABLE[around[:, k]]
        many = high[some] - low[some] + 1
        row = np.repeat(np.arange(len(around)), many)
        x = low[some][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        at = LEFT - x
        strings = sums[row, at + LENGTH] - sums[row, at] * _POWER
        parts.append((_mix(strings ^ _mix(group[some][row] + x.astype(np.uint64))), row + begin, x))
    strings, row, x = map(np.concatenate, zip(*parts))
    _, first, inverse = np.unique(strings, return_index=True, return_inverse=True)
    earliest = row[first[inverse]]
    later = (doc[earliest] != doc[row]) | (place[earliest] != place[row])  # a repeated row is not earlier than itself
    row, x, earliest = row[later], x[later], earliest[later]
    del strings, first, inverse
    same = np.empty(len(row), bool)
    for begin in range(0, len(row), 1 << 19):
        some = slice(begin, begin + (1 << 19))
        same[some] = _same_bytes(rows["around"], low, high, row[some], earliest[some], x[some])
    return _spans(doc[row[same]], place[row[same]] - x[same])


def _same_bytes(around: pd.Series, low: np.ndarray, high: np.ndarray, row: np.ndarray, other: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether the strings at distance `x` before the anchors of the rows `row` and `other` are equal byte by byte.

    Each pair of rows is compared once, to the left and to the right of the anchor.
    """
    pairs, pair_of = np.unique(row * len(around) + other, return_inverse=True)
    a, b = np.divmod(pairs, len(around))
    left, right = np.empty(len(pairs), np.int64), np.empty(len(pairs), np.int64)
    for begin in range(0, len(pairs), 8_192):
        some = slice(begin, begin + 8_192)
        one, two = (_around(around.iloc[k], high[k]) for k in (a[some], b[some]))
        left[some] = np.minimum(_common(one[:, LEFT - 1 :: -1], two[:, LEFT - 1 :: -1]), np.minimum(high[a[some]], high[b[some]]))
        right[some] = np.minimum(_common(one[:, LEFT:], two[:, LEFT:]), LENGTH - np.maximum(low[a[some]], low[b[some]]))
    return (x <= left[pair_of]) & (LENGTH - x <= right[pair_of])


def within_groups(rows: DataFrame, chunk: int = 16_384) -> DataFrame:
    """(id, start, stop) for groups of bounded size; a task works through its sorted groups in chunks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0
        for frame in frames:
            done = frame[frame["around"].isna()]
            yield pd.DataFrame({"id": done["id"], "start": done["at"], "stop": done["at"] + done["high"]})
            frame = frame[frame["around"].notna()]
            held.append(frame)
            count += len(frame)
            if count >= chunk and len(frame):
                whole = pd.concat(held, ignore_index=True)
                ready = whole["key"] != whole["key"].iloc[-1]
                if ready.any():
                    yield _later_strings(whole[ready])
                held = [whole[~ready]]
                count = len(held[0])
        if held and count:
            yield _later_strings(pd.concat(held, ignore_index=True))

    return rows.repartition("key").sortWithinPartitions("key").mapInPandas(run, "id bigint, start bigint, stop bigint")


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of each pair of rows."""
    differs = a != b
    return np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])


def _row_hash(around: np.ndarray, length: np.ndarray, seed: np.ndarray) -> np.ndarray:
    total = seed.copy()
    for k in range(around.shape[1]):
        more = k < length
        total[more] = total[more] * _BASE + _TABLE[around[more, k]]
    return _mix(total)


def against_pivots(rows: DataFrame) -> DataFrame:
    """One quicksort step for large groups, against the earliest row of each.

    Rows of ROWS with (start, stop): what equals the pivot (around is null), or
    what differs from it in a first byte on the left or on the right, under a
    key that holds the bytes up to there. Strings that are equal differ from
    the pivot in the same byte, so they meet again. An anchor at an edge of a
    batch has two rows; when one of them is the pivot, the other goes on.
    """
    pivots = rows.groupBy("key").agg(F.min(F.struct("id", "at", "low", "high", "around")).alias("pivot"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            doc, at, low, high, pivot_low, pivot_high = (frame[c].to_numpy() for c in ("id", "at", "low", "high", "pivot_low", "pivot_high"))
            own, pivot = _around(frame["around"], high), _around(frame["pivot_around"], pivot_high)
            other = (doc != frame["pivot_id"].to_numpy()) | (at != frame["pivot_at"].to_numpy())
            left = np.minimum(_common(own[:, LEFT - 1 :: -1], pivot[:, LEFT - 1 :: -1]), pivot_high)
            right = np.minimum(_common(own[:, LEFT:], pivot[:, LEFT:]), LENGTH - pivot_low)
            seed = frame["key"].to_numpy().view(np.uint64)
            equal_low, equal_high = np.maximum(low, LENGTH - right), np.minimum(high, left)
            left_low = np.maximum(low, left + 1)
            right_high = np.minimum(np.minimum(high, LENGTH - right - 1), left)
            left_key = _row_hash(own[:, LEFT - 1 :: -1], np.minimum(left + 1, LEFT), seed ^ _ODD[1])
            right_key = _row_hash(own[:, LEFT:], np.minimum(right + 1, LENGTH), seed ^ _ODD[2])
            for some, key, a, b, kept in (
                (other & (equal_low <= equal_high), seed, equal_low, equal_high, False),
                (left_low <= high, left_key, left_low, high, True),
                (low <= right_high, right_key, low, right_high, True),
            ):
                around = None
                if kept:
                    cuts = zip(frame["around"][some], (high - b)[some].tolist(), (high - a + LENGTH)[some].tolist())
                    around = [data[i:j] for data, i, j in cuts]
                yield pd.DataFrame({"key": key[some].view(np.int64), "id": doc[some], "at": at[some], "low": a[some], "high": b[some], "around": around})

    joined = rows.join(pivots, "key").select(
        "key", "id", "at", "low", "high", "around", F.col("pivot.id").alias("pivot_id"), F.col("pivot.at").alias("pivot_at"), F.col("pivot.low").alias("pivot_low"), F.col("pivot.high").alias("pivot_high"), F.col("pivot.around").alias("pivot_around")
    )
    return joined.mapInPandas(run, ROWS)


def repeated_starts(rows: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, start, stop): runs of starts of strings that also start earlier. `rows` is a stored frame of ROWS."""
    found = None
    while True:
        sizes = rows.filter(F.col("around").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        large = counted(sizes.filter(F.col("n") > group_rows).select("key"), BROADCAST_IDS)  # at most one of `group_rows` rows
        small = within_groups(rows.join(large, "key", "left_anti"))
        found = small if found is None else found.unionByName(small)
        if large.isEmpty():
            return found
        split = cut_lineage(against_pivots(rows.join(large, "key", "left_semi")))
        equal = split.filter(F.col("around").isNull())
        found = found.unionByName(equal.select("id", (F.col("at") - F.col("high")).cast("bigint").alias("start"), (F.col("at") - F.col("low")).cast("bigint").alias("stop")))
        rows = split.filter(F.col("around").isNotNull())


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bucket_rows: int = BUCKET_ROWS, group_rows: int = GROUP_ROWS,
    with_bytes: bool = True,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept if `with_bytes`): one row per input row.

    Removed is every byte that a string of LENGTH bytes covers which also starts
    earlier: in a document of smaller id, or earlier in the same one. Strings
    may overlap and are judged on the input. `kept` are the remaining bytes.

    A null text counts as empty; a text shorter than LENGTH loses nothing.
    Rows that repeat id and text have the same result; rows with a null id are
    left out. Other columns are not looked at; an empty table gives no rows.
    Ids must be integers.
    """
    spark = docs.sparkSession
    whole_batches(spark, 8)
    wanted = docs.select(docs[id_column].cast("bigint").alias("id"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"))
    wanted = wanted.filter(F.col("id").isNotNull())
    size = F.octet_length("text")
    keyed = cut_lineage(wanted.select("id", F.unhex(F.sha2("text", 256)).alias("key"), size.cast("bigint").alias("size")))
    facts = keyed.filter(F.col("size") >= LENGTH).agg(F.sum("size"), F.count(F.lit(1))).first()
    copies = cut_lineage(group_winners(keyed.filter(F.col("size") >= LENGTH).select("id", "key"), F.min).filter("id <> keep_id").select("id").distinct())
    long = wanted.filter(size >= LENGTH)
    few = copies.count() <= BROADCAST_IDS
    if few:  # whole copies need no suffixes
        long = long.join(F.broadcast(copies), "id", "left_anti")
    buckets = max(1, -(-int((facts[0] or 0) * 2 / (WINDOW + 1)) // bucket_rows))
    folder = f"{shared_folder(spark)}/suffix-{uuid.uuid4().hex}"
    tied = tied_suffixes(long, facts[1], buckets, f"{folder}/tied")
    if not few:  # the texts would be shuffled: leave the copies out of the places
        tied = tied.join(copies, "id", "left_anti")
    packed = zipped(wanted)
    rows = tied_rows(packed, tied.select("id", "at"))
    if tied.groupBy("rest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_rows).isEmpty():
        starts = within_groups(rows)
    else:
        rows.write.parquet(f"{folder}/rows")
        starts = repeated_starts(spark.read.parquet(f"{folder}/rows"), group_rows)
    runs = starts.groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    all_gone = copies.select("id", F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(-1).cast("bigint").alias("stop"))).alias("runs"))
    removed = runs.unionByName(all_gone).select("id", F.col("runs.start").alias("starts"), F.col("runs.stop").alias("stops"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text, starts, stops in zip(frame["zip"], frame["starts"], frame["stops"]):
                data = np.frombuffer(unzipped(text), np.uint8)
                if starts is None:
                    rows.append((len(data), 0, 0, data.tobytes()))
                    continue
                stops = np.where(stops < 0, len(data) - LENGTH, stops)  # -1: to the end
                cover = np.zeros(len(data) + 1, np.int32)
                np.add.at(cover, starts, 1)
                np.add.at(cover, stops + LENGTH, -1)
                gone = np.cumsum(cover[:-1]) > 0
                spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                rows.append((len(data), int(gone.sum()), spans, data[~gone].tobytes()))
            done = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])
            done.insert(0, "doc_id", frame["id"].to_numpy())
            done["kept_sha256"] = [hashlib.sha256(k).hexdigest() for k in done["kept"]]
            yield done[names]

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_bytes]
    kinds = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_bytes
    return packed.join(removed, "id", "left").select("id", "zip", "starts", "stops").mapInPandas(cut, kinds)


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"), with_bytes=False)


QUERIES = {"op5_suffix_dedup": op5_suffix_dedup}
SQL: dict[str, str] = {}
