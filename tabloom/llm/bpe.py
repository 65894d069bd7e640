"""Byte-level BPE: a lazily determinised transducer encodes, a UTF-8 state machine decodes.

A token sequence is the BPE encoding of its bytes exactly when every pair of
neighbours is the encoding of the bytes of the pair. So the merges compile into
a nondeterministic transducer whose configurations are (last token, place in
the trie of tokens inside the next one). Sets of configurations with their
pending tokens are the states of the deterministic one; they are made the first
time they are met and kept. What all configurations agree on is emitted: a
token leaves as soon as no longer token can replace it, after fewer bytes than
the longest token has.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import table, whole_batches

MOST_STATES = 100_000
MOST_WORDS = 250_000
CHUNK = 1 << 16


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank from a file with lines of base64 token and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Transducer:
    """Encodes one pre-token at a time; states are made when first reached.

    Kept states are dropped and made anew beyond `MOST_STATES`, which bounds
    memory and never changes a result.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.edges: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.inner = bytearray(1)  # 1: a longer token goes on from this node
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = 1
                node = self.edges.setdefault(node << 8 | byte, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
                    self.inner.append(0)
            self.token_at[node] = rank
        self.pairs: dict[int, bool] = {}
        self.parts: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.edge_parts: dict[tuple[bytes, int], list] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, tuple]] = {}
        self.start = self._number(((-1, 0, ()),))

    def _number(self, configurations: tuple) -> int:
        number = self.numbers.get(configurations)
        if number is None:
            number = self.numbers[configurations] = len(self.states)
            self.states.append(configurations)
        return number

    def merge(self, data: bytes, below: int = 1 << 62) -> list[int]:
        """The defining procedure: merge the lowest-ranked neighbours, leftmost first, by merges of rank under `below`."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [(rank, i) for i in range(len(parts) - 1) if (rank := self.ranks.get(parts[i] + parts[i + 1], below)) < below]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts that the last merge of `token` joins; None for a byte or a token that merging never makes."""
        if token not in self.parts:
            found = self.merge(token, below=self.ranks[token]) if len(token) > 1 else []
            self.parts[token] = (self.bytes_of[found[0]], self.bytes_of[found[1]]) if len(found) == 2 else None
        return self.parts[token]

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """Parts that stand at one end of `token` while it is merged, each with the rank of the merge that swallows it."""
        key = (token, side)
        if key not in self.edge_parts:
            out = [(token, len(self.ranks) * 2)]
            while (split := self.halves(token)) is not None:
                out.append((split[side], self.ranks[token]))
                token = split[side]
            self.edge_parts[key] = out
        return self.edge_parts[key]

    def fits(self, last: int, token: int) -> bool:
        """Whether `token` may follow `last` (-1: the start) in an encoding.

        Each of the two is made by its own merges unless parts at the border
        join first: at equal rank the merge further left goes first.
        """
        key = last << 32 | token
        known = self.pairs.get(key)
        if known is None:
            if last < 0:
                right = self.bytes_of[token]
                known = len(right) == 1 or self.halves(right) is not None
            else:
                known = self.fits(-1, token) and not self._crossed(self.bytes_of[last], self.bytes_of[token])
            if len(self.pairs) > 4 * MOST_STATES:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _crossed(self, left: bytes, right: bytes) -> bool:
        """Whether parts of two tokens join across their border before the tokens are complete."""
        get, starts = self.ranks.get, self.edge(right, 0)
        for p, p_until in self.edge(left, 1):
            for q, q_until in starts:
                rank = get(p + q)
                if rank is not None and rank < p_until and rank <= q_until:
                    return True
        return False

    def _step(self, state: int, byte: int) -> tuple:
        reached, whole = [], None  # from the earliest start of the open token to the latest
        edges, inner, token_at, pairs = self.edges, self.inner, self.token_at, self.pairs
        for last, node, pending in self.states[state]:
            to = edges.get(node << 8 | byte)
            if to is None:
                continue
            if inner[to]:
                reached.append((last, to, pending))
            if whole is None and (token := token_at[to]) >= 0:  # an encoding is unique: look no further
                if pairs[key] if (key := last << 32 | token) in pairs else self.fits(last, token):
                    whole = (token, 0, (*pending, token))
        reached.append(whole)
        shortest = reached[0][2]
        for c in reached:
            if len(c[2]) < len(shortest):
                shortest = c[2]
        agreed = len(shortest)
        while agreed and any([c[2][:agreed] != shortest[:agreed] for c in reached]):
            agreed -= 1
        following = tuple([(last, node, pending[agreed:]) for last, node, pending in reached] if agreed else reached)
        if len(self.states) >= MOST_STATES:
            return -1, following, shortest[:agreed]
        done = self.steps[state << 8 | byte] = (self._number(following), shortest[:agreed])
        return done

    def _finish(self, state: int, byte: int) -> tuple:
        """What is still to be emitted when `byte` is the last one; makes no state."""
        for last, node, pending in self.states[state]:
            token = self.token_at[self.edges.get(node << 8 | byte, 0)]
            if token >= 0 and self.fits(last, token):
                return (*pending, token)
        raise ValueError("the vocabulary lacks a byte")

    def encode(self, data: bytes) -> list[int]:
        """Tokens of one pre-token; the whole of it being a token comes first, as in the tiktoken library."""
        whole = self.ranks.get(data)
        if whole is not None or not data:
            return [whole] if data else []
        if len(self.states) + len(data) >= MOST_STATES:
            self._reset()
        out: list[int] = []
        state, steps = self.start, self.steps
        for byte in memoryview(data)[:-1]:
            done = steps.get(state << 8 | byte)
            if done is None:
                done = self._step(state, byte)
                if done[0] < 0:  # too many states: go on from this one in an empty table
                    self._reset()
                    steps = self.steps
                    done = (self._number(done[1]), done[2])
            state, certain = done
            if certain:
                out += certain
        out += self._finish(state, data[-1])
        return out


class Utf8Machine:
    """Incremental UTF-8: `feed` returns the text that is complete and holds an unfinished character back.

    The states are the well-formed continuations of a lead byte: how many bytes
    are still to come and the range of the next one. Bytes that can belong to
    no character become U+FFFD.
    """

    #: lead bytes from-to: (bytes to come, lowest and highest second byte)
    LEADS = [
        (0xC2, 0xDF, 1, 0x80, 0xBF),
        (0xE0, 0xE0, 2, 0xA0, 0xBF),
        (0xE1, 0xEC, 2, 0x80, 0xBF),
        (0xED, 0xED, 2, 0x80, 0x9F),
        (0xEE, 0xEF, 2, 0x80, 0xBF),
        (0xF0, 0xF0, 3, 0x90, 0xBF),
        (0xF1, 0xF3, 3, 0x80, 0xBF),
        (0xF4, 0xF4, 3, 0x80, 0x8F),
    ]
    TABLE = {lead: row[2:] for row in LEADS for lead in range(row[0], row[1] + 1)}

    def __init__(self) -> None:
        self.held = b""

    @classmethod
    def unfinished(cls, data: bytes) -> int:
        """Length of the started but unfinished character at the end of `data`."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:
                continue
            to_come, low, high = cls.TABLE.get(lead, (0, 0, 0))
            if back > to_come or back > 1 and not low <= data[-back + 1] <= high:
                return 0
            return back
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self.unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


# The classes of the splitting pattern for characters up to U+024F, where a plain `re` with them gives the same matches.
LATIN = {
    r"\p{L}": r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f",
    r"\p{N}": r"0-9\xb2\xb3\xb9\xbc-\xbe",
    r"\s": r"\t-\r \x85\xa0",
    r"\S": r"^\t-\r \x85\xa0",
}


def latin_pattern(pattern: str) -> str:
    """The pattern with its Unicode classes spelt out for Latin text."""
    inside = False
    out, i = "", 0
    while i < len(pattern):
        name = next((c for c in LATIN if pattern.startswith(c, i)), None)
        if name:
            out += LATIN[name] if inside else f"[{LATIN[name]}]"
            i += len(name)
            continue
        inside = pattern[i] == "[" or inside and pattern[i] != "]"
        out += pattern[i]
        i += 1
    return out


def pieces_of(text: str, chunk: int = CHUNK) -> Iterator[str]:
    """Cut a long text where the splitting pattern always has a border: before a single space between words."""
    start, border = 0, regex.compile(r"(?<=\S) (?=\p{L})")
    while len(text) - start > chunk:
        found = border.search(text, start + chunk)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Words(dict):
    """Decimal ids of words, made when first asked for.

    At most MOST_WORDS are kept: when the newer half is full it becomes the
    older one, whose words come back when they are met again. So the frequent
    words stay, however many rare ones pass.
    """

    def __init__(self, transducer: Transducer):
        self.encode, self.older = transducer.encode, {}

    def __missing__(self, word: str) -> str:
        ids = self.older.get(word)
        if ids is None:
            ids = ",".join(map(str, self.encode(word.encode("utf-8"))))
        if len(word) <= 64:
            if len(self) >= MOST_WORDS // 2:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encodes and decodes whole texts with one vocabulary; lives as long as a Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.split = regex.compile(pattern)
        self.split_latin = re.compile(latin_pattern(pattern))
        self.latin = re.compile("[\x00-\u024f]*")
        self.words = Words(self.transducer)
        self.bytes_of = {str(rank): token for rank, token in self.transducer.bytes_of.items()}

    def encode(self, text: str) -> Iterator[str]:
        """Decimal ids joined by commas, piece by piece."""
        word = self.words.__getitem__
        for piece in pieces_of(text):
            if len(piece) > 2 * CHUNK:  # one long run without a border: never all matches at once
                matches = (m.group() for m in self.split.finditer(piece))
                while part := list(islice(matches, CHUNK)):
                    yield ",".join(map(word, part))
                continue
            latin = piece.isascii() or self.latin.fullmatch(piece)
            parts = (self.split_latin if latin else self.split).findall(piece)
            if parts:
                yield ",".join(map(word, parts))

    def decode(self, ids: Iterable[str]) -> Iterator[str]:
        """Text of the ids, piece by piece."""
        machine = Utf8Machine()
        for part in ids:
            yield machine.feed(b"".join(map(self.bytes_of.__getitem__, part.split(","))))
        yield machine.end()


_CODECS: dict[str, Codec] = {}


def codec(data: bytes, pattern: str) -> Codec:
    """One codec per vocabulary and worker process, so that its states serve all tasks of the worker.

    States and words form no cycles; a collector that looks through them again and again only costs time.
    """
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(parse_ranks(data), pattern)
        gc.freeze()
        gc.set_threshold(100_000, 50, 50)
    return _CODECS[key]


def round_trip(texts: DataFrame, data: bytes, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded and the ids decoded again.

    `data` is the content of a rank file, shipped to the workers once. A null
    or empty text has no tokens (digests of the empty string). Equal rows give
    equal rows; other columns are not looked at; an empty table gives no rows.
    Texts of any length are worked off in pieces.
    """
    spark = texts.sparkSession
    whole_batches(spark, 4)
    shipped = spark.sparkContext.broadcast(data)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(shipped.value, pattern)
        for frame in frames:
            rows = []
            for text in frame["text"]:
                ids, decoded, n = hashlib.sha256(), hashlib.sha256(), 0
                encoded = []
                for part in own.encode(text):
                    ids.update(("," + part if n else part).encode())
                    n += part.count(",") + 1
                    encoded.append(part)
                for part in own.decode(encoded):
                    decoded.update(part.encode("utf-8"))
                rows.append((n, ids.hexdigest(), decoded.hexdigest()))
            done = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            done.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield done

    kind = texts.schema[id_column].dataType.simpleString()
    wanted = texts.select(texts[id_column].alias("doc_id"), F.coalesce(texts[text_column].cast("string"), F.lit("")).alias("text"))
    return wanted.mapInPandas(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def public_vocabulary(name: str = VOCABULARY) -> tuple[bytes, str]:
    """Content of a rank file of the public tokenizers and the pattern that goes with it."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"), *public_vocabulary())


QUERIES = {"op3_byte_bpe": op3_byte_bpe}
SQL: dict[str, str] = {}
