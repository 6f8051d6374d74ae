"""Byte-level BPE encoding with a lazily determinised transducer, and streaming decoding.

The merges of a rank file are compiled into rules on neighbours: two tokens may stand side by
side if merging never joins anything across their border. A sequence is the encoding of
its bytes if all its neighbours may. So for every prefix of the bytes there is one last
token, and reading one byte finds the next from those of the positions before it.

A state stands for all places at which a token that still goes on can have begun: that is
the longest such stretch of bytes, since the others are its ends. A transition carries
the tokens that end with its byte; the first that may stand beside the last token at its beginning
is taken. States and transitions are made when first met and remembered; there are no
more states than beginnings of tokens. A token goes out once every place where a coming token
can begin leads back through its end, so the lookahead is bounded by the longest
token and the stretch between two looks.

Decoding joins the bytes of tokens and runs a UTF-8 machine over them that keeps an unfinished
character until its other bytes arrive.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of
from millrace.llm.pieces import LONGEST, REMEMBERED, PartIds, matches, read_ranks

#: Answers on neighbours that a task remembers at once; beyond, it starts anew.
PAIRS = 1_000_000
#: Bytes of one match between two looks for tokens that are sure.
LOOK = 4096
CHUNK = 4096


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Transducer:
    """Encodes single matches of the pattern."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.sizes = {r: len(b) for b, r in ranks.items()}
        self.prefixes = {b[:i] for b in ranks for i in range(1, len(b))}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.states: dict[bytes, int] = {}
        self.open: list[bytes] = []
        self.moves: dict[int, tuple[int, tuple, int]] = {}
        self.start = self._state(b"")

    def _state(self, open_: bytes) -> int:
        known = self.states.get(open_)
        if known is None:
            known = self.states[open_] = len(self.open)
            self.open.append(open_)
        return known

    def merged(self, data: bytes, down_to: int = 1) -> list[int]:
        """Plain merging, lowest rank first, until ``down_to`` tokens are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            best, at = min(
                ((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            )
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens a token is merged from; None for single bytes and for tokens merging never makes."""
        if token not in self.halves:
            data = self.bytes_of[token]
            found = self.merged(data, 2) if len(data) > 1 else []
            made = len(found) == 2 and self.ranks.get(data) == token
            self.halves[token] = (found[0], found[1]) if made else None
        return self.halves[token]

    def _beside(self, left: int, right: int) -> bool:
        known = self._apart(left, right)
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[left << 32 | right] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Whether no merge ever joins two tokens across their border.

        Undoes the merges of both from the last one back: of the two tokens at the border the one
        that was made later is halved. The border would have been merged away if its two
        neighbours make a token of a lower rank than the merge undone before, that is, sooner;
        among merges of equal rank the one further to the left goes first.
        """
        before = 1 << 60
        while True:
            joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < before:
                return False
            halves_left = self._halves(left)
            halves_right = self._halves(right)
            if halves_left is None and halves_right is None:
                return True
            if halves_right is None or (halves_left is not None and left > right):
                before, left = left, halves_left[1]
            else:
                # The right one is made after anything of its rank to its left.
                before, right = right + 1, halves_right[0]

    def _step(self, state: int, byte: int) -> tuple[int, tuple, int]:
        """The next state, the longer tokens ending with the byte, longest first, and the byte's own token."""
        read = self.open[state] + byte.to_bytes()
        ends = []
        for i in range(len(read) - 1):
            token = self.ranks.get(read[i:])
            if token is not None and self._halves(token) is not None:
                ends.append((len(read) - i, token))
        i = 0
        while i < len(read) and read[i:] not in self.prefixes:
            i += 1
        move = self.moves[state << 8 | byte] = (self._state(read[i:]), tuple(ends), self.ranks[read[-1:]])
        return move

    def _chain(self, last: list, at: int) -> list[int]:
        """Ends of the tokens that lead to a position, the position first."""
        ends = [at]
        while at:
            at -= self.sizes[last[at]]
            ends.append(at)
        return ends

    def _tokens(self, last: list, at: int) -> list[int]:
        return [last[i] for i in reversed(self._chain(last, at)[:-1])]

    def _sure(self, last: list, state: int) -> int:
        """The greatest end that all places where a coming token can begin lead back through."""
        n, open_ = len(last) - 1, self.open[state]
        common = set(self._chain(last, n))
        for i in range(len(open_)):
            if open_[i:] in self.prefixes:
                common &= set(self._chain(last, n - len(open_) + i))
        return max(common)

    def encode(self, data: bytes) -> list[int]:
        if data in self.ranks:
            return [self.ranks[data]]
        out: list[int] = []
        last: list[int | None] = [None]
        state, moves, pairs = self.start, self.moves, self.pairs
        for byte in data:
            state, ends, token = moves.get(state << 8 | byte) or self._step(state, byte)
            for size, longer in ends:
                left = last[-size]
                if left is None:
                    token = longer
                    break
                fits = pairs.get(left << 32 | longer)
                if fits is None:
                    fits = self._beside(left, longer)
                if fits:
                    token = longer
                    break
            last.append(token)
            if len(last) > LOOK:
                sure = self._sure(last, state)
                out += self._tokens(last, sure)
                # From here on the last sure token is the left neighbour, as None is at the beginning.
                last = last[sure:]
        return out + self._tokens(last, len(last) - 1)


class MatchIds(dict):
    """Ids of matches as little-endian unsigned 32-bit integers; remembers short matches seen before."""

    def __init__(self, transducer: Transducer):
        self.transducer = transducer

    def __missing__(self, match: str) -> bytes:
        ids = self.transducer.encode(match.encode())
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(match) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[match] = found
        return found


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> PartIds:
    known, split = MatchIds(Transducer(read_ranks(path))).__getitem__, matches(pattern)
    return PartIds(lambda part: b"".join(map(known, split(part))))


class Utf8:
    """Takes bytes in any portions and gives text; broken bytes become U+FFFD."""

    def __init__(self) -> None:
        self.pending = b""

    def feed(self, data: bytes) -> str:
        data = self.pending + data
        keep = len(data) - self._unfinished(data)
        self.pending = data[keep:]
        return data[:keep].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.pending = self.pending, b""
        return rest.decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Length of the character that has begun at the end and still lacks bytes."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:
                need = 2 if 0xC2 <= byte <= 0xDF else 3 if 0xE0 <= byte <= 0xEF else 4 if 0xF0 <= byte <= 0xF4 else 1
                return back if need > back else 0
        return 0


def decoded(ids: array, bytes_of: dict[int, bytes]) -> Iterator[tuple[bytes, str]]:
    """Bytes and text of the ids, portion by portion; the text lags behind by unfinished characters."""
    machine = Utf8()
    for i in range(0, len(ids), CHUNK):
        data = b"".join(map(bytes_of.__getitem__, ids[i : i + CHUNK]))
        yield data, machine.feed(data)
    if tail := machine.close():
        yield b"", tail


def decode(ids: Iterable[int], path: str | None = None) -> str:
    table = {r: b for b, r in read_ranks(path or vocabulary()).items()}
    return "".join(text for _, text in decoded(array("I", ids), table))


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, ids (little-endian, 32 bits each). NULL counts as empty."""
    path, pattern = path or vocabulary(), pattern or _pattern()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path, pattern)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield batch_of({"doc_id": batch.column("doc_id"), "ids": [known.of(t or "") for t in texts]}, schema)

    return _texts(docs).mapInArrow(run, "doc_id bigint, ids binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, decoded_chars of ids and of what they decode to."""
    path = path or vocabulary()
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()), ("decoded_chars", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {r: b for b, r in read_ranks(path).items()}
        for batch in batches:
            rows = []
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids = array("I")
                ids.frombytes(packed)
                seen, chars = hashlib.sha256(), 0
                for data, text in decoded(ids, table):
                    seen.update(data)
                    chars += len(text)
                rows.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), seen.hexdigest(), chars))
            if rows:
                yield batch_of(dict(zip(schema.names, zip(*rows))), schema)

    return encoded(docs, path, pattern).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, decoded_chars bigint"
    )
