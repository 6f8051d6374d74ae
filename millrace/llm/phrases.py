"""Phrases of two to five words that are frequent in their language, scored by their weakest cut.

Texts are cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at blanks and tabs; only
A-Z are lower-cased. A phrase is a run of words of one piece.

* A phrase can only be frequent if the phrases it is made of are. So word counts go up one by one:
  of n words only those are summed whose first and last n - 1 words may be frequent.
* Each length is summed by Misra-Gries summaries, one per range of the 64-bit hashes (of language and words).
  A task sends the counts of its texts as packed arrays, a range merges them. The capacity exceeds the
  range's mass divided by the least count, so every frequent phrase survives; the number
  of ranges grows with the text, so that what one merge holds is bounded.
* What survives is told to the next length as a bit map of fixed size (``BITS``), put together from one slice
  per range. Where the map fills up or hashes meet, more phrases are looked at; none is lost.
* A second pass counts the survivors exactly, as text, summed in tasks before the shuffle; words are
  counted as far as they are part of a frequent phrase.

A NULL text is empty, a NULL language is ``und``; ids are not looked at, repeated rows count each.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, chunks, mix64, partitions, utf8
from millrace.workspace import stored

LONGEST = 5
LEAST = 100
BEST = 2000
#: Bits of the map of survivors, as a power of two: 8 MB for each length, whatever the corpus.
BITS = 26
#: Bytes of text that are cut into words at once inside a task.
PORTION = 1_500_000
#: Counts that a task holds before it sends them.
HELD = 1_500_000
HELD_TEXTS = 300_000
#: Most bytes of packed counts that one range has to merge, if every word had a single letter.
RANGE_BYTES = 1 << 27

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_END = np.zeros(256, bool)
_END[[*b".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _END.copy()
_GAP[[32, 9]] = True
_ENTRY = np.dtype([("gram", "<u8"), ("n", "<u4")])
# Two odd bases: the first hash finds phrases, both together tell them apart inside a task.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if base not in _powers or len(_powers[base][0]) < n:
        _powers[base] = tuple(
            np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, b, np.uint64))))
            for b in (base, pow(base, -1, 1 << 64))
        )
    return _powers[base]


class Words:
    """The words of some rows: their places, pieces, rows and hashes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, salts: np.ndarray):
        self.low = _LOWER[data]
        gap = _GAP[self.low]
        first = np.zeros(len(self.low) + 1, bool)
        first[bounds] = True
        apart = np.ones(len(self.low) + 1, bool)
        apart[1:-1] = gap[:-1]
        self.starts = np.flatnonzero(~gap & (apart[:-1] | first[:-1]))
        apart[:-1], apart[-1] = gap, True
        self.ends = np.flatnonzero(~gap & (apart[1:] | first[1:])) + 1
        self.row = np.searchsorted(bounds, self.starts, side="right") - 1
        ends_before = np.cumsum(_END[self.low], dtype=np.int64)
        # Both parts never fall, so they are equal together only inside one piece.
        self.piece = ends_before[self.starts] + self.row
        self.salt = salts[self.row]

    def __len__(self) -> int:
        return len(self.starts)

    def _hashes(self, base: int) -> np.ndarray:
        powers, inverse = _powers_of(base, len(self.low) + 1)
        sums = np.zeros(len(self.low) + 1, np.uint64)
        np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * powers[: len(self.low)], out=sums[1:])
        return mix64((sums[self.ends] - sums[self.starts]) * inverse[self.starts])

    def grams(self, longest: int, which: int = 0) -> Iterator[np.ndarray]:
        """Hashes of the phrases of 1, 2, ... words that start at each word, whatever their pieces."""
        words = self._hashes(_BASES[which])
        gram = mix64(words ^ self.salt)
        yield gram
        for n in range(2, longest + 1):
            gram = mix64(gram[: max(len(words) - n + 1, 0)] * np.uint64(0xD6E8FEB86659FD93) + words[n - 1 :])
            yield gram

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each word on are of one piece."""
        return self.piece[: max(len(self) - n + 1, 0)] == self.piece[n - 1 :]

    def text(self, at: int, n: int) -> str:
        found = self.low[self.starts[at] : self.ends[at + n - 1]].tobytes()
        return (found if n == 1 else b" ".join(found.split())).decode()


def _salts(langs: list[str]) -> np.ndarray:
    known = {x: int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    for batch in batches:
        data, bounds = utf8(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        for a, b in chunks(bounds, PORTION):
            yield Words(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], _salts(langs[a:b])), langs[a:b]


def _marked(bits: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Whether the bits of the hashes are set."""
    at = (gram >> np.uint64(64 - BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _summed(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(gram, kind="stable")
    gram, n = gram[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1]))) if len(gram) else np.empty(0, np.int64)
    return gram[first], np.add.reduceat(n, first) if len(first) else n[:0]


class Summary:
    """Misra-Gries counters: at most ``capacity`` of them; a count is too small by ``cut`` at most."""

    def __init__(self, capacity: int):
        self.capacity, self.cut = capacity, 0
        self.gram, self.n = np.empty(0, np.uint64), np.empty(0, np.int64)

    def merge(self, gram: np.ndarray, n: np.ndarray, cut: int = 0) -> None:
        """Take in the counters of another summary, or of texts counted exactly."""
        self.gram, self.n = _summed(np.concatenate((self.gram, gram)), np.concatenate((self.n, n)))
        self.cut += cut
        if len(self.n) > self.capacity:
            place = len(self.n) - self.capacity - 1
            less = int(np.partition(self.n, place)[place])
            left = self.n > less
            self.gram, self.n, self.cut = self.gram[left], self.n[left] - less, self.cut + less

    def at_least(self, least: int) -> np.ndarray:
        """The hashes whose count may be ``least`` or more."""
        return self.gram[self.n + self.cut >= least]


def _survivors(docs: DataFrame, n: int, least: int, ranges: int, before: np.ndarray | None) -> np.ndarray:
    """The bit map of the phrases of n words that may occur ``least`` times or more."""
    known = None if before is None else docs.sparkSession.sparkContext.broadcast(before)
    schema = pa.schema([("range", pa.int32()), ("packed", pa.binary())])
    shift = np.uint64(64 - (ranges.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for words, _ in _portions(batches):
            with np.errstate(over="ignore"):
                shorter = None
                for gram in words.grams(n):
                    last, shorter = shorter, gram
            kept = words.whole(n)
            if known is not None and len(kept):
                frequent = _marked(known.value, last)
                kept &= frequent[: len(kept)] & frequent[1 : len(kept) + 1]
            held.append(np.unique(gram[kept], return_counts=True))
            if sum(len(g) for g, _ in held) >= HELD:
                yield from send(held)
                held = []
        yield from send(held)

    def send(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if not any(len(g) for g, _ in held):
            return
        found, times = _summed(*(np.concatenate(part) for part in zip(*held)))
        packed = np.empty(len(found), _ENTRY)
        packed["gram"], packed["n"] = found, times
        place = (found >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(found), np.int64)
        cuts = np.searchsorted(place, np.arange(ranges + 1))
        used = np.flatnonzero(np.diff(cuts))
        yield batch_of({"range": used, "packed": [packed[cuts[i] : cuts[i + 1]].tobytes() for i in used]}, schema)

    slice_bits = (1 << BITS) // ranges

    def merge(table: pa.Table) -> pa.Table:
        at = table.column("range")[0].as_py()
        blocks = [np.frombuffer(b.as_buffer(), _ENTRY) for b in table.column("packed")]
        mass = sum(int(b["n"].sum(dtype=np.int64)) for b in blocks)
        summary = Summary(mass // least + 1)
        held, size = [], 0
        for i, block in enumerate(blocks):
            held.append(block)
            size += len(block)
            if size >= max(summary.capacity, 1 << 20) or i == len(blocks) - 1:
                part = np.concatenate(held)
                summary.merge(part["gram"], part["n"].astype(np.int64))
                held, size = [], 0
        bits = np.zeros(slice_bits, np.uint8)
        bits[(summary.at_least(least) >> np.uint64(64 - BITS)).astype(np.int64) - at * slice_bits] = 1
        return pa.table({"range": pa.array([at], pa.int32()), "packed": [np.packbits(bits, bitorder="little").tobytes()]})

    kind = "range int, packed binary"
    merged = docs.mapInArrow(count, kind).groupBy("range").applyInArrow(merge, kind)
    bits = np.zeros((1 << BITS) // 8, np.uint8)
    # One slice per range, 8 MB together.
    for row in merged.toLocalIterator():
        part = np.frombuffer(row["packed"], np.uint8)
        bits[row["range"] * len(part) : (row["range"] + 1) * len(part)] = part
    if known is not None:
        known.unpersist()
    return bits


def _counted(docs: DataFrame, maps: dict[int, np.ndarray], ranges: int) -> DataFrame:
    """Rows (lang, phrase, words, n): exact counts of what the maps of each length hold.

    With a map for single words, rows of no words hold the number of words of each language. As in the first pass, a
    task sends packed counts, here with the texts, and each range of phrases is merged on its own.
    """
    known = docs.sparkSession.sparkContext.broadcast(maps)
    schema = pa.schema([("range", pa.int32()), ("packed", pa.binary())])
    texts = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, str, int]] = Counter()
        for words, langs in _portions(batches):
            if 1 in known.value:
                for row, n in zip(*np.unique(words.row, return_counts=True)):
                    held[langs[row], "", 0] += int(n)
            longest = max(known.value)
            with np.errstate(over="ignore"):
                for n, (one, other) in enumerate(zip(words.grams(longest), words.grams(longest, 1)), start=1):
                    if n not in known.value:
                        continue
                    at = np.flatnonzero(words.whole(n) & _marked(known.value[n], one))
                    _, first, kind, times = np.unique(
                        one[at], return_index=True, return_inverse=True, return_counts=True
                    )
                    if (other[at] != other[at[first]][kind]).any():
                        both = np.stack((one[at], other[at]), axis=1)
                        _, first, times = np.unique(both, axis=0, return_index=True, return_counts=True)
                    for i, time in zip(at[first].tolist(), times.tolist()):
                        held[langs[words.row[i]], words.text(i, n), n] += time
            if len(held) >= HELD_TEXTS:
                yield from sent(held)
                held.clear()
        yield from sent(held)

    def sent(held: Counter) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        lang, phrase, words = zip(*held)
        table = pa.table([lang, phrase, words, list(held.values())], schema=texts)
        place = np.array([crc32(p.encode()) % ranges for p in phrase])
        order = np.argsort(place, kind="stable")
        table, cuts = table.take(pa.array(order)), np.searchsorted(place[order], np.arange(ranges + 1))
        used = np.flatnonzero(np.diff(cuts))
        packed = []
        for i in used:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, texts) as stream:
                stream.write_table(table.slice(cuts[i], cuts[i + 1] - cuts[i]))
            packed.append(out.getvalue().to_pybytes())
        yield batch_of({"range": used, "packed": packed}, schema)

    def merge(blocks: pa.Table) -> pa.Table:
        parts = pa.concat_tables(pa.ipc.open_stream(b.as_buffer()).read_all() for b in blocks.column("packed"))
        summed = parts.group_by(["lang", "phrase", "words"]).aggregate([("n", "sum")])
        return summed.rename_columns({"n_sum": "n"}).select(texts.names).cast(texts)

    packed = docs.mapInArrow(count, "range int, packed binary")
    return packed.groupBy("range").applyInArrow(merge, "lang string, phrase string, words int, n bigint")


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows (lang, phrase, words, n): every phrase of two to five words with n >= ``least``.

    Also the words that these are made of, and the number of all words of each language in rows of no words. Stored in
    the shared folder.
    """
    docs = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # At most one word for two bytes of text.
    wanted = max(partitions(docs), size // 2 * _ENTRY.itemsize // RANGE_BYTES + 1)
    ranges = min(1 << (wanted - 1).bit_length(), 1 << (BITS - 3))
    maps: dict[int, np.ndarray] = {}
    for n in range(1, LONGEST + 1):
        bits = _survivors(docs, n, least, ranges, maps.get(n - 1))
        if not bits.any():
            break
        maps[n] = bits
    maps.pop(1, None)
    if not maps:
        return docs.sparkSession.createDataFrame([], "lang string, phrase string, words int, n bigint")
    found, _ = stored(_counted(docs, maps, ranges).where(F.col("n") >= least), "phrases")
    used = _survivors(found.select(F.col("phrase").alias("text"), "lang"), 1, 1, ranges, None)
    return found.unionByName(stored(_counted(docs, {1: used}, ranges), "words")[0])


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language.

    a, l, r are the counts of the phrase and of the two sides of its lowest-scoring cut, n the language's
    words, score is floor(1000 * a * n / (l * r)). A phrase is left out where a longer one that holds it occurs as often.
    """
    counts = phrase_counts(docs, least)
    totals = counts.where("words = 0").select("lang", F.col("n").alias("total"))
    parts = counts.where("words > 0")
    some = parts.where("words > 1").withColumn("w", F.split("phrase", " "))
    size = F.col("words")
    # A longer phrase that occurs as often implies one that is a single word longer.
    inner = some.where("words > 2").select(
        "lang",
        F.explode(F.array(_joined(F.col("w"), F.lit(1), size - 1), _joined(F.col("w"), F.lit(2), size - 1))).alias("phrase"),
        F.col("n").alias("longer"),
    ).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    own = some.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR longer < n")
    cuts = own.select("lang", "phrase", "w", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        _joined(F.col("w"), F.lit(1), F.col("k")).alias("left"),
        _joined(F.col("w"), F.col("k") + 1, size - F.col("k")).alias("right"),
    )

    def side(name: str, count: str) -> DataFrame:
        return parts.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))

    scored = (
        cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).join(totals, "lang")
        .withColumn("score", F.expr(
            "(1000 * CAST(a AS DECIMAL(38, 0)) * CAST(total AS DECIMAL(38, 0)))"
            " DIV (CAST(l AS DECIMAL(38, 0)) * CAST(r AS DECIMAL(38, 0)))"
        ))
    )
    weakest = scored.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        weakest.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= best)
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


#: DuckDB's form of ``collocations``.
SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS total FROM split GROUP BY lang
), grams AS (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM split, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(w) >= size)
), counts AS (
  SELECT lang, phrase, size, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 100
), several AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1
), inside AS (
  SELECT lang, part, max(n) AS longer
  FROM (SELECT lang, n, unnest([array_to_string(w[1 : size - 1], ' '), array_to_string(w[2 : size], ' ')]) AS part FROM several WHERE size > 2)
  GROUP BY lang, part
), own AS (
  SELECT s.* FROM several s LEFT JOIN inside i ON s.lang = i.lang AND s.phrase = i.part WHERE i.longer IS NULL OR i.longer < s.n
), cuts AS (
  SELECT lang, phrase, n AS a, k, array_to_string(w[1 : k], ' ') AS lhs, array_to_string(w[k + 1 : size], ' ') AS rhs
  FROM (SELECT *, unnest(range(1, size)) AS k FROM own)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.n AS l, y.n AS r, t.total,
    CAST((1000::HUGEINT * c.a * t.total) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON c.lang = x.lang AND c.lhs = x.phrase
  JOIN counts y ON c.lang = y.lang AND c.rhs = y.phrase JOIN totals t ON c.lang = t.lang
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, total AS n, score FROM weakest
) WHERE rank <= 2000
"""
