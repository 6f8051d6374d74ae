"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, modulo two primes, the polynomial hash of its first i code
points. Any span's hash follows from two entries, so spans are compared without reading them, and
the longest common extension of two places is found by binary search. The fingerprint is a
bottom sketch of the hashes of all spans of ``SPAN`` code points (the whole text, if shorter):
its ``KEPT`` smallest values as hexadecimal text. The likeness of two fingerprints estimates
the Jaccard similarity of their spans. The empty text has an empty fingerprint; two of
them are alike by 1, one and another text by 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, mix64, partitions

SPAN = 12
KEPT = 48
DIGITS = 10
#: Code points of rows that are hashed together.
TOGETHER = 1 << 16
#: 2^31 less 1 and less 19, so that the upper bits of a number count 1 or 19 times.
PRIMES = (2147483647, 2147483629)
BASES = (1_000_003, 1_221_221)
_powers: list[np.ndarray] = [np.ones(1, np.uint64) for _ in PRIMES]
_inverse: list[np.ndarray] = [np.ones(1, np.uint64) for _ in PRIMES]


def modulo(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` below 2^63 modulo one of the primes, without dividing."""
    bits, more = np.uint64((1 << 31) - 1), np.uint64((1 << 31) - p)
    for _ in range(2):
        high = x >> np.uint64(31)
        if more > 1:
            high *= more
        x = x & bits
        x += high
    # Below 2^31 + 19 * 20; where it is below p, the difference wraps around to a huge number.
    return np.minimum(x, x - np.uint64(p))


def _grow(n: int) -> None:
    """Powers of the bases and of their inverses up to n, doubling what is there."""
    for k, p in enumerate(PRIMES):
        for table, base in ((_powers, BASES[k]), (_inverse, pow(BASES[k], -1, p))):
            while len(table[k]) <= n:
                more = table[k] * np.uint64(pow(base, len(table[k]), p)) % np.uint64(p)
                table[k] = np.concatenate([table[k], more])


class Prefixes:
    """Prefix arrays of a text, or of texts one behind the other, given by the code points."""

    def __init__(self, points: np.ndarray):
        _grow(len(points) + 1)
        self.n = len(points)
        self.sums = []
        wide = points.astype(np.uint64) + np.uint64(1)
        for k, p in enumerate(PRIMES):
            # At most 2^33 numbers below 2^31 are summed.
            total = np.zeros(self.n + 1, np.uint64)
            np.cumsum(modulo(wide * _powers[k][: self.n], p), out=total[1:])
            self.sums.append(modulo(total, p))

    def span(self, i: int, j: int) -> tuple[int, ...]:
        """Hash of the code points from i to before j, wherever they stand."""
        return tuple(
            (int(s[j]) - int(s[i])) * int(_inverse[k][i]) % PRIMES[k] for k, s in enumerate(self.sums)
        )

    def spans(self, width: int) -> np.ndarray:
        """Hashes of all spans of one width, mixed to 64 bits."""
        n = self.n - width + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for k, p in enumerate(PRIMES):
            s = self.sums[k]
            # A difference below 2^32 times a number below 2^31.
            value = modulo((s[width:] + np.uint64(p) - s[:n]) * _inverse[k][:n], p)
            out = (out << np.uint64(31)) ^ value
        return mix64(out)


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int, most: int | None = None) -> int:
    """How many code points (``most`` at most) from i in one text and j in the other are equal."""
    end = min(a.n - i, b.n - j) if most is None else most
    low, step = 0, 1
    while low + step <= end and a.span(i + low, i + low + step) == b.span(j + low, j + low + step):
        low, step = low + step, 2 * step
    high = min(end, low + step - 1)
    while low < high:
        mid = (low + high + 1) // 2
        if a.span(i, i + mid) == b.span(j, j + mid):
            low = mid
        else:
            high = mid - 1
    return low


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def span_hashes(points: np.ndarray) -> np.ndarray:
    return Prefixes(points).spans(min(SPAN, len(points))) if len(points) else np.empty(0, np.uint64)


def least(values: np.ndarray) -> np.ndarray:
    """The ``KEPT`` smallest distinct values, which have 4 * ``DIGITS`` bits."""
    if len(values) > 4 * KEPT:
        # Some 3 * KEPT of them, if they are spread.
        found = np.unique(values[values < np.uint64((3 * KEPT << 4 * DIGITS) // len(values))])
        if len(found) >= KEPT:
            return found[:KEPT]
    return np.unique(values)[:KEPT]


def shortened(hashes: np.ndarray) -> np.ndarray:
    """Hashes cut to the digits kept."""
    return hashes >> np.uint64(64 - 4 * DIGITS)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The smallest distinct hashes, cut to the digits kept."""
    return least(shortened(hashes))


def written(values: np.ndarray) -> str:
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2 :].tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.array([int(fingerprint[i : i + DIGITS], 16) for i in range(0, len(fingerprint), DIGITS)], np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smallest values of both sketches together that both hold."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    of_union = np.arange(2, len(both) + 1) - np.cumsum(twice)
    size = min(KEPT, 1 + int((~twice).sum()))
    return float((twice & (of_union <= KEPT)).sum() / size)


COLUMNS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, kept_chars bigint"
)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, edge, doc_id): each with the row behind it in its bucket."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("kept_chars", pa.int64()),
    ])
    held: list[tuple] = []
    for batch in batches:
        rows = held + list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "edge", "doc_id", "text"))))
        sizes = np.cumsum([len(r[3] or "") for r in rows])
        start = 0
        while start < len(rows) - 1:
            # Rows hashed together, two at least; the last one is also the first of the next.
            end = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + TOGETHER))
            end = min(max(end, start + 2), len(rows))
            out = _paired(rows[start:end])
            if out:
                yield batch_of(dict(zip(schema.names, zip(*out))), schema)
            start = end - 1
        held = rows[-1:]


def _paired(rows: list[tuple]) -> list[tuple]:
    """The results of all rows with a row behind them in the same bucket."""
    texts = [r[3] or "" for r in rows]
    points = points_of("".join(texts))
    begins = np.cumsum([0, *map(len, texts)]).tolist()
    prefixes = Prefixes(points)
    values = shortened(prefixes.spans(SPAN))

    def own(i: int) -> np.ndarray:
        a, b = begins[i], begins[i + 1]
        return least(values[a : b - SPAN + 1]) if b - a >= SPAN else sketch(span_hashes(points[a:b]))

    pairs = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
    sketches = {i: own(i) for i in {*pairs, *(i + 1 for i in pairs)}}
    # What follows where a text is cut, behind the code points that its spans begin in.
    cuts, tails, ends = {}, {}, [np.empty(0, np.uint32)]
    for i in pairs:
        n = len(texts[i])
        cuts[i] = n - n // 4
        tails[i] = points[begins[i + 1] : begins[i + 1] + min(n // 4, len(texts[i + 1]))]
        if cuts[i] >= SPAN:
            cut = begins[i] + cuts[i]
            ends += [points[cut - SPAN + 1 : cut], tails[i]]
    behind = shortened(Prefixes(np.concatenate(ends)).spans(SPAN))
    out, place = [], 0
    for i in pairs:
        n, cut, tail = len(texts[i]), cuts[i], tails[i]
        if cut >= SPAN:
            before = values[begins[i] : begins[i] + cut - SPAN + 1]
            changed = least(np.concatenate([before, behind[place : place + len(tail)]]))
            place += SPAN - 1 + len(tail)
        else:
            changed = sketch(span_hashes(np.concatenate([points[begins[i] : begins[i] + cut], tail])))
        kept = common_extension(prefixes, begins[i] + cut, prefixes, begins[i + 1], len(tail))
        edited = texts[i][:cut] + texts[i + 1][: n // 4]
        out.append((
            rows[i][2], n, hashlib.sha256(edited.encode()).hexdigest(), written(sketches[i]), written(changed),
            likeness(sketches[i], changed), likeness(sketches[i], sketches[i + 1]), cut + kept,
        ))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its fingerprint, and that of the text with its end replaced.

    The last quarter of the code points gives way to the first as many of the next row by doc_id
    (NULL first, equal ids by text; after the last row the first), NULL texts being empty.
    ``kept_chars`` is how far a text and its edited text are equal from the start. Rows are dealt into
    ranges of ids; the first row of a range is also sent to the range below it.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    width = partitions(docs)
    steps = 3 * width
    cuts = texts.agg(F.percentile_approx("doc_id", [i / steps for i in range(1, steps)], 20 * steps)).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        known = pd.to_numeric(ids, errors="coerce")
        spots = np.searchsorted(bounds, known.fillna(0).to_numpy(np.int64), side="right")
        return pd.Series(np.where(known.isna(), 0, spots).astype(np.int32))

    placed = texts.withColumn("bucket", place("doc_id"))
    first = placed.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("least")).collect()
    order = sorted(r["bucket"] for r in first)
    # One row for each range.
    least = {r["bucket"]: r["least"]["doc_id"] for r in first}
    rows = [(b, least[b], order[i - 1]) for i, b in enumerate(order)]
    edges = docs.sparkSession.createDataFrame(rows or [(-1, None, -1)], "bucket int, least bigint, below int")
    sent = placed.join(F.broadcast(edges), "bucket")
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("edge"))
    there = F.struct(F.col("below").alias("bucket"), F.lit(True).alias("edge"))
    both = F.when(F.col("doc_id").eqNullSafe(F.col("least")), F.array(here, there)).otherwise(F.array(here))
    dealt = sent.select("doc_id", "text", F.explode(both).alias("to")).select("to.bucket", "to.edge", "doc_id", "text")
    return (
        dealt.repartition(width, "bucket").sortWithinPartitions("bucket", "edge", "doc_id", "text")
        .mapInArrow(_compared, COLUMNS)
    )
