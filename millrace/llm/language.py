"""Language identification with interpolated Kneser-Ney character models.

Every language has its own model of character n-grams. Counts come from a bounded sample of
labelled rows, whole texts: ``sample`` rows per language, drawn by a hash of the id. The
highest order uses counts, the lower orders the number of distinct left neighbours
(Kneser-Ney), all interpolated with absolute discounting. A model is kept as sorted arrays of
64-bit n-gram codes and their costs. A text gets the language with the lowest cost per
character; it is rejected where even that cost lies beyond the bound of that language: a high quantile of the
costs of its labelled rows that the models didn't see and that came out as it, and a margin.

Letters are lower-cased, every other run of characters is one space. NULL or letterless
texts are ``und`` with score 0 and are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, chunks, drawn, held_out, portions, sample_share, utf8

UNKNOWN = "und"
ORDER = 4
BITS = 16
DISCOUNT = 0.75
#: Characters a confidence is reckoned for at most; beyond that every text is as sure.
SURE = 40
#: Bits that a text may cost above the bound in all, which matters for a few words only.
SHORT = 24.0
#: Rows of a language that calibrate its own bound at least; with fewer the rows of all languages do.
FEW = 50
#: Odd, so that the product with it is another number for each 64-bit number.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
_letters: np.ndarray | None = None


def letter_codes() -> np.ndarray:
    """For every code point the 16-bit code of its lower-case letter, 0 for anything else."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, np.uint16)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = ord(c.lower()[0])
                table[cp] = low if low < 65535 else 1 + (low * 40503 & 0xFFFF) % 65534
        _letters = table
    return _letters


def code_points(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the rows and the row bounds among them."""
    lead = (data & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(lead)))
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return points, before[bounds]


def gram_codes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-gram code of every character of the rows, and the row of each.

    A row reads as a space, then its letters with one space for every run of other
    characters; the n-gram ends at the character and never reaches into another row.
    """
    points, ends = code_points(data, bounds)
    codes = letter_codes()[points]
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(ends))
    first = np.zeros(len(codes), bool)
    first[ends[:-1][np.diff(ends) > 0]] = True
    space = codes == 0
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1] & ~first[1:]
    codes, row = codes[keep], row[keep]
    if not len(codes):
        return np.empty(0, np.uint64), row
    wide = codes.astype(np.uint64)
    at = np.arange(len(row)) - np.repeat(starts := np.flatnonzero(np.diff(row, prepend=-1)), np.diff(starts, append=len(row)))
    gram = wide.copy()
    for back in range(1, ORDER):
        moved = np.zeros_like(wide)
        moved[back:] = wide[:-back]
        moved[at < back] = 0
        gram |= moved << np.uint64(BITS * back)
    return gram, row


@dataclass
class Models:
    """Costs (negative log2) of n-grams for all languages, found by binary search.

    ``grams[k]`` and ``costs[k]`` belong to contexts of k characters, ``backoff[k]`` holds what
    a context of k characters adds when the n-gram is new. ``bounds`` holds the highest accepted
    cost per character of a long text for each language; None accepts all.
    """

    langs: list[str]
    grams: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    bounds: np.ndarray | None = None

    def compiled(self) -> Models:
        """The same with every array sorted by hash, for lookups of many n-grams."""
        hashed = Models(self.langs, [], [], [], [], self.bounds)
        for keys, values, to_keys, to_values in (
            (self.grams, self.costs, hashed.grams, hashed.costs),
            (self.contexts, self.backoff, hashed.contexts, hashed.backoff),
        ):
            for k in range(ORDER):
                table = Hashed(keys[k])
                to_keys.append(table)
                to_values.append(np.ascontiguousarray(values[k][table.order]))
        return hashed

    def accepts(self, cost: np.ndarray, length: np.ndarray) -> np.ndarray:
        """From the costs of all languages. A short text may cost more for each character."""
        if not self.langs or self.bounds is None:
            return (length > 0) & bool(self.langs)
        return (length > 0) & (cost.min(axis=1) <= self.bounds[cost.argmin(axis=1)] + SHORT / np.maximum(length, 1))

    def of(self, gram: np.ndarray) -> np.ndarray:
        """A row of costs, one per language, for each n-gram."""
        spot, hit = self.grams[-1].find(gram)
        if not len(self.costs[-1]):
            return np.full((len(gram), len(self.langs)), BITS, np.float32)
        out = self.costs[-1].take(spot, axis=0)
        new = np.flatnonzero(~hit)
        if len(new):
            out[new] = self._shorter(gram[new])
        return out

    def _shorter(self, gram: np.ndarray) -> np.ndarray:
        """Of n-grams that no language has: what the shorter ones cost, from the longest down."""
        out = np.zeros((len(gram), len(self.langs)), np.float32)
        left = np.arange(len(gram))
        for k in range(ORDER - 1, 0, -1):
            spot, hit = self.contexts[k].find((gram[left] & np.uint64((1 << BITS * (k + 1)) - 1)) >> np.uint64(BITS))
            out[left[hit]] += self.backoff[k][spot[hit]]
            spot, hit = self.grams[k - 1].find(gram[left] & np.uint64((1 << BITS * k) - 1))
            out[left[hit]] += self.costs[k - 1][spot[hit]]
            left = left[~hit]
        out[left] += np.float32(BITS)
        return out


class Hashed:
    """Keys as an array sorted by hash; the leading bits of a hash say where to start."""

    def __init__(self, keys: np.ndarray):
        hashes = keys * SPREAD
        self.order = np.argsort(hashes)
        self.hashes = np.append(hashes[self.order], np.uint64(2**64 - 1))
        self.bits = max(1, int(2 * len(keys)).bit_length())
        firsts = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.start = np.searchsorted(self.hashes[:-1], firsts)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there."""
        hashes = keys * SPREAD
        spot = self.start[hashes >> np.uint64(64 - self.bits)]
        behind = np.flatnonzero(self.hashes[spot] < hashes)
        while len(behind):
            spot[behind] += 1
            behind = behind[self.hashes[spot[behind]] < hashes[behind]]
        hit = (self.hashes[spot] == hashes) & (spot < len(self.order))
        return np.minimum(spot, max(len(self.order) - 1, 0)), hit


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    spot = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return spot, sorted_keys[spot] == keys


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, spot = np.unique(keys, return_inverse=True)
    return unique, np.bincount(spot, values, len(unique))


def _model(gram: np.ndarray, count: np.ndarray, alphabet: int) -> tuple[list, list]:
    """Of one language: per order (n-grams, probabilities), and (contexts, weight left over)."""
    counts = [None] * ORDER
    counts[ORDER - 1] = (gram, count.astype(float))
    for k in range(ORDER - 2, -1, -1):
        higher = counts[k + 1][0]
        counts[k] = _sum_by(higher & np.uint64((1 << BITS * (k + 1)) - 1), np.ones(len(higher)))
    probs, left = [], []
    for k in range(ORDER):
        keys, c = counts[k]
        context, spot = np.unique(keys >> np.uint64(BITS), return_inverse=True)
        total = np.bincount(spot, c, len(context))
        kinds = np.bincount(spot, minlength=len(context))
        rest = DISCOUNT * kinds / total
        if k == 0:
            lower = np.full(len(keys), 1.0 / alphabet)
        else:
            spot_low, hit = _find(probs[k - 1][0], keys & np.uint64((1 << BITS * k) - 1))
            lower = np.where(hit, probs[k - 1][1][spot_low], 1.0 / alphabet)
        probs.append((keys, np.maximum(c - DISCOUNT, 0) / total[spot] + rest[spot] * lower))
        left.append((context, rest))
    return probs, left


def compile_models(counts: pd.DataFrame) -> Models:
    """From rows (lang, gram, n). Languages are taken in alphabetical order."""
    langs = sorted(counts["lang"].unique())
    alphabet = len(np.unique(counts["gram"].to_numpy(np.uint64) & np.uint64(0xFFFF))) + 1
    each = []
    for lang in langs:
        own = counts[counts["lang"] == lang].sort_values("gram")
        each.append(_model(own["gram"].to_numpy(np.uint64), own["n"].to_numpy(), alphabet))
    grams, costs, contexts, backoff = [], [], [], []
    for k in range(ORDER):
        contexts.append(np.unique(np.concatenate([left[k][0] for _, left in each])) if each else np.empty(0, np.uint64))
        table = np.zeros((len(contexts[k]), len(langs)))
        for i, (_, left) in enumerate(each):
            spot, hit = _find(left[k][0], contexts[k])
            # A context that a language has never seen leaves everything to the lower order.
            table[hit, i] = -np.log2(left[k][1][spot[hit]])
        backoff.append(table.astype(np.float32))
    for k in range(ORDER):
        union = np.unique(np.concatenate([probs[k][0] for probs, _ in each])) if each else np.empty(0, np.uint64)
        table = np.zeros((len(union), len(langs)))
        for i, (probs, left) in enumerate(each):
            spot, hit = _find(probs[k][0], union)
            table[hit, i] = -np.log2(probs[k][1][spot[hit]])
            new = union[~hit]
            if k == 0:
                table[~hit, i] = np.log2(alphabet) - np.log2(left[0][1][0])
            else:
                spot, _ = _find(grams[k - 1], new & np.uint64((1 << BITS * k) - 1))
                low = costs[k - 1][spot, i]
                at, known = _find(contexts[k], new >> np.uint64(BITS))
                table[~hit, i] = low + np.where(known, backoff[k][at, i], 0)
        grams.append(union)
        costs.append(table.astype(np.float32))
    return Models(langs, grams, costs, contexts, backoff)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in sorted(set(langs)):
            data, bounds = utf8(batch.column("text").filter(pa.array(langs == lang)))
            for a, b in chunks(bounds):
                gram, _ = gram_codes(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                keys, n = np.unique(gram, return_counts=True)
                yield batch_of({"lang": [lang] * len(keys), "gram": keys.view(np.int64), "n": n}, schema)


def scores(models: Models, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cost per character for each text and language, and the number of letters and gaps."""
    data, bounds = utf8(column)
    n = len(bounds) - 1
    total, length = np.zeros((n, len(models.langs))), np.zeros(n)
    for a, b in chunks(bounds):
        gram, row = gram_codes(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
        if not len(gram):
            continue
        length[a:b] = np.bincount(row, minlength=b - a)
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        total[a + row[starts]] = np.add.reduceat(models.of(gram), starts, axis=0, dtype=np.float64)
    return total / np.maximum(length, 1)[:, None], length


def fit(labelled: DataFrame, sample: int = 2000, quantile: float = 0.99, margin: float = 0.45) -> Models:
    """Models of the languages in ``labelled`` (doc_id, text, lang; NULL labels are left out).

    About ``sample`` rows of each language are read for counts, and half as many others
    calibrate the rejection: the bound of a language lies ``margin`` above the ``quantile`` of the costs of its rows that come out as it.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("lang") != UNKNOWN))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Models([], *([np.empty(0, np.uint64)] * ORDER for _ in range(4)))
    share = sample_share(counts, sample + sample // 2)
    limit = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")]
    draw = drawn(F.col("doc_id"), "language") / limit
    picked = rows.where(draw < 1).select("text", "lang", (draw < 2 / 3).alias("learn"))
    grams = (
        picked.where("learn").select("text", "lang").mapInArrow(_counted, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    models = compile_models(grams.toPandas())
    if not models.langs:
        return models

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("best", pa.int32()), ("cost", pa.float64())])
        hashed = models.compiled()
        for batch in batches:
            cost, length = scores(hashed, batch.column("text"))
            best = cost.argmin(axis=1)
            long = (length >= 20) & (np.array(models.langs, object)[best] == np.array(batch.column("lang").to_pylist(), object))
            # What short texts are granted is left out.
            yield batch_of({"best": best[long], "cost": (cost.min(axis=1) - SHORT / np.maximum(length, 1))[long]}, schema)

    seen = picked.where(~F.col("learn")).select("text", "lang").mapInArrow(costs, "best int, cost double")
    high = F.percentile("cost", quantile).alias("high")
    # A row for each language, and one for all.
    found = seen.rollup("best").agg(high, F.count("*").alias("n")).collect()
    overall = next((r["high"] for r in found if r["best"] is None and r["n"]), None)
    if overall is not None:
        models.bounds = np.full(len(models.langs), overall * (1 + margin))
        for r in found:
            if r["best"] is not None and r["n"] >= FEW:
                models.bounds[r["best"]] = r["high"] * (1 + margin)
    return models


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_pred, score, cost, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
        ("cost", pa.float64()), ("rejected", pa.bool_()),
    ])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value.compiled()
        langs = np.array([*models.langs, UNKNOWN], object)
        for batch in batches:
            cost, length = scores(models, batch.column("text"))
            n = len(length)
            letters = (length > 0) & (len(models.langs) > 0)
            best = np.argmin(cost, axis=1) if models.langs else np.zeros(n, np.int64)
            low = cost.min(axis=1) if models.langs else np.zeros(n)
            odds = np.exp2(-(cost - low[:, None]) * np.minimum(length, SURE)[:, None]).sum(axis=1) if models.langs else np.ones(n)
            yield batch_of({
                "doc_id": batch.column("doc_id"),
                "lang_pred": langs[np.where(letters, best, -1)],
                "score": np.where(letters, 1 / np.maximum(odds, 1), 0.0),
                "cost": low,
                "rejected": ~(letters & models.accepts(cost, length)),
            }, schema)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        judged, "doc_id bigint, lang_pred string, score double, cost double, rejected boolean"
    )


def language_models(docs: DataFrame) -> Models:
    """Fitted on the labelled rows outside the held-out fold."""
    return fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))


def language_id(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, cost, rejected."""
    found = identify(docs, language_models(docs))
    return found.withColumn("held_out", held_out(F.col("doc_id")))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows whose language is not rejected, with the columns of ``docs``."""
    models = language_models(docs)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value.compiled()
        for batch in portions(batches):
            cost, length = scores(models, batch.column("text"))
            yield batch.filter(pa.array(models.accepts(cost, length)))

    return docs.mapInArrow(kept, docs.schema)
