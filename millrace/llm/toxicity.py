"""Toxicity with a subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel of two words sums, over all ordered letter triples (gaps allowed, at most ``SPAN``
letters wide, each weighted by ``DECAY`` per letter spanned), the product of their weights; it
is divided by what the weights of two words of these lengths give without gaps in common. So a
word with letters put in between still resembles the word without them. Words are read without
the signs inside them, and runs of single letters are read as one word.

Labels belong to documents, so what is toxic in a document has to be found first. Sentences are read as windows of one to
``WORDS`` words. A witness is a window in more toxic documents than chance explains, given how many windows of its size
are tried, and without a shorter witness in it; so an insult may be made of harmless words. Of
copies (documents of a class that share ``COPY`` of their words) one document counts. The machine learns
witnesses against windows of clean documents, mapped by the Nyström method: kernel
values against the landmarks, times the inverse root of the landmarks' kernel matrix. With
fixed landmarks the decision is one weighted sum over letter triples, and it is applied so.
Windows of clean documents that come out too high are learned in further rounds.

Letters of scripts without blanks are words of their own. Other words over ``WINDOW`` letters are learned and scored in
overlapping pieces and are in no longer window. Insults whose words are further apart than a window are not learned.

A document scores by the highest margin of its
windows, turned into a probability on the labelled sample. Empty and NULL texts have no word and
get the lowest score.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, chunks, drawn, held_out, mix64, portions, sample_share, utf8
from millrace.llm.language import code_points

SPAN = 5
DECAY = 0.6
#: Longer words are read in overlapping windows.
WINDOW = 20
THRESHOLD = 0.3
#: Distances of the second and third letter from the first.
STEPS = [(i, j) for i in range(1, SPAN - 1) for j in range(i + 1, SPAN)]
_signs = re.compile(r"[\W\d_]+")
#: Most words of a window.
WORDS = 3
#: Scripts without blanks: Thai to Lao, Myanmar, Khmer, kana, Han.
_ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_alone = re.compile(f"([{_ALONE}])")
LOWEST = -4.0
#: Share of their common words from which two documents are copies, and least hashes in a band.
COPY = 0.8
BAND = 4
_salts = mix64(np.arange(1, 65, dtype=np.uint64))


def read(text: str | None) -> tuple[list[str], list[int]]:
    """Words of a text, and the number of its sentence for each: lower case, letters only, single letters in a row joined.

    A sentence ends with a sign before a blank, or with the line.
    """
    found: list[str] = []
    sentences: list[int] = []
    joined, sentence = False, 0
    for line in (text or "").lower().split("\n"):
        for raw in line.split():
            for t in _alone.split(_signs.sub("", raw)):
                alone = bool(_alone.match(t))
                if len(t) == 1 and joined and not alone:
                    found[-1] += t
                elif t:
                    found.append(t)
                    sentences.append(sentence)
                joined = len(t) == 1 and not alone or joined and not t
            sentence += raw[-1] in ".!?"
        sentence += 1
    return found, sentences


def tokens(text: str | None) -> list[str]:
    return read(text)[0]


def learnable(words: list[str]) -> set[str]:
    """The words, those over ``WINDOW`` letters in the pieces that they are scored by."""
    out: set[str] = set()
    for w in words:
        out.update([w] if len(w) <= WINDOW else (w[a : a + WINDOW] for a in range(0, len(w) - WINDOW // 2, WINDOW // 2)))
    return out


def windows(words: list[str], sentences: list[int], out: set[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per size from two words up: hash and first word of the windows without a word of ``out``."""
    code = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)
    usable = np.array([len(w) <= WINDOW and w not in out for w in words], bool)
    place = np.array(sentences, np.int64)
    found, code_of = [], code
    for size in range(2, WORDS + 1):
        n = max(len(words) - size + 1, 0)
        code_of = mix64(code_of[:n] * np.uint64(0x9E3779B97F4A7C15) + code[size - 1 :][:n])
        fits = place[:n] == place[size - 1 :][:n]
        for k in range(size):
            fits = fits & usable[k : k + n]
        spot = np.flatnonzero(fits)
        found.append((code_of[spot], spot))
    return found


def norm(length: int) -> float:
    """Root of the summed squares of the weights of all triples of a word, taken as distinct."""
    return sum(max(length + 2 - b, 0) * DECAY ** (2 * b + 2) for _, b in STEPS) ** 0.5


def triples(word: str) -> dict[str, float]:
    """Weight of every letter triple of a word; a blank marks either end."""
    marked = f" {word} "
    found: dict[str, float] = defaultdict(float)
    scale = norm(len(word))
    for i, first in enumerate(marked):
        for a, b in STEPS:
            if i + b < len(marked):
                found[first + marked[i + a] + marked[i + b]] += DECAY ** (b + 1) / scale
    return found


def kernel(a: str, b: str) -> float:
    x, y = triples(a), triples(b)
    return sum(v * y[k] for k, v in x.items() if k in y)


@dataclass
class Machine:
    """Weights of letter triples, a bias, and the line that turns a margin into log-odds."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = LOWEST
    slope: float = 1.0
    shift: float = 0.0

    def compiled(self) -> Scorer:
        return Scorer(self)

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


class Scorer:
    """A machine as tables over letter codes: 0 a blank, 1 a letter that no weight knows."""

    def __init__(self, machine: Machine):
        letters = sorted({c for k in machine.weights for c in k} - {" "})
        codes = {" ": 0} | {c: i + 2 for i, c in enumerate(letters)}
        self.bits = max(1, (len(letters) + 1).bit_length())
        self.table = np.zeros(1 << 3 * self.bits, np.float32)
        for k, v in machine.weights.items():
            x, y, z = (codes[c] for c in k)
            self.table[x << 2 * self.bits | y << self.bits | z] = v
        self.bias = machine.bias
        self.codes = np.full(0x110000, -1, np.int32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isspace():
                self.codes[cp] = 0
            elif c.isalpha():
                self.codes[cp] = codes.get(c.lower()[0], 1)
        self.alone = np.zeros(0x110000, bool)
        for first, last in re.findall("(.)-(.)", _ALONE):
            self.alone[ord(first) : ord(last) + 1] = True

    def words(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per range of rows: the first row, the row of each word, and the margins of the windows that begin with it, by size."""
        data, bounds = utf8(column)
        for first, last in chunks(bounds):
            own = bounds[first : last + 1] - bounds[first]
            points, ends = code_points(data[bounds[first] : bounds[last]], own)
            codes = self.codes[points]
            row = np.repeat(np.arange(last - first), np.diff(ends))
            sign = (points == 46) | (points == 33) | (points == 63)
            ending = points == 10
            ending[:-1] |= sign[:-1] & (codes[1:] == 0)
            keep = codes >= 0
            yield first, *self._margins(codes[keep], row[keep], np.cumsum(ending)[keep], self.alone[points[keep]])

    def _margins(self, codes: np.ndarray, row: np.ndarray, sentence: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        letter = codes > 0
        edge = ~letter[:-1] | (row[1:] != row[:-1]) | alone[1:] | alone[:-1]
        fresh = np.ones(len(codes), bool)
        fresh[1:] = edge
        start = np.flatnonzero(letter & fresh)
        if not len(start):
            return np.empty(0, np.int64), np.empty((0, WORDS))
        last = np.ones(len(codes), bool)
        last[:-1] = ~letter[1:] | edge
        length = np.flatnonzero(letter & last) + 1 - start
        owner = row[start]
        # Single letters in a row belong to one word.
        single = (length == 1) & ~alone[start]
        new = np.ones(len(start), bool)
        new[1:] = ~(single[1:] & single[:-1] & (owner[1:] == owner[:-1]))
        length = np.add.reduceat(length, np.flatnonzero(new))
        owner, sentence = owner[new], sentence[start][new]
        # All letters again, one blank after each word and one before the first.
        words = len(length)
        word = np.repeat(np.arange(words), length)
        line = np.zeros(1 + len(word) + words + SPAN, np.int32)
        begin = 1 + np.concatenate(([0], np.cumsum(length + 1)[:-1]))
        place = np.arange(len(word)) + word + 1
        line[place] = codes[letter]
        stop = begin + length
        n = int(stop[-1]) + 1
        # The triple that begins at a blank belongs to the word behind it; it may end in one of the words behind that.
        ahead = [np.repeat(stop[np.minimum(np.arange(words) + k, words - 1)], length + 1) - np.arange(n - 1) for k in range(WORDS)]
        value = [np.zeros(n - 1, np.float32) for _ in range(WORDS)]
        bits = self.bits
        head = line[: n - 1] << 2 * bits
        for a, b in STEPS:
            key = head | line[a : n - 1 + a] << bits | line[b : n - 1 + b]
            weight = self.table[key] * np.float32(DECAY ** (b + 1))
            for k in range(WORDS):
                value[k] += np.where(ahead[k] >= b, weight, 0)
        total = [np.concatenate(([0.0], np.cumsum(v, dtype=np.float64))) for v in value]
        sums = [t[stop] - t[begin - 1] for t in total]
        norms = np.array([norm(k) or 1.0 for k in range(WORDS * (WINDOW + 1))])
        short = length <= WINDOW
        margin = np.full((words, WORDS), -np.inf)
        margin[:, 0] = sums[0] / norms[np.minimum(length, WINDOW)]
        for i in np.flatnonzero(~short):
            a = np.arange(begin[i] - 1, stop[i] - WINDOW // 2, WINDOW // 2)
            margin[i, 0] = ((total[0][np.minimum(a + WINDOW, stop[i])] - total[0][a]) / norms[WINDOW]).max()
        for size in range(2, min(WORDS, words) + 1):
            m = words - size + 1
            fits = (owner[:m] == owner[size - 1 :]) & (sentence[:m] == sentence[size - 1 :])
            inside = np.zeros(m)
            for k in range(size):
                fits &= short[k : k + m]
                inside += sums[size - 1 - k][k : k + m]
            spot = np.flatnonzero(fits)
            margin[spot, size - 1] = inside[spot] / norms[stop[spot + size - 1] - begin[spot]]
        return owner, margin + self.bias

    def margins(self, column: pa.Array) -> np.ndarray:
        """The highest margin of the windows of each text."""
        out = np.full(len(column), LOWEST)
        for first, owner, margin in self.words(column):
            if len(owner):
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                out[first + owner[starts]] = np.maximum(np.maximum.reduceat(margin.max(axis=1), starts), LOWEST)
        return out

    def of_words(self, words: list[str]) -> np.ndarray:
        return self.margins(pa.array(words, pa.string()))

    def above(self, texts: list[str], least: float) -> dict[str, float]:
        """The windows of some texts with margins over ``least``; pieces stand for long words."""
        found: dict[str, float] = {}
        for first, owner, margin in self.words(pa.array(texts, pa.string())):
            spot, size = np.nonzero(margin > least)
            begin = np.searchsorted(owner, owner[spot])
            known, words = -1, []
            for i, k, a in zip(spot.tolist(), size.tolist(), begin.tolist()):
                if owner[i] != known:
                    known, words = owner[i], tokens(texts[first + owner[i]])
                if len(words[i - a]) <= WINDOW:
                    found[" ".join(words[i - a : i - a + k + 1])] = float(margin[i, k])
                else:
                    found.update(dict.fromkeys(learnable([words[i - a]]), float(margin[i, k])))
        return found


#: Rows of a block of the machine's matrix.
BLOCK = 250


def _support_vector(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    w = np.zeros(x.shape[1])
    for _ in range(20):
        # Block by block, so that the rows inside the margin are never copied as a whole.
        hessian, right = np.eye(x.shape[1]), np.zeros(x.shape[1])
        for i in range(0, len(x), BLOCK):
            xs, ys, cs = x[i : i + BLOCK].astype(np.float64), y[i : i + BLOCK], cost * weight[i : i + BLOCK]
            cs = np.where(ys * (xs @ w) < 1, cs, 0.0)
            hessian += xs.T @ (xs * cs[:, None])
            right += xs.T @ (cs * ys)
        new = np.linalg.solve(hessian, right)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def _learn(toxic: list[str], clean: list[str], landmarks: list[str], cost: float) -> Machine:
    """A machine that tells the words of ``toxic`` from those of ``clean``."""
    codes: dict[str, int] = {}
    marks = [triples(m) for m in landmarks]
    for k in sorted({k for m in marks for k in m}):
        codes[k] = len(codes)

    def dense(rows: list[dict]) -> np.ndarray:
        out = np.zeros((len(rows), len(codes)), np.float32)
        for i, x in enumerate(rows):
            for k, v in x.items():
                if k in codes:
                    out[i, codes[k]] = v
        return out

    basis = dense(marks)
    eigen, vectors = np.linalg.eigh((basis @ basis.T).astype(np.float64))
    keep = eigen > 1e-6
    project = basis.T @ (vectors[:, keep] / np.sqrt(eigen[keep]))
    words = toxic + clean
    x = np.ones((len(words), project.shape[1] + 1), np.float32)
    for i in range(0, len(words), BLOCK):
        x[i : i + BLOCK, :-1] = dense([triples(w) for w in words[i : i + BLOCK]]) @ project
    y = np.concatenate([np.ones(len(toxic)), -np.ones(len(clean))])
    weight = np.where(y > 0, len(words) / (2 * len(toxic)), len(words) / (2 * max(len(clean), 1)))
    w = _support_vector(x, y, weight, cost)
    folded = project @ w[:-1]
    return Machine({k: float(folded[i]) for k, i in codes.items()}, float(w[-1]))


def _line(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the labels on the margin, a little penalised."""
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), x.T @ (p - y) + 1e-2 * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 1e-3), float(w[1])


class Copies:
    """Word sets counted so far; a copy shares ``COPY`` of all words with one of them."""

    def __init__(self) -> None:
        self.sets: list[np.ndarray] = []
        self.bands: dict[bytes, list[int]] = defaultdict(list)

    def new(self, words: set[str]) -> bool:
        """Whether the words are no copy; they are kept if so. A document without words is none."""
        if not words:
            return True
        own = np.unique(np.array([zlib.crc32(w.encode()) for w in words], np.uint32))
        least = mix64(own.astype(np.uint64)[:, None] ^ _salts[None, :]).min(axis=0).reshape(-1, BAND)
        # Bands of least hashes only name candidates: a set this alike lacks all of them once in 5,000 times.
        keys = [blake2b(bytes([i]) + band.tobytes(), digest_size=8).digest() for i, band in enumerate(least)]
        for i in {i for k in keys for i in self.bands.get(k, ())}:
            both = len(np.intersect1d(own, self.sets[i], assume_unique=True))
            if both >= COPY * (len(own) + len(self.sets[i]) - both):
                return False
        for k in keys:
            self.bands[k].append(len(self.sets))
        self.sets.append(own)
        return True


def _parts(window: str) -> set[str]:
    """A window and the shorter ones in it."""
    words = window.split(" ")
    return {" ".join(words[a:b]) for a in range(len(words)) for b in range(a + 1, len(words) + 1)}


def _longer_windows(counted: dict[int, list[str]], witnesses: set[str], telling: Callable[[int, int, int], bool]) -> tuple[dict[str, int], set[str]]:
    """Witnesses of two words and more with the number of their toxic documents, and some windows of clean documents.

    Windows are counted by hash, once a document.
    """
    def read_in(texts: list[str]) -> Iterator[tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]]:
        for text in texts:
            words, sentences = read(text)
            yield words, windows(words, sentences, witnesses)

    sizes = range(WORDS - 1)
    hashes: list[list[np.ndarray]] = [[] for _ in sizes]
    for _, found in read_in(counted[1]):
        for k in sizes:
            hashes[k].append(np.unique(found[k][0]))
    keys, counts, tried, others = [], [], [], []
    for k in sizes:
        key, n = np.unique(np.concatenate([np.empty(0, np.uint64), *hashes[k]]), return_counts=True)
        tried.append(int((n > 1).sum()))
        few = np.array([telling(i, 0, tried[k]) for i in range(int(n.max(initial=0)) + 1)], bool)[n]
        keys.append(key[few])
        counts.append(n[few])
        others.append(np.zeros(few.sum(), np.int64))
    sample: set[str] = set()
    for words, found in read_in(counted[0]):
        for k in sizes:
            hashed, spot = found[k]
            others[k] += np.isin(keys[k], hashed)
            sample.update(" ".join(words[i : i + k + 2]) for i in spot[hashed % np.uint64(64) == 0].tolist())
    numbers = [
        {int(h): int(n) for h, n, other in zip(keys[k], counts[k], others[k]) if telling(int(n), int(other), tried[k])} for k in sizes
    ]
    longer: dict[str, int] = {}
    if any(numbers):
        wanted = [np.array(sorted(found), np.uint64) for found in numbers]
        for words, found in read_in(counted[1]):
            for k in sizes:
                hashed, spot = found[k]
                for i in np.flatnonzero(np.isin(hashed, wanted[k])).tolist():
                    longer[" ".join(words[spot[i] : spot[i] + k + 2])] = numbers[k][int(hashed[i])]
    return {w: n for w, n in longer.items() if len(_parts(w) & longer.keys()) == 1}, sample - longer.keys()


def fit(rows: pd.DataFrame, landmarks: int = 240, words: int = 6_000, cost: float = 1.0) -> Machine:
    """From labelled rows (text, toxic). One class alone gives a constant score."""
    y = rows["toxic"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Machine(slope=1e-3, shift=0.0 if not len(y) else (6.0 if y[0] else -6.0))
    inside, outside, seen = Counter(), Counter(), {0: Copies(), 1: Copies()}
    counted: dict[int, list[str]] = {0: [], 1: []}
    n1 = n0 = 0
    for text, label in zip(rows["text"], y):
        own = set(tokens(text))
        if seen[int(label > 0)].new(own):
            (inside if label else outside).update(learnable(own))
            counted[int(label > 0)].append(text)
            n1, n0 = n1 + bool(label), n0 + (not label)
    # The sets of words take more room than all that follows.
    seen.clear()
    # How unlikely is it that a window as frequent falls so much on the toxic side by chance? The
    # number of windows of its size that are tried is allowed for.
    base = -math.log(n1 / (n1 + n0))

    def telling(n: int, other: int, tried: int) -> bool:
        ways = math.lgamma(n + other + 1) - math.lgamma(n + 1) - math.lgamma(other + 1)
        return n * base - ways > math.log(2 * max(1, tried)) and n / n1 > 10 * (other + 0.5) / n0

    tried = sum(n > 1 for n in inside.values())
    witnesses = {w for w, n in inside.items() if telling(n, outside.get(w, 0), tried)}
    longer, negatives = _longer_windows(counted, witnesses, telling)
    clean = sorted(outside.keys() - witnesses, key=lambda w: (zlib.crc32(w.encode()), w))
    negatives = sorted(negatives, key=lambda w: (zlib.crc32(w.encode()), w))[:words]
    inside.update(longer)
    witnesses |= longer.keys()
    if not witnesses or not clean:
        return Machine(slope=1e-3, shift=float(np.log(n1 / n0)))
    learned: set[str] = set()
    first = clean[:words] + negatives
    for _ in range(4):
        sure = sorted(witnesses, key=lambda w: (-inside[w], w))[:words]
        known = first + sorted(learned)
        marks = sure[: landmarks // 2]
        machine = _learn(sure, known, marks + known[: landmarks - len(marks)], cost)
        scorer = machine.compiled()
        # Clean windows that come out too high are learned next.
        high: dict[str, float] = {}
        for i in range(0, len(counted[0]), 200):
            high |= scorer.above(counted[0][i : i + 200], -0.7)
        high = {w: m for w, m in high.items() if witnesses.isdisjoint(_parts(w))}
        wrong = set(sorted(high, key=lambda w: (-high[w], w))[:words]) - learned - set(first)
        if not wrong:
            break
        learned |= wrong
    machine.slope, machine.shift = _line(scorer.margins(pa.array(rows["text"].tolist(), pa.string())), y)
    return machine


def toxicity_machine(docs: DataFrame, labels: DataFrame, toxic: int = 2000, clean: int = 4000) -> Machine:
    """Learned on about so many toxic and clean documents outside the held-out fold.

    Labels count once per document (the highest, if rows differ); NULL labels are left out.
    """
    marked = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    nothing = pd.DataFrame({"text": [], "toxic": []})
    if not counts:
        return fit(nothing)
    share = {k: sample_share({k: n}, toxic if k else clean)[k] for k, n in counts.items()}
    limit = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("toxic")]
    # A bounded number of ids, so that the documents need no shuffle.
    picked = marked.where(drawn(F.col("id"), "toxicity") < limit)
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    rows = texts.join(F.broadcast(picked), "id").select("id", "text", "toxic")

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = pa.Table.from_batches(batches, schema).to_pandas()
        machine = fit(sample.sort_values(["id", "text"], kind="stable").reset_index(drop=True))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(machine)], pa.binary())], names=["machine"])

    schema = pa.schema([("id", pa.int64()), ("text", pa.string()), ("toxic", pa.int32())])
    # The sample is bounded: one task learns from it, and is repeated where its executor is lost. The driver gets the weights.
    rows = rows.select(F.col("id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"), "toxic")
    found = rows.repartition(1).mapInArrow(learned, "machine binary").first()
    # No task runs where no labelled document is there.
    return pickle.loads(found["machine"]) if found else fit(nothing)


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.compiled()
        for batch in batches:
            p = shared.value.probability(scorer.margins(batch.column("text")))
            yield batch_of({"doc_id": batch.column("doc_id"), "score": p, "predicted": (p >= threshold).astype(np.int32)}, schema)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        judged, "doc_id bigint, score double, predicted int"
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    return score(docs, toxicity_machine(docs, labels)).withColumn("held_out", held_out(F.col("doc_id")))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that are not predicted toxic, with the columns of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(toxicity_machine(docs, labels))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.compiled()
        for batch in portions(batches):
            p = shared.value.probability(scorer.margins(batch.column("text")))
            yield batch.filter(pa.array(p < threshold, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
