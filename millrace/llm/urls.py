"""URL filters: rules on hosts and paths, and a word model for what no rule fits.

Names that run words together are split by a unigram Viterbi search over all words of all page titles;
anything else costs by its length. A multinomial naive Bayes model over the words of host and path
learns from the pages that rules judge and judges the others.

No table is taken for small. Each different name is split once: its parts are looked up in the table of
words by a join, after a bit map of fixed size (``CELLS``) has dropped most parts that are no words (a full map costs work,
not results). Weights come to names, and names to pages, by joins too; keys that hold a large share of the
rows are looked up in a broadcast of at most ``HOT`` rows. Costs and weights are whole numbers, so sums do
not depend on the order of rows.

NULL urls and urls without ``://`` have an empty host and path and no words: the prior decides. Repeated
rows are all returned.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of
from millrace.workspace import stored

#: (verdict, host and the beginning of the path). A rule holds for subdomains too; the longest wins.
RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]
ALLOW, BLOCK = "allow", "block"
#: A key with more than this part of all rows is hot; so there are fewer hot keys than this.
HOT = 1000
#: 64-bit cells of the map of words, as a power of two: 8 MB.
CELLS = 20
#: What a part that is no word costs for each letter: a tenth as likely with each letter more. Costs are in millionths.
LETTER = 2_300_000
UNIT = 1_000_000_000
_word = re.compile(r"[^\W\d_]+|\d+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def by_rules(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` (host, path) with rule and verdict, NULL where no rule fits."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = (F.concat(F.lit("."), F.col("host")).endswith("." + name)) & F.col("path").startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return pages.withColumn("rule", none if rule is None else rule).withColumn("verdict", none if verdict is None else verdict)


def title_words(pages: DataFrame) -> DataFrame:
    """(word, n) of all titles of ``pages`` (html)."""
    title = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?is)<title[^>]*>([^<]*)", 1))
    found = pages.select(F.explode(F.split(title, r"[^\p{L}]+")).alias("word")).where("word != ''")
    return found.groupBy("word").agg(F.count("*").alias("n"))


def cost(n: int, total: int) -> int:
    return round(1_000_000 * math.log(total / n))


def split(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The cheapest words that make up ``name``; ``counts`` has all words that occur in it.

    Ties go to the longest last part.
    """
    known = {w: cost(n, total) for w, n in counts.items()}
    sizes = sorted({len(w) for w in known})
    unknown = cost(1, total)
    best, back = [0], [0]
    # Where the cheapest last part that is no word starts: the start with the least best - LETTER * start.
    cheapest = 0
    for end in range(1, len(name) + 1):
        least, start = best[cheapest] + unknown + LETTER * (end - cheapest), cheapest
        for size in sizes:
            if size > end:
                break
            one = known.get(name[end - size : end])
            if one is not None and (best[end - size] + one, end - size) < (least, start):
                least, start = best[end - size] + one, end - size
        best.append(least)
        back.append(start)
        if least - LETTER * end < best[cheapest] - LETTER * cheapest:
            cheapest = end
    out, end = [], len(name)
    while end:
        out.append(name[back[end] : end])
        end = back[end]
    return out[::-1]


def names_of(host: str, path: str) -> Iterator[tuple[str, str]]:
    """(side, name) of an url: runs of letters; numbers count by their length."""
    for side, text in (("h", host), ("p", path.lower())):
        for run in _word.findall(text):
            yield side, f"#{len(run)}" if run.isdigit() else run


def digest(name: str) -> bytes:
    return hashlib.md5(name.encode("utf-8", "surrogatepass")).digest()


def looked_up(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one row per key; hot keys of ``left`` are not shuffled."""
    counted = left.groupBy(key).agg(F.count("*").alias("__n"))
    rows = left.count()
    hot = F.broadcast(counted.where(F.col("__n") * HOT > rows).select(key))
    near = left.join(hot, key, "left_semi").join(F.broadcast(right.join(hot, key, "left_semi")), key, how)
    return near.unionByName(left.join(hot, key, "left_anti").join(right, key, how))


def word_map(words: DataFrame) -> np.ndarray:
    """The bit map of the words by crc32."""
    crc = F.crc32(F.col("word").cast("binary"))
    low = 32 - CELLS
    bit = F.expr(f"shiftleft(1L, CAST(shiftright(crc, {low - 6}) & 63 AS INT))")
    cells = words.select(crc.alias("crc")).select(F.shiftright("crc", low).alias("cell"), bit.alias("bit"))
    found = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << CELLS, np.int64)
    out[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return out


def segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """(digest, words) of ``names`` (digest, name), split by the words of a table (word, n)."""
    context = names.sparkSession.sparkContext
    facts = words.agg(F.sum("n").alias("n"), F.collect_set(F.length("word")).alias("sizes")).first()
    total, sizes = (facts["n"] or 0) + 1, sorted(facts["sizes"])
    known = context.broadcast(word_map(words))
    pair = pa.schema([("digest", pa.binary()), ("word", pa.string())])

    def may_be(part: str) -> bool:
        crc = zlib.crc32(part.encode("utf-8", "surrogatepass"))
        return bool(int(known.value[crc >> 32 - CELLS]) >> (crc >> 26 - CELLS & 63) & 1)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, name in zip(batch.column("digest").to_pylist(), batch.column("name").to_pylist()):
                seen: set[str] = set()
                for size in sizes:
                    if size > len(name):
                        break
                    seen.update(filter(may_be, {name[i : i + size] for i in range(len(name) - size + 1)}))
                if seen:
                    yield batch_of({"digest": [key] * len(seen), "word": sorted(seen)}, pair)

    found, _ = stored(names.where("name NOT LIKE '#%'").mapInArrow(parts, "digest binary, word string"), "urls-parts")
    hits = looked_up(found, words, "word").groupBy("digest").agg(
        F.collect_list("word").alias("parts"), F.collect_list("n").alias("counts")
    )
    schema = pa.schema([("digest", pa.binary()), ("words", pa.list_(pa.string()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("digest", "name", "parts", "counts")))
            out = [(d, [n] if n[0] == "#" else split(n, dict(zip(w or (), c or ())), total)) for d, n, w, c in rows]
            if out:
                yield batch_of(dict(zip(schema.names, zip(*out))), schema)

    return names.join(hits, "digest", "left").mapInArrow(cut, "digest binary, words array<string>")


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("digest", pa.binary()), ("name", pa.string())])
    for batch in batches:
        found = sorted({n for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()) for _, n in names_of(h, p)})
        yield batch_of({"digest": [digest(n) for n in found], "name": found}, schema)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.string()), ("side", pa.string()), ("place", pa.int64()), ("digest", pa.binary())])
    for batch in batches:
        for key, host, path in zip(*(batch.column(c).to_pylist() for c in ("key", "host", "path"))):
            out = [(key, side, i, digest(n)) for i, (side, n) in enumerate(names_of(host, path))]
            if out:
                yield batch_of(dict(zip(schema.names, zip(*out))), schema)


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("verdict", pa.string()), ("side", pa.string()), ("digest", pa.binary()), ("n", pa.int64())])
    for batch in batches:
        seen: dict[tuple[str, str, str], int] = {}
        for host, path, verdict, n in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "verdict", "n"))):
            for side, name in names_of(host, path):
                seen[verdict, side, name] = seen.get((verdict, side, name), 0) + n
        if seen:
            rows = [(v, side, digest(name), n) for (v, side, name), n in seen.items()]
            yield batch_of(dict(zip(schema.names, zip(*rows))), schema)


def name_odds(rows: DataFrame, split_names: DataFrame) -> tuple[DataFrame, int]:
    """(digest, words, h, p): the log odds of block a name brings on either side; and the prior. In units of 1 / ``UNIT``.

    Add-one smoothing over the words seen; an unseen word has the odds of a count of zero.
    """
    ruled = rows.where("verdict IS NOT NULL")
    seen = ruled.mapInArrow(_learned, "verdict string, side string, digest binary, n bigint")
    seen = seen.groupBy("verdict", "side", "digest").agg(F.sum("n").alias("n"))
    blocked, allowed = F.when(F.col("verdict") == BLOCK, F.col("n")).otherwise(0), F.when(F.col("verdict") == ALLOW, F.col("n")).otherwise(0)
    counts = seen.join(split_names, "digest").select("side", blocked.alias("b"), allowed.alias("a"), F.explode("words").alias("word"))
    counts, _ = stored(counts.groupBy("side", "word").agg(F.sum("b").alias("b"), F.sum("a").alias("a")), "urls-counts")
    facts = counts.agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.count("*").alias("v")).first()
    docs = ruled.agg(F.sum(blocked).alias("b"), F.sum(allowed).alias("a")).first()
    sizes = {k: (facts[k] or 0) + facts["v"] + 1 for k in "ba"}
    unseen = math.log(sizes["a"] / sizes["b"])
    odds = F.round((F.log((F.col("b") + 1) / (F.col("a") + 1)) + unseen) * UNIT).cast("bigint")
    zero = round(unseen * UNIT)
    weights = counts.groupBy("word").agg(*[F.max(F.when(F.col("side") == s, odds)).alias(s) for s in "hp"])
    single = split_names.select("digest", F.explode("words").alias("word"))
    weighed = looked_up(single, weights, "word", "left").groupBy("digest").agg(*[F.sum(F.coalesce(s, F.lit(zero))).alias(s) for s in "hp"])
    prior = math.log(((docs["b"] or 0) + 1) / ((docs["a"] or 0) + 1))
    return split_names.join(weighed, "digest"), round(prior * UNIT)


def judged(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, block_odds, host_words."""
    page = F.col("page_id").cast("bigint")
    ruled = by_rules(pages.select(page.alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), rules)
    # A host holds no slash and a path starts with one, so host and path can be told apart.
    ruled = ruled.withColumn("key", F.md5(F.concat("host", "path").cast("binary")))
    rows, _ = stored(ruled.groupBy("key", "host", "path", "verdict").agg(F.count("*").alias("n")), "urls-rows")
    words, _ = stored(title_words(pages), "urls-words")
    names = rows.mapInArrow(_names, "digest binary, name string").distinct()
    split_names, _ = stored(segmented(names, words), "urls-names")
    weighed, prior = name_odds(rows, split_names)
    weighed, _ = stored(weighed, "urls-odds")
    places, _ = stored(rows.mapInArrow(_places, "key string, side string, place bigint, digest binary"), "urls-places")
    host_part = F.when(F.col("side") == "h", F.struct("place", "words"))
    scores = looked_up(places, weighed, "digest").groupBy("key").agg(
        F.sum(F.when(F.col("side") == "h", F.col("h")).otherwise(F.col("p"))).alias("odds"),
        F.flatten(F.transform(F.sort_array(F.collect_list(host_part)), lambda x: x["words"])).alias("words"),
    )
    score = F.coalesce("odds", F.lit(0)) + F.lit(prior)
    method = F.when(score > 0, BLOCK).otherwise(ALLOW)
    return looked_up(ruled, scores, "key", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), (score / UNIT).alias("block_odds"),
        F.coalesce("words", F.array().cast("array<string>")).alias("host_words"),
    )
