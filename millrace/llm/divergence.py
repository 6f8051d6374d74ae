"""How the sources of a language differ in their words: an audit by exact term counts.

Terms are runs of letters A-Z and of all characters beyond ASCII; only A-Z are lower-cased. Inside a task,
pointers to the starts of terms in the Arrow buffer are sorted by what they point at (multikey
quicksort on eight bytes at a time), shard by shard. Equal runs then hold a term's places: their number
is its count, the rows they lie in give its document frequency and its sources. Only these numbers leave a task.

All that follows is whole-number arithmetic on counts per (language, source, term). A pair of
sources needs a value over all kept terms; terms that both sources lack have one value for all, so
it is put together from histograms of counts and the terms that both hold.

NULL text, language and source are empty texts. Each row is a document, repeated rows too; ids are not looked
at, other columns ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, chunks, utf8
from millrace.workspace import stored

#: A kept term is in so many documents of its language.
DOCUMENTS = 10
TOP = 10
#: Bytes of text of a shard.
SHARD = 4_000_000
#: Slices of fewer pointers are finished together.
SMALL = 4096

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


class Pointers:
    """Starts of the terms of some rows, in the lower-cased buffer."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        term = _TERM[data]
        first = np.zeros(len(data) + 1, bool)
        first[bounds] = True
        before = np.zeros(len(data), bool)
        before[1:] = term[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = term[1:]
        self.starts = np.flatnonzero(term & (~before | first[:-1]))
        self.ends = np.flatnonzero(term & (~after | first[1:])) + 1
        self.buffer = np.concatenate((_LOWER[data], np.zeros(8, np.uint8)))
        # Eight bytes from every place on, as one number that sorts like them.
        self._eight = np.ndarray((len(data) + 1,), ">u8", self.buffer, strides=(1,))

    def keys(self, which: np.ndarray, depth: np.ndarray | int) -> np.ndarray:
        """The depth-th eight bytes of terms; a byte past the end of a term is 0, which no term holds."""
        at = self.starts[which] + 8 * depth
        left = self.ends[which] - at
        whole = self._eight[np.minimum(at, len(self._eight) - 1)].astype(np.uint64)
        past = np.clip(8 - left, 0, 8).astype(np.uint64) * np.uint64(8)
        return np.where(left > 0, whole >> np.minimum(past, 63) << np.minimum(past, 63), np.uint64(0))

    def text(self, i: int) -> str:
        return self.buffer[self.starts[i] : self.ends[i]].tobytes().decode()

    def sorted_runs(self) -> tuple[np.ndarray, np.ndarray]:
        """The pointers sorted by their terms, and the starts of the runs of equal terms.

        Slices are split in three by a pivot of eight bytes; what equals the pivot goes on with the next eight
        unless the term ends there. Small slices are finished together, eight bytes at a time.
        """
        order = np.arange(len(self.starts))
        begins = np.zeros(len(order) + 1, bool)
        todo = [(0, len(order), 0)] if len(order) else []
        small: list[tuple[int, int, int]] = []
        while todo:
            low, high, depth = todo.pop()
            begins[low] = True
            if high - low <= SMALL:
                if high - low > 1:
                    small.append((low, high, depth))
                continue
            part = order[low:high]
            keys = self.keys(part, depth)
            pivot = np.sort(keys[:: max(1, len(keys) // 9)])[4]
            less, more = keys < pivot, keys > pivot
            equal = ~(less | more)
            a, b = low + int(less.sum()), high - int(more.sum())
            order[low:high] = np.concatenate((part[less], part[equal], part[more]))
            begins[a] = True
            if a > low:
                todo.append((low, a, depth))
            if high > b:
                todo.append((b, high, depth))
            if int(pivot) & 0xFF:
                todo.append((a, b, depth + 1))
        self._finish(order, begins, small)
        return order, np.flatnonzero(begins[:-1])

    def _finish(self, order: np.ndarray, begins: np.ndarray, slices: list[tuple[int, int, int]]) -> None:
        if not slices:
            return
        low, high, depth = (np.array(x) for x in zip(*slices))
        while len(low):
            size = high - low
            of = np.repeat(np.arange(len(low)), size)
            at = np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size)
            keys = self.keys(order[at], np.repeat(depth, size))
            by = np.lexsort((keys, of))
            order[at], keys = order[at][by], keys[by]
            new = np.concatenate(([True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])))
            begins[at[new]] = True
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(at)))
            again = (size > 1) & (keys[first] & np.uint64(0xFF) != 0)
            low, high, depth = at[first[again]], at[first[again]] + size[again], depth[of[first[again]]] + 1


def term_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences and documents of each term in each group."""
    schema = pa.schema([(c, pa.string()) for c in ("lang", "source", "term")] + [("n", pa.int64()), ("docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column("text"))
            groups = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"])
            names = {k: i for i, k in enumerate({(g["lang"], g["source"]): None for g in groups.to_pylist()})}
            group = np.array([names[g["lang"], g["source"]] for g in groups.to_pylist()], np.int64)
            known = list(names)
            for a, b in chunks(bounds, SHARD):
                pointers = Pointers(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                order, runs = pointers.sorted_runs()
                if not len(order):
                    continue
                run = np.zeros(len(order), np.int64)
                run[runs[1:]] = 1
                run = np.cumsum(run)
                row = np.searchsorted(bounds[a : b + 1] - bounds[a], pointers.starts[order], side="right") - 1
                # One number per (run, row), then per (run, group).
                where, n = np.unique(run * (b - a) + row, return_counts=True)
                of = where // (b - a) * len(known) + group[a + where % (b - a)]
                by = np.argsort(of, kind="stable")
                of, n = of[by], n[by]
                first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
                terms = [pointers.text(i) for i in order[runs]]
                place, which = of[first] // len(known), of[first] % len(known)
                yield batch_of({
                    "lang": [known[i][0] for i in which], "source": [known[i][1] for i in which],
                    "term": [terms[i] for i in place], "n": np.add.reduceat(n, first),
                    "docs": np.diff(np.append(first, len(of))),
                }, schema)

    found = docs.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _p(count: str, total: str) -> str:
    """1 + floor(10^9 * (count + 2) / (total + 2 * V)); the product may pass 64 bits."""
    return f"1 + (CAST(1000000000 AS DECIMAL(38, 0)) * (CAST({count} AS DECIMAL(38, 0)) + 2)) DIV (CAST({total} AS DECIMAL(38, 0)) + 2 * v)"


def _f(p: str, q: str) -> str:
    """floor((p - q)^2 / (p + q)): both are 10^9 + 1 at most, so the square stays in 64 bits."""
    return f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})"


def source_divergence(docs: DataFrame, least_docs: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part ``pair``: every other source of the language with its distance over all kept terms. Part ``term``: the
    ``top`` terms the source has more of than its language.
    """
    empty = F.lit("")
    docs = docs.select(
        F.coalesce(F.col("lang").cast("string"), empty).alias("lang"),
        F.coalesce(F.col("source").cast("string"), empty).alias("source"),
        "text",
    )
    in_lang = Window.partitionBy("lang", "term")
    kept, _ = stored(
        term_counts(docs)
        .withColumn("in_docs", F.sum("docs").over(in_lang)).withColumn("in_lang", F.sum("n").over(in_lang))
        .where(F.col("in_docs") >= least_docs).select("lang", "source", "term", "n", "in_lang"),
        "terms",
    )
    terms = kept.groupBy("lang", "term").agg(F.max("in_lang").alias("n"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    # A row per group, and the value of a term it lacks; without kept terms there is nothing to compare.
    groups, _ = stored(
        docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        .na.fill(0, ["total", "present", "v", "lang_total"])
        .withColumn("base", F.expr(f"CASE WHEN v > 0 THEN {_p('0', 'total')} ELSE 0 END")),
        "groups",
    )
    valued = kept.join(groups.select("lang", "source", "total", "v", "base", "lang_total"), ["lang", "source"]).withColumn(
        "p", F.expr(_p("n", "total"))
    )

    def sources(a: DataFrame, side: str, *columns: str) -> DataFrame:
        return a.select("lang", F.col("source").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])

    # Terms of one source as if the other lacked them: few distinct counts stand for all terms.
    histogram = valued.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    alone = (
        sources(histogram, "s", "p", "times").join(sources(groups, "t", "base"), "lang").where("s != t")
        .groupBy("lang", F.least("s", "t").alias("s"), F.greatest("s", "t").alias("t"))
        .agg(F.sum(F.expr(f"times_s * ({_f('p_s', 'base_t')})")).alias("alone"))
    )
    here = valued.select("lang", "term", "source", "p", "base")
    both = (
        here.toDF("lang", "term", "s", "p_s", "base_s").join(here.toDF("lang", "term", "t", "p_t", "base_t"), ["lang", "term"])
        .where("s < t").groupBy("lang", "s", "t")
        .agg(
            F.count("*").alias("shared"),
            F.sum(F.expr(f"{_f('p_s', 'p_t')} - {_f('p_s', 'base_t')} - {_f('base_s', 'p_t')}")).alias("change"),
        )
    )
    pairs = (
        sources(groups, "s", "base", "present", "v").join(sources(groups, "t", "base", "present"), "lang").where("s < t")
        .join(alone, ["lang", "s", "t"], "left").join(both, ["lang", "s", "t"], "left")
        .na.fill(0, ["alone", "shared", "change"])
        .withColumn("value", F.expr(
            "CASE WHEN v_s = 0 THEN 0 ELSE alone + change"
            f" + (v_s - present_s - present_t + shared) * ({_f('base_s', 'base_t')}) END"
        ))
        .select("lang", "value", F.explode(F.array(
            F.struct(F.col("s").alias("source"), F.col("t").alias("item")),
            F.struct(F.col("t").alias("source"), F.col("s").alias("item")),
        )).alias("pair"))
        .select("lang", "pair.source", F.lit("pair").alias("part"), "pair.item", F.col("value").cast("bigint").alias("value"))
    )
    telling = (
        valued.withColumn("q", F.expr(_p("in_lang", "lang_total"))).where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(order)
    return pairs.withColumn("rank", ranked).unionByName(
        telling.withColumn("rank", ranked).where(F.col("rank") <= top)
    )


#: DuckDB's form of ``source_divergence``.
SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), places AS (
  SELECT id, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS in_lang FROM places GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), langs AS (
  SELECT lang, count(*) AS v, sum(in_lang) AS total FROM kept GROUP BY lang
), grp AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT g.lang, g.source, k.term, k.in_lang, coalesce(c.n, 0) AS n
  FROM grp g JOIN kept k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM places GROUP BY ALL) c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), valued AS (
  SELECT c.lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY c.lang, source) + 2 * l.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (in_lang + 2)) // (l.total + 2 * l.v)::HUGEINT AS q
  FROM counts c JOIN langs l ON c.lang = l.lang
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT s.lang, s.source AS s, t.source AS t, sum(((s.p - t.p) * (s.p - t.p)) // (s.p + t.p)) AS value
    FROM valued s JOIN valued t ON s.lang = t.lang AND s.term = t.term AND s.source <> t.source GROUP BY ALL
  ) x ON x.lang = a.lang AND x.s = a.source AND x.t = b.source
), telling AS (
  SELECT lang, source, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM valued WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM telling
) WHERE rank <= 10
"""
