"""Similarity join of documents on the Jaccard similarity of their word n-grams, exact.

A document is the set of its distinct n-grams of words (the whole sequence as one, if it has fewer
words). N-grams are 64-bit hashes. Documents link when the sets overlap by ``share`` of their union.

* Equal sets are one class; one member, the smallest id, stands for it. A task sends one member
  of each class it meets, so a text copied a million times is sent once a task.
* N-grams are counted in hash buckets: packed arrays of 48 bits of the hash, and the documents that have some there.
  Only n-grams that two documents share go on, so a document whose other n-grams exceed
  the room for differences is done. N-grams in a fixed share of all documents are found
  beforehand; they are few (a document's size over the share), are broadcast, and travel with
  their documents instead of meeting in one bucket.
* N-grams are ordered from rare to frequent. Two documents that link share one of the first few
  n-grams (the prefix), with a shorter prefix on the smaller side. N-grams of one document come first
  and only shorten the prefix.
* A group of documents with a common prefix n-gram may hold a third of all. First every document
  is compared with one member of one of its groups, in rounds with other choices; what links is merged: documents
  carry a label, equal only among connected ones, and the sets themselves are written once. Then it meets some members of its groups. Last, the pairs of a group that are not merged yet, not both of its largest component, are made
  distinct, filtered by length, position and suffix, and verified once each.

Components are exact: pairs left out are merged already. NULL and wordless texts have an
empty set and link with nothing. Rows with the same id are the same document; if
their texts differ, each keeps the size of its own set. A NULL id gets a NULL component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, chunks, mix64, partitions, utf8
from millrace.llm.components import components
from millrace.workspace import stored

WORDS = 5
#: The least share of the union, as numerator and denominator.
SHARE = (3, 4)
#: N-grams in this share of all documents are sent with their documents.
FREQUENT = 0.005
BUCKET = 800_000
ROUNDS = 3
#: The first pass over the remaining pairs takes one in so many members of each group.
WAVE = 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    """Powers of the base and of its inverse (both odd, so all is exact modulo 2^64)."""
    global _powers, _inverse
    if len(_powers) < n:
        back = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, _BASE, np.uint64))))
        _inverse = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, back, np.uint64))))


def sets_of(data: np.ndarray, bounds: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each row."""
    n = len(bounds) - 1
    low = _LOWER[data]
    word = ~_SPACE[low]
    first = np.zeros(len(low) + 1, bool)
    first[bounds] = True
    before = np.zeros(len(low), bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | first[:-1]))
    after = np.zeros(len(low), bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    _grow(len(low) + 1)
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers[: len(low)], out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * _inverse[starts])
    at = np.searchsorted(starts, bounds)
    gram = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for k in range(words):
        gram += hashes[k : k + len(gram)] * np.uint64(2 * k * 0x51ED27 + 0xD6E8FEB86659FD93)
    gram = mix64(gram)
    for i in range(n):
        a, b = at[i], at[i + 1]
        if b - a >= words:
            own = np.sort(gram[a : b - words + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                whole = mix64(whole * np.uint64(31) + h)
            yield whole
        else:
            yield np.empty(0, np.uint64)


def _signature(own: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    x = mix64(own ^ np.uint64(0x5555))
    return int(x.sum(dtype=np.uint64).view(np.int64)), int(mix64(x + np.uint64(1)).sum(dtype=np.uint64).view(np.int64))


def _rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[list, list]]:
    """Ids and sets of ranges of rows."""
    for batch in batches:
        data, bounds = utf8(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        for a, b in chunks(bounds):
            with np.errstate(over="ignore"):
                yield ids[a:b], list(sets_of(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], words))


def _surveyed(docs: DataFrame, words: int) -> DataFrame:
    """Rows (doc_id, n, s1, s2) of documents, and rows (gram, n) of n-grams frequent in a task's rows."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n", "s1", "s2", "gram")])

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _rows(batches, words):
            signed = [_signature(s) for s in sets]
            yield batch_of({
                "doc_id": ids, "n": [len(s) for s in sets], "s1": [a for a, _ in signed],
                "s2": [b for _, b in signed], "gram": [None] * len(ids),
            }, schema)
            alone = list({k: s for k, s in zip(signed, sets) if len(s)}.values())
            if alone:
                gram, n = np.unique(np.concatenate(alone), return_counts=True)
                often = n >= max(8, FREQUENT * len(alone))
                none = [None] * int(often.sum())
                yield batch_of({"doc_id": none, "n": n[often], "s1": none, "s2": none, "gram": gram[often].view(np.int64)}, schema)

    return docs.mapInArrow(survey, "doc_id bigint, n bigint, s1 bigint, s2 bigint, gram bigint")


def _planes(x: np.ndarray) -> bytes:
    """Numbers by place of their bytes, so that equal upper bytes stand together and compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind)[:, 0]


def _rank(df: np.ndarray) -> np.ndarray:
    """Class of a document frequency: finer than steps of a tenth, up to 255."""
    return np.minimum(255, np.floor(8 * np.log2(df))).astype(np.uint8)


def _key(gram: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of an n-gram, and the n-gram as bucket and 48 bits of its hash."""
    bucket = (gram >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)
    return bucket.astype(np.int64), (bucket << np.uint64(48)) | (gram & np.uint64((1 << 48) - 1))


def _dealt(ids: np.ndarray, owner: np.ndarray, grams: np.ndarray, buckets: int) -> dict[str, list]:
    """A block of n-grams for each bucket, with the ids of the documents that have some there, each with their number."""
    bucket, _ = _key(grams, buckets)
    order = np.argsort(bucket.astype(np.uint16), kind="stable")
    grams, owner, bucket = grams[order], owner[order], bucket[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    used = [k for k in range(buckets) if edges[k] < edges[k + 1]]
    low = grams.view(np.uint8).reshape(-1, 8)[:, :6]
    begins = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(bucket, prepend=-1) != 0))
    ids, counts = ids[owner[begins]], np.diff(begins, append=len(owner)).astype(np.uint32)
    spans = np.searchsorted(begins, edges)
    return {
        "bucket": used, "docs": [_planes(ids[spans[k] : spans[k + 1]]) for k in used],
        "spots": [_planes(counts[spans[k] : spans[k + 1]]) for k in used],
        "grams": [low[edges[k] : edges[k + 1]].tobytes() for k in used], "ranks": [b""] * len(used),
    }


def _shared_grams(docs: DataFrame, frequent: np.ndarray, ranks: np.ndarray, buckets: int, parts: int, words: int) -> DataFrame:
    """Per document the n-grams it shares with others: rows (doc_id, n, grams, ranks) in rare-first order.

    Only documents of which enough n-grams are shared to link at all.
    """
    shared = docs.sparkSession.sparkContext.broadcast((frequent, ranks))
    block = pa.schema([("bucket", pa.int64()), ("docs", pa.binary()), ("spots", pa.binary()), ("grams", pa.binary()), ("ranks", pa.binary())])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, rank = shared.value
        for ids, sets in _rows(batches, words):
            kept: dict[tuple, tuple] = {}
            for id_, own in zip(ids, sets):
                if len(own) and id_ is not None:
                    key = _signature(own)
                    if key not in kept or id_ < kept[key][0]:
                        kept[key] = (id_, own)
            if not kept:
                continue
            ids = np.array([i for i, _ in kept.values()], np.int64)
            sizes = np.array([len(s) for _, s in kept.values()])
            grams = np.concatenate([s for _, s in kept.values()])
            owner = np.repeat(np.arange(len(ids)), sizes)
            spot = np.minimum(np.searchsorted(often, grams), max(len(often) - 1, 0))
            hit = often[spot] == grams if len(often) else np.zeros(len(grams), bool)
            # Sizes and frequent n-grams go on untouched, in any bucket.
            yield batch_of({
                "bucket": [-1 - int(ids[0] % buckets)], "docs": [ids.tobytes()], "spots": [sizes.astype(np.uint32).tobytes() + owner[hit].astype(np.uint32).tobytes()],
                "grams": [_key(grams[hit], buckets)[1].tobytes()], "ranks": [rank[spot[hit]].tobytes() if len(often) else b""],
            }, block)
            yield batch_of(_dealt(ids, owner[~hit], grams[~hit], buckets), block)

    sent = pa.schema([("part", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary()), ("grams", pa.binary()), ("ranks", pa.binary())])

    def send(ids: np.ndarray, grams: np.ndarray, rank: np.ndarray, sizes: np.ndarray | None = None) -> pa.RecordBatch:
        """Entries grouped by the part of their document; with ``sizes``, rows of (id, size) too."""
        part = (mix64(ids.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((ids, part))
        ids, grams, rank, part = ids[order], grams[order], rank[order], part[order]
        sizes = sizes[order] if sizes is not None else None
        out: dict[str, list] = {f.name: [] for f in sent}
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(part))):
            unique, n = np.unique(ids[a:b], return_counts=True)
            out["part"].append(int(part[a]))
            out["ids"].append(_planes(unique))
            out["counts"].append(_planes(n.astype(np.uint32) if sizes is None else sizes[a:b].astype(np.uint32)))
            out["grams"].append(b"" if sizes is not None else _planes(grams[a:b]))
            out["ranks"].append(b"" if sizes is not None else rank[a:b].tobytes())
        return batch_of(out, sent)

    def counted(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        blocks = list(zip(*(table.column(c).to_pylist() for c in ("docs", "spots", "grams", "ranks"))))
        out = []
        if bucket < 0:
            for docs_, spots, grams, rank in blocks:
                ids, spots = np.frombuffer(docs_, np.int64), np.frombuffer(spots, np.uint32)
                sizes, owner = spots[: len(ids)], spots[len(ids) :]
                none = np.zeros(len(ids), np.uint64)
                out.append(send(ids, none, none.astype(np.uint8), sizes))
                if len(owner):
                    out.append(send(ids[owner], np.frombuffer(grams, np.uint64), np.frombuffer(rank, np.uint8)))
        else:
            ids = np.concatenate([np.repeat(_from_planes(d, np.int64), _from_planes(s, np.uint32)) for d, s, _, _ in blocks])
            low = np.frombuffer(b"".join(g for _, _, g, _ in blocks), np.uint8).reshape(-1, 6)
            gram = np.zeros((len(low), 8), np.uint8)
            gram[:, :6] = low
            gram = gram.view(np.uint64)[:, 0] | np.uint64(bucket << 48)
            order = np.lexsort((ids, gram))
            gram, ids = gram[order], ids[order]
            # Copies of a document in several tasks send the same n-grams.
            new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (ids[1:] != ids[:-1])))
            gram, ids = gram[new], ids[new]
            cuts = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
            df = np.repeat(np.diff(cuts, append=len(gram)), np.diff(cuts, append=len(gram)))
            both = df > 1
            if both.any():
                out.append(send(ids[both], gram[both], _rank(df[both])))
        return pa.Table.from_batches(out, schema=sent)

    numerator, denominator = SHARE
    full = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("grams", pa.binary()), *[(f"k{r}", pa.int64()) for r in range(ROUNDS)]])

    def gathered(key: tuple, table: pa.Table) -> pa.Table:
        blocks = list(zip(*(table.column(c).to_pylist() for c in ("ids", "counts", "grams", "ranks"))))
        sizes: dict[int, int] = {}
        owners, grams, ranks = [], [], []
        for i, c, g, r in blocks:
            ids, counts = _from_planes(i, np.int64), _from_planes(c, np.uint32)
            if not r:
                sizes.update(zip(ids.tolist(), counts.tolist()))
            else:
                owners.append(np.repeat(ids, counts))
                grams.append(_from_planes(g, np.uint64))
                ranks.append(np.frombuffer(r, np.uint8))
        out: dict[str, list] = {f.name: [] for f in full}
        if owners:
            owner, gram, rank = np.concatenate(owners), np.concatenate(grams), np.concatenate(ranks)
            order = np.lexsort((gram, rank, owner))
            owner, gram = owner[order], gram[order]
            new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])))
            owner, gram = owner[new], gram[new]
            cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            for a, b in zip(cuts, np.append(cuts[1:], len(owner))):
                id_ = int(owner[a])
                n = sizes[id_]
                own = gram[a:b]
                unshared = n - len(own)
                room = _prefix(n) - unshared
                if room <= 0:
                    continue
                out["doc_id"].append(id_)
                out["n"].append(n)
                out["grams"].append(_planes(own))
                for r in range(ROUNDS):
                    head = own[:room]
                    out[f"k{r}"].append(int(head[np.argmin(mix64(head + np.uint64(r * 0x1234567)))].view(np.int64)))
        return pa.Table.from_pydict(out, schema=full)

    blocks = docs.mapInArrow(dealt, "bucket bigint, docs binary, spots binary, grams binary, ranks binary")
    lists = blocks.groupBy("bucket").applyInArrow(counted, "part bigint, ids binary, counts binary, grams binary, ranks binary")
    names = ", ".join(f"k{r} bigint" for r in range(ROUNDS))
    return lists.groupBy("part").applyInArrow(gathered, f"doc_id bigint, n bigint, grams binary, {names}")


def _prefix(n: int) -> int:
    """How many of the first n-grams a document must show to meet every partner."""
    a, b = SHARE
    return n - -(-a * n // b) + 1


def _short_prefix(n: int) -> int:
    """The same towards partners that are no smaller."""
    a, b = SHARE
    return n - -(-2 * a * n // (a + b)) + 1


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of documents that link, with what other numbers their rows have."""
    num, den = SHARE
    one = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("n1"), F.col("grams").alias("g1"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("n2"), F.col("grams").alias("g2"))
    names = pairs.columns
    schema = pa.schema([(c, pa.int64()) for c in names])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "g1", "g2")))
            yield batch.select(names).filter(pa.array([_links(*row) for row in rows], pa.bool_())).cast(schema)

    # Both sides of a pair must be near in size.
    near = (F.least("n1", "n2") * den >= F.greatest("n1", "n2") * num)
    return pairs.join(one, "a").join(two, "b").where(near).select(*names, "n1", "n2", "g1", "g2").mapInArrow(
        check, ", ".join(f"{c} bigint" for c in names)
    )


def _links(n1: int, n2: int, g1: bytes, g2: bytes) -> bool:
    num, den = SHARE
    need = -(-num * (n1 + n2) // (num + den))
    x, y = _from_planes(g1, np.uint64), _from_planes(g2, np.uint64)
    if min(len(x), len(y)) < need:
        return False
    x, y = np.sort(x), np.sort(y)
    # Suffix filter: what lies on either side of a middle n-gram can meet only there.
    cut = x[len(x) // 2]
    i, j = np.searchsorted(x, cut), np.searchsorted(y, cut)
    if min(i, j) + min(len(x) - i, len(y) - j) < need:
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= need


def _prefixes(sets: DataFrame) -> DataFrame:
    """Rows (gram, position, doc_id, n, comp, short) of the shared part of each document's prefix."""
    schema = pa.schema([("gram", pa.int64()), ("position", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("comp", pa.int64()), ("short", pa.bool_())])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id_, n, comp, grams in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "comp", "grams"))):
                own = _from_planes(grams, np.int64)
                alone = n - len(own)
                m = _prefix(n) - alone
                yield batch_of({
                    "gram": own[:m], "position": np.arange(alone, alone + m), "doc_id": [id_] * m, "n": [n] * m,
                    "comp": [comp] * m, "short": np.arange(alone, alone + m) < _short_prefix(n),
                }, schema)

    return sets.select("doc_id", "n", "comp", "grams").mapInArrow(
        explode, "gram bigint, position bigint, doc_id bigint, n bigint, comp bigint, short boolean"
    )


def _relabelled(state: DataFrame, found: DataFrame) -> DataFrame:
    """``state`` (doc_id, comp, ...) after links between documents labelled ``o`` and ``c``: who had the one gets the other.

    Equal labels are connected; connected documents may have different ones until components are taken.
    """
    moved = found.groupBy(F.col("o").alias("comp")).agg(F.min("c").alias("to"))
    return state.join(moved, "comp", "left").withColumn("comp", F.coalesce("to", "comp")).select(*state.columns)


def _labelled(sets: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (doc_id, comp) of the component of each document."""
    found = components(links).withColumnRenamed("node", "doc_id")
    return sets.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("comp"))


def _remaining_pairs(sets: DataFrame, state: DataFrame, wave: int = 1) -> DataFrame:
    """Distinct pairs that share a prefix n-gram, pass length and position, and are not merged.

    With ``wave`` over 1 only with that part of the members of each group.
    """
    num, den = SHARE
    entries = _prefixes(sets.join(state.select("doc_id", "comp"), "doc_id"))
    sizes = entries.groupBy("gram", "comp").agg(F.count("*").alias("m"))
    groups = sizes.groupBy("gram").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1")
    open_, _ = stored(entries.join(groups.select("gram", "main"), "gram"), "prefixes")
    x = open_.where("comp != main").select(
        "gram", F.col("doc_id").alias("a"), F.col("n").alias("n1"), F.col("position").alias("p1"), F.col("comp").alias("c1"), F.col("short").alias("s1")
    )
    y = open_.select(
        "gram", F.col("doc_id").alias("b"), F.col("n").alias("n2"), F.col("position").alias("p2"), F.col("comp").alias("c2"), F.col("short").alias("s2")
    )
    if wave > 1:
        y = y.where(F.pmod(F.xxhash64("b"), F.lit(wave)) == 0)
    # The larger side shows its prefix, the smaller one its shorter prefix.
    sides = F.when(F.col("n1") < F.col("n2"), F.col("s1")).when(F.col("n1") > F.col("n2"), F.col("s2")).otherwise(F.col("s1") & F.col("s2"))
    length = F.least("n1", "n2") * den >= F.greatest("n1", "n2") * num
    position = (F.least(F.col("n1") - F.col("p1"), F.col("n2") - F.col("p2")) + F.least("p1", "p2")) * (num + den) >= (F.col("n1") + F.col("n2")) * num
    pairs = x.join(y, "gram").where((F.col("c1") != F.col("c2")) & sides & length & position)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar_documents(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    survey, _ = stored(_surveyed(texts, words), "survey")
    own = survey.where("gram IS NULL").select("doc_id", "n", "s1", "s2")
    rows, total = own.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    often = survey.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("n").alias("df")).where(F.col("df") >= max(8, FREQUENT * rows))
    # At most the size of a set over FREQUENT.
    often = often.toPandas()
    frequent = often["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(frequent)
    ranks = _rank(np.maximum(often["df"].to_numpy(float), 2))[order]
    heads, _ = stored(
        own.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(F.min("doc_id").alias("head"), F.count("*").alias("copies")), "heads"
    )
    buckets = min(65536, max(64, math.ceil(total / BUCKET)))
    parts = max(partitions(docs), math.ceil(rows / 4000))
    lists = _shared_grams(texts, frequent[order], ranks, buckets, parts, words)
    sets, _ = stored(lists.join(heads.select(F.col("head").alias("doc_id")).distinct(), "doc_id", "left_semi"), "sets")
    state = sets.select("doc_id", F.col("doc_id").alias("comp"), *(f"k{r}" for r in range(ROUNDS)))
    links = None
    for r in range(ROUNDS):
        key = f"k{r}"
        lead = state.groupBy(key).agg(F.min(F.struct("comp", "doc_id")).alias("lead"), F.max("comp").alias("last"))
        lead, _ = stored(lead.where(F.col("last") != F.col("lead.comp")).select(key, F.col("lead.doc_id").alias("b"), F.col("lead.comp").alias("c")), "leads")
        pairs = state.join(lead, key).where("comp != c").select(F.col("doc_id").alias("a"), "b", F.col("comp").alias("o"), "c")
        found, _ = stored(_verified(pairs, sets), "links")
        links = found.select("a", "b") if links is None else links.unionByName(found.select("a", "b"))
        state, _ = stored(_relabelled(state, found), "labels")
    # Most of what is left links with many members of a group: a part of them merges it, and
    # only what is unlike all of these meets every member.
    early, _ = stored(_verified(_remaining_pairs(sets, state, WAVE), sets), "links")
    links = links.unionByName(early)
    state, _ = stored(_labelled(sets, links), "labels")
    last, _ = stored(_verified(_remaining_pairs(sets, state), sets), "links")
    reached, _ = stored(components(links.unionByName(last)), "components")
    reached = reached.select(F.col("node").alias("head"), "component")
    classes, _ = stored(
        heads.where("copies > 1").join(reached, "head", "left").select("s1", "s2", F.coalesce("component", "head").alias("component_id")), "classes"
    )
    alone = reached.select(F.col("head").alias("doc_id"), "component").distinct()
    named = own.join(classes, ["s1", "s2"], "left").join(alone, "doc_id", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component_id", "component", "doc_id")).otherwise(F.col("doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with its columns.

    Rows without an id are groups of their own: all are kept.
    """
    found = similar_documents(docs, words)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
