"""Operators for training data against plain Python, with awkward rows."""

import collections
import functools
import gzip
import hashlib
import os
import re
import types
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import bpe, components, fingerprint, language, licenses, neighbours, ngram_join, packing, toxicity, urls, warc
from millrace.llm.pieces import read_ranks
from millrace.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(TABLES), reason="shared tables are not here")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n int, gram string, id int, size int, comp string"
LONG = "one two three four five six seven eight nine ten " * 300


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "en", None, None, 1, "x", 2, 3, "y") for i, t in pairs], SCHEMA)


AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (5, "A"), (6, LONG), (7, LONG + "extra"), (8, LONG.upper()),
    (9, "é" * 50), (10, "it's  two   blanks \n\n end "), (11, "😀 <|endoftext|> x"), (None, "no id here at all today"), (12, "v w x y z"),
]


def words_set(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute_components(pairs):
    sets = {i: words_set(t) for i, t in pairs if i is not None}
    meet = collections.Counter()
    holders = collections.defaultdict(set)
    for i, s in sets.items():
        for g in s:
            holders[g].add(i)
    for ids in holders.values():
        for a in ids:
            for b in ids:
                if a < b:
                    meet[a, b] += 1
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in meet.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def test_buckets_of_ngrams_get_their_own_documents_only():
    rng = np.random.default_rng(13)
    ids, sizes = np.arange(5, 905, dtype=np.int64) * (1 << 33), np.full(900, 3)
    owner, grams = np.repeat(np.arange(900), sizes), rng.integers(0, 1 << 63, 2700, dtype=np.uint64) * np.uint64(2)
    for buckets in (1, 64, 5000):
        sent = ngram_join._dealt(ids, owner, grams, buckets)
        # Before, every bucket got the ids of all 900 documents.
        assert sum(map(len, sent["docs"])) <= 8 * len(grams)
        got = []
        for k, docs_, counts, low in zip(sent["bucket"], sent["docs"], sent["spots"], sent["grams"]):
            own = np.repeat(ngram_join._from_planes(docs_, np.int64), ngram_join._from_planes(counts, np.uint32))
            got += zip([k] * len(own), own.tolist(), (low[i : i + 6] for i in range(0, len(low), 6)))
        bucket, _ = ngram_join._key(grams, buckets)
        assert sorted(got) == sorted((b, ids[o], int(g).to_bytes(8, "little")[:6]) for b, o, g in zip(bucket, owner, grams))
    assert ngram_join._dealt(ids[:0], owner[:0], grams[:0], 64)["docs"] == []


def test_similar_documents(spark):
    near = []
    base = [f"w{i}" for i in range(200)]
    for k in range(40):
        own = list(base)
        own[k * 5] = f"edit{k}"
        own[(k * 7 + 3) % 200] = f"more{k}"
        near.append((100 + k, " ".join(own)))
    rest = [(200 + k, f"head{k} " * 3 + " ".join(base[:60]) + f" tail{k}" * k) for k in range(20)]
    pairs = AWKWARD + near + rest
    got = ngram_join.similar_documents(docs(spark, pairs)).collect()
    assert len(got) == len(pairs)
    want = brute_components(pairs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    kept = ngram_join.one_of_each(docs(spark, pairs))
    assert kept.columns == docs(spark, pairs).columns
    firsts = {i for i, (_, c) in want.items() if i == c}
    assert {r.doc_id for r in kept.collect()} == firsts | {i for i, _ in pairs if i is None}


def test_sets_are_written_once(spark, monkeypatch):
    written, kept = [], ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, purpose: written.append((purpose, df.columns)) or kept(df, purpose))
    taken, components_of = [], ngram_join.components
    monkeypatch.setattr(ngram_join, "components", lambda edges: taken.append(1) or components_of(edges))
    base = [f"w{i}" for i in range(60)]
    pairs = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(4)]
    got = ngram_join.similar_documents(docs(spark, pairs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(pairs)
    # Before, all n-grams were written again for every round.
    assert [purpose for purpose, columns in written if "grams" in columns] == ["sets"]
    assert len(taken) == 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 40), (40, 60), (70, 70), (50, 40)]
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    reached = {r.node: r.component for r in got}
    assert all(reached[i] == 0 for i in range(31)) and reached[60] == reached[50] == 40


def test_repeated_rows_over_partitions(spark):
    """A row that another partition repeats shares no n-gram with itself, and links with no more texts than once."""
    words = [f"a{i}" for i in range(104)]
    other = words[:64] + [f"b{i}" for i in range(40)]
    sharing = [(20 + k, " ".join(other[60:] + [f"c{k}_{j}" for j in range(70)])) for k in range(6)]
    pairs = [(4, " ".join(words)), (10, " ".join(other)), *sharing]
    want = brute_components(pairs)
    assert want[10][1] == 10
    frame = docs(spark, pairs)
    again = docs(spark, pairs[:1]).repartition(3)
    for extra in (again, again.unionByName(again), frame):
        rows = frame.repartition(9).unionByName(extra)
        got = ngram_join.similar_documents(rows).collect()
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, n, c) for i, (n, c) in want.items()}
        assert len(got) == rows.count()


def test_one_of_each_with_other_columns(spark):
    rows = spark.createDataFrame([(1, "a b c d e f", 5, 6), (2, "a b c d e f", 7, 8)], "doc_id bigint, text string, __id int, component_id int")
    assert [tuple(r) for r in ngram_join.one_of_each(rows).collect()] == [(1, "a b c d e f", 5, 6)]


def test_components_of_a_long_chain(spark, monkeypatch):
    """A path over ascending ids takes rounds by its logarithm, and plans stay shallow."""
    from millrace.llm import components as module

    stored, rounds = module.stored, []

    def counted(df, purpose):
        rounds.append(len(df._jdf.queryExecution().optimizedPlan().toString()))
        return stored(df, purpose)

    monkeypatch.setattr(module, "stored", counted)
    chain = spark.range(1000).selectExpr("id AS a", "id + 1 AS b").repartition(3)
    found = module.components(chain).collect()
    assert len(found) == 1001 and {r.component for r in found} == {0}
    assert len(rounds) <= 13 and rounds[-1] <= 1.2 * rounds[1]


def test_one_of_each_keeps_rows_without_id(spark):
    pairs = [(1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "u v w x y z"), (None, None)]
    kept = ngram_join.one_of_each(docs(spark, pairs)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == sorted((str(i), str(t)) for i, t in pairs if i != 2)


def tiktoken_ids(name):
    import public_tokenizers
    import tiktoken

    ranks = read_ranks(public_tokenizers.path(name))
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_byte_bpe(spark):
    encode = tiktoken_ids("byte_bpe_multi_50k.tiktoken")
    got = {r.doc_id: r for r in bpe.round_trip(docs(spark, AWKWARD)).collect()}
    for i, text in AWKWARD:
        ids = np.array(encode(text or ""), "<u4")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.decode(encode("naïve 😀 text")) == "naïve 😀 text"


def test_matches_longer_than_a_look():
    encode = tiktoken_ids("byte_bpe_multi_50k.tiktoken")
    machine = bpe.Transducer(bpe.read_ranks(bpe.vocabulary()))
    for unit in ("a", "ab", "=", "日", "thein"):
        text = unit * (2 * bpe.LOOK // len(unit.encode()) + 3)
        if len(bpe.matches(bpe._pattern())(text)) == 1:
            assert machine.encode(text.encode()) == encode(text)


def test_utf8_machine():
    data = "aé😀z".encode()
    machine = bpe.Utf8()
    assert "".join(machine.feed(data[i : i + 1]) for i in range(len(data))) + machine.close() == "aé😀z"
    broken = bpe.Utf8()
    assert broken.feed(b"\xf0\x9f") + broken.close() == "�"


def check_packing(rows, length):
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    return len(places)


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = ["a <|endoftext|> b", "<|endoftext|>", "two  <|endoftext|>  blanks", "x<|endoftext|>y " * 900]
    pairs = AWKWARD + [(7000 + i, t) for i, t in enumerate(special)]
    assert packing.part_ids(packing.vocabulary()).of(special[0]) == np.array([64, 220, 50256, 275], "<u4").tobytes()
    rows = packing.pack(docs(spark, pairs)).collect()
    check_packing(rows, 2048)
    wanted = collections.Counter()
    for i, text in pairs:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        first, start, piece = len(ids) % 2048 or 2048, 0, 0
        while start < len(ids):
            stop = min(len(ids), first if piece == 0 else start + 2048)
            wanted[i, piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())] += 1
            start, piece = stop, piece + 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted


def test_packing_in_rounds_and_to_the_end(spark, monkeypatch):
    sizes = {i: 1 + (i * i * 37) % 97 for i in range(1500)}
    items = spark.createDataFrame(list(sizes.items()), "id bigint, size int")
    starts = []
    kept = packing.stored
    monkeypatch.setattr(packing, "stored", lambda df, purpose: starts.append(purpose) or kept(df, purpose))
    for last, rounds in ((0, None), (700, None), (1500, 0)):
        monkeypatch.setattr(packing, "LAST", last)
        starts.clear()
        rows = packing.best_fit(items, 100).collect()
        assert sorted(r.id for r in rows) == sorted(sizes)
        assert rounds is None and "packing" in starts or starts == ["placed"]
        Row = collections.namedtuple("Row", "sequence_id offset length")
        least = -(-sum(sizes.values()) // 100)
        assert least <= check_packing([Row(r.sequence, r.offset, sizes[r.id]) for r in rows], 100) <= 1.05 * least


def test_a_text_is_encoded_in_one_call(monkeypatch):
    import tiktoken

    calls = []
    for name in ("encode", "encode_ordinary", "encode_to_numpy"):
        plain = getattr(tiktoken.Encoding, name)
        monkeypatch.setattr(tiktoken.Encoding, name, lambda *a, f=plain, **k: calls.append(1) or f(*a, **k))
    packing.part_ids.cache_clear()
    of = packing.part_ids(packing.vocabulary()).of
    assert len(of(" ".join(f"w{i:04d}" for i in range(1000)))) >= 4000
    packing.part_ids.cache_clear()
    assert len(calls) == 1


@pytest.mark.parametrize("sizes", [
    [(i, 1 + (i * i * 37) % 99) for i in range(3000)] + [(5000 + i, 50) for i in range(1000)],
    [(i, 1 + i % 7) for i in range(6000)],
    [(i, 3) for i in range(2000)],
], ids=["all sizes", "small", "equal"])
def test_best_fit_is_tight(spark, sizes):
    got = packing.best_fit(spark.createDataFrame(sizes, "id bigint, size int"), 100).collect()
    size = dict(sizes)
    assert sorted(r.id for r in got) == sorted(size)
    used = collections.defaultdict(list)
    for r in got:
        used[r.sequence].append((r.offset, size[r.id]))
    for own in used.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 100
    assert len(used) <= 1.05 * -(-sum(size.values()) // 100) + 5


def test_fingerprints(spark):
    pairs = [(i, t) for i, t in AWKWARD if i is not None and i != 4] + [(20, LONG[:5000]), (21, LONG[:5000])]
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs(spark, pairs)).collect()}
    ordered = sorted(pairs)
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.edited_fingerprint == fingerprint.written(fingerprint.sketch(fingerprint.span_hashes(fingerprint.points_of(edited))))
        assert r.kept_chars == next((k for k, (a, b) in enumerate(zip(text, edited)) if a != b), min(len(text), len(edited)))
    assert got[20].fingerprint == got[21].fingerprint and got[20].near_next == 1.0


def test_prefix_hashes():
    text = "abracadabra abracadabrb"
    p = fingerprint.Prefixes(fingerprint.points_of(text))
    assert p.span(0, 4) == p.span(7, 11) != p.span(1, 5)
    assert fingerprint.common_extension(p, 0, p, 12) == 10


def test_modulo_without_dividing():
    rng = np.random.default_rng(9)
    for p in fingerprint.PRIMES:
        edge = np.array([0, 1, p - 1, p, p + 1, 2 * p, (1 << 31) - 1, 1 << 31, (1 << 63) - 1, (p - 1) * (p - 1)], np.uint64)
        x = np.concatenate([edge, rng.integers(0, 1 << 63, 10_000, dtype=np.uint64)])
        assert (fingerprint.modulo(x, p) == x % np.uint64(p)).all()


def test_least_values_and_likeness():
    rng = np.random.default_rng(10)
    for n, high in [(0, 2), (5, 9), (300, 3), (900, 1 << 30), (5000, 1 << 40), (5000, 60)]:
        a, b = (rng.integers(0, high, n, dtype=np.uint64) for _ in range(2))
        one, two = fingerprint.least(a), fingerprint.least(np.concatenate([a[: n // 2], b]))
        assert one.tolist() == sorted(set(a.tolist()))[: fingerprint.KEPT]
        assert fingerprint.written(one) == "".join(f"{v:010x}" for v in one.tolist())
        both = sorted({*one.tolist(), *two.tolist()})[: fingerprint.KEPT]
        if n:
            assert fingerprint.likeness(one, two) == sum(v in one and v in two for v in both) / len(both)


@pytest.mark.parametrize("together", [1, 40, 1 << 16])
def test_rows_are_fingerprinted_together_as_alone(monkeypatch, together):
    monkeypatch.setattr(fingerprint, "TOGETHER", together)
    rng = np.random.default_rng(12)
    sizes = [0, 1, 3, 11, 12, 15, 16, 17, 40, 0, 400, 3000, 5, 700, 700]
    texts = ["".join(rng.choice(list("ab c\u00e9\U0001F600"), n)) for n in sizes] + [LONG[:4000]] * 2 + [None]
    rows = [(i // 6, False, i, t) for i, t in enumerate(texts)]
    rows = sorted([*rows, *((b, True, 6 * b + 6, texts[6 * b + 6]) for b in range(2))], key=lambda r: r[:3])
    schema = pa.schema([("bucket", pa.int32()), ("edge", pa.bool_()), ("doc_id", pa.int64()), ("text", pa.string())])
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[i : i + 7]], schema) for i in range(0, len(rows), 7)]
    got = {r["doc_id"]: r for b in fingerprint._compared(iter(batches)) for r in b.to_pylist()}
    assert sorted(got) == list(range(len(texts) - 1))

    def plain(text):
        return fingerprint.sketch(fingerprint.span_hashes(fingerprint.points_of(text)))

    for i, (text, after) in enumerate(zip(texts, texts[1:])):
        after = after or ""
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        assert got[i]["fingerprint"] == fingerprint.written(plain(text))
        assert got[i]["edited_fingerprint"] == fingerprint.written(plain(edited))
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["near_edited"] == fingerprint.likeness(plain(text), plain(edited))
        assert got[i]["near_next"] == fingerprint.likeness(plain(text), plain(after))
        assert got[i]["kept_chars"] == next((k for k, (a, b) in enumerate(zip(text, edited)) if a != b), min(len(text), len(edited)))


PAGES = [
    (1, "http://A.b.example.org/es/1?q", "<p>" + "x" * 200), (2, "https://shop.example.com/fr/9", "<p>" + "x" * 200), (3, None, None),
    (4, "no scheme", "short"), (5, "http://c.net?x", "short"), (6, "http://c.com/de/x#f", "<title>shop words</title>" + "y" * 100),
    (7, "http://example.org", ""), (8, "ftp://x.example.org/en/12", "<p>" + "x" * 200),
]
PAGE = "page_id bigint, url string, html string, host string, file string"


def pages(spark):
    return spark.createDataFrame([(*p, "h", "f") for p in PAGES], PAGE)


def test_url_filters(spark):
    got = {r.page_id: r for r in urls.judged(pages(spark)).collect()}
    assert {i: got[i].rule for i in got} == {
        1: "example.org/es/", 2: "com/fr/", 3: None, 4: None, 5: None, 6: "com/de/", 7: None, 8: "example.org/en/1",
    }
    assert (got[1].host, got[1].path) == ("a.b.example.org", "/es/1") and (got[3].host, got[3].path) == ("", "")
    assert (got[5].host, got[5].path) == ("c.net", "") and got[6].verdict == "block" and got[2].verdict == "allow"
    assert urls.split("shopwords", {"shop": 50, "words": 50, "sho": 1}, 102) == ["shop", "words"]


def plain_split(name, counts):
    """The cheapest of all ways to cut a name, every part tried at every place."""
    total = sum(counts.values()) + 1

    def price(part):
        return urls.cost(counts[part], total) if part in counts else urls.cost(1, total) + urls.LETTER * len(part)

    best = [(0, [])]
    for end in range(1, len(name) + 1):
        least, start = min((best[k][0] + price(name[k:end]), k) for k in range(end))
        best.append((least, best[start][1] + [name[start:end]]))
    return best[-1][1]


def plain_judged(rows):
    """(host words, log odds of block) of each page (page_id, url, html, verdict by rules)."""
    titles = collections.Counter()
    for _, _, html, _ in rows:
        title = re.search(r"(?is)<title[^>]*>([^<]*)", html or "")
        titles.update(re.findall(r"[^\W\d_]+", title[1].lower()) if title else [])
    tokens, seen, docs = [], collections.defaultdict(collections.Counter), collections.Counter()
    cut = functools.cache(lambda name: plain_split(name, titles))
    for _, url, _, verdict in rows:
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), found[1]), found[2].lower()) if found else ("", "")
        tokens.append([
            (side, w) for side, text in (("h", host), ("p", path)) for run in re.findall(r"[^\W\d_]+|\d+", text)
            for w in ([f"#{len(run)}"] if run.isdigit() else cut(run))
        ])
        if verdict:
            seen[verdict].update(tokens[-1])
            docs[verdict] += 1
    kinds = len({t for c in seen.values() for t in c}) + 1

    def share(kind, token):
        return np.log((seen[kind][token] + 1) / (sum(seen[kind].values()) + kinds))

    prior = np.log((docs["block"] + 1) / (docs["allow"] + 1))
    return [([w for side, w in t if side == "h"], prior + sum(share("block", x) - share("allow", x) for x in t)) for t in tokens]


def compare_judged(rows):
    """Rows of ``urls.judged`` beside the plain reckoning."""
    for r, (words, odds) in zip(rows, plain_judged([(r.page_id, r.url, r.html, r.verdict if r.rule else None) for r in rows])):
        assert r.host_words == words and abs(r.block_odds - odds) < 1e-6, r
        assert r.rule or abs(odds) < 1e-6 or r.verdict == ("block" if odds > 0 else "allow")


def test_url_words_and_odds(spark):
    assert urls.judged(spark.createDataFrame([], PAGE)).collect() == []
    long = "verylong" * 60
    names = ["newsshop", "shopnews", "thebigshop", "xqzt", "bigbignews", long, "straßenews", "Éclair", "a", "shop24news", "antidisestablishmentarianisms"]
    ends = ["org", "net", "com", "example.org"]
    rows = [
        (i, f"http://{names[i % 11]}.{names[i % 7]}.{ends[i % 4]}/{['es', 'fr', 'de', 'en'][i % 3]}/{names[i % 5]}-{i}?q=1#f",
         f"<title>The big {['shop', 'news', 'antidisestablishmentarianisms', 'verylong'][i % 4]} a Straße</title>", "h", "f")
        for i in range(300)
    ]
    # One url holds a third of all rows; others are NULL, empty or without a host.
    rows += [(i % 3, "https://www.newsshop.net/x", None, "h", "f") for i in range(200)] + [(None, None, None, "h", "f"), (7, "", "", "h", "f"), (8, "none", "", "h", "f")]
    table = spark.createDataFrame(rows, PAGE)
    by_page = {(r.page_id, r.host, r.path): r for r in urls.judged(table).collect()}
    got = urls.judged(table.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, urls.judged(table).collect())) and len(got) == len(rows)
    places = urls.by_rules(table.select("page_id", "url", "html", urls.host_of(table.url).alias("host"), urls.path_of(table.url).alias("path")))
    joined = [Row(**{**r.asDict(), **by_page[r.page_id, r.host, r.path].asDict()}) for r in places.collect()]
    compare_judged(joined)
    assert {tuple(r.host_words) for r in joined if r.host == "newsshop.shopnews.org"} <= {("news", "shop", "shop", "news", "org")}
    assert any("antidisestablishmentarianisms" in r.host_words for r in joined)


@needs_tables
def test_url_words_and_odds_of_a_table(spark):
    table = spark.read.parquet(f"{TABLES}/pages.parquet")
    html = {r.page_id: (r.url, r.html) for r in table.collect()}
    compare_judged([Row(**r.asDict(), url=html[r.page_id][0], html=html[r.page_id][1]) for r in urls.judged(table).collect()])


def test_archives(spark):
    got = {r.page_id: r for r in warc.archive_round_trip(pages(spark)).collect()}
    for i, _, html in PAGES:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
    assert {i: got[i].refers_to for i in got if got[i].record_type == "revisit"} == {2: 1, 8: 1}
    fields, payload = warc.parse(gzip.decompress(gzip.compress(warc.record(5, "http://a/", b"\r\n\r\nx", "d", None))))
    assert payload == b"\r\n\r\nx" and fields["X-Page-ID"] == "5"


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 16))
    rows = [(i, (centres[i % 20] + 0.3 * rng.standard_normal(16)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[40][1]) for i in range(60)] + [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] * 16), (3060, [1.0, None] * 8)]
    got = neighbours.neighbours(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), trees=8).collect()
    good = rows[:1560]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good], np.float32).astype(float)
    hits = total = 0
    found = collections.defaultdict(dict)
    for r in got:
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    for q, ranked in found.items():
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]].tolist()
        assert sorted(ranked) == list(range(1, 21))
        hits += len(set(best) & {v for v, _ in ranked.values()})
        total += 20
    assert hits >= 0.9 * total


def test_forest_ranges_are_bounded(monkeypatch):
    monkeypatch.setattr(neighbours, "RANGE", 100)
    rng = np.random.default_rng(11)
    hashes = rng.integers(0, 2**64, (4000, 2), np.uint64)
    hashes[:2500, 0] = 2**64 - 5
    forest = neighbours.Forest(4, 2, 1.0)
    assert forest.cut(hashes, 4000) == 40
    salts = neighbours.mix64(np.arange(4000, dtype=np.uint64))
    for tree in range(2):
        own = forest.range_of(tree, hashes[:, tree], salts)
        assert np.bincount(own, minlength=40).max() <= 200
        order = np.sort(hashes[:, tree])
        query, visited = forest.visited(tree, hashes[:50, tree], 350)
        # The ranges visited hold the 350 rows on either side; of the equal hashes of the first tree any will do.
        for q in range(50 * tree):
            at = np.searchsorted(order, hashes[q, tree])
            near = np.isin(hashes[:, tree], order[max(0, at - 350) : at + 350])
            assert set(own[near]) <= set(visited[query == q])


@pytest.mark.parametrize("blocks", [False, True])
def test_neighbours_over_many_ranges(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "RANGE", 100)
    monkeypatch.setattr(neighbours, "QUERIES", 30)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1200, 8)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = neighbours.neighbours(rows, trees=8, blocks=blocks).collect()
    found = collections.defaultdict(dict)
    for r in got:
        found[r.query_id][r.rank] = r.vec_id
    hits = 0
    for q in range(0, 1200, 20):
        score = x.astype(float) @ x[q].astype(float)
        score[q] = -np.inf
        assert sorted(found[q]) == list(range(1, 21))
        hits += len(set(np.argsort(-score)[:20].tolist()) & set(found[q].values()))
    assert hits == 60 * 20 if blocks else hits >= 0.9 * 60 * 20


def test_ascended_takes_the_longest_prefixes():
    rng = np.random.default_rng(6)
    hashes = np.sort(np.concatenate([rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2), np.full(30, 12345, np.uint64)]))
    for asked in [*rng.integers(0, 1 << 63, 20, dtype=np.uint64), np.uint64(12345), np.uint64(0), np.uint64((1 << 64) - 1)]:
        bits = np.sort(neighbours._prefix_bits(hashes, asked))[::-1]
        for most in (1, 7, 40, 229, 230, 500):
            (a,), (b,) = neighbours.ascended(hashes, np.array([asked]), most)
            assert b - a == min(most, 230)
            assert sorted(neighbours._prefix_bits(hashes[a:b], asked), reverse=True) == bits[:most].tolist()


def test_sizes_do_not_choose_the_way_of_neighbours(spark, monkeypatch):
    # On vectors without structure the forest's trees give more rows than there are; it is taken all the same.
    monkeypatch.setattr(neighbours, "depth", lambda *_: 60)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 32)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    plain = {(r.query_id, r.vec_id) for r in neighbours.neighbours(rows, trees=8, blocks=True).collect()}
    few = {(r.query_id, r.vec_id) for r in neighbours.neighbours(rows, trees=8).collect()}
    # 8 trees of 60 rows give more than the 400 rows in all, but miss some neighbours.
    assert len(few) == len(plain) == 20 * 20 and few != plain


def test_licenses(spark):
    pairs = [
        (1, "x\nReleased under the MIT License.\ny"), (2, "This work is licensed under the GNU General Public License version 3"),
        (3, "my driving license has expired"), (4, None), (5, "word " * 500 + "Licensed under the Apache License, Version 2.0. " + "word " * 500),
        (6, "All rights reserved. Licensed under CC BY-NC 4.0."), (7, ""),
    ]
    got = licenses.license_findings(docs(spark, pairs)).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [
        (1, "MIT"), (2, "GPL-3.0"), (5, "Apache-2.0"), (6, "ARR"), (6, "CC-BY-NC-4.0"),
    ]


def test_licenses_across_lines_and_in_long_lines(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\n# modification, are permitted"
    gnu = "/* This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n" \
        " * the Free Software Foundation; either version 2 of the License, or\n * (at your option) any later version. */"
    pairs = [
        (1, "# Licensed under the Apache License,\n# Version 2.0."), (2, bsd), (3, gnu),
        (4, "copyright " + "x" * 240 + " " + bsd.replace("\n#", "") + " word" * 200),
        (5, "my license " + "word " * 45 + "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. " + "word " * 200),
        (6, "All rights reserved. Some words between. All rights reserved."),
        (7, "This work is licensed under the GNU Lesser General\nPublic License, version 3."),
        (8, "redistribution of licenses, version 2 0, may be permitted under all rights of the public"),
    ]
    found = sorted((r.doc_id, r.license) for r in licenses.license_findings(docs(spark, pairs)).collect())
    assert found == [
        (1, "Apache-2.0"), (2, "BSD-3-Clause"), (3, "GPL-2.0"), (4, "BSD-3-Clause"), (5, "MPL-2.0"), (6, "ARR"), (6, "ARR"), (7, "LGPL-3.0"),
    ]


def test_full_license_texts():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text, tells in licenses.full_texts():
        words = text.split()
        wrapped = "\n * ".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
        changed = " ".join("changed" if i % 10 == 7 and w.lower().strip(",.") not in tells.split() else w for i, w in enumerate(words))
        for made, n in ((text, 1), (" ".join(words) + " and then " + wrapped, 2), (changed, 1)):
            assert [f[1] for f in scanner.findings(made)] == [name] * n
    for name, text, _ in licenses.TEMPLATES:
        assert [f[1] for f in scanner.findings("a b c " + text + " d e f")] == [name]


def test_every_template_is_found_whole_and_wrapped(spark):
    pairs, want = [], []
    for k, (name, text, _) in enumerate(licenses.TEMPLATES):
        words = text.split()
        pairs += [(2 * k, text), (2 * k + 1, "\n# ".join(words))]
        want += [(2 * k, name), (2 * k + 1, name)]
    got = licenses.license_findings(docs(spark, pairs)).collect()
    assert sorted((r.doc_id, r.license) for r in got) == want
    assert all(r.differences == 0 and r.bytes_saved > 0 for r in got)


def test_license_cues_and_rows(spark):
    pairs = [(1, "All rights\n# reserved."), (None, "Released under the MIT License."), (2, "RELEASED UNDER THE MIT LICENSE."),
             (2, "Released under the MIT License."), (3, None), (4, ""), (5, "all general rights, mit and bsd")]
    got = collections.Counter((r.doc_id, r.license) for r in licenses.license_findings(docs(spark, pairs)).collect())
    assert got == {(1, "ARR"): 1, (None, "MIT"): 1, (2, "MIT"): 2}


def test_license_notices_side_by_side():
    # Places known by making: any notices in any order, with and without words between, are each found where they begin.
    scanner = licenses.Scanner(licenses.TEMPLATES)
    short = licenses.STATEMENTS + licenses.NOTICES
    draw = np.random.default_rng(5)
    for between in (0, 1, 40):
        for _ in range(40):
            text, want = "", []
            for k in draw.integers(0, len(short), 4):
                text += "tree " * between
                want.append((len(text) + (short[k][1][0] == '"'), short[k][0]))
                text += short[k][1] + "\n"
            found = [(f[0], f[1]) for f in scanner.findings(text)]
            assert found == want, (between, found, want)


def test_compression_ranks_templates():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    plain = licenses.zstandard.ZstdCompressor(level=licenses.LEVEL)
    for name, text, _ in licenses.TEMPLATES:
        block = re.findall(r"[^\W_]+", text.lower())
        ranked = scanner.rank(block)
        data = " ".join(block).encode()
        assert len(ranked) == len(licenses.TEMPLATES)
        assert [s for s, _ in ranked] == sorted((s for s, _ in ranked), reverse=True)
        assert ranked[0][0] < len(plain.compress(data))
        assert name in {scanner.kinds[i].name for s, i in ranked if s >= ranked[0][0] - 8}


def test_awkward_rows_for_trained_operators(spark):
    found = {r.doc_id: r for r in language.language_id(docs(spark, AWKWARD)).collect()}
    assert found[1].lang_pred == found[2].lang_pred == found[3].lang_pred == "und" and found[6].lang_pred == "en"
    labels = spark.createDataFrame([(6, 1, 0), (7, None, 1), (8, 1, 1), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    scored = toxicity.toxicity(docs(spark, AWKWARD), labels).collect()
    assert len(scored) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)


@needs_tables
def test_unlearned_languages_are_rejected(spark):
    table = spark.read.parquet(TABLES.replace("0.001", "0.1") + "/documents.parquet").where("lang IS NOT NULL AND length(text) > 200")
    unseen = language.held_out(F.col("doc_id"))
    for left in ("en", "de"):
        models = language.fit(table.where(~unseen & (F.col("lang") != left)).select("doc_id", "text", "lang"))
        found = language.identify(table.where(unseen), models).join(table.select("doc_id", "lang"), "doc_id")
        share = {r[0]: r[1] for r in found.groupBy(F.col("lang") == left).agg(F.avg(F.col("rejected").cast("int"))).collect()}
        assert share[True] > 0.95 and share[False] < 0.01, (left, share)


def test_kernel_tolerates_gaps():
    assert toxicity.kernel("idiot", "idiot") > 0.9 > toxicity.kernel("idiot", "idixot") > toxicity.kernel("idiot", "house")
    assert toxicity.tokens("an i.d i o t here") == ["an", "id", "iot", "here"] and toxicity.tokens("m-o r,on") == ["mo", "ron"]
    machine = toxicity.Machine({k: v for k, v in toxicity.triples("idiot").items()}, 0.0)
    scorer = machine.compiled()
    want = [toxicity.kernel("idiot", w) for w in ("idiot", "idixot", "house")]
    assert np.allclose(scorer.of_words(["idiot", "idixot", "house"]), want, atol=1e-5)


@needs_tables
def test_held_out_accuracy(spark):
    folder = TABLES.replace("0.001", "0.01")
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op6_language_id"](spark, folder).where("held_out").join(table, "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    assert not found.where("rejected").count()
    folder = TABLES.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = QUERIES["op10_toxicity"](spark, folder).where("held_out").join(labels, "doc_id")
    assert scored.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()[0] > 0.93


def test_unlike_documents_all_count():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 8))
    common = [word() for _ in range(8)]
    made = [[*common, *(word() for _ in range(30))] for _ in range(120)]
    seen = toxicity.Copies()
    assert all(seen.new(set(m)) for m in made) and not any(seen.new({*m[1:], "changed"}) for m in made)
    texts = [" ".join([*m, "blockhead"] if i < 40 else m) for i, m in enumerate(made)]
    machine = toxicity.fit(pd.DataFrame({"text": texts, "toxic": [int(i < 40) for i in range(120)]}))
    fresh = [" ".join([word() for _ in range(20)] + own) for own in ([], ["blockhead"])]
    p = machine.probability(machine.compiled().of_words(fresh))
    assert p[0] < toxicity.THRESHOLD <= p[1]


def test_windows_of_words_are_learned():
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 7))
    common = ["empty", "bucket", "head", "house", "river", "stone", "笨", "蛋", "好", "人", "zq"]
    def made(insult):
        words = [word() for _ in range(20)] + [w for w in common if w not in insult.split()]
        rng.shuffle(words)
        return " x. ".join(words) + ". " + insult + "."
    for insult, harmless in (("empty bucket", "bucket. Empty"), ("笨蛋", "蛋 x 笨"), ("zq", "house"), ("y" * 10 + "kw" * 20, "house")):
        texts = [made(insult if i < 50 else harmless) for i in range(150)]
        machine = toxicity.fit(pd.DataFrame({"text": texts, "toxic": [int(i < 50) for i in range(150)]}))
        p = machine.probability(machine.compiled().of_words([made(harmless) for _ in range(20)] + [made(insult) for _ in range(20)]))
        assert p[:20].max() < toxicity.THRESHOLD <= p[20:].min(), insult


def test_margins_of_windows():
    machine = toxicity.Machine(toxicity.triples("you bad cat"), 0.0)
    scorer = machine.compiled()
    text = "Oh, you b.a.d cat! Is it 笨蛋 a i o\nyou bad"
    words, sentences = toxicity.read(text)
    assert words == ["oh", "you", "bad", "cat", "is", "it", "笨", "蛋", "aio", "you", "bad"]
    (_, owner, margin), = scorer.words(toxicity.pa.array([text]))
    assert len(owner) == len(words)
    for i in range(len(words)):
        for size in range(1, 4):
            whole = i + size <= len(words) and sentences[i] == sentences[i + size - 1]
            want = toxicity.kernel("you bad cat", " ".join(words[i : i + size])) if whole else -np.inf
            assert np.isclose(margin[i, size - 1], want, atol=1e-5)


@needs_tables
def test_held_out_toxic_class(spark):
    folder = TABLES.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = QUERIES["op10_toxicity"](spark, folder).where("held_out").join(labels, "doc_id")
    both, toxic, flagged = found.agg(F.sum(F.col("toxic") * F.col("predicted")), F.sum("toxic"), F.sum("predicted")).first()
    assert both >= 0.92 * toxic and both >= 0.65 * flagged


EMPTY = [
    lambda s, d: language.language_id(d), lambda s, d: language.accepted(d), lambda s, d: ngram_join.similar_documents(d),
    lambda s, d: bpe.round_trip(d), lambda s, d: packing.pack(d), lambda s, d: licenses.license_findings(d),
    lambda s, d: fingerprint.fingerprints(d),
    lambda s, d: toxicity.toxicity(d, s.createDataFrame([], "doc_id bigint, toxic int")),
    lambda s, d: urls.judged(s.createDataFrame([], PAGE)), lambda s, d: warc.archive_round_trip(s.createDataFrame([], PAGE)),
    lambda s, d: neighbours.neighbours(s.createDataFrame([], "vec_id bigint, embedding array<float>")),
]


@pytest.mark.parametrize("made", EMPTY)
def test_empty_tables(spark, made):
    assert made(spark, docs(spark, [])).collect() == []


@needs_tables
def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, TABLES).collect()
    check_packing(rows, 2048)
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()]
    firsts = {i for i, (_, c) in brute_components(table).items() if i == c}
    toxic = {r.doc_id for r in spark.read.parquet(f"{TABLES}/labels.parquet").where("toxic = 1").collect()}
    kept = {r.doc_id for r in rows}
    assert len(kept & firsts) >= 0.9 * len(firsts - toxic) and len(kept) <= len(firsts) + len(toxic)


def test_kept_rows_go_back_in_small_batches(monkeypatch):
    class Rows:
        """What a stage asks of a table, without a session."""

        schema = None
        sparkSession = sparkContext = property(lambda self: self)

        def broadcast(self, value):
            return types.SimpleNamespace(value=value)

        def mapInArrow(self, function, schema):
            return function

    counts = pd.DataFrame({"lang": ["en"], "gram": np.array([1], np.int64), "n": [5]})
    monkeypatch.setattr(language, "language_models", lambda docs: language.compile_models(counts))
    monkeypatch.setattr(toxicity, "toxicity_machine", lambda docs, labels: toxicity.Machine(slope=1e-3, shift=-6.0))
    batch = pa.record_batch({"doc_id": pa.array(range(2300)), "text": pa.array([f"some words {i}" for i in range(2300)])})
    for kept in (language.accepted(Rows()), toxicity.accepted(Rows(), None)):
        sent = list(kept(iter([batch])))
        # Before, a batch of the reading side went back whole.
        assert max(b.num_rows for b in sent) <= 500
        assert [i for b in sent for i in b.column("doc_id").to_pylist()] == list(range(2300))
