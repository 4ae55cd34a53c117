"""The numbered operators against plain versions, and on nulls, empty and long texts, ties, repeats and odd columns."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import dedup, encode, jaccard, lm, packing, pages, quality, rangecoder, segmentation, tokenfiles, toxicity, words
from starloom.llm.components import components

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
SCHEMA = "doc_id long, text string, digest string, n string, fp double, k int"


def lower(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, "one two three"), (6, "ONE two THREE"), (7, LONG), (8, LONG + " tail"),
    (9, "a b c d e f g h i j k l m n o p q r s t"), (10, "a b c d e f g h i j k l m n o p q r s t u"), (11, None), (None, "one two three"),
    (4, "one two three"), (12, "x" * 50_000), (13, "é́ ünï‑code text ﬁ\x1c\x85 it's ..'s 12.5 “q”"), (14, "\n\n  \n"), (15, "same\nsame\n\nsame\n"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like helpers."""
    return spark.createDataFrame([(i, t, "d", "n", 1.0, 2) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def folders(spark, odd, empty, tmp_path_factory):
    at = tmp_path_factory.mktemp("docs")
    odd.repartition(3).write.parquet(f"{at}/odd.parquet")
    empty.write.parquet(f"{at}/empty.parquet")
    return at


# ---- encoding


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_encode_like_the_whole_text(name, documents):
    own = Tokenizer.from_file(tokenizer_path(name))
    own.encode_special_tokens = True
    signs = [" ", "  ", "\n", "a", "é", "é", "'", "'s", ".", "1", "²", "\x1c", " ", "“", "ſ", "Σ", "İ", "\x00", "<|endoftext|>", "_", "字", "‍", "\x85"]
    rng = random.Random(5)
    texts = [t for _, t in documents[:60]] + [t or "" for _, t in ODD] + ["".join(rng.choices(signs, k=rng.randint(1, 14))) for _ in range(4000)]
    got = encode.Encoder(name).encode(texts)
    for text, one in zip(texts, got, strict=True):
        assert np.frombuffer(one, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name, end", [("word_bpe_49k.json", 49407), ("byte_bpe_50k.json", 50256)])
def test_special_tokens_in_a_text(name, end):
    own = Tokenizer.from_file(tokenizer_path(name))
    texts = ["a <|endoftext|> b", "<|endoftext|>", None, "plain text", "x<|endoftext|><|startoftext|>Y", "<|endoftext", "plain text"]
    marked = [np.frombuffer(x, "<u4").tolist() for x in encode.Encoder(name, marks=True).encode(texts)]
    assert marked == [own.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert marked[1] == [end]
    plain = [np.frombuffer(x, "<u4").tolist() for x in encode.Encoder(name).encode(texts)]
    assert end not in plain[1] and plain[3] == marked[3]


def test_an_encoder_stays_small(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdef", k=rng.choice([3, 8, 300]))) for _ in range(60)) for _ in range(80)]
    whole = encode.Encoder("word_bpe_49k.json").encode(texts)
    monkeypatch.setattr(encode, "MOST_BYTES", 20_000)
    small = encode.Encoder("word_bpe_49k.json")
    got = [x for k in range(0, 80, 4) for x in small.encode(texts[k : k + 4])]
    assert got == whole and small.size < 120_000 and max(map(len, small.known)) <= encode.LONG_CHUNK


def test_regular_strings_have_hashes_of_their_own():
    """Strings of two letters by the parity of ones, and their complements: equal for a polynomial modulo 2**64."""
    for n in (64, 1024, 4096):
        one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        other = one.translate(str.maketrans("ab", "ba"))
        data = np.frombuffer((one + other).encode(), np.uint8)
        h = words.hashes(data, np.array([0, n, 0]), np.array([n, 2 * n, n]))
        assert h[0] != h[1] and h[0] == h[2]


HISTOGRAMS = {
    "three fit exactly": ({1366: 1000, 1365: 2000}, 1000),
    "two and a half": ({2049: 300, 2047: 300, 1500: 400, 1000: 500}, 575),
    "five lengths": ({1800: 1800, 1400: 1800, 1100: 1800, 900: 1800, 700: 1800}, 2740),
    "near a third": ({1300 + k: 100 + k % 7 for k in range(130)}, 4620),
    "few": ({3000: 5, 1097: 4, 1096: 7, 999: 3}, 8),
    "whole": ({4096: 3, 1: 5}, 4),
    "none": ({}, 0),
}


@pytest.mark.parametrize("name", list(HISTOGRAMS))
def test_plans_are_as_good_as_best_fit(name):
    lengths, most = HISTOGRAMS[name]
    plan = packing.plan_patterns(lengths, 4096)
    held = collections.Counter()
    for p in plan:
        assert sum(n * k for n, k in p.content) + p.room == 4096 and p.room >= 0
        for n, k in p.content:
            held[n] += k * p.times
    assert held == collections.Counter(lengths)
    assert packing.sequences(plan) <= min(most, packing.sequences(packing.plan_patterns(lengths, 4096, rounds=0)))


def test_prices_find_the_best_configuration():
    rng = random.Random(8)
    for _ in range(60):
        sizes = np.array(rng.sample(range(3, 40), 5))
        value = np.array([rng.choice([0.0, rng.random()]) for _ in sizes])
        most = np.array([rng.randint(0, 4) for _ in sizes])
        limit = rng.randint(1, 90)
        got = packing.price_configuration(sizes, value, most, limit)
        assert (got <= most).all() and got @ sizes <= limit
        every = [c for c in itertools.product(*[range(m + 1) for m in most]) if np.dot(c, sizes) <= limit]
        assert got @ value >= max(np.dot(c, value) for c in every) - 1e-6


# ---- 1


def test_token_counts(spark, documents, odd, empty):
    own = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in tokenfiles.token_counts(docs.repartition(3)).collect()}
    assert got == {i: len(own.encode(t).ids) + 1 for i, t in documents}
    rows = sorted((r.doc_id or 0, r.n_tokens) for r in tokenfiles.token_counts(odd).collect())
    assert rows == sorted((i or 0, len(own.encode(t or "").ids) + 1) for i, t in ODD)
    assert tokenfiles.token_counts(empty).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_scan_stitches_any_blocks(spark, size):
    ids = [5, 9, 9, 1, 2, 3, 4, 5, 6, 9, 7]  # 9 ends; an empty document; the last one is open
    flat = np.array(ids, "<u2")
    rows = [(1, k, flat[lo : lo + size].tobytes()) for k, lo in enumerate(range(0, len(ids), size))] + [(2, 0, b""), (2, 1, np.array([9], "<u2").tobytes())]
    got = tokenfiles.scan_blocks(spark.createDataFrame(rows, "file long, block long, ids binary"), 9).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 2, True), (1, 1, 2, 1, True), (1, 2, 3, 7, True), (1, 3, 10, 1, False), (2, 0, 0, 1, True)]


# ---- 2


def test_sampling_follows_the_lattice():
    lat = segmentation.lattices()
    normal = lat.normalize("the cat")
    words = lat.split(normal)

    def all_paths(w):
        edges, _ = lat.word(w)

        def walk(i):
            if i == len(w):
                yield (), 0.0
                return
            for j, p, x in edges[i]:
                for rest, y in walk(j):
                    yield (p, *rest), x + y

        return list(walk(0))

    every = [((), 0.0)]
    for w in words:
        every = [(a + b, x + y) for a, x in every for b, y in all_paths(w)]
    z = sum(math.exp(x) for _, x in every)
    prob = {p: math.exp(x) / z for p, x in every}
    first, weight, n = collections.Counter(), 0.0, 3000
    for s in range(n):
        found, threshold = lat.sample(normal, 3, random.Random(s))
        assert len({tuple(i) for i, _, _ in found}) == 3
        assert [v for _, _, v in found] == sorted((v for _, _, v in found), reverse=True)
        first[tuple(found[0][0])] += 1
        weight += sum(math.exp(p) / segmentation.inclusion(p, threshold) for _, p, _ in found)
    top = max(prob, key=prob.get)
    assert abs(first[top] / n - prob[top]) < 0.02
    assert abs(weight / n - 1) < 0.02
    found, threshold = lat.sample(normal, len(every) + 1, random.Random(1))
    assert len(found) == len(every) and threshold == -math.inf
    assert all(abs(math.exp(p) - prob[tuple(i)]) < 1e-9 for i, p, _ in found)


def test_segmentations_of_rows(spark, odd, empty):
    got = segmentation.sample_segmentations(odd, ["doc_id", "digest"], "text", k=2).collect()
    assert all(r.decoded_ok for r in got)
    assert {r.doc_id for r in got} == {i for i, _ in ODD}
    assert [(r.sample, r.n_pieces, r.inclusion) for r in got if r.doc_id == 2] == [(0, 0, 1.0)]
    again = segmentation.sample_segmentations(odd.repartition(4), ["doc_id", "digest"], "text", k=2).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert segmentation.sample_segmentations(empty, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        segmentation.sample_segmentations(odd.withColumnRenamed("n", "ids"), ["ids"])


# ---- 3


def test_lines_and_zones():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>H</header><nav><ul><li>m</ul></nav>
    <div class="cookie-notice">C</div><div id="sidebar"><p>S</div><article><h1>A &amp; B</h1><p>one <b>two<br>three
    <p>four&nbsp;&#x41;<script>var x="</p>"</script></p><form><p>F</p></form><aside>X</aside><ul><li>i<li>j</ul>
    <div class="comments"><p>no</div><!-- <p>gone --> tail</article><footer>&copy; Z</footer></body></html>"""
    assert [x for x, z in pages.read_lines(page) if z == pages.ARTICLE] == ["A & B", "one two three", "four A", "i", "j", "tail"]
    assert pages.read_lines(None) == pages.read_lines("") == []
    assert pages.read_lines("a < b <unclosed") == [("a < b <unclosed", pages.OTHER)]
    assert [x for x, _ in pages.read_lines("<p>x</p><p>y")] == ["x", "y"]


def test_longest_common_lines():
    def plain(a, b):
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        return d[-1][-1]

    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        at = pages.common_lines(np.array(a, np.int64), np.array(b, np.int64))
        assert len(at) == plain(a, b) and at == sorted(set(at))
        rest = iter(b)
        assert all(a[k] in rest for k in at)


def test_long_alignments_are_halved(monkeypatch):
    rng = random.Random(13)
    pairs = [[np.array([rng.randint(0, 6) for _ in range(rng.randint(0, 60))], np.int64) for _ in range(2)] for _ in range(150)]
    whole = [len(pages.common_lines(a, b)) for a, b in pairs]
    monkeypatch.setattr(pages, "MOST_BITS", 40)
    for (a, b), n in zip(pairs, whole, strict=True):
        at = pages.common_lines(a, b)
        rest = iter(b.tolist())
        assert len(at) == n and at == sorted(set(at)) and all(a[k] in rest for k in at)


@pytest.mark.parametrize(
    "page",
    [
        '<body class="home has-sidebar"><p>text</p></body>', '<main class="content with-sidebar"><p>text</p></main>', '<article class="post related"><p>text</article>',
        '<p class="share-price">text</p>', '<section id="search-algorithms">text</section>', '<p id="notice-of-death">text</p>', '<p title="a hidden gem">text</p>',
        '<div class="entry-header"><h1>text</h1></div>', '<h2 class="banner">text</h2>', '<div data-nav="x" class=\'story\'>text</div>',
    ],
)
def test_names_that_mark_no_boilerplate(page):
    assert pages.article_text(pages.read_lines(page), []) == "text"


@pytest.mark.parametrize(
    "tag",
    [
        'div class="ad"', 'div class="cookie-notice"', 'div class="x site-header"', 'div id="sidebar"', 'div class="related-posts"', 'ul class="social-links"', 'p class="ad"',
        'div role="navigation"', 'div class="commentList"', 'div hidden', 'div aria-hidden="true"', 'section aria-label="Main navigation"', "div class='newsletter-signup-form'",
        'div class="ad-slot top"', 'div id="comments"',
    ],
)
def test_names_that_mark_boilerplate(tag):
    name = tag.split()[0]
    assert pages.article_text(pages.read_lines(f"<article><p>text</p><{tag}>gone</{name}></article>"), []) == "text"


@pytest.mark.parametrize("piece", ["<a x='", '<a x="', "<a x='y' ", "<!", "<a ", "<", "<a x='\">", "<p>x", "</", "<![CDATA[", "<!--"])
@pytest.mark.parametrize("end", ["", ">", "'>", '"'])
def test_broken_markup_is_read_in_linear_time(piece, end):
    page = piece * (300_000 // len(piece)) + end
    start = time.process_time()
    pages.read_lines(page)
    assert time.process_time() - start < 8


def test_articles(spark):
    t = "<div>Menu of the site</div><div>Buy now</div>{}<div>Imprint</div>"
    body = lambda *x: t.format("".join(f"<p>{y}</p>" for y in x))
    rows = [
        (1, "http://h.org/a/1", body("First story", "More of it"), "x"), (2, "http://h.org/a/2", body("Second story"), "x"),
        (3, "https://h.org/z", body("Third"), "x"), (3, "https://h.org/z", body("Third"), "x"), (4, "http://alone.org/", "<p>All of it</p>", "x"),
        (5, None, None, "x"), (6, "http://m.org/1", "<article><p>same</p></article><p>t</p>", "x"), (7, "http://m.org/2", "<article><p>same</p></article><p>t</p>", "x"),
        (8, "http://c.org/1", body("twin"), "x"), (9, "http://c.org/2", body("twin"), "x"), (None, "", "", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in pages.extract_articles(df).collect())
    want = {0: "", 1: "First story\nMore of it", 2: "Second story", 3: "Third", 4: "All of it", 5: "", 6: "same", 7: "same"}
    want[8] = want[9] = "Menu of the site\nBuy now\ntwin\nImprint"  # nearly all lines shared: a copy
    assert got == sorted((i or 0, want[i or 0], len(want[i or 0])) for i, *_ in rows)
    assert pages.extract_articles(df.limit(0)).count() == 0
    near = {r.key: r.near for r in pages.nearest_pages(spark.createDataFrame([(k, "h", f"/{k // 10}/{k}") for k in range(100)], "key long, host string, path string")).collect()}
    assert len(near) == 100 and all(k // 10 == v // 10 and k != v for k, v in near.items())


# ---- 4


def test_packing(spark, documents, odd, empty):
    own = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for df, rows, limit in ((spark.read.parquet(f"{SMALL}/documents.parquet"), documents, 4096), (odd, ODD, 64)):
        got = packing.pack(df, limit=limit).toPandas()
        want = []
        for i, t in rows:
            ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
            want += [(-1 if i is None else i, k, k * limit, len(ids[k * limit : (k + 1) * limit]), zlib.crc32(ids[k * limit : (k + 1) * limit])) for k in range(-(-len(ids) // limit))]
        have = got.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(int)
        assert sorted(map(tuple, have.to_numpy().tolist())) == sorted(want)
        for _, s in got.sort_values("offset").groupby("sequence_id"):
            assert s["offset"].tolist() == np.append(0, np.cumsum(s["length"])[:-1]).tolist() and s["length"].sum() <= limit
        assert got["sequence_id"].nunique() <= -(-got["length"].sum() // limit) * 1.02 + 1
    assert packing.pack(empty).count() == 0


def test_plan_fills_sequences():
    rng = random.Random(2)
    for limit, lengths in ((100, [34, 33, 33, 50, 50, 100, 1]), (4096, [int(min(4096, rng.lognormvariate(6, 1.2)) + 1) for _ in range(20_000)]), (10, [6] * 1000 + [4] * 500 + [5] * 3)):
        count = collections.Counter(min(n, limit) for n in lengths)
        plan = packing.plan_patterns(count, limit)
        held = collections.Counter()
        for p in plan:
            assert sum(n * k for n, k in p.content) + p.room == limit and p.room >= 0 and p.times > 0
            for n, k in p.content:
                held[n] += k * p.times
        assert held == count
    assert sum(p.times for p in plan) == 1000 + 2  # sixes with fours, fives by two
    assert packing.plan_patterns({}, 10) == []


# ---- 5


def test_lm_scores(spark, documents, folders):
    train = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    sql = "crc32(cast(cast(doc_id as string) as binary)) % 5 <> 1"
    rows = lm.score(spark, f"{SMALL}/documents.parquet", sql).collect()
    toks = {i: [*WORD.findall(lower(t)), None] for i, t in documents}
    count = collections.Counter(w for i, ws in toks.items() if train(i) for w in ws)
    n, v = sum(count.values()), len(count)
    assert {r.id for r in rows} == set(toks)
    for r in rows:
        ws = toks[r.id]
        assert (r.train, r.n_tokens, r.n_known, r.train_tokens) == (train(r.id), len(ws), sum(w in count for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
    held = [r for r in rows if not r.train]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    odd = lm.score(spark, f"{folders}/odd.parquet", "doc_id > 3").collect()
    assert len(odd) == len(ODD) and all(r.n_tokens == 1 for r in odd if r.id in (1, 2, 3))
    assert lm.score(spark, f"{folders}/empty.parquet", "true").count() == 0


def test_filter_finds_what_was_put_in(spark):
    column = pa.array(["a b a b a b c"] * 50, pa.large_string())
    rows = spark.createDataFrame([(i, t, True, i % 3) for i, t in enumerate(column.to_pylist())], "id long, text string, train boolean, blk long")
    model = lm.build_filter(rows, lm.word_totals(rows), most_bits=1 << 20)
    _, _, row, h = next(lm.tokens(column))
    assert model.total == 50 * 8 and model.distinct == 4
    two = lm.pairs(row, h)[:8]
    for level, true in zip(model.levels(two), [50, 150, 100, 150, 100, 150, 50, 50], strict=True):
        assert lm.LEVELS[level - 1] <= true < lm.LEVELS[level]
    count = np.array([150, 150, 150, 150, 150, 150, 50, 50])
    alone, after, before = model.parts(h[:8], row[:8], count)
    assert model.texts == 50 and before.tolist() == [50, 150, 150, 150, 150, 150, 150, 50]
    assert after[[0, 7]] == pytest.approx(1.0, rel=0.1) and alone[6] == 50.5 / (400 + 2.5)
    assert model.parts(h[:8], row[:8], count, own=1)[2].tolist() == [49, 149, 149, 149, 149, 149, 149, 49]
    assert (model.levels(np.arange(1, 1000, dtype=np.uint64) << np.uint64(50)) == 0).mean() > 0.95


def test_a_small_filter_leaves_out_rare_pairs_and_is_never_full(spark):
    rng = random.Random(2)
    texts = ["x y z " * 3 + " ".join(f"w{rng.randrange(10**6)}" for _ in range(200)) for _ in range(60)]
    rows = spark.createDataFrame([(i, t, True, i % 3) for i, t in enumerate(texts)], "id long, text string, train boolean, blk long")
    totals = lm.word_totals(rows)
    for most in (1 << 13, 1 << 20):
        model = lm.build_filter(rows, totals, most_bits=most)
        assert np.unpackbits(model.bits).mean() < 0.6
        _, _, row, h = next(lm.tokens(pa.array(texts[:1], pa.large_string())))
        found = model.levels(lm.pairs(row, h)) > 0
        assert found[1:8].all() and (found.all() if most > 1 << 13 else found[10:].mean() < 0.4)


def test_copies_of_training_texts_stand_out(spark, tmp_path):
    rng = random.Random(6)
    make = lambda: " ".join(rng.choices([f"w{k}" for k in range(400)], k=120))
    own = [make() for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(own)] + [(1000 + i, own[i] if i % 2 else make()) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    got = {r.id: (r.score - r.base_score) / r.n_tokens for r in lm.score(spark, f"{tmp_path}/d", "doc_id < 1000").collect()}
    assert min(got[1000 + i] for i in range(1, 40, 2)) > max(got[1000 + i] for i in range(0, 40, 2))


# ---- 6


def linked(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 80 * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d or 0, len(sets[i]), low.get(find(i)) or 0) for i, (d, _) in enumerate(rows))


def test_near_duplicates(spark, documents, odd, empty):
    got = jaccard.near_duplicates(odd).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == linked(ODD)
    assert jaccard.near_duplicates(empty).count() == 0
    got = jaccard.near_duplicates(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == linked(documents)


def test_ids_that_many_rows_share(spark):
    """A third of the rows without an id, a third with one id, near copies among all of them."""
    rng = random.Random(21)
    base = [rng.choices("abcdefghijklmnopqrstuvwxyz", k=60) for _ in range(12)]
    rows = []
    for k in range(180):
        words_ = list(rng.choice(base))
        words_[rng.randrange(60)] = f"w{k % 9}"
        rows.append(([None, 7, 100 + k][k % 3], " ".join(words_)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = [(k, t) for k, (_, t) in enumerate(rows)]
    group = {k: c for k, _, c in linked(keyed)}
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[group[k]] = min(least.get(group[k], i), i)
    want = sorted((str(i), str(least.get(group[k]))) for k, (i, _) in enumerate(rows))
    got = sorted((str(r.doc_id), str(r.component_id)) for r in jaccard.near_duplicates(df).collect())
    assert got == want


@pytest.mark.parametrize("block", [40, 2_000_000])
def test_links_at_the_threshold(spark, block, monkeypatch):
    """Chains of texts that differ by single words, of all small sizes, in one block and in many."""
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", block)
    rng = random.Random(block)
    rows = []
    for size in [*range(1, 40), 60, 90]:
        base = [f"s{size}w{k}" for k in range(size)]
        for _ in range(9):
            rows.append((len(rows), " ".join(base)))
            base = base[:]
            at = rng.randrange(len(base))
            base[at] = f"x{len(rows)}" if rng.random() < 0.6 else base[at]
            if rng.random() < 0.5:
                base = base + [f"y{len(rows)}"] if rng.random() < 0.5 else base[1:] or base
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == linked(rows)


def test_prefix_tree_finds_every_link():
    rng = np.random.default_rng(1)
    for _ in range(40):
        base = rng.integers(0, 60, 30)
        sets = [np.unique(np.where(rng.random(30) < 0.1, rng.integers(0, 60, 30), base)).astype(np.uint64) for _ in range(25)]
        roots = jaccard.connected(sets)
        up = jaccard.Union(25)
        for i in range(25):
            for j in range(i):
                o = len(np.intersect1d(sets[i], sets[j]))
                if 9 * o >= 4 * (len(sets[i]) + len(sets[j])):
                    up.join(np.array([i]), np.array([j]))
        assert roots.tolist() == up.roots().tolist()


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 8), (8, 7), (7, 6), (6, 5), (10, 10), (3, 1)] + [(100, k) for k in range(101, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, **{k: 4 for k in range(4, 10)}, **{k: 100 for k in range(100, 300)}}


# ---- 7


def kernel(s: bytes, t: bytes) -> float:
    """Sum over common subsequences of ORDER bytes, each with DECAY to the sum of both spans."""
    from itertools import combinations

    total, decay, order = 0.0, toxicity.DECAY, toxicity.ORDER
    seen = collections.defaultdict(list)
    for at in combinations(range(len(t)), order):
        seen[bytes(t[k] for k in at)].append(at[-1] - at[0] + 1)
    for at in combinations(range(len(s)), order):
        for span in seen.get(bytes(s[k] for k in at), ()):
            total += decay ** (span + at[-1] - at[0] + 1)
    return total


def test_subsequence_kernel():
    items = [b"idiot", b"i.d.i.o.t", b"moron", b"ab", b"aaaa", b"diotidi"]
    pairs = [(a, b) for a in items for b in items]
    s, n = toxicity.padded([a for a, _ in pairs])
    t, m = toxicity.padded([b for _, b in pairs])
    assert toxicity.subsequence_kernel(s, n, t, m) == pytest.approx([kernel(a, b) for a, b in pairs], rel=1e-4, abs=1e-6)


def test_toxicity_learns_insults(spark, odd, empty):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnoprstu", k=rng.randint(3, 9))) for _ in range(400)]
    texts = []
    for k in range(400):
        w = rng.choices(words, k=rng.randint(5, 60))
        if k % 4 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(["blockhead", "nincompoop"]))
        texts.append(" ".join(w))
    labels = [int(k % 4 == 0) for k in range(400)]
    model = toxicity.fit(texts[:300], labels[:300])
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts[300:] + ["you blockkhead", "a b-lock-head here", "", None])], "i int, text string")
    got = {r.i: r.score for r in toxicity.score(df, model).collect()}
    assert [int(got[i] >= 0.5) for i in range(100)] == labels[300:]
    assert got[100] >= 0.5 and got[101] >= 0.5 and got[102] == got[103] < 0.5
    scored = toxicity.score(odd, model, score_col="sc").collect()
    assert len(scored) == len(ODD) and scored[0].asDict().keys() == {*odd.columns, "sc"}
    assert toxicity.score(empty, model).count() == 0
    with pytest.raises(ValueError):
        toxicity.score(odd, model, score_col="fp")
    assert toxicity.fit([], []).landmarks == [] and toxicity.fit(["a"], [1]).probability(np.zeros((1, 0)))[0] > 0.5


# ---- 8


def test_range_coder_round_trips(documents):
    rng = np.random.default_rng(8)
    for ids in (np.zeros(0), np.array([65535]), rng.integers(0, 50257, 5000), np.zeros(70_000), np.tile(np.arange(50), 900), rng.zipf(1.3, 40_000) % 50257):
        ids = ids.astype("<u4")
        record = rangecoder.encode_block(ids)
        assert (rangecoder.decode_block(record) == ids).all()
    assert len(rangecoder.encode_block(np.zeros(70_000, "<u4"))) < 70_000 / 2
    broken = bytearray(rangecoder.encode_block(np.arange(3000, dtype="<u4")))
    broken[-40] ^= 1
    with pytest.raises(ValueError):
        rangecoder.decode_block(bytes(broken))
    with pytest.raises(ValueError):
        rangecoder.decode_block(bytes(broken[:-3]))
    with pytest.raises(ValueError):
        rangecoder.decode_block(b"no record")


def test_blocks_of_documents(spark, documents, odd, empty):
    own = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    for df, rows in ((spark.read.parquet(f"{SMALL}/documents.parquet"), documents), (odd, ODD)):
        want, start = [], 0
        for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
            ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
            want.append((i, start, len(ids), zlib.crc32(ids)))
            start += len(ids)
        got = sorted(map(tuple, rangecoder.round_trip(df).collect()), key=lambda r: r[1])
        assert got == want
    assert rangecoder.round_trip(empty).count() == 0


# ---- 9


def copies(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(-1 if i is None else i)
    return sorted((-1 if i is None else i, max(groups[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_copies(spark, folders, weak):
    """With a digest of nothing but the length, the comparison of full texts alone must tell texts apart."""
    digest = (lambda t: F.length(t).cast("string").cast("binary")) if weak else dedup.sha256_digest
    got = dedup.mark_copies(spark, f"{folders}/odd.parquet", digest=digest).collect()
    have = sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.dup_keep_id is None else r.dup_keep_id, r.dup_group_size, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in got)
    assert have == copies(ODD)
    assert sum(r.dup_kept for r in got) == len({t or "" for _, t in ODD})
    assert all(r.doc_id == r.dup_keep_id for r in got if r.dup_kept)
    assert dedup.mark_copies(spark, f"{folders}/empty.parquet").count() == 0


def test_state_goes_on(spark, tmp_path):
    """Files that come later meet the state of the earlier ones; nothing expires."""
    at, state = f"{tmp_path}/in", f"file://{tmp_path}/state"
    schema = "doc_id long, text string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1).write.parquet(at)
    full = spark.read.parquet(at).schema
    assert dedup.collect_state(spark, at, full, state).count() == 2
    spark.createDataFrame([(5, "a"), (3, "c")], schema).coalesce(1).write.mode("append").parquet(at)
    got = {r.place.id: r.n for r in dedup.collect_state(spark, at, full, state, files_per_batch=1).collect()}
    assert got == {5: 2, 2: 1, 3: 1}


# ---- 10


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count = collections.Counter(grams)
    covered = {k + d for k, g in enumerate(grams) if count[g] > 1 for d in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_statistics(spark, documents, odd, empty):
    for rows in (documents, ODD):
        got = quality.count_statistics(pa.array([t for _, t in rows], pa.large_string()))
        for k, (_, t) in enumerate(rows):
            assert tuple(int(got[c][k]) for c in quality.COUNTS[:5]) == statistics(t)
    out = quality.with_verdict(quality.with_statistics(odd, prefix="q_"), [], "q_")
    assert out.count() == len(ODD) and out.columns[: len(odd.columns)] == odd.columns
    assert out.where("doc_id in (1, 2, 3, 4)").where("q_kept").count() == 0
    assert quality.with_statistics(empty).count() == 0
    with pytest.raises(ValueError):
        quality.with_statistics(odd.withColumnRenamed("n", "n_words"))


def test_rules_are_learned(spark):
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.FEATURES)))
    bad = (x[:, 3] > 0.8) & (x[:, 0] < 0.5) | (x[:, 5] < 0.1)
    rules = quality.learn_rules(x, bad, quality.FEATURES)
    covered = np.zeros(len(x), bool)
    for r in rules:
        covered |= quality._holds(x, [(quality.FEATURES.index(n), s, v) for n, s, v in r.terms])
    assert (covered == bad).mean() > 0.97 and (covered & ~bad).mean() < 0.01
    assert quality.learn_rules(x, np.zeros(len(x), bool), quality.FEATURES) == []
    assert quality.learn_rules(x[:0], bad[:0], quality.FEATURES) == []
    one = quality.Rule((("symbol_share", ">=", 0.5), ("n_words", "<=", 100.0)), 1, 1.0)
    frame = quality.with_statistics(spark.createDataFrame([("## $$",), ("ab cd",), (None,)], "text string"))
    assert [r[0] for r in frame.select(quality.verdict([one])).collect()] == [1, None, None]
