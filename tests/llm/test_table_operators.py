"""Top-k, exact and near duplicates, packing, wrappers and the pipeline against brute force."""

import hashlib
import html
import itertools
import random
import re
import string
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimloom.llm import exact_dedup, near_dedup, packing, queries, topk, wrappers
from claimloom.staging import stage

SMALL = "/root/testdata/sf0.001"


# --- top-k ------------------------------------------------------------------------


@pytest.mark.parametrize("shard_rows, query_block", [(1000, 100), (40, 7)])
def test_topk_equals_brute_force(spark, shard_rows, query_block):
    rng = np.random.default_rng(3)
    vectors = rng.normal(scale=0.2, size=(300, 8)).astype("float32")
    vectors[200:230] = vectors[0]  # ties
    rows = [(i, [float(x) for x in v], i) for i, v in enumerate(vectors)]
    rows += [(300, None, 0), (301, [1.0, None] + [0.0] * 6, 0), (302, [float("nan")] * 8, 0), (303, [float("inf")] * 8, 0), (None, rows[0][1], 0)]
    rows += rows[5:6]  # a repeated row
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    quantised = df.select("vec_id", topk.quantise(F.col("embedding")).alias("v"))
    asked = quantised.where("vec_id % 10 = 0 or vec_id = 5")
    got = topk.top_k(quantised, asked, "vec_id", "v", 5, shard_rows, query_block).collect()
    whole = np.floor(vectors.astype(float) * 256).astype(int)
    usable = [*range(300), 5]
    for q in [*range(0, 300, 10), 5]:
        scores = sorted((-int(whole[i] @ whole[q]), i) for i in usable if i != q)[:5]
        own = sorted((r["rank"], -r.score, r.vec_id) for r in got if r.query_id == q)
        assert own == [(n + 1, s, i) for n, (s, i) in enumerate(scores)]
    assert {r.query_id for r in got} == {*range(0, 300, 10), 5}


def test_topk_of_large_values_and_several_lengths(spark):
    rng = random.Random(8)
    scale = [1.0, 1e7, -1e7, 1e12, 1e300]
    rows = [(i, [rng.uniform(-1, 1) * rng.choice(scale[: 1 + i % 5]) for _ in range(rng.choice([0, 3, 3, 5]))]) for i in range(90)]
    df = spark.createDataFrame(rows + [(91, None), (92, [float("nan"), 1.0, 2.0])], "vec_id long, embedding array<double>")
    quantised = df.select("vec_id", topk.quantise(F.col("embedding")).alias("v"))
    vectors = {r.vec_id: r.v for r in quantised.collect() if r.v is not None}
    assert len(vectors) == 90
    clip = lambda x: min(max(x, -(2**63)), 2**63 - 1)
    want = set()
    for q in range(0, 90, 10):
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        want |= {(q, rank, i, clip(-s)) for rank, (s, i) in enumerate(scores[:5], 1)}
    # a query's scores are ranked per shard, so one shard tells the exact order beyond 64 bits
    got = topk.top_k(quantised, quantised.where("vec_id % 10 = 0 and vec_id < 90"), "vec_id", "v", 5).collect()
    assert {(r.query_id, r.vec_id, r.score) for r in got} == {(q, i, s) for q, _, i, s in want}


def test_a_block_of_queries_shares_the_index():
    """Exact for every query of a block, at a cost per query far below a visit of each segment by itself."""
    rng = np.random.default_rng(4)
    vectors = np.floor(rng.normal(scale=32, size=(6000, 64))).astype(np.int32)
    vectors[100:400] = vectors[0]  # ties
    ids = rng.permutation(6000)
    asked = np.arange(0, 6000, 20)
    before = time.process_time()
    found = topk.ShardIndex(ids, vectors).search(ids[asked], vectors[asked].astype(np.int64), 5)
    assert time.process_time() - before < 4  # 1.2 s; 7.3 when each query went through the segments alone
    for q, (best, scores) in zip(asked, found):
        whole = vectors.astype(np.int64) @ vectors[q].astype(np.int64)
        order = [i for i in np.lexsort((ids, -whole)) if i != q][:5]
        assert best.tolist() == ids[order].tolist() and scores.tolist() == whole[order].tolist()


@pytest.mark.parametrize("scale", [1, 3_000, 40_000_000, 3_000_000_000])
def test_index_sums_are_exact_at_any_scale(scale):
    rng = np.random.default_rng(5)
    vectors = rng.integers(-200, 200, size=(500, 6)) * scale
    vectors[7] = 0
    ids = np.arange(500)
    for q, (best, scores) in zip(range(10), topk.ShardIndex(ids, vectors).search(ids[:10], vectors[:10], 3)):
        whole = vectors.astype(object) @ vectors[q].astype(object)
        order = sorted((i for i in range(500) if i != q), key=lambda i: (-whole[i], i))[:3]
        told = [min(whole[i], 2**63 - 1) for i in order]
        assert scores.tolist() == told and best.tolist() == order


def test_topk_of_little(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [3, 4])], "vec_id long, v array<int>")
    assert [tuple(r) for r in topk.top_k(df, df, "vec_id", "v").orderBy("query_id").collect()] == [(0, 1, 1, 11), (1, 1, 0, 11)]
    assert topk.top_k(df.limit(0), df.limit(0), "vec_id", "v").count() == 0


# --- exact duplicates -------------------------------------------------------------


def test_exact_duplicates(spark):
    texts = ["Same", "same", "SAME", "É a", "é a", "É A", None, "", "x" * 200 + "1", "x" * 200 + "2", "X" * 200 + "1", "alone"]
    rows = [(i, t, "k", 1) for i, t in enumerate(texts)] + [(2, "SAME", "k", 1), (None, "same", "k", 1), (None, "only", "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n int")
    table = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

    def normal(t):
        return (t or "").translate(table)

    for slots in (1, 1 << 20):
        groups = exact_dedup.duplicate_groups(docs, "doc_id", "text", slots=slots)
        got = {r.text_sha256: (r.keep_id, r.group_size) for r in groups.collect()}
        want = {}
        for i, t, *_ in rows:
            want.setdefault(hashlib.sha256(normal(t).encode()).hexdigest(), []).append(i)
        assert got == {k: (max((i for i in v if i is not None), default=None), len(v)) for k, v in want.items() if len(v) > 1}
    for rows_per_task in (1, 1_000_000):
        flags = exact_dedup.flag_duplicates(docs, "doc_id", "text", rows_per_task).collect()
        assert len(flags) == len(rows)
        assert {(r.id, r.keep_id, r.kept) for r in flags if r.id in (0, 2, 3, 5, 6, 7, 11)} == {
            (0, 2, False), (2, 2, True), (3, 5, False), (5, 5, True), (6, 7, False), (7, 7, True), (11, 11, True)
        }
    left = exact_dedup.drop_duplicates(docs, "doc_id", "text")
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [2, 2, 4, 5, 7, 9, 10, 11]
    assert [r.text for r in left.where("doc_id is null").collect()] == ["only"]
    assert exact_dedup.flag_duplicates(docs.limit(0), "doc_id", "text").count() == 0


# --- near-duplicates ----------------------------------------------------------------


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def components_by_hand(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def altered(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    return " ".join(words)


def near_rows():
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = [(i, t) for i, t in enumerate([None, "", "  \t", "One", "one", "two words", "Two  Words", "two words more", "ONE two THREE four", "one two three four"])]
    rows += [(100 + i, altered(base, rng, rng.randrange(5))) for i in range(80)]
    drift = list(base)
    for i in range(30):  # a chain: neighbours are close, the ends are not
        drift[(i * 4) % 120] = f"d{i}"
        rows.append((200 + i, " ".join(drift)))
    # many texts with a frequent passage, similar but below the threshold
    rows += [(300 + i, " ".join(base[:90] + [f"t{i}_{k}" for k in range(14)])) for i in range(60)]
    rows += [(400 + i, " ".join(base[:90] + [f"t{i}_{k}" for k in range(13)] + ["z"])) for i in range(20)]
    return rows


@pytest.mark.parametrize("n, percent, widest", [(3, 85, 20_000), (3, 85, 3), (5, 80, 8)])
def test_near_duplicates_equal_brute_force(spark, n, percent, widest):
    rows = near_rows()
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, kept int")
    found = near_dedup.link_components(docs, words=n, percent=percent, widest=widest).collect()
    assert {r.id: (r.n_shingles, r.component) for r in found} == components_by_hand(rows, n, percent)
    assert all(r.kept == (r.id == r.component) for r in found) and len(found) == len(rows)


def test_near_duplicates_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op10_near_dedup(spark, SMALL).collect()}
    assert got == components_by_hand(rows, 3, 85)


def test_near_duplicate_edges(spark):
    text = "a b c d e f g"
    docs = spark.createDataFrame([(1, text), (1, text), (2, text.upper()), (None, text), (3, None)], "doc_id long, text string")
    got = sorted(tuple(r) for r in near_dedup.link_components(docs).collect() if r.id is not None)
    assert got == [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True)]
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 1, 3]
    assert near_dedup.link_components(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [np.unique(pool[:1000]), np.unique(pool[200:1200]), np.unique(pool[2000:2003]), np.unique(pool[2000:2003])]
    made = near_dedup.sketches(sets, 300)
    assert not (made == np.uint64(2**64 - 1)).any()
    assert abs((made[0] == made[1]).mean() - 800 / 1200) < 0.1 and (made[2] == made[3]).all()


# --- packing --------------------------------------------------------------------------


def padding(lengths, counts, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts))


def test_bounds_are_optimal():
    rng = random.Random(4)
    for _ in range(40):
        lengths = sorted(rng.sample(range(1, 60), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 50) for _ in lengths]
        for k in (1, 2, 3, 4):
            best = min(
                padding(lengths, counts, [*cut, lengths[-1]])
                for size in range(min(k, len(lengths)))
                for cut in itertools.combinations(lengths[:-1], size)
            )
            bounds = packing.optimal_bounds(lengths, counts, k)
            assert len(bounds) <= k and padding(lengths, counts, bounds) == best
    assert packing.optimal_bounds([], []) == []


def test_batches_keep_the_budget(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 3, 40, 41, 300, 5000]))), 9) for i in range(300)]
    rows += [(None, None, 9), (7, rows[7][1], 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket int")
    got = packing.pack(docs, token_budget=1000, buckets=3).collect()
    assert len(got) == len(rows)
    batches = {}
    for r in got:
        assert r.n_tokens <= r.bound
        batches.setdefault((r.bucket, r.bound, r.batch), []).append(r.slot)
    for (bucket, bound, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) <= max(1, 1000 // bound)
        if (bucket, bound, batch + 1) in batches:  # only the last one is not full
            assert len(slots) == max(1, 1000 // bound)
    assert packing.pack(docs.limit(0)).count() == 0


# --- wrappers -----------------------------------------------------------------------


def article_by_hand(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    lines = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def test_main_text_of_pages(spark):
    want = {r.page_id: article_by_hand(r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = queries.op4_wrappers(spark, SMALL).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def page(title, paragraphs, extra="", close="</div>"):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f"<html><head><title>{title}</title><style>p{{}}</style></head><body><div class='menu'><a href='/'>Home</a></div>"
        f"<div id='post-17' class='body'><h2>{title}</h2>{body}{extra}{close}"
        "<div class='comments'><p>Nice &amp; long reader comment, really quite long for a comment.</p></div>"
        "<form><p>Write to us</p></form><script>if (a < b) x('</p>')</script><div>All rights reserved.</div></body></html>"
    )


def test_regions_come_from_the_host(spark):
    pages = [
        (i, f"https://h.example.org/{i}", page(f"Title {i}", [f"First &lt;{i}&gt; of\n several   words {i}.", f"Second <b>bo</b>ld{i}"][: 1 + i % 2], "<aside>advert</aside>" if i % 3 else ""))
        for i in range(9)
    ]
    pages += [(20, None, None), (21, "nonsense", "just text"), (22, "https://one.example.org/", "<p>a<p>b &amp c"), (23, "", "")]
    df = spark.createDataFrame([(*p, "x") for p in pages + pages[:1]], "page_id long, url string, html string, text string")
    got = wrappers.extract_main_text(df, "page_id", "url", "html", {"page_id": F.col("page_id")}).collect()
    assert len(got) == len(pages) + 1
    text = {r.page_id: r.text for r in got}
    for i in range(9):
        assert text[i].split("\n") == [f"Title {i}", f"First <{i}> of several words {i}.", f"Second bold{i}"][: 2 + i % 2]
    assert [text[i] for i in (20, 21, 22, 23)] == ["", "just text", "a\nb & c", ""]
    found = wrappers.infer_wrappers(df, "url", "html").where("host = 'h.example.org'").first()
    assert found.region[-1] == "div.body.post-0"
    assert "#slot" in found.wrapper and ")?" in found.wrapper
    assert wrappers.extract_main_text(df.limit(0), "page_id", "url", "html", {"page_id": F.col("page_id")}).count() == 0


def test_every_page_of_a_host_shapes_its_wrapper(spark):
    """Sixty structures in one host, one page each, and a hundred pages of one more."""
    letters = [a + b for a in "abcdef" for b in "ghijklmnop"]
    pages = [
        (i, "https://many.example.org/", f"<body><div class='text'><p>Words {i} of the page.</p><div class='box{x}'>Box</div></div></body>")
        for i, x in enumerate(letters)
    ]
    pages += [(100 + i, "https://many.example.org/", f"<body><div class='text'><p>Word {i}.</p></div></body>") for i in range(100)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    for fan_in in (wrappers.FAN_IN, 4):
        found = wrappers.infer_wrappers(df, "url", "html", fan_in).collect()
        assert [r.region for r in found] == [["body", "div.text"]]
        assert all(f"<div.box{x}>" in found[0].wrapper for x in letters)
        again = wrappers.infer_wrappers(df.unionByName(df).repartition(2), "url", "html", fan_in).collect()
        assert again == found  # neither copies nor the deal of the rows matter


def test_wrappers_align_with_wrappers():
    def of(*pages):
        return wrappers.infer_wrapper(list(pages))

    a = of("<p>x</p><hr><i>one</i>", "<p>x</p><i>two</i>")
    b = of("<p>x</p><i>three</i><u>v</u>", "<p>x</p><i>four</i>")
    both = wrappers.align(a, wrappers.load(wrappers.dump(b)))
    assert " ".join(map(str, both)) == "<p> #text </p> (<hr>)? <i> #slot </i> (<u> #text </u>)?"


@pytest.mark.parametrize(
    "shape",
    [
        "<article><h1>T{0}</h1><div class='lead'><p>Lead {0}.</p></div><div class='body'><p>{1}</p></div></article>",
        "<article><header><h1>T{0}</h1></header><p>Lead {0}.</p><div class='body'><section><p>{1}</p></section></div></article>",
        "<main><div class='x'><article><h1>T{0}</h1><div><p>Lead {0}.</p></div><div class='body'><p>{1}</p></div></article></div></main>",
        "<div class='page'><div class='top'><h1>T{0}</h1></div><div class='lead'><p>Lead {0}.</p></div><div class='body'><p>{1}</p></div></div>",
    ],
)
def test_no_block_of_an_article_is_lost(shape):
    long = "A long text of many words that holds most of what the page says. "
    tail = "<section><p>Last words {0}.</p></section>"
    inner = re.sub(r"(</article>.*|</div>)$", lambda m: tail + m[0], shape)
    pages = [f"<html><body><nav>Menu</nav>{inner.format(i, (long + str(i) + ' ') * 9)}<footer>End</footer></body></html>" for i in range(4)]
    region = wrappers.region_of(wrappers.infer_wrapper(pages))
    for i, html_ in enumerate(pages):
        want = [f"T{i}", f"Lead {i}.", ((long + str(i) + " ") * 9).strip(), f"Last words {i}."]
        assert wrappers.main_text(html_, region).split("\n") == want


@pytest.mark.parametrize(
    "name",
    ["content has-sidebar", "layout-with-sidebar", "main-content no-comments", "social-post", "td-post-content share-enabled",
     "page nav-open", "page sidebar-content", "story"],
)
def test_class_names_about_the_page_do_not_hide_the_article(name):
    around = "<div class='site-nav'><p>Menu {0}</p></div>{1}<div class='post-comments'><p>Comment {0}.</p></div><div class='cookie-banner'>We use {0} cookies</div>"
    story = "<h1>T{0}</h1><p>" + "A long text of story {0}. " * 9 + "</p><p>End {0}.</p>"
    for form in ("<div class='{name}'>{story}</div>", "<div class='sidebar {name}'><article>{story}</article></div>"):
        inner = form.format(name=name, story=story)
        pages = [f"<html><body>{around.format(i, inner.format(i))}</body></html>" for i in range(5)]
        region = wrappers.region_of(wrappers.infer_wrapper(pages))
        for i, html_ in enumerate(pages):
            want = [f"T{i}", (f"A long text of story {i}. " * 9).strip(), f"End {i}."]
            assert wrappers.main_text(html_, region).split("\n") == want
            assert wrappers.main_text(html_, None).split("\n") == want


def test_matching_of_long_sequences(monkeypatch):
    monkeypatch.setattr(wrappers, "FULL_COMPARISON", 30)
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randrange(rng.choice([3, 60])) for _ in range(rng.randint(0, 60))]
        b = [x for x in a if rng.random() > 0.2]
        for _ in range(rng.randint(0, 5)):
            b.insert(rng.randint(0, len(b)), rng.randrange(60))
        at_a = at_b = 0
        for i, j, n in wrappers.matching(a, b):
            assert n > 0 and i >= at_a and j >= at_b and a[i : i + n] == b[j : j + n]
            at_a, at_b = i + n, j + n
    long = list(range(5000))
    assert sum(n for *_, n in wrappers.matching(long, long[:2000] + [-1] + long[2500:])) == 4500


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = row
        row = [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
    return row[-1]


@pytest.mark.parametrize("held", [1, 50, 1 << 26])
def test_long_sequences_are_compared_whole(monkeypatch, held):
    """Also without a key that occurs once, and where such a key has moved."""
    monkeypatch.setattr(wrappers, "FULL_COMPARISON", 30)
    monkeypatch.setattr(wrappers, "HELD_BITS", held)
    rng = random.Random(9)
    for _ in range(300):
        kinds = rng.choice([1, 2, 3, 20, 80])
        a, b = ([f"k{rng.randrange(kinds)}" for _ in range(rng.randint(6, 50))] for _ in range(2))
        found = wrappers.matching(a, b)
        assert all(a[i : i + n] == b[j : j + n] and n > 0 for i, j, n in found)
        assert all(i + n <= k and j + n <= m for (i, j, n), (k, m, _) in zip(found, found[1:]))
        if len(a) * len(b) > 2500 // 4:  # beyond the limit also without their equal ends
            assert sum(n for *_, n in found) == common_length(a, b)
    moved = ["p", "q"] * 40
    assert sum(n for *_, n in wrappers.matching(["x", *moved], [*moved, "x"])) == 80


def test_long_stories_without_unique_tags():
    """Stories of over 1,200 blocks that share no tag occurring once, repeat nothing, and differ at both ends; a
    short note differs from page to page too."""
    rng = random.Random(4)
    blocks = ["<p>{}</p>", "<h2>{}</h2>", "<pre>{}</pre>", "<blockquote>{}</blockquote>", "<p><b>{}</b></p>", "<p><i>{}</i></p>"]

    def story(k):
        kinds = [k]
        while len(kinds) < 1200 or kinds[-1] != k + 3:
            kinds.append(rng.randrange(len(blocks)))
            if any(kinds[-w:] == kinds[-2 * w : -w] for w in range(1, 5)):
                kinds.pop()
        return [(f"Line {i} of {k}", blocks[kind]) for i, kind in enumerate(kinds)]

    page = "<html><body><div class='info'><p>Issue {}</p></div><article>{}</article></body></html>"
    stories = [story(k) for k in range(3)]
    pages = [page.format(k, "".join(block.format(line) for line, block in lines)) for k, lines in enumerate(stories)]
    region = wrappers.region_of(wrappers.infer_wrapper(pages))
    assert region[-1] == "article"
    for html_, lines in zip(pages, stories):
        assert wrappers.main_text(html_, region) == "\n".join(line for line, _ in lines)


def test_long_and_malformed_pages():
    """Tens of thousands of elements, open or not, are read in one go."""
    rows = [f"<div class='row'><p>Line {{0}} of {i}</p></div>" if i % 3 else f"<ul><li>{i}</li></ul>" for i in range(12_000)]
    pages = [f"<html><body><article>{''.join(rows).format(k)}</article></body></html>" for k in range(2)]
    region = wrappers.region_of(wrappers.infer_wrapper(pages))
    assert region[-1] == "article"
    assert wrappers.main_text(pages[1], region).count("\n") == 11_999
    assert wrappers.main_text("<html><body>" + "<div>x " * 5000, None) == "\n".join("x" * 5000)
    assert wrappers.main_text("<b>" * 5000 + "y" + "</i>" * 5000, None) == "y"


def test_alignment_generalises():
    def shown(*pages):
        return " ".join(map(str, wrappers.infer_wrapper(list(pages))))

    assert shown("<ul><li>a</li><li>b</li></ul>") == "<ul> (<li> #slot </li>)+ </ul>"
    assert shown("<b>x</b><ul><li>a</li></ul>", "<b>x</b><ul><li>a</li><li>b</li><li>c</li></ul>") == "<b> #text </b> <ul> (<li> #slot </li>)+ </ul>"
    assert shown("<p>x</p>", "<hr><p>y</p>", "<p>z</p>") == "(<hr>)? <p> #slot </p>"


# --- the pipeline ---------------------------------------------------------------------


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame(
        [(10_000, None, "en", "s", 0), (10_001, "123", "en", "s", 3), (10_002, "the and of token=abcdefgh12 with words", "en", "s", 39)],
        docs.schema,
    )
    table = docs.unionByName(extra).withColumn("kept", F.lit(True))
    seen = {}
    for name, function in corpus_pipeline.STAGES:
        made = stage(function(spark, table, SMALL), "test-pipeline")
        if name != "packing":
            assert made.columns == table.columns
        seen[name], table = (table, made), made

    def ids(df):
        return {r.doc_id for r in df.select("doc_id").collect()}

    assert ids(seen["language"][0]) - ids(seen["language"][1]) == {10_000, 10_001}
    before, after = seen["exact_dedup"]
    best = {}
    for r in before.collect():
        key = r.text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
        best[key] = max(best.get(key, -1), r.doc_id)
    assert ids(after) == set(best.values())
    before, after = seen["near_dedup"]
    linked = components_by_hand([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert ids(after) == {i for i, (_, c) in linked.items() if i == c}
    before, after = seen["secrets"]
    masked = {r.doc_id: r for r in after.collect()}
    assert masked[10_002].text == "the and of [SECRET] with words" and masked[10_002].n_chars == 30
    assert ids(before) == set(masked) and not any("AKIA" in r.text for r in masked.values())
    assert ids(seen["packing"][1]) == ids(after)
