"""Merkle manifest, periodic runs and URL rules against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimloom.llm import merkle, periodic, queries, url_rules

FOLDER = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- Merkle manifest ---------------------------------------------------------------


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(digests):
    """All levels of a tree, leaves first."""
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, i):
    """[(sibling or None, whether it stands left)] from leaf ``i`` to the root."""
    steps = []
    for level in tree[:-1]:
        steps.append((level[i ^ 1] if i ^ 1 < len(level) else None, i % 2 == 1))
        i //= 2
    return steps


def by_hand(rows, names):
    """{(key, leaf): {(subroot, root, way)}} for rows (key, group, ...)."""
    groups = {}
    for row in rows:
        leaf = sha("".join(field(row[n]) for n in names))
        groups.setdefault(row["g"], []).append((row["k"] is not None, row["k"] or 0, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf for *_, leaf in sorted(groups[g])]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for n, g in enumerate(order):
        for i, (known, key, leaf) in enumerate(sorted(groups[g])):
            steps = tuple(way(trees[g], i) + way(top, n))
            out.append((key if known else None, leaf, trees[g][-1][0], top[-1][0], steps))
    return sorted(out, key=repr)


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest_by_hand(spark, height):
    rng = random.Random(height)
    rows = [
        {"k": rng.choice([None, *range(40)]), "g": g, "t": rng.choice([None, "", "é", "a:b", "x" * 5000])}
        for g, n in ((None, 3), ("", 1), ("en", 65), ("en2", 64), ("日本", 7), ("a", 2), ("b", 33))
        for _ in range(n)
    ]
    rows += rows[:5]  # repeated rows keep a place each
    frame = spark.createDataFrame([(r["k"], r["g"], r["t"], 1) for r in rows], "k long, g string, t string, rank int")
    found = merkle.manifest(frame, ["k", "t", "g"], "g", "k", {"k": F.col("k")}, height)
    found = found.withColumn("folded", merkle.fold(F.col("leaf"), F.col("siblings")))
    got = []
    for r in found.collect():
        steps = tuple((s.digest.hex() if s.digest else None, s.left) for s in r.siblings)
        got.append((r.k, r.leaf, r.subroot, r.root, steps))
        assert r.folded == r.root
    assert sorted(got, key=repr) == by_hand(rows, ["k", "t", "g"])


def test_no_rows_and_one_row(spark):
    frame = spark.createDataFrame([(1, "en", "x")], "k long, g string, t string")
    one = merkle.manifest(frame, ["k"], "g", "k", {"k": F.col("k")}).first()
    assert one.leaf == one.subroot == one.root == sha("1:1") and one.siblings == []
    assert merkle.manifest(frame.limit(0), ["k"], "g", "k", {"k": F.col("k")}).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 21])
def test_the_log_lies_in_postorder(spark, n):
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    leaves = spark.createDataFrame([("t", i, bytearray(d)) for i, d in enumerate(digests)], "tree string, rank long, digest binary")
    tiers = merkle.build_log(leaves, height=2)
    got = merkle.log_nodes(tiers, height=2).orderBy("position").collect()
    tree, want = levels([d.hex() for d in digests]), []

    def walk(level, i):
        if level:
            for child in (2 * i, 2 * i + 1):
                if child < len(tree[level - 1]):
                    walk(level - 1, child)
        want.append((level, tree[level][i]))

    walk(len(tree) - 1, 0)
    assert [r.position for r in got] == list(range(len(want)))
    assert [(r.level, r.digest.hex()) for r in got] == want
    assert merkle.tree_roots(tiers).first().root.hex() == tree[-1][0]


def test_tampered_rows_are_found(spark):
    got = queries.op11_merkle(spark, FOLDER).collect()
    chars = {r.doc_id: r.n_chars for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(got) == len(chars) and len({r.root for r in got}) == 1
    for r in got:
        tampered = zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and chars[r.doc_id] is not None
        assert r.verified == (not tampered)


# --- periodic runs -----------------------------------------------------------------


def runs_by_hand(words):
    """Every stretch of equal words q apart, for all q; the smallest period names it."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(6, 4 * q):
                found.setdefault((start, length), q)
            i += i == start
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def made_of_repeats(rng, symbols, parts):
    words = []
    for _ in range(rng.randint(0, parts)):
        root = [rng.choice(symbols) for _ in range(rng.randint(1, 6))]
        words += [root[i % len(root)] for i in range(rng.randint(1, 30))]
    return words


def test_lyndon_lengths_by_hand():
    rng = random.Random(1)
    for _ in range(1500):
        word = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 24))]
        want = [next((j for j in range(i + 1, len(word)) if word[j:] < word[i:]), len(word)) - i for i in range(len(word))]
        assert periodic.lyndon_lengths(word) == want


def test_runs_by_hand():
    rng = random.Random(2)
    documents = [made_of_repeats(rng, "ab" if i % 2 else "abcde", 6) for i in range(800)]
    got = periodic.runs_of(documents)
    assert sum(map(len, got)) > 500
    for words, runs in zip(documents, got):
        assert runs == runs_by_hand(words)
        assert periodic.runs_of([words]) == [runs]
    assert periodic.runs_of([]) == []


def test_nested_and_long_runs():
    inner = ["a"] * 8 + ["b"]
    assert periodic.runs_of([inner * 6])[0] == runs_by_hand(inner * 6)
    (unary,) = periodic.runs_of([["x"] * 100_000])
    assert unary == [(0, 100_000, 1)]
    (long,) = periodic.runs_of([[str(i % 20_000) for i in range(90_000)]])
    assert long == [(0, 90_000, 20_000)]


def test_find_runs_edges(spark):
    texts = [
        None, "", " \t\n\x0b\x0c\r ", "one", "a a a a a", "a a a a a a", "a\u00a0a " * 6, "x y " * 4 + "z", "x y " * 3,
        "b " + "k l m " * 5 + "k c", "word " * 70_000,
    ]
    docs = spark.createDataFrame([(i, t, "r") for i, t in enumerate(texts + texts[:1])], "doc_id long, text string, runs string")
    got = {r.doc_id: r for r in periodic.find_runs(docs, "text", {"doc_id": F.col("doc_id"), "own": F.col("runs")}).collect()}
    assert len(got) == docs.count()
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        want = runs_by_hand(words) if len(words) < 1000 else [(0, 70_000, 1)]
        drop = {i for a, n, q in want for i in range(a + q, a + n)}
        assert [tuple(r) for r in got[i].runs] == want and got[i].n_words == len(words) and got[i].own == "r"
        assert got[i].collapsed == " ".join(w for i, w in enumerate(words) if i not in drop)
    assert periodic.find_runs(docs.limit(0), "text", {}).count() == 0


def test_run_columns_by_hand(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in queries.op12_runs(spark, FOLDER).collect()}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if n > 500:  # the check by hand is quadratic
            continue
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_by_hand(words)
        drop = {i for a, n, q in runs for i in range(a + q, a + n)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        left = " ".join(w for i, w in enumerate(words) if i not in drop)
        assert got[doc_id] == (doc_id, len(runs), *told, sha(lines), sha(left))


# --- URL rules ---------------------------------------------------------------------


def as_regex(glob):
    parts = re.split(r"(\*\*|\*)", glob)
    return re.compile("".join({"**": "[\\s\\S]*", "*": "[^/]*"}.get(p, re.escape(p)) for p in parts).encode())


@pytest.mark.parametrize("few", [0, 10**9], ids=["as arrays", "as integers"])
def test_globs_are_regular_expressions(monkeypatch, few):
    monkeypatch.setattr(url_rules, "FEW_ROWS", few)
    monkeypatch.setattr(url_rules, "CELLS", 400)
    rng = random.Random(3)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randint(0, n)))
    globs = ["", "*", "**", "é*", *("".join(rng.choice(["a", "b", "/", ".", "*", "**"]) for _ in range(rng.randint(1, 7))) for _ in range(100))]
    texts = ["", "é/", "/" * 50, *(pick("ab/.", 30) for _ in range(200)), "a" * 70, "a" * 70 + "/"]
    automaton = url_rules.GlobAutomaton(globs)
    seen = set()
    for rows, fits in automaton.accepts(pa.array([t.encode() for t in texts], pa.binary())):
        for row, own in zip(rows, fits):
            seen.add(row)
            assert [bool(f) for f in own] == [as_regex(g).fullmatch(texts[row].encode()) is not None for g in globs]
    assert seen == set(range(len(texts)))


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.net/en/1", "https://a.b.example.net/EN/", "x://net/", "x://.net/",
    "http://mynet/a", "http://a.net", "http://a.net?x=/", "http://a.net/en/#y", "http://a.org/fr", "http://a.org/fr/",
    "http://www.example.com/de/x?y", "http://example.com/de", "http://İ.NET/", "a://b://c.net/", "http://a.com/x.net/en/",
    "http://u@example.net:80/en/", "http://example.net/en/" + "x" * 100_000, "http://" + "h" * 100_000 + ".net/",
    "http://a.net/\nb",
]


def test_rules_by_hand(spark):
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(URLS + URLS[:2])], "page_id long, url string, rule string")
    keep = {"page_id": F.col("page_id"), "own": F.col("rule")}
    got = {r.page_id: r for r in url_rules.judge_urls(pages, "url", queries.URL_RULES, keep).collect()}
    assert len(got) == pages.count()
    for i, url in enumerate(URLS):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(str.maketrans(url_rules.UPPER, url_rules.LOWER))
        fits = [
            rule for rule in queries.URL_RULES
            for h, p in [rule.name.split("/", 1)]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)
        ]
        best = max(fits, key=lambda rule: len(rule.name), default=None)
        want = (host, path, best and best.name, best.verdict if best else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want and got[i].own == "r"
    assert url_rules.judge_urls(pages.limit(0), "url", queries.URL_RULES, keep).count() == 0


def test_many_rules_span_many_words(spark):
    """Hundreds of rules; of equally long ones the first listed wins."""
    rules = [url_rules.Rule(f"host{i:03}.org/", "block") for i in range(300)]
    rules += [url_rules.Rule("*.org/x", "allow"), url_rules.Rule("**.org/y", "block")]
    pages = spark.range(600).select("id", F.format_string("http://a.host%03d.org/x", F.col("id")).alias("url"))
    got = url_rules.judge_urls(pages, "url", rules, {"id": F.col("id")}, otherwise="block").collect()
    for r in got:
        want = f"host{r.id:03}.org/" if r.id < 300 else "*.org/x"
        assert (r.rule, r.verdict) == (want, "block" if r.id < 300 else "allow")
    assert url_rules.RuleSet([], "allow").judge(pa.array([b"a/"])).to_pylist() == [{"rule": None, "verdict": "allow"}]
