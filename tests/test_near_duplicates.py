"""Candidates against a plain Python reading of MinHash LSH, row by row."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom import NearDuplicateSettings, near_duplicate_pairs, with_near_duplicates
from claimloom.functions.minhash import lsh_bands
from claimloom.operators.near_duplicates import find_near_duplicates

PRIME, MASK = (1 << 61) - 1, (1 << 32) - 1


def polynomial(shingle):
    """Code points plus one as digits of a number, modulo a prime."""
    number = 0
    for letter in shingle:
        number = (number * 1_540_483_477 + ord(letter) + 1) % 4_294_967_291
    return number


def signature(value, settings):
    draw = np.random.RandomState(settings.seed)
    maps = [
        (int(draw.randint(1, PRIME, dtype=np.uint64)), int(draw.randint(0, PRIME, dtype=np.uint64)))
        for _ in range(settings.num_perm)
    ]
    n = settings.ngram
    shingles = {value[i : i + n] for i in range(max(1, len(value) - n + 1))}
    hashes = [polynomial(s) for s in shingles]
    return [min((((a * h + b) % (1 << 64)) % PRIME) & MASK for h in hashes) for a, b in maps]


def candidates(texts, settings):
    """{key: keys sharing a band}, by comparing every two signatures."""
    bands, rows = lsh_bands(settings.threshold, settings.num_perm)
    signatures = {}
    for value in {t or "" for _, t in texts}:
        s = signature(value, settings)
        signatures[value] = [tuple(s[i * rows : (i + 1) * rows]) for i in range(bands)]
    bands_of = {key: signatures[t or ""] for key, t in texts}
    return {
        key: sorted(other for other, b in bands_of.items() if any(x == y for x, y in zip(mine, b)))
        for key, mine in bands_of.items()
    }


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["casa", "ação", "governo", "vacina", "eleição", "notícia", "falso", "rede", "mil", "não"]
    out = []
    for i in range(25):
        base = " ".join(rng.choice(words) for _ in range(rng.randint(8, 30)))
        out.append(base)
        for _ in range(rng.randint(0, 3)):  # near copies: one word changed
            parts = base.split()
            parts[rng.randrange(len(parts))] = f"x{i}"
            out.append(" ".join(parts))
    out += [out[0]] * 6 + ["", None, "abc", "abc", "abcd", "한글 각 👍"]
    return list(enumerate(out))


@pytest.mark.parametrize(
    "settings",
    [
        NearDuplicateSettings(),
        NearDuplicateSettings(threshold=0.85, ngram=3, num_perm=64),
        NearDuplicateSettings(threshold=0.5, rows_per_task=1),
    ],
    ids=["default", "other-banding", "wide-and-salted"],
)
def test_texts_and_groups_hold_exactly_the_candidates(spark, texts, settings):
    df = spark.createDataFrame(texts, "id long, t string")
    want = candidates(texts, settings)
    got = with_near_duplicates(df, "id", "t", settings).collect()
    assert len(got) == len(texts)
    least, members = {}, {}
    for key, t in texts:
        least.setdefault(t or "", key)
    for row in got:
        assert row.text_id == least[row.t or ""]
        assert row.near_duplicate_groups == sorted(set(row.near_duplicate_groups))
        for group in (row.text_id, *row.near_duplicate_groups):
            members.setdefault(group, set()).add(row.id)
    for row in got:
        together = members[row.text_id].union(*[members[g] for g in row.near_duplicate_groups])
        assert sorted(together) == want[row.id]
        for group in row.near_duplicate_groups:  # a group is named by its least text
            assert int(group.split(":")[1]) == min(members[group])


@pytest.mark.parametrize("rows_per_task", [1_000_000, 20, 1])
def test_lists_hold_every_candidate(spark, texts, rows_per_task):
    """Each row's list is whole: copies, near copies and the row itself, however large the bucket."""
    settings = NearDuplicateSettings(rows_per_task=rows_per_task)
    base = " ".join(f"palavra{i} do texto comum" for i in range(60))
    more = [base if i < 40 else f"{base} {i}" for i in range(80)]
    rows = texts + list(enumerate(more, len(texts)))
    df = spark.createDataFrame(rows, "id long, t string").repartition(3)
    got = find_near_duplicates(df, "id", "t", settings, lists=True).collect()
    assert len(got) == len(rows)
    assert {r.id: r.near_duplicates for r in got} == candidates(rows, settings)
    assert max(len(r.near_duplicates) for r in got) >= 79


def test_lists_with_repeated_and_null_keys(spark):
    rows = [(1, "um texto"), (1, "um texto"), (1, "outra coisa"), (2, "um texto"), (None, "outra coisa"), (None, "nada"), (3, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    got = find_near_duplicates(df, "id", "t", lists=True).collect()
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    assert sorted([(r.id, r.near_duplicates) for r in got], key=key) == [
        (None, []), (None, [1]), (1, [1]), (1, [1, 2]), (1, [1, 2]), (2, [1, 2]), (3, [3])
    ]


def test_query_of_lists_names_the_candidates(spark):
    import __spark_entry__ as contract

    folder = "/root/testdata/sf0.001"
    got = contract.queries()["near_dup_lists"](spark, folder).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = candidates(texts, NearDuplicateSettings())
    assert {r.doc_id: r.near_duplicates for r in got} == {k: " ".join(map(str, v)) for k, v in want.items()}
    assert any(len(v) > 1 for v in want.values())


def told_pairs(rows):
    """The pairs of texts that star edges (least text, other text, band) stand for."""
    stars = {}
    for r in rows:
        stars.setdefault((r.id_a, r.band), {r.id_a}).add(r.id_b)
    return {(a, b) for ids in stars.values() for a in ids for b in ids if a < b}


def test_pairs_are_the_candidates_of_distinct_texts(spark, texts):
    settings = NearDuplicateSettings()
    first = {}
    for key, t in texts:
        first.setdefault(t or "", key)
    distinct = [(key, t) for t, key in first.items()]
    want = {(a, b) for a, others in candidates(distinct, settings).items() for b in others if a < b}
    df = spark.createDataFrame(texts, "id long, t string")
    got = near_duplicate_pairs(df, "id", "t", settings).collect()
    assert len(got) == len({tuple(r) for r in got}) and told_pairs(got) == want


def test_hundreds_of_copies_and_near_copies(spark):
    """The form of the answer is the same for any number of rows, and linear in them."""
    base = " ".join(f"palavra{i} do texto comum" for i in range(60))
    texts = [(i, base if i < 300 else f"{base} {i}") for i in range(600)] + [(600, "outra coisa"), (601, None)]
    df = spark.createDataFrame(texts, "id long, t string")
    settings = NearDuplicateSettings(rows_per_task=50)
    got = {r.id: r for r in with_near_duplicates(df, "id", "t", settings).collect()}
    want = candidates(texts, settings)
    assert {i for i, r in got.items() if r.text_id == 0} == set(range(300))
    assert len({tuple(got[i].near_duplicate_groups) for i in range(300)}) == 1
    groups = {i: set(r.near_duplicate_groups) for i, r in got.items()}
    for i in (0, 299, 300, 599, 600, 601):
        like = [j for j in got if got[j].text_id == got[i].text_id or groups[i] & groups[j]]
        assert sorted(like) == want[i]
    assert got[600].near_duplicate_groups == got[601].near_duplicate_groups == []
    edges = near_duplicate_pairs(df, "id", "t", settings)
    assert 0 < edges.count() <= 14 * 301


def test_a_third_of_the_rows_is_one_text(spark):
    settings = NearDuplicateSettings(rows_per_task=20)
    df = spark.range(300).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("o mesmo texto de sempre")).otherwise(
            F.sha2(F.col("id").cast("string"), 256)).alias("t"),
    )
    got = with_near_duplicates(df, "id", "t", settings).collect()
    assert len(got) == 300
    assert all(r.text_id == (r.id if r.id % 3 else 0) and r.near_duplicate_groups == [] for r in got)


def test_true_near_copies_are_found(spark):
    """Of pairs with Jaccard similarity 0.9 a band catches 1 - (1 - 0.9^9)^14 = 99.9 %."""
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    first = {}
    for r in documents.orderBy("doc_id").collect():
        first.setdefault(r.text, r.doc_id)
    rows = [(key, {t[i : i + 5] for i in range(max(1, len(t) - 4))}) for t, key in first.items()]
    close = {
        (a, b)
        for i, (a, x) in enumerate(rows)
        for b, y in rows[i + 1 :]
        if 0.9 <= len(x & y) / len(x | y)
    }
    found = told_pairs(near_duplicate_pairs(documents, "doc_id", "text").collect())
    assert close and len(close & found) >= 0.95 * len(close)


def shingles(value, n=5):
    return frozenset(value[i : i + n] for i in range(max(1, len(value) - n + 1)))


def jaccard(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


@pytest.mark.parametrize("tile_texts, rows_per_task", [(32, 1_000_000), (3, 20)], ids=["one-tile", "small-tiles-and-salted"])
def test_verified_pairs_are_the_candidates_above_the_threshold(spark, texts, monkeypatch, tile_texts, rows_per_task):
    from claimloom.operators import similarity

    monkeypatch.setattr(similarity, "TILE_TEXTS", tile_texts)
    settings = NearDuplicateSettings(threshold=0.6, rows_per_task=rows_per_task)
    rng = random.Random(3)
    base = " ".join(f"palavra{i}" for i in range(40))
    more = [f"{base} {rng.randrange(10**9)} {'x' * rng.randrange(80)}" for _ in range(60)]  # one large group of several sizes
    rows = [(f"k{key:03}", t) for key, t in texts + list(enumerate(more, len(texts)))]
    first = {}
    for key, t in rows:
        first.setdefault(t or "", key)
    distinct = [(key, t) for t, key in first.items()]
    text_of = dict(distinct)
    want = {
        (a, b): jaccard(text_of[a], text_of[b])
        for a, others in candidates(distinct, settings).items()
        for b in others
        if a < b and jaccard(text_of[a], text_of[b]) >= settings.threshold
    }
    df = spark.createDataFrame(rows, "id string, t string")
    got = near_duplicate_pairs(df, "id", "t", settings, verify=True).collect()
    assert len(want) > 1500 and len(got) == len(want)
    assert {(r.id_a, r.id_b): r.jaccard for r in got} == want


def test_recall_of_verified_pairs(spark):
    """Against all pairs of the given documents: nothing false, at least nine tenths found."""
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    first = {}
    for r in documents.orderBy("doc_id").collect():
        first.setdefault(r.text or "", r.doc_id)
    sets = [(key, shingles(t)) for t, key in first.items()]
    close = {(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1 :] if len(x & y) >= 0.7 * len(x | y)}
    got = {(r.id_a, r.id_b) for r in near_duplicate_pairs(documents, "doc_id", "text", verify=True).collect()}
    assert close and got <= close and len(got) >= 0.9 * len(close)


def test_verified_pairs_of_nothing(spark):
    none = spark.createDataFrame([], "id long, t string")
    assert near_duplicate_pairs(none, "id", "t", verify=True).collect() == []
    alone = spark.createDataFrame([(1, "um texto"), (2, None), (3, ""), (4, "um texto")], "id long, t string")
    assert near_duplicate_pairs(alone, "id", "t", verify=True).collect() == []  # copies are one text


def test_intersections_by_hand(monkeypatch):
    from claimloom.operators import similarity

    monkeypatch.setattr(similarity, "COLUMNS", 7)
    rng = random.Random(4)
    sets = [np.array(sorted({rng.randrange(90) for _ in range(rng.randint(1, 60))}), np.uint64) for _ in range(20)]
    got = similarity.common_counts(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            shared = len(set(a.tolist()) & set(b.tolist()))
            assert got[i, j] == shared or (i == j and got[i, j] <= shared)  # alone in a set: not counted


def test_shingle_hashes_by_hand():
    from claimloom.functions.shingles import code_points, rolling_hash, shingle_names

    rng = random.Random(6)
    for n in (1, 5, 1500):
        value = "".join(rng.choice("aé한👍 ") for _ in range(1600))
        got = rolling_hash(code_points(value), n).tolist()
        assert got == [polynomial(value[i : i + n]) for i in range(1600 - n + 1)]
    assert len(shingle_names("abcabcabc", 5)) == len(shingles("abcabcabc"))
    assert len(shingle_names("abc", 5)) == len(shingle_names("", 5)) == 1


def test_long_texts_are_hashed_whole(spark, monkeypatch):
    """Texts cut into pieces of 50 letters give the digests of the whole text."""
    from claimloom.functions import minhash

    rng = random.Random(7)
    values = ["".join(rng.choice("abcdeção 한👍") for _ in range(n)) for n in (0, 3, 5, 49, 50, 51, 54, 55, 333, 1000)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, t string")

    def digests():
        rows = df.select("id", minhash.band_digests(F.col("t"), 5, 128, 3, 14, 9).alias("d")).orderBy("id")
        return [r.d for r in rows.collect()]

    whole = digests()
    monkeypatch.setattr(minhash, "CHUNK_CHARS", 50)
    monkeypatch.setattr(minhash, "GATHERED", 16)
    assert digests() == whole
    settings = NearDuplicateSettings()
    for value, found in zip(values, whole):
        data = np.array(signature(value, settings), dtype="<u4").tobytes()
        assert found == [
            hashlib.blake2b(data[i * 36 : (i + 1) * 36], digest_size=16, salt=i.to_bytes(4, "little")).digest()
            for i in range(14)
        ]


def test_batches_are_read_in_pieces(spark, monkeypatch):
    """However many rows a batch has, a few at a time are strings; the digests are those of the whole batch."""
    from claimloom.functions import minhash

    values = [f"texto {i % 90} de {i}" for i in range(500)]
    whole = spark.createDataFrame(list(enumerate(values)), "id long, t string").coalesce(1)
    want = [r.d for r in whole.select("id", minhash.band_digests(F.col("t"), 5, 128, 3, 14, 9).alias("d")).orderBy("id").collect()]
    made, taken = [], []

    class Batch:
        def __init__(self, rows):
            self.rows = rows

        def __len__(self):
            return len(self.rows)

        def slice(self, start, length):
            return Batch(self.rows[start : start + length])

        def to_pylist(self):
            taken.append(len(self.rows))
            return self.rows

    monkeypatch.setattr(minhash, "PIECE_ROWS", 40)
    monkeypatch.setattr(F, "arrow_udf", lambda function, kind: made.append(function) or (lambda column: column))
    minhash.band_digests(F.col("t"), 5, 128, 3, 14, 9)
    found = [d for part in made[0](iter([Batch(values[:260]), Batch([]), Batch(values[260:])])) for d in part.to_pylist()]
    assert found == want and max(taken) <= 40 and sum(taken) == 500
