import datetime
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from claimloom import (
    Corpus,
    assign_uids,
    clean_corpus,
    enrich_with_reviews,
    ensure_schema,
    flag_corpus,
    merge_corpora,
    preview,
    read_corpora,
    read_responses,
    run,
    run_to,
    unify_urls,
    with_row_ids,
)
from claimloom.operators import audit
from claimloom.operators.duplicates import flag_duplicates, keep_first_copies
from claimloom.operators.merge import describe_datasets, unnumbered_corpora
from claimloom.operators.near_duplicates import NearDuplicateSettings
from claimloom.operators.skew import hot_keys, salted_left_join
from claimloom.plans.corpus import surviving_texts
from claimloom.sources import scan, sinks

CANONICAL = [
    "orig_id", "text", "label", "url_claim", "url_review", "date_iso", "dataset_name", "source_type",
    "source_description",
]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_ensure_schema_maps_raw_columns(spark):
    raw = spark.createDataFrame(
        [("k9", "chuva de peixes", "Parcialmente Falso", "3/2/2019", None, "check.example.net/9", 5),
         ("k3", "eclipse total", None, "Feb 29, 2020", "www.ceu.example.org", None, 6),
         ("k5", "sem data", "outra coisa", "29/02/2021", "x", None, 7)],
        "ID string, noticia string, rotulo string, date string, link string, url_review string, ignored int",
    )
    out = ensure_schema(raw, "ceu", "web", None)
    assert out.columns == CANONICAL
    assert rows(out, "orig_id", "text", "label", "date_iso", "url_review", "source_type", "source_description") == [
        ("k3", "eclipse total", None, "2020-02-29", None, "web", "Dataset ceu"),
        ("k5", "sem data", "outra coisa", None, None, "web", "Dataset ceu"),
        ("k9", "chuva de peixes", "mixed", "2019-02-03", "check.example.net/9", "web", "Dataset ceu"),
    ]


def test_ensure_schema_types_and_priorities(spark):
    raw = spark.createDataFrame(
        [(7, "t", 1, datetime.datetime(2020, 5, 6, 23, 0), "c")],
        "ID int, message string, target int, created_at timestamp, claim string",
    )
    out = ensure_schema(raw, "d")
    assert rows(out, "orig_id", "text", "label", "date_iso", "source_type", "source_description") == [
        ("7", "c", "fake", "2020-05-06", "news", "Dataset d")
    ]


def test_ensure_schema_matches_names_exactly(spark):
    raw = spark.createDataFrame([("a", "b", "fake")], "`Text` string, `texto` string, `Rótulo` string")
    assert rows(ensure_schema(raw, "d"), "text", "label") == [("b", "fake")]


def test_text_falls_back_to_title_and_body(spark):
    data = [(None, "T", "B"), (None, None, "B"), (None, "T", None), (None, None, None)]
    raw = spark.createDataFrame(data, "text string, headline string, body string")
    assert [r.text for r in ensure_schema(raw, "d").collect()] == ["T. B", "B", "T. ", ""]
    only_title = spark.createDataFrame([("T",)], "titulo string")
    assert rows(ensure_schema(only_title, "d"), "text") == [("T",)]
    nothing = ensure_schema(spark.createDataFrame([(1,)], "x int"), "d")
    assert nothing.columns == CANONICAL and nothing.count() == 0


def test_claim_url_from_text_only_without_url_column(spark):
    raw = spark.createDataFrame([("ver www.site.com/x", )], "text string")
    assert rows(ensure_schema(raw, "d"), "url_claim") == [("http://www.site.com/x",)]
    raw = spark.createDataFrame([("ver www.site.com/x", "src0")], "text string, source string")
    assert rows(ensure_schema(raw, "d"), "url_claim") == [("src0",)]


def test_uids_run_on_over_frames(spark):
    sizes = [3, 0, 5, 0, 1]
    frames = [spark.range(n).select((-F.col("id")).alias("k"), F.lit(f"f{i}").alias("f")) for i, n in enumerate(sizes)]
    numbered = assign_uids(frames, order_by=["k"])
    at = 0
    for size, frame in zip(sizes, numbered):
        assert [r.uid for r in frame.orderBy("k").collect()] == list(range(at + 1, at + size + 1))
        at += size
    assert assign_uids([]) == []
    with pytest.raises(ValueError):
        assign_uids(frames[:1])


def test_uids_of_filtered_and_multiplied_frames(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(0, 200, 1, 3).write.parquet(path)
    whole = scan.read_parquet(spark, path)
    twice = whole.join(spark.createDataFrame([(0,), (1,)], "n int"), F.col("id") % 2 >= F.col("n"))
    for frames in ([whole.where("id % 7 < 3")], [whole, whole.where("id > 150")], [twice]):
        got = [r.uid for frame in assign_uids(frames) for r in frame.collect()]
        assert sorted(got) == list(range(1, len(got) + 1))


def test_uids_by_key_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5003).alias("k"))
    got = assign_uids([df], order_by=["k"])[0].orderBy("k").collect()
    assert [r.uid for r in got] == list(range(1, 5001))


def test_row_ids_follow_the_files(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(0, 1000, 1, 5).select((999 - F.col("id")).alias("v")).write.parquet(path)
    got = with_row_ids(scan.read_parquet(spark, path)).orderBy("rid").collect()
    assert [r.rid for r in got] == list(range(1000))
    assert [r.v for r in got] == [r.v for r in spark.read.parquet(path).orderBy(
        "_metadata.file_path", "_metadata.row_index").collect()]


def test_split_csv_is_numbered_in_file_order(spark, tmp_path):
    zone = tmp_path / "raw"
    zone.mkdir()
    for name, first in (("p", 0), ("q", 4000)):
        lines = [f"{i},texto numero {i}\n" for i in range(first, first + 3000)]
        (zone / f"{name}.csv").write_text("id,text\n" + "".join(lines))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        corpora = read_corpora(spark, str(zone), multi_line=False)
        assert corpora[0].frame.rdd.getNumPartitions() > 3
        want = [*range(3000), *range(4000, 7000)]
        got = merge_corpora(corpora).orderBy("uid").collect()
        assert [(r.uid, int(r.orig_id)) for r in got] == list(enumerate(want, 1))
        # a filtered frame, next to one whose files are not split
        mixed = [Corpus("p", corpora[0].frame.where("id % 3 = 0")), read_corpora(spark, str(zone))[1]]
        got = merge_corpora(mixed).orderBy("uid").collect()
        assert [(r.uid, int(r.orig_id)) for r in got] == list(enumerate([*range(0, 3000, 3), *range(4000, 7000)], 1))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.fixture()
def small_splits(spark):
    """Files are cut every 250 bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size="250": [spark.conf.set(k, v) for k, v in zip(before, (size, "1"))]
    for key, value in before.items():
        spark.conf.set(key, value)


def _csv_text(rng, end):
    """Rows of every kind of cell: quotes, line breaks and separators inside quotes, stray quotes outside."""
    def cell():
        body = "".join(rng.choice(["a", "é", '"', "\n", ",", "\r\n", " ", "xyz", '""', "\n\n"]) for _ in range(rng.randint(0, 12)))
        quoted = '"' + body.replace('"', '""') + '"'
        return rng.choice([quoted] * 4 + ['in "quotes" 5"', '"closed"x"y', "", "plain", " lead", "NA", "x" * 300])

    text = "id,text,label" + end
    for i in range(120):
        text += f"{i},{cell()},{cell()}{end}" + rng.choice(["", "", "", "", end, f"short{end}"])
    return text + 'last,"no line\nbreak at the end",x'


@pytest.mark.parametrize("end", ["\n", "\r\n"], ids=["lf", "crlf"])
def test_split_csv_with_line_breaks_in_texts(spark, tmp_path, small_splits, end):
    """Many tasks give the rows, order and uids of the whole-file reader."""
    zone = tmp_path / "raw"
    zone.mkdir()
    for seed, name in enumerate("pq"):
        (zone / f"{name}.csv").write_bytes(_csv_text(random.Random(seed), end).encode())

    def read():
        corpora = read_corpora(spark, str(zone))
        merged = merge_corpora(corpora).orderBy("uid")
        return corpora, [(r.uid, r.dataset_name, r.orig_id, r.text, r.label) for r in merged.collect()]

    corpora, whole = read()
    assert "block" not in corpora[0].frame.schema["_position"].dataType.names
    small_splits()
    corpora, split = read()
    assert corpora[0].frame.select("_position.block").distinct().count() > 20
    assert len(whole) > 100 and split == whole
    assert any("\n" in text for *_, text, _ in split)


def test_a_text_longer_than_many_splits(spark, tmp_path, small_splits):
    long = "linha com \"\" aspas\n" * 200
    path = tmp_path / "x.csv"
    path.write_text(f'a,b\n1,"{long}"\n\n2,"fim"\n')
    small_splits()
    got = scan.read_csv(spark, str(path)).orderBy("_position").collect()
    assert [(r.a, r.b) for r in got] == [("1", long.replace('""', '"')), ("2", "fim")]
    path.write_text("a,b\n")
    small_splits("3")
    assert scan.read_csv(spark, str(path)).count() == 0


@pytest.fixture()
def raw_zone(spark, tmp_path):
    zone = tmp_path / "raw"
    (zone / "deep").mkdir(parents=True)
    (zone / ".hidden.csv").write_text("text\nno\n")
    (zone / "manifest.json").write_text("{}")
    (zone / "notes.txt").write_text("no")
    (zone / "A.b_1.csv").write_text(
        'id,text,label,url,data\n1,"linha um\nlinha ""dois"" três",falso,0,2024-01-10\n'
        "2,N/A,fake,exemplo.com/a,x\n3,quatro palavras mais uma,nan,http://e.com,10/01/2024\n"
    )
    (zone / "deep" / "FakeTweetBr.CSV").write_text(
        "text,label,url\num dois três,verdadeiro,https://twitter.com/a/status/55\n"
    )
    spark.createDataFrame(
        [("Um dois  TRÊS quatro", "real"), ("um dois tres quatro", "fake"), ("curto", "true")],
        "noticia string, rotulo string",
    ).coalesce(1).write.parquet(str(zone / "deep" / "C.parquet"))
    return str(zone)


def test_raw_zone_listing(spark, raw_zone):
    paths = scan.list_raw_files(spark, raw_zone)
    assert sorted(map(scan.dataset_name, paths)) == ["A.b_1", "C", "FakeTweetBr"]


def test_unreadable_dataset_is_left_out(spark, raw_zone):
    with open(f"{raw_zone}/broken.parquet", "w") as f:
        f.write("not parquet")
    open(f"{raw_zone}/void.csv", "w").close()
    with pytest.raises(Exception, match="(?i)parquet"):
        read_corpora(spark, raw_zone)
    with pytest.warns(UserWarning, match="broken.parquet"):
        corpora = read_corpora(spark, raw_zone, skip_unreadable=True)
    assert sorted(c.name for c in corpora) == ["A.b_1", "C", "FakeTweetBr"]  # an empty file is no dataset
    assert merge_corpora(corpora).count() == 6


def test_merge_reads_numbers_and_drops_null_texts(spark, raw_zone):
    corpora = read_corpora(spark, raw_zone, {"C": ("web", "Corpus C")})
    merged = merge_corpora(corpora)
    assert merged.columns[:8] == [
        "dataset_name", "source_type", "source_description", "label", "date_iso", "tweet_id", "url_claim", "text",
    ]
    got = rows(merged.orderBy("uid"), "uid", "dataset_name", "orig_id", "label", "url_claim", "date_iso", "tweet_id")
    assert got == [
        (1, "A.b_1", "1", "fake", None, "2024-01-10", None),
        (3, "A.b_1", "3", None, "http://e.com", "2024-01-10", None),  # uid 2 had no text
        (4, "C", None, "true", None, None, None),
        (5, "C", None, "fake", None, None, None),
        (6, "C", None, "true", None, None, None),
        (7, "FakeTweetBr", None, "true", "https://twitter.com/a/status/55", None, "55"),
    ]
    assert merged.where("uid = 1").first().text == 'linha um\nlinha "dois" três'
    assert rows(merged.where("dataset_name = 'C'"), "source_type", "source_description")[0] == ("web", "Corpus C")


def test_csv_na_literals_become_null(spark, tmp_path):
    path = tmp_path / "x.csv"
    values = ["NA", "null", "None", "nan", "#N/A", "<NA>", "", "Nan", "NONE", "0"]
    path.write_text("a,b\n" + "".join(f"{v},x\n" for v in values))
    assert [r.a for r in scan.read_csv(spark, str(path)).collect()] == [None] * 7 + ["Nan", "NONE", "0"]


def test_clean_corpus_small(spark):
    labels = ["Fake", "REAL", "mixed", None]
    texts = ["Água  mole em PEDRA dura", "agua mole em pedra dura www.rio.example.com/p?q=1", "pedra", "ver https://a.example", None]
    data = [
        (name, f"{name}{i}{j}", 100 * n + 10 * i + j, text, label, "xx")
        for n, name in enumerate(("rio", "mar"))
        for i, text in enumerate(texts)
        for j, label in enumerate(labels)
    ]
    df = spark.createDataFrame(
        data, "dataset_name string, orig_id string, uid long, text string, label string, language string"
    )
    clean = clean_corpus(df, min_tokens=2)
    # of the ten labelled rows of a dataset, four hold the same long text and two a single word
    assert rows(clean, "orig_id", "label", "text_clean") == [
        ("mar00", "fake", "agua mole em pedra dura"), ("rio00", "fake", "agua mole em pedra dura"),
    ]
    assert "language" not in clean.columns and clean.columns[0] == "dataset_name"
    flags = flag_corpus(df, 2).where("dataset_name = 'mar'").orderBy("uid").collect()
    assert [(r.is_duplicated, r.is_null, r.too_short) for r in flags] == [
        (False, False, False), (True, False, False), (True, False, False), (True, False, False),
        (False, False, True), (True, False, True), (False, False, True), (True, False, True),
        (False, True, True), (True, True, True),
    ]


def test_invalid_label_copies_do_not_count(spark):
    df = spark.createDataFrame(
        [(1, "a b c d", "satire"), (2, "a b c d", "real"), (3, "a b c d", "falso")],
        "uid long, text string, label string",
    )
    assert rows(clean_corpus(df), "uid", "label") == [(2, "true")]
    assert clean_corpus(df.where("uid = 1")).count() == 0


def test_duplicate_flags_leave_one_per_group(spark):
    df = spark.range(3000).select(
        F.col("id").alias("uid"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("t"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 2).alias("d"),
    )
    flagged = flag_duplicates(df, "uid", "t", "d")
    assert flagged.count() == 3000
    groups = df.select("d", "t").distinct().count()
    firsts = flagged.where(~F.col("is_duplicated"))
    assert firsts.count() == groups
    least = df.groupBy("d", "t").agg(F.min("uid").alias("uid")).select("uid")
    assert firsts.select("uid").exceptAll(least).count() == 0


def test_salted_join_equals_plain_join(spark):
    left = spark.range(20000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 == 0, None).otherwise(
            F.concat(F.lit("k"), F.col("id") % 4000)).alias("k"),
    )
    right = left.where("k is not null").select("k").distinct().where("k <> 'k7'").withColumn("v", F.length("k"))
    hot = hot_keys(left, "k", rows_per_task=100)
    assert [r.k for r in hot.where("k is not null").collect()] == ["hot"]
    for how in ("left", "inner"):
        got = salted_left_join(left, right, "k", "id", how=how, rows_per_task=100)
        want = left.join(right, "k", how)
        assert got.count() == want.count()
        assert got.select("k", "id", "v").exceptAll(want.select("k", "id", "v")).count() == 0


def test_pieces_of_a_hot_key_are_bounded(spark, monkeypatch):
    """No piece is larger than asked for, however many keys are hot; too many are not broadcast."""
    left = spark.range(9000).select("id", (F.col("id") % 30).alias("k"))
    hot = hot_keys(left, "k", rows_per_task=7)
    assert hot.count() == 30 and {r._pieces for r in hot.collect()} == {43}
    right = spark.range(30).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    monkeypatch.setattr("claimloom.operators.skew.MAX_BROADCAST_ROWS", 10)
    assert salted_left_join(left, right, "k", "id", hot=hot).where("v = 'v'").count() == 9000


def test_lookup_keeps_every_row_once(spark):
    long = "y" * 700
    texts = ["lua", None, "sol", "\t \n", "lua", long, "estrela", "", "lua"]
    base = spark.createDataFrame(list(enumerate(texts)), "uid long, text string")

    def response(rating):
        return json.dumps({"claims": [{"claimant": None, "claimReview": [{"textualRating": rating}, {"url": "second"}]}]})

    answers = spark.createDataFrame(
        [("lua", response("R1")), ("sol", json.dumps({"claims": []})), ("", response("R0")), (long[:512], response("R2"))],
        "query string, response_json string",
    )
    want = ["R1", None, None, None, "R1", "R2", None, None, "R1"]
    whole = enrich_with_reviews(base, answers).where("uid = 5").first()
    assert whole.factcheck_rating is None  # another text, though its first 512 characters are the query
    for table in (answers, answers.unionByName(answers)):
        got = enrich_with_reviews(base, table, rows_per_task=1, max_query_chars=512).orderBy("uid").collect()
        assert [r.factcheck_rating for r in got] == want
        assert [r.factcheck_url for r in got] == [None if w is None else "" for w in want]


def test_unify_urls(spark):
    df = spark.createDataFrame(
        [(1, "c", None), (2, "c", "r"), (3, None, None)], "uid long, url_claim string, url_review string"
    )
    out = unify_urls(df.withColumn("n", F.col("uid")))
    assert out.columns == ["url_review", "n"]
    assert rows(out, "n", "url_review") == [(1, "c"), (2, "r"), (3, None)]
    assert rows(unify_urls(df.drop("url_review")), "url_review") == [("c",), ("c",), (None,)]
    assert unify_urls(df.select("uid", "url_review")).columns == ["url_review"]


def test_describe_datasets(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "uid long, dataset_name string")
    dim = spark.createDataFrame([("a", "web", "A!")], "dataset_name string, source_type string, source_description string")
    assert rows(describe_datasets(df, dim), "uid", "source_type", "source_description") == [
        (1, "web", "A!"), (2, "news", "Dataset b"), (3, "news", None),
    ]


def test_audits(spark):
    df = spark.createDataFrame(
        [("a", "fake", "t", "u"), ("a", None, None, None), (None, "fake", "t", None)],
        "dataset_name string, label string, text string, url_claim string",
    ).withColumn("url_review", F.lit(None).cast("string"))
    assert [tuple(r) for r in audit.dataset_counts(df).collect()] == [("a", 2), (None, 1)]
    assert [tuple(r) for r in audit.label_counts(df).collect()] == [("fake", 2), (None, 1)]
    stats = {(r.dataset_name, r.is_total): (r.normalized_rows, r.merged_rows) for r in audit.dataset_stats(df).collect()}
    assert stats == {("a", False): (2, 1), (None, False): (1, 1), (None, True): (3, 2)}
    stages = {r.stage: r.n_rows for r in audit.stage_audit(df, df.limit(1), 2).collect()}
    assert stages == {"files_scanned": 2, "normalized": 3, "null_text_removed": 1, "merged": 2, "labelled": 2, "clean": 1}
    urls = audit.url_audit(df, df.withColumn("url_claim", F.lit(None).cast("string"))).collect()
    assert sorted(map(tuple, urls), key=repr) == [("a", 1, 0, True), (None, 0, 0, True)]
    alone = audit.url_audit(df.unionByName(df.withColumn("url_claim", F.lit("www.a.example/1")))).collect()
    assert sorted(map(tuple, alone), key=repr) == [("a", 3, 2, True), (None, 1, 1, True)]


def test_preview(spark):
    assert [r.uid for r in preview(spark.range(100).withColumnRenamed("id", "uid")).collect()] == [0, 1, 2, 3, 4]


def test_manifest_and_landed_files(spark, tmp_path):
    (tmp_path / "b.bin").write_bytes(b"x" * 2000)
    (tmp_path / "a.bin").write_bytes(b"y")
    (tmp_path / "manifest.json").write_text("{}")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.bin").write_bytes(b"z" * 3000)
    got = [tuple(r) for r in sinks.manifest(spark, str(tmp_path)).collect()]
    assert got == [
        ("a.bin", hashlib.sha256(b"y").hexdigest(), 1),
        ("b.bin", hashlib.sha256(b"x" * 2000).hexdigest(), 2000),
        ("sub/c.bin", hashlib.sha256(b"z" * 3000).hexdigest(), 3000),
    ]
    assert rows(scan.landed_files(spark, str(tmp_path)), "name", "bytes") == [("b.bin", 2000), ("c.bin", 3000)]
    assert rows(scan.landed_files(spark, str(tmp_path), ["c.bin"]), "name") == [("c.bin",)]


def test_tables_are_dealt_out_where_the_session_says_so(spark):
    before = spark.conf.get(scan.PARTITIONS, None)
    df = spark.range(1000).coalesce(1)
    try:
        spark.conf.set(scan.PARTITIONS, "5")
        dealt = scan.share_out(df, "id")
        assert dealt.select(F.spark_partition_id()).distinct().count() == 5 and rows(dealt, "id") == rows(df, "id")
        spark.conf.unset(scan.PARTITIONS)
        if spark.conf.get(scan.PARTITIONS, None) is None:
            assert scan.share_out(df, "id") is df
    finally:
        if before is not None:
            spark.conf.set(scan.PARTITIONS, before)


def test_responses_from_json_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([("q", "{}")], "query string, response_json string")
    df.write.json(str(tmp_path / "r.json"))
    df.write.parquet(str(tmp_path / "r.parquet"))
    for name in ("r.json", "r.parquet"):
        assert rows(read_responses(spark, str(tmp_path / name)), "query", "response_json") == [("q", "{}")]


def test_whole_job_written(spark, raw_zone, tmp_path):
    answers = spark.createDataFrame([("um dois três", "{}")], "query string, response_json string")
    paths = run_to(str(tmp_path / "out"), read_corpora(spark, raw_zone), answers, NearDuplicateSettings())
    merged = spark.read.parquet(paths["merged_parquet"])
    clean = spark.read.parquet(paths["clean_parquet"])
    final = spark.read.parquet(paths["factchecked_parquet"])
    assert merged.count() == 6
    assert sorted(r.text_clean for r in clean.collect()) == [
        'linha um linha "dois" tres', "um dois tres", "um dois tres quatro",
    ]
    assert final.count() == clean.count()
    assert {"near_duplicate_groups", "factcheck_rating"} <= set(final.columns) and "uid" not in final.columns
    again = spark.read.csv(paths["clean_csv"], header=True, multiLine=True, quote='"', escape='"')
    assert again.count() == 3 and set(again.columns) == set(clean.columns)
    # counted while writing, the same as counted by queries
    corpora = read_corpora(spark, raw_zone)
    normalized = unnumbered_corpora(corpora)
    audits = {
        "dataset_stats": audit.dataset_stats(normalized),
        "stage_audit": audit.stage_audit(normalized, surviving_texts(normalized.where("text is not null")), len(corpora)),
    }
    for name, want in audits.items():
        schema = want.schema
        assert sorted(map(repr, spark.read.schema(schema).json(paths[name]).collect())) == sorted(map(repr, want.collect()))
    listed = {r.name: (r.sha256, r.bytes) for r in spark.read.json(paths["manifest"]).collect()}
    written = [
        p for p in (tmp_path / "out").rglob("*")
        if p.is_file() and p.name[0] not in "._" and "manifest.json" not in p.parts
    ]
    assert listed == {
        str(p.relative_to(tmp_path / "out")): (hashlib.sha256(p.read_bytes()).hexdigest(), p.stat().st_size) for p in written
    }


def test_files_follow_bytes_not_tasks(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 32).select(
        F.when(F.col("id") % 10 == 0, "tiny").otherwise("huge").alias("dataset_name"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
    )
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "700k", "spark.sql.shuffle.partitions": "64"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        sinks.write_parquet(rows, str(tmp_path / "t"), "dataset_name")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = {d: len(list((tmp_path / "t" / f"dataset_name={d}").glob("*.parquet"))) for d in ("tiny", "huge")}
    assert files["tiny"] <= 2 < files["huge"] < 32
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40_000


@pytest.mark.parametrize("max_dropped", [0, 1000], ids=["shuffled", "broadcast"])
def test_first_copies_are_kept_whole(spark, max_dropped):
    df = spark.createDataFrame(
        [(3, "a", "x", 1), (1, "a", "x", 2), (2, "b", "x", 3), (5, None, "y", 4), (4, None, "y", 5), (6, "a", None, 6), (7, "a", None, 7)],
        "uid long, t string, d string, payload int",
    )
    kept = keep_first_copies(df, "uid", "t", "d", max_dropped)
    assert kept.columns == df.columns
    assert sorted(r.payload for r in kept.collect()) == [2, 3, 5, 6]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and ("BroadcastHashJoin" in plan) == (max_dropped > 0)


def test_final_rows_come_in_uid_order(spark):
    """``run`` drops the key; its rows stay in that order."""
    rng = random.Random(1)
    texts = [(i, f"texto numero {rng.randrange(10**6)} aqui", "fake") for i in range(300)]
    frame = spark.createDataFrame(texts, "id long, text string, label string").repartition(7)
    answers = spark.createDataFrame([("x", "{}")], "query string, response_json string")
    result = run([Corpus("one", frame)], answers, NearDuplicateSettings(), order_by=["orig_id"])
    assert "uid" not in result.final.columns
    assert [r.orig_id for r in result.final.collect()] == sorted(str(i) for i in range(300))


def test_dataset_names_stay_text(spark, tmp_path):
    zone = tmp_path / "raw"
    zone.mkdir()
    for name in ("001", "002"):
        (zone / f"{name}.csv").write_text(f"text,label\nlinha numero {name} aqui,fake\noutra linha de {name},true\n")
    answers = spark.createDataFrame([("x", "{}")], "query string, response_json string")
    paths = run_to(str(tmp_path / "out"), read_corpora(spark, str(zone)), answers)
    final = spark.read.csv(paths["factchecked_csv"], header=True)
    assert {r.dataset_name for r in final.collect()} == {"001", "002"}
    stored = spark.read.parquet(paths["factchecked_parquet"]).collect()
    assert [r.dataset_name for r in stored] == ["001", "001", "002", "002"]


def test_corpus_of_plain_frames_needs_a_key(spark):
    frame = spark.createDataFrame([("b", "x y z", "1"), ("a", "u v w", "0")], "id string, text string, label string")
    merged = merge_corpora([Corpus("one", frame)], order_by=["orig_id"])
    assert rows(merged, "uid", "orig_id", "label") == [(1, "a", "true"), (2, "b", "fake")]


def test_large_files_are_hashed_as_streams(spark, tmp_path, monkeypatch):
    (tmp_path / "sub dir").mkdir()
    for name, data in (("a.bin", b"x" * 100), ("sub dir/b é%20.bin", bytes(range(256)) * 40), ("edge", b"y" * 1000)):
        (tmp_path / name).write_bytes(data)
    whole = [tuple(r) for r in sinks.manifest(spark, str(tmp_path)).collect()]
    monkeypatch.setattr(sinks, "HASHED_WHOLE", 1000)
    assert [tuple(r) for r in sinks.manifest(spark, str(tmp_path)).collect()] == whole
    assert [r[0] for r in whole] == ["a.bin", "edge", "sub dir/b é%20.bin"]
    assert all(hashlib.sha256((tmp_path / name).read_bytes()).hexdigest() == digest for name, digest, _ in whole)


def test_a_file_beyond_two_gigabytes_is_in_the_manifest(spark, tmp_path):
    with (tmp_path / "sparse.csv").open("wb") as out:
        out.truncate(3 << 30)
    want = hashlib.sha256()
    for _ in range(3 << 7):
        want.update(bytes(1 << 23))
    assert [tuple(r) for r in sinks.manifest(spark, str(tmp_path)).collect()] == [("sparse.csv", want.hexdigest(), 3 << 30)]


@pytest.mark.parametrize("multi_line", [True, False])
def test_headers_that_differ_in_case_stay_apart(spark, tmp_path, multi_line):
    path = tmp_path / "set.csv"
    path.write_text("ID,text,Text,id,TEXT,x5,X6\n1,a,b,2,c,d,e\n")
    frame = scan.read_csv(spark, str(path), multi_line).drop(scan.POSITION)
    assert frame.columns == ["ID.1", "text", "Text.1", "id", "TEXT.2", "x5", "X6"]
    assert [tuple(r) for r in frame.collect()] == [("1", "a", "b", "2", "c", "d", "e")]
    mapped = ensure_schema(frame, "set").collect()
    assert [(r.orig_id, r.text) for r in mapped] == [("2", "a")]
    path.write_text("Text,texT,label\na,b,1\n")
    assert scan.read_csv(spark, str(path), multi_line).columns[:3] == ["Text", "texT.1", "label"]
    path.write_text("x0,x1,x2\na,b,1\n")
    assert scan.read_csv(spark, str(path), multi_line).columns[:3] == ["x0", "x1", "x2"]
