import json

from pyspark.sql import functions as F

from claimloom import clean_corpus, ensure_schema
from claimloom.streaming.incremental import clean_stream, enrich_incrementally

SCHEMA = "id long, texto string, classificacao string"
DATA = [(1, "Boato  VELHO aqui http://a.com/b", "falso"), (2, "curta", "true"), (3, "sem rótulo algum", "x")]


def test_stateless_steps_on_a_stream(spark, tmp_path):
    spark.createDataFrame(DATA, SCHEMA).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    query = (
        clean_stream(stream, "d").writeStream.format("memory").queryName("cleaned")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {r.orig_id: (r.text_clean, r.too_short) for r in spark.table("cleaned").collect()}
    assert got == {"1": ("boato velho aqui", False), "2": ("curta", True)}
    batch = clean_corpus(
        ensure_schema(spark.createDataFrame(DATA, SCHEMA), "d").withColumn("uid", F.col("orig_id").cast("long"))
    )
    assert [r.text_clean for r in batch.collect()] == ["boato velho aqui"]


def test_lookup_of_newly_landed_rows(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "cp"))
    answer = json.dumps({"claims": [{"claimant": "c", "claimReview": []}]})
    responses = spark.createDataFrame([("a b", answer)], "query string, response_json string")
    for uid in (1, 2):
        spark.createDataFrame([(uid, "a b"), (uid + 10, None)], "uid long, text string").write.mode("append").parquet(landing)
        stream = spark.readStream.schema("uid long, text string").parquet(landing)
        enrich_incrementally(stream, responses, out, state).awaitTermination()
    got = sorted((r.uid, r.factcheck_claimant) for r in spark.read.parquet(out).collect())
    assert got == [(1, "c"), (2, "c"), (11, None), (12, None)]
