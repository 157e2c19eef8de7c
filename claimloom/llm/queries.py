"""One query per operator, with production parameters, and their SQL where it can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimloom.llm import (
    bpe,
    exact_dedup,
    language,
    licenses,
    merkle,
    near_dedup,
    packing,
    periodic,
    quality,
    secret_scan,
    topk,
    url_rules,
    wrappers,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _remainder(divisor: int):
    """crc32 of the document id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    return bpe.encode_documents(
        _table(spark, folder, "documents"), "doc_id", "text", tokenizer,
        lambda ids, decoded: (_sha256(ids), _sha256(decoded)),
        "ids_sha256 string, decoded_sha256 string",
    )


def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", topk.quantise(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), "vec_id", "v", k=5)


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    held_out = _remainder(5) == 0
    labels = _table(spark, folder, "labels").where(~held_out)
    docs = _table(spark, folder, "documents")
    return quality.rank_quality(
        docs, labels, keep={"doc_id": F.col("doc_id"), "held_out": F.coalesce(held_out, F.lit(False))}
    ).select("doc_id", "held_out", "score", "predicted")


def op4_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return wrappers.extract_main_text(
        pages, "page_id", "url", "html", keep={"page_id": F.col("page_id"), "url": F.col("url")}
    )


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = secret_scan.scan_documents(docs, "text", keep={"doc_id": F.col("doc_id")})
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_unopened"
    )


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return exact_dedup.flag_duplicates(docs, "doc_id", "text").withColumnRenamed("id", "doc_id")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), "doc_id")


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.document_licenses(_table(spark, folder, "documents"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = _remainder(4) == 2
    samples = language.language_samples(docs.where(~held_out), "lang", "text")
    keep = {"doc_id": F.col("doc_id"), "held_out": F.coalesce(held_out, F.lit(False))}
    return language.identify(docs, samples, "text", keep)


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = near_dedup.link_components(docs, "doc_id", "text", words=3, percent=85)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept"
    )


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    # one character more than stated; nulls stay, as does the greatest long
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.when(_remainder(7) == 0, merkle.leaf_digest([more if c == "n_chars" else F.col(c) for c in fields]))
    proved = merkle.manifest(docs, fields, "lang", "doc_id", {"doc_id": F.col("doc_id"), "tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("siblings"))
    return proved.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("siblings")).alias("proof_sha256"),
        folded.alias("folded_root"), "siblings",
    ).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _made_periodic(text: Column, doc_id: Column) -> Column:
    """The text, in every tenth document with all words from some place on repeating its next few."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))

    # a lambda's argument is computed once, a column named twice perhaps twice
    made = F.transform(F.array(words), lambda w: F.array_join(F.when(F.size(w) > 0, repeated(w)).otherwise(w), " "))
    return F.when(h % 10 == 0, made[0]).otherwise(text)


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    text = _made_periodic(F.col("text"), F.col("doc_id"))
    found = periodic.find_runs(docs, text, {"doc_id": F.col("doc_id")})
    best = periodic.strongest(F.col("runs"))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


URL_RULES = (
    url_rules.Rule("net/", "block"),
    url_rules.Rule("example.net/en/", "allow"),
    url_rules.Rule("example.com/de/", "block"),
    url_rules.Rule("org/fr/", "allow"),
)


def op13_urls(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, folder, "pages"), "url", URL_RULES, {"page_id": F.col("page_id")})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe, op2_topk, op3_quality, op4_wrappers, op5_secrets,
        op6_exact_dedup, op7_packing, op8_licenses, op9_language, op10_near_dedup,
        op11_merkle, op12_runs, op13_urls,
    )
}

_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

_DEDUP = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)
"""


def _packing_sql() -> str:
    """The dynamic programme step by step: best cost, then path, for 1, 2, ... buckets."""
    steps = [
        """p1 AS (SELECT j, length * before AS cost, [length] AS bounds FROM h)"""
    ] + [
        f"""p{k} AS (
          SELECT h.j, min(p.cost + h.length * (h.before - g.before)) AS cost,
                 list_append(arg_min(p.bounds, {{'c': p.cost + h.length * (h.before - g.before), 'i': g.j}}), h.length) AS bounds
          FROM h JOIN h g ON g.j < h.j JOIN p{k - 1} p ON p.j = g.j GROUP BY h.j, h.length)"""
        for k in range(2, packing.BUCKETS + 1)
    ]
    choices = " UNION ALL ".join(
        f"SELECT {k} AS k, cost, bounds FROM p{k} WHERE j = (SELECT max(j) FROM h)" for k in range(1, packing.BUCKETS + 1)
    )
    return f"""
WITH t AS (
  SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 AS BIGINT) AS n_tokens FROM documents),
r AS (SELECT *, CAST(ceil(n_tokens / {packing.MULTIPLE}.0) * {packing.MULTIPLE} AS BIGINT) AS length FROM t),
c AS (SELECT length, count(*) AS n FROM r GROUP BY length),
h AS MATERIALIZED (
  SELECT length, CAST(sum(n) OVER (ORDER BY length) AS BIGINT) AS before, row_number() OVER (ORDER BY length) AS j FROM c),
{", ".join(s.replace("AS (", "AS MATERIALIZED (", 1) for s in steps)},
best AS (SELECT bounds FROM ({choices}) ORDER BY cost, k LIMIT 1),
b AS (SELECT r.doc_id, r.n_tokens, len(list_filter(best.bounds, lambda x: x < r.length)) AS bucket, best.bounds
      FROM r, best),
n AS (SELECT doc_id, n_tokens, CAST(bucket AS INTEGER) AS bucket, bounds[bucket + 1] AS bound,
             row_number() OVER (PARTITION BY bucket ORDER BY doc_id) - 1 AS number FROM b)
SELECT doc_id, n_tokens, bucket, bound,
       CAST(number // greatest(1, {packing.TOKEN_BUDGET} // bound) AS BIGINT) AS batch,
       CAST(number % greatest(1, {packing.TOKEN_BUDGET} // bound) AS BIGINT) AS slot
FROM n
"""


# crc32 bit by bit: a byte is added, then eight halvings, -1 standing for one.
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(s, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END))"""


def _field_sql(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field_sql, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _level_sql(tree: str) -> str:
    return f"""SELECT lang, level + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2
  FROM {tree} WHERE n > 1 GROUP BY lang, level, i // 2, n"""


# Level by level, as the definition says; a sibling is written L, R or - with its digest behind.
_MERKLE = f"""
WITH RECURSIVE crc AS (SELECT s, {_CRC32} AS crc FROM (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL)),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS lang, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN crc % 7 = 0 THEN {_leaf_sql("CAST(n_chars AS HUGEINT) + 1")} END AS tampered
  FROM documents LEFT JOIN crc ON s = CAST(doc_id AS VARCHAR)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
tree(lang, level, i, d, n) AS (
  SELECT lang, 0, i, leaf, n FROM ranked
  UNION ALL
  {_level_sql("tree")}),
roots AS (
  SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
upper(lang, level, i, d, n) AS (
  SELECT '', 0, i, subroot, n FROM roots
  UNION ALL
  {_level_sql("upper")}),
steps AS (
  SELECT r.lang, r.i, t.level, CASE WHEN s.d IS NULL THEN '-' WHEN s.i < t.i THEN 'L' || s.d ELSE 'R' || s.d END AS step
  FROM ranked r JOIN tree t ON t.lang = r.lang AND t.i = r.i >> t.level AND t.n > 1
  LEFT JOIN tree s ON s.lang = t.lang AND s.level = t.level AND s.i = xor(t.i, 1)),
own AS (SELECT lang, i, list(step ORDER BY level) AS steps FROM steps GROUP BY ALL),
over AS (
  SELECT r.lang, list(CASE WHEN s.d IS NULL THEN '-' WHEN s.i < t.i THEN 'L' || s.d ELSE 'R' || s.d END ORDER BY t.level) AS steps
  FROM roots r JOIN upper t ON t.i = r.i >> t.level AND t.n > 1
  LEFT JOIN upper s ON s.level = t.level AND s.i = xor(t.i, 1) GROUP BY r.lang),
proofs AS (
  SELECT r.doc_id, r.leaf, r.tampered, roots.subroot, (SELECT d FROM upper WHERE n = 1) AS root,
         list_concat(coalesce(own.steps, []), coalesce(over.steps, [])) AS steps
  FROM ranked r JOIN roots USING (lang) LEFT JOIN own ON own.lang = r.lang AND own.i = r.i LEFT JOIN over ON over.lang = r.lang),
folded AS (
  SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_concat([''], list_transform(steps, lambda s: s[2:])), 'string_agg', '')) AS proof_sha256,
         list_reduce(list_concat([coalesce(tampered, leaf)], steps),
           lambda d, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || d WHEN 'R' THEN d || s[2:] ELSE d END)) AS folded_root
  FROM proofs)
SELECT *, folded_root = root AS verified FROM folded
"""

_URLS = """
WITH r AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM r),
f AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM f
"""

SQL: dict[str, str] = {
    "op11_merkle": _MERKLE,
    "op13_urls": _URLS,
    "op2_topk": _TOPK,
    "op6_exact_dedup": _DEDUP,
    "op7_packing": _packing_sql(),
}
