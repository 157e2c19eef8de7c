"""The catalog's queries again as SQL over the same tables, for DuckDB.

Written from the definitions, not from the Spark plans: duplicates are plain
window functions, the lookup is a plain join, MinHash is 128 SQL expressions.
"""

from __future__ import annotations

import os
import zipfile
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyspark

from claimloom.functions.minhash import MAX_HASH, MERSENNE_PRIME, lsh_bands
from claimloom.functions.shingles import HASH_BASE, HASH_PRIME
from claimloom.functions.unicode_tables import emoji_pattern
from claimloom.plans.catalog import EMOJI_SAMPLE, TABLES
from claimloom.plans.inputs import LABEL_SPELLINGS, ROLE_VERDICTS

BLANKS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
NUMBER = "'[0-9]+([.,][0-9]+)?'"


def text(value: str) -> str:
    """An SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def no_quotes(x: str) -> str:
    return f"""regexp_replace({strip(x)}, '^["''](.*)["'']$', '\\1')"""


def no_emoji(x: str) -> str:
    return f"regexp_replace({x}, {text(emoji_pattern())}, '', 'g')"


def one_space(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def clean(x: str) -> str:
    return one_space(f"lower(strip_accents({no_quotes(no_emoji(strip(x)))}))")


def tokens(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN 0 ELSE len(string_split({x}, ' ')) END"


def disguised(x: str) -> str:
    return f"regexp_full_match(replace(lower(trim({x})), 'o', '0'), {NUMBER})"


@lru_cache(maxsize=1)
def top_level_domains() -> tuple[str, ...]:
    """Suffixes of one label in the public list, read straight from the jar that carries it."""
    jars = Path(os.environ.get("SPARK_HOME") or Path(pyspark.__file__).parent) / "jars"
    for jar in sorted(jars.glob("*httpclient-4*.jar")):
        with zipfile.ZipFile(jar) as archive:
            lines = archive.read("mozilla/public-suffix-list.txt").decode().split("BEGIN PRIVATE")[0].splitlines()
        rules = (line.strip() for line in lines)
        return tuple(rule for rule in rules if rule and rule.isalpha() and "." not in rule)
    return ()


def _url_regex() -> str:
    stop = r"\s\"<>;"
    tail = f"[^{stop}]*[^{stop}.,!?:)\\]}}']"
    labels = r"(?:[\p{L}\p{N}-]+\.)+"
    full = f"(?:https?|ftp)://(?:{labels}[\\p{{L}}\\p{{N}}-]+|localhost)"
    bare = f"{labels}[\\p{{L}}\\p{{N}}-]+@?"  # one that touches an @ is mail
    return f"(?i)(?:^|[^\\p{{L}}\\p{{N}}_@.-])((?:{full}|{bare})(?::[0-9]+)?(?:[/?#](?:{tail})?)?)"


def urls(x: str) -> str:
    listed = ", ".join(text(domain) for domain in top_level_domains())
    known = f"list_contains([{listed}], lower(regexp_extract(u, '^[^:/?#]*[.]([^.:/?#]+)', 1)))"
    return f"""list_filter(regexp_extract_all({x}, {text(_url_regex())}, 1), lambda u: NOT {disguised('u')}
      AND NOT contains(regexp_extract(u, '^[^/?#]*'), '@') AND (contains(u, '://') OR starts_with(lower(u), 'www.') OR {known}))"""


def without_urls(x: str, found: str) -> str:
    return strip(f"list_reduce(list_concat([{x}], {found}), lambda a, u: replace(a, u, ''))")


def plausible(x: str) -> str:
    host = f"regexp_extract({strip(x)}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#]*)', 1)"
    return (
        f"CASE WHEN NOT regexp_full_match({strip(x)}, {NUMBER}) AND contains({host}, '.') THEN {strip(x)} END"
    )


# What label spellings mean, written out here so that a wrong table elsewhere shows.
def raw_label(x: str) -> str:
    spelled = f"lower({strip(x)})"
    return f"""CASE WHEN {spelled} IN ('-1', 'none', 'nan') THEN NULL
      WHEN {spelled} IN ('1', 'fake', 'falsa', 'falso', 'mentira') THEN 'fake'
      WHEN {spelled} IN ('0', 'real', 'true', 'verdade', 'verdadeira', 'verdadeiro') THEN 'true'
      WHEN {spelled} IN ('duvidoso', 'misleading', 'mixed', 'parcialmente falso', 'partly false', 'partly_true') THEN 'mixed'
      ELSE {spelled} END"""


def final_label(x: str) -> str:
    spelled = f"lower({strip(x)})"
    return f"""CASE WHEN {spelled} IN ('', '-1', 'none', 'nan') THEN NULL
      WHEN {spelled} IN ('fake', 'falsa', 'false', 'falso') THEN 'fake'
      WHEN {spelled} IN ('real', 'true', 'verdadeira', 'verdadeiro') THEN 'true'
      ELSE {spelled} END"""


def spelling(key: str) -> str:
    listed = ", ".join(text(s) for s in LABEL_SPELLINGS)
    return f"list_extract([{listed}], CAST({key} % {len(LABEL_SPELLINGS)} AS INT) + 1)"


NULL_TEXT = "CAST(NULL AS VARCHAR)"
_VERDICT = "CASE role" + "".join(f" WHEN {text(k)} THEN {text(v)}" for k, v in ROLE_VERDICTS.items()) + " END"
KEPT = "('fake', 'true')"

# The four corpora after mapping, each with the order its rows have in its file.
_CORPORA = f"""
docs AS (
  SELECT d.doc_id AS pos, CAST(d.doc_id AS VARCHAR) AS orig_id, d.text AS text,
         {raw_label("CAST(l.toxic AS VARCHAR)")} AS label, d.source AS url_claim,
         {NULL_TEXT} AS url_review, {NULL_TEXT} AS date_iso, 'documents' AS dataset_name,
         'web' AS source_type, 'Documents with labels' AS source_description
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
webs AS (
  SELECT page_id AS pos, CAST(page_id AS VARCHAR) AS orig_id, html AS text,
         {raw_label(spelling("page_id"))} AS label, url AS url_claim, {NULL_TEXT} AS url_review,
         {NULL_TEXT} AS date_iso, 'pages' AS dataset_name, 'news' AS source_type,
         'Dataset pages' AS source_description
  FROM pages),
chats AS (
  SELECT conv_id * 100000 + turn AS pos, conv_id || '-' || turn AS orig_id,
         CASE WHEN role <> 'system' THEN text END AS text, {raw_label(_VERDICT)} AS label,
         {NULL_TEXT} AS url_claim, {NULL_TEXT} AS url_review, {NULL_TEXT} AS date_iso,
         'conversations' AS dataset_name, 'chat' AS source_type,
         'Dataset conversations' AS source_description
  FROM conversations),
claims AS (
  SELECT item_id AS pos, CAST(item_id AS VARCHAR) AS orig_id, text, {NULL_TEXT} AS label,
         'https://twitter.com/u/status/' || (item_id + 500) AS url_claim,
         CASE WHEN item_id % 2 = 0 THEN 'https://check.example.org/' || item_id END AS url_review,
         '2021-03-1' || (item_id % 10) AS date_iso, 'FakeTweetBr' AS dataset_name,
         'tweets' AS source_type, 'Dataset FakeTweetBr' AS source_description
  FROM benchmark)"""

_NORMALIZED = f"""{_CORPORA},
stacked AS (
  SELECT 0 AS frame, * FROM docs UNION ALL SELECT 1, * FROM webs
  UNION ALL SELECT 2, * FROM chats UNION ALL SELECT 3, * FROM claims),
normalized AS (
  SELECT orig_id, text, label, {plausible("url_claim")} AS url_claim, url_review, date_iso,
         dataset_name, source_type, source_description,
         CASE WHEN dataset_name = 'FakeTweetBr' THEN regexp_extract(url_claim, '(\\d+)$', 1) END AS tweet_id,
         row_number() OVER (ORDER BY frame, pos) AS uid
  FROM stacked),
merged AS (SELECT * FROM normalized WHERE text IS NOT NULL)"""

_FLAGGED = f"""{_NORMALIZED},
labelled AS (
  SELECT * REPLACE ({final_label("label")} AS label) FROM merged WHERE {final_label("label")} IN {KEPT}),
found AS (SELECT *, {urls("text")} AS links FROM labelled),
cut AS (SELECT *, {without_urls("text", "links")} AS text_no_url FROM found),
cleaned AS (SELECT *, {clean("text_no_url")} AS text_clean FROM cut),
flagged AS (
  SELECT *, row_number() OVER (PARTITION BY dataset_name, text_clean ORDER BY uid) > 1 AS is_duplicated,
         text_clean IS NULL AS is_null, coalesce({tokens("text_clean")} < 3, TRUE) AS too_short
  FROM cleaned),
good AS (SELECT * FROM flagged WHERE NOT (is_null OR is_duplicated OR too_short))"""

_CLEAN_COLUMNS = """dataset_name, source_type, source_description, label, date_iso, tweet_id, url_claim,
  url_review, text, text_clean, orig_id, uid, array_to_string(links, ' ') AS extracted_urls, text_no_url,
  is_null, too_short, is_duplicated"""

# Texts of the lookup queries and the responses by query, fields already apart.
_CHECKED = f"""
texts AS (
  SELECT doc_id AS uid, text, 'http://site.example.com/' || doc_id AS url_claim, {NULL_TEXT} AS url_review
  FROM documents
  UNION ALL SELECT item_id + 1000000000 * shift, text, NULL, 'https://check.example.org/' || item_id
  FROM benchmark, (VALUES (1), (2)) AS s(shift)
  UNION ALL SELECT doc_id + 3000000000, CASE WHEN toxic = 1 THEN '  ' END, NULL, NULL FROM labels)"""
_REVIEWS = """
answers AS (
  SELECT text AS query, item_id,
         CASE WHEN item_id % 4 <= 1 THEN CASE WHEN item_id % 3 = 0 THEN 'False' ELSE 'Misleading' END
              WHEN item_id % 4 = 2 THEN '' END AS factcheck_rating,
         CASE WHEN item_id % 4 <= 2 THEN 'agency ' || item_id END AS factcheck_claimant,
         CASE WHEN item_id % 4 <= 1 THEN 'https://check.example.org/' || item_id
              WHEN item_id % 4 = 2 THEN '' END AS factcheck_url
  FROM benchmark)"""


def _near(source: str, threshold: float = 0.7, ngram: int = 5, num_perm: int = 128, seed: int = 3) -> str:
    """CTEs from ``source(id, body)`` to ``pair(a, b)``: rows that share a band, themselves included."""
    draw = np.random.RandomState(seed)
    maps = [
        (int(draw.randint(1, MERSENNE_PRIME, dtype=np.uint64)), int(draw.randint(0, MERSENNE_PRIME, dtype=np.uint64)))
        for _ in range(num_perm)
    ]
    wrap = 1 << 64
    hashed = ", ".join(
        f"CAST((((hv * {a} + {b}) % {wrap}) % {MERSENNE_PRIME}) & {MAX_HASH} AS UINTEGER) AS h{k}"
        for k, (a, b) in enumerate(maps)
    )
    minima = ", ".join(f"min(h{k}) AS m{k}" for k in range(num_perm))
    bands, rows = lsh_bands(threshold, num_perm)
    band = ", ".join(
        f"concat_ws(',', {i}, {', '.join(f'm{k}' for k in range(i * rows, (i + 1) * rows))})" for i in range(bands)
    )
    grams = "||".join(["c"] + [f"lead(c, {i}, '') OVER w" for i in range(1, ngram)])
    return f"""
distinct_body AS (SELECT body, min(id) AS rep FROM {source} GROUP BY body),
chars AS (
  SELECT rep, length(body) AS n, unnest(string_split(body, '')) AS c,
         generate_subscripts(string_split(body, ''), 1) AS i
  FROM distinct_body WHERE body <> ''),
grams AS (SELECT rep, n, i, {grams} AS s FROM chars WINDOW w AS (PARTITION BY rep ORDER BY i)),
shingles AS (
  SELECT DISTINCT rep, s FROM grams WHERE i <= greatest(1, n - {ngram - 1})
  UNION ALL SELECT rep, '' FROM distinct_body WHERE body = ''),
numbers AS (
  SELECT s, CAST(list_reduce(
      list_concat([CAST(0 AS BIGINT)], list_transform(list_filter(string_split(s, ''), lambda c: c <> ''), lambda c: CAST(unicode(c) AS BIGINT) + 1)),
      lambda h, c: (h * {HASH_BASE} + c) % {HASH_PRIME}) AS HUGEINT) AS hv
  FROM (SELECT DISTINCT s FROM shingles)),
hashes AS (SELECT s, {hashed} FROM numbers),
signatures AS (SELECT rep, {minima} FROM shingles JOIN hashes USING (s) GROUP BY rep),
bands AS (SELECT rep, unnest([{band}]) AS bucket, unnest(range({bands})) AS band FROM signatures),
groups AS (
  SELECT rep, band, min(rep) OVER g AS least FROM bands
  WINDOW g AS (PARTITION BY bucket) QUALIFY count(*) OVER g > 1)"""


# Pairs that share a band, each by its exact similarity, counted shingle by shingle.
_VERIFIED = """candidates AS (
  SELECT DISTINCT x.rep AS a, y.rep AS b FROM groups x JOIN groups y USING (band, least) WHERE x.rep < y.rep),
sizes AS (SELECT rep, count(*) AS n FROM shingles GROUP BY rep),
common AS (
  SELECT a, b, count(*) AS k FROM candidates JOIN shingles x ON x.rep = a JOIN shingles y ON y.rep = b AND y.s = x.s
  GROUP BY a, b),
verified AS (
  SELECT a AS id_a, b AS id_b, CAST(k AS DOUBLE) / CAST(p.n + q.n - k AS DOUBLE) AS jaccard
  FROM common JOIN sizes p ON p.rep = a JOIN sizes q ON q.rep = b)"""

_MEMBERS = """named AS (
  SELECT rep, string_agg(name, ' ' ORDER BY name) AS names
  FROM (SELECT rep, band || ':' || least AS name FROM groups) GROUP BY rep),
members AS (
  SELECT id, rep AS text_id, coalesce(names, '') AS near_duplicate_groups
  FROM src JOIN distinct_body USING (body) LEFT JOIN named USING (rep))"""

# Every row that shares a band with a text, its own rows included.
_LISTS = """pairs AS (SELECT DISTINCT x.rep AS a, y.rep AS b FROM bands x JOIN bands y ON x.bucket = y.bucket),
copies AS (SELECT DISTINCT id, rep FROM src JOIN distinct_body USING (body)),
lists AS (
  SELECT a, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY id) AS near_duplicates
  FROM pairs JOIN copies ON rep = b GROUP BY a)"""

_WITH_URLS = """
linked AS (
  SELECT d.doc_id, d.text || ' ' || coalesce(p.url, 'www.exemplo.com.br')
         || ' custa 50.OOO veja exemplo.com/a, e ' || coalesce(p.url, 'www.exemplo.com.br') AS text
  FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id)"""

_MAPPED = "SELECT * EXCLUDE (pos) FROM {corpus}"

_RAW_LABELS = f"""raws AS (
  SELECT doc_id, unnest([CAST(toxic AS VARCHAR), ' ' || quality, {spelling("doc_id")}]) AS raw FROM labels)"""

_DATES = """SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 9 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date_iso
FROM orders"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name; absent for queries that read the folder itself."""
    plain_quote = """CASE p_size % 4 WHEN 0 THEN ' "' WHEN 1 THEN '''' WHEN 2 THEN '' ELSE '""' END"""
    end_quote = """CASE p_partkey % 5 WHEN 0 THEN '"' WHEN 1 THEN ''' ' WHEN 2 THEN '''' WHEN 3 THEN chr(10) ELSE '' END"""
    total = "regexp_replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '0', 'O', 'g')"
    names = " UNION ALL ".join(
        f"SELECT '{t}' AS dataset_name, count(*) AS n_rows FROM {t}" for t in TABLES
    )
    flag = "row_number() OVER (PARTITION BY {group} ORDER BY doc_id) > 1 AS is_duplicated"
    return {
        "clean_text": f"""WITH c AS (SELECT doc_id, {clean("'  \"' || text || '''  '")} AS text_clean FROM documents)
            SELECT doc_id, text_clean, CAST({tokens("text_clean")} AS BIGINT) AS n_tokens FROM c""",
        "outer_quotes": f"""SELECT p_partkey, {no_quotes(f"({plain_quote} || p_name || {end_quote})")} AS unquoted FROM part""",
        "accents": "SELECT doc_id, strip_accents(text) AS plain FROM documents",
        "spaces": f"""SELECT doc_id, {one_space("' ' || chr(10) || chr(9) || text || ' ' || chr(13) || chr(10) || '  fim '")} AS spaced
            FROM documents""",
        "strip_emoji": f"""SELECT doc_id, {no_emoji(f"text || {text(EMOJI_SAMPLE)} || doc_id")} AS no_emoji FROM documents""",
        "remove_urls": f"""WITH {_WITH_URLS}, f AS (SELECT doc_id, text, {urls("text")} AS links FROM linked)
            SELECT doc_id, {without_urls("text", "links")} AS text_no_url,
                   array_to_string(links, ' ') AS extracted_urls, CAST(len(links) AS BIGINT) AS n_urls FROM f""",
        "numbers_in_disguise": f"""SELECT o_orderkey,
            {disguised(f"CASE WHEN o_orderstatus = 'F' THEN {total} || 'x' ELSE {total} END")} AS number_like FROM orders""",
        "extract_url": """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_extract(url, '(?i)https?://(?:[a-z0-9-]+\\.)+[a-z]+(?:/\\S*)?')
            ELSE 'http://' || regexp_extract(regexp_replace(url, '^https?://', 'www.'), '(?i)www\\.(?:[a-z0-9-]+\\.)+[a-z]+(?:/\\S*)?') END AS url
            FROM pages""",
        "tweet_id": """SELECT event_id, CASE event_type WHEN 'click' THEN CAST(event_id AS VARCHAR)
            WHEN 'view' THEN CAST(event_id + 1000000000000 AS VARCHAR) END AS tweet_id FROM events""",
        "url_plausible": f"""WITH r AS (
            SELECT doc_id, unnest([source, ' ' || source || '.com.br/a ', CAST(n_chars AS VARCHAR), n_chars || '.5',
                   'http://' || source || '/a.b', 'ftp://x.' || source || '?q=1']) AS raw FROM documents
            UNION ALL SELECT page_id, url FROM pages)
            SELECT doc_id, raw, {plausible("raw")} AS url_claim FROM r""",
        "label_map_raw": f"""WITH {_RAW_LABELS} SELECT doc_id, raw, {raw_label("raw")} AS label FROM raws""",
        "label_map_clean": f"""WITH {_RAW_LABELS}, l AS (SELECT doc_id, raw, {final_label("raw")} AS label FROM raws)
            SELECT doc_id, raw, label, coalesce(label IN {KEPT}, FALSE) AS kept FROM l""",
        "date_iso": _DATES,
        "date_free_form": """SELECT o_orderkey, CASE o_orderkey % 11 WHEN 10 THEN NULL
              WHEN 7 THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_iso
            FROM orders""",
        "query_text": "SELECT doc_id, substr(text, 1, 512) AS query FROM documents",
        "text_digest": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
        "ensure_schema_docs": f"WITH {_CORPORA} {_MAPPED.format(corpus='docs')}",
        "ensure_schema_pages": f"WITH {_CORPORA} {_MAPPED.format(corpus='webs')}",
        "ensure_schema_conv": f"WITH {_CORPORA} {_MAPPED.format(corpus='chats')}",
        "ensure_schema_claims": f"WITH {_CORPORA} {_MAPPED.format(corpus='claims')}",
        "claim_url_from_text": f"""WITH {_WITH_URLS} SELECT CAST(doc_id AS VARCHAR) AS orig_id,
            regexp_replace(regexp_extract(text, '(?i)(?:https?://|www\\.)(?:[a-z0-9-]+\\.)+[a-z]+(?:/\\S*)?'), '^www', 'http://www') AS url_claim
            FROM linked""",
        "text_fallback": """SELECT CAST(p_partkey AS VARCHAR) AS orig_id,
            regexp_replace(CASE WHEN p_size > 10 THEN p_name ELSE '' END || '. ' ||
                           CASE WHEN p_size < 40 THEN p_type ELSE '' END, '^\\.\\s*', '') AS text FROM part""",
        "row_ids": "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS rid, o_orderkey FROM orders",
        "normalized_corpora": f"WITH {_NORMALIZED} SELECT * FROM normalized",
        "merge_corpora": f"WITH {_NORMALIZED} SELECT * FROM merged",
        "describe_datasets": """SELECT c_custkey AS uid, 'nation ' || c_nationkey AS dataset_name,
            CASE WHEN n_regionkey < 3 THEN 'region ' || n_regionkey ELSE 'news' END AS source_type,
            CASE WHEN n_regionkey < 3 THEN n_name ELSE 'Dataset nation ' || c_nationkey END AS source_description
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
        "dataset_names": names,
        "duplicates_by_language": f"""WITH c AS (SELECT doc_id, lang, {clean("text")} AS t FROM documents)
            SELECT doc_id, lang, {flag.format(group="lang, t")} FROM c""",
        "exact_duplicates": f"""WITH c AS (SELECT doc_id, {clean("text")} AS t FROM documents)
            SELECT doc_id, {flag.format(group="t")} FROM c""",
        "quality_flags": f"""WITH {_CHECKED}, c AS (SELECT uid, {clean("text")} AS t FROM texts)
            SELECT uid, t IS NULL AS is_null, coalesce({tokens("t")} < 5, TRUE) AS too_short FROM c""",
        "flag_corpus": f"WITH {_FLAGGED} SELECT uid, label, is_duplicated, is_null, too_short FROM flagged",
        "clean_corpus": f"WITH {_FLAGGED} SELECT {_CLEAN_COLUMNS} FROM good",
        "dataset_counts": f"WITH {_NORMALIZED} SELECT dataset_name, count(*) AS n_rows FROM merged GROUP BY 1",
        "label_counts": f"WITH {_NORMALIZED} SELECT label, count(*) AS n_rows FROM merged GROUP BY 1",
        "label_counts_by_dataset": f"""WITH {_NORMALIZED}
            SELECT dataset_name, label, count(*) AS n_rows FROM normalized GROUP BY 1, 2""",
        "dataset_stats": f"""WITH {_NORMALIZED}
            SELECT dataset_name, count(*) AS normalized_rows, count(text) AS merged_rows, FALSE AS is_total
            FROM normalized GROUP BY 1
            UNION ALL SELECT NULL, count(*), count(text), TRUE FROM normalized""",
        "url_audit": f"""WITH {_NORMALIZED},
            before AS (SELECT dataset_name, count(url_claim) AS urls_before FROM stacked GROUP BY 1),
            after AS (SELECT dataset_name, count(url_claim) AS urls_after, count(url_review) = 0 AS no_review_url
                      FROM normalized GROUP BY 1)
            SELECT * FROM before JOIN after USING (dataset_name)""",
        "stage_audit": f"""WITH {_FLAGGED}
            SELECT 'files_scanned' AS stage, 4 AS n_rows
            UNION ALL SELECT 'normalized', count(*) FROM normalized
            UNION ALL SELECT 'null_text_removed', count(*) FROM normalized WHERE text IS NULL
            UNION ALL SELECT 'merged', count(*) FROM merged
            UNION ALL SELECT 'labelled', count(*) FROM labelled
            UNION ALL SELECT 'clean', count(*) FROM good""",
        "preview": f"WITH {_NORMALIZED} SELECT uid, dataset_name, label, text FROM merged ORDER BY uid LIMIT 5",
        "review_enrich": f"""WITH {_CHECKED}, {_REVIEWS}
            SELECT uid, text, url_claim, url_review, factcheck_rating, factcheck_claimant, factcheck_url
            FROM texts LEFT JOIN answers ON query = text ORDER BY uid""",
        "unify_urls": f"""WITH {_CHECKED}
            SELECT text, coalesce(url_review, url_claim) AS url_review, uid AS row_key FROM texts""",
        "near_duplicates": f"""WITH src AS (SELECT doc_id AS id, coalesce(text, '') AS body FROM documents), {_near("src")}
            SELECT least AS id_a, rep AS id_b, CAST(band AS INTEGER) AS band FROM groups WHERE least < rep""",
        "near_dup_verified": f"""WITH src AS (SELECT doc_id AS id, coalesce(text, '') AS body FROM documents), {_near("src")}, {_VERIFIED}
            SELECT * FROM verified WHERE jaccard >= 0.7""",
        "near_dup_lists": f"""WITH src AS (SELECT doc_id AS id, coalesce(text, '') AS body FROM documents), {_near("src")}, {_MEMBERS}, {_LISTS}
            SELECT id AS doc_id, text_id, near_duplicate_groups, near_duplicates FROM members LEFT JOIN lists ON a = text_id""",
        "whole_run": f"""WITH {_FLAGGED}, src AS (SELECT uid AS id, text_clean AS body FROM good), {_near("src")}, {_MEMBERS},
            {_REVIEWS}, final AS (SELECT {_CLEAN_COLUMNS}, uid AS k FROM good)
            SELECT f.* EXCLUDE (k, uid, url_claim) REPLACE (coalesce(url_review, url_claim) AS url_review),
                   text_id, near_duplicate_groups, factcheck_rating, factcheck_claimant, factcheck_url
            FROM final f JOIN members ON id = k LEFT JOIN answers ON query = text""",
    }
