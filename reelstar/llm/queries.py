"""Registered queries of the corpus operators: each applies its operator with
production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontamination import contamination
from .embedding_dedup import embedding_dedup
from .license_scan import TEMPLATES, THRESHOLD, WINDOW_LINES, license_scan
from .line_dedup import line_dedup
from .packing import pack, word_tokenizer
from .periodic_runs import periodic_runs
from .quality_rules import quality_rules, trusted_rows_of
from .secret_scan import secret_scan
from .sentencepiece_codec import encode_texts, model_bytes
from .simhash_dedup import simhash_groups
from .spelling_variants import spelling_variants
from .token_counts import token_counts
from .url_filter import url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = word_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return pack(table(spark, sf_dir, "documents"), tokenizer)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    return encode_texts(table(spark, sf_dir, "documents"), model, keep=["doc_id"])


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts(table(spark, sf_dir, "documents"), model, keep=["doc_id"])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is a file ``source/lang/<doc_id by hundreds>/<doc_id>``."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"),
                       F.col("doc_id").cast("string"))
    return license_scan(docs.select("doc_id", "text", path.alias("path")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = trusted_rows_of(table(spark, sf_dir, "labels"))
    return quality_rules(table(spark, sf_dir, "documents"), trusted, keep=["doc_id"])


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages")).drop("component")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_near_items")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), keep=["doc_id"], tail_id="doc_id").drop("runs")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_secret_scan": op2_secret_scan,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_decontamination": op11_decontamination,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_periodic_runs": op13_periodic_runs,
}


def _license_sql() -> str:
    given = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))  # no quote in them
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = "regexp_extract_all(" + low + r", '[a-z0-9\x{{80}}-\x{{10FFFF}}]+')"
    return f"""
        WITH given(template, license, body) AS (VALUES {given}),
        terms AS (
            SELECT template, license, term, 1 + ln(count(*)) AS tf
            FROM (SELECT template, license, unnest({words.format('body')}) AS term FROM given)
            GROUP BY ALL),
        docs AS (
            SELECT doc_id, concat_ws('/', source, lang, doc_id // 100, doc_id) AS path,
                   concat_ws('/', source, lang, doc_id // 100) AS folder, coalesce(text, '') AS body
            FROM documents),
        held AS (SELECT DISTINCT doc_id, unnest({words.format('body')}) AS term FROM docs),
        idf AS (
            SELECT term, ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + count(doc_id))) + 1 AS idf
            FROM (SELECT term FROM terms UNION SELECT term FROM held) LEFT JOIN held USING (term) GROUP BY term),
        raw AS (SELECT template, license, term, tf * idf AS w FROM terms JOIN idf USING (term)),
        weights AS (
            SELECT template, license, term, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS weight FROM raw),
        cut AS (SELECT doc_id, string_split(body, chr(10)) AS ls FROM docs),
        units AS (
            SELECT doc_id, first, n_lines, array_to_string(list_slice(ls, first + 1, first + n_lines), chr(10)) AS body
            FROM (SELECT doc_id, ls, first, unnest(range(1, least({WINDOW_LINES}, len(ls) - first) + 1)) AS n_lines
                  FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS first FROM cut))
            UNION ALL SELECT doc_id, -1, 0, body FROM docs),
        vectors AS (
            SELECT doc_id, first, n_lines, term, (1 + ln(count(*))) * any_value(idf) AS w
            FROM (SELECT doc_id, first, n_lines, unnest({words.format('body')}) AS term FROM units) JOIN idf USING (term)
            GROUP BY doc_id, first, n_lines, term),
        norms AS (SELECT doc_id, first, n_lines, sqrt(sum(w * w)) AS norm FROM vectors GROUP BY ALL),
        scored AS (
            SELECT v.doc_id, v.first, v.n_lines, license, round(sum(w * weight) / any_value(norm), 6) AS score
            FROM vectors v JOIN weights USING (term)
            JOIN norms n ON v.doc_id = n.doc_id AND v.first = n.first AND v.n_lines = n.n_lines
            GROUP BY v.doc_id, v.first, v.n_lines, template, license),
        good AS (SELECT * FROM scored WHERE score >= {THRESHOLD}),
        found AS (SELECT DISTINCT doc_id, first, n_lines FROM good WHERE first >= 0),
        least_ones AS (
            SELECT doc_id, count(*) AS n_notices FROM found f
            WHERE NOT EXISTS (
                SELECT 1 FROM found g WHERE g.doc_id = f.doc_id AND g.first >= f.first
                AND g.first + g.n_lines <= f.first + f.n_lines AND g.n_lines < f.n_lines)
            GROUP BY doc_id),
        own AS (
            SELECT doc_id, any_value(n_notices) AS n_notices,
                   min((-score, license)) AS best, min((-score, license)) FILTER (first < 0) AS file
            FROM good LEFT JOIN least_ones USING (doc_id) GROUP BY doc_id),
        licensed AS (
            SELECT folder AS at, min(file)[2] AS license FROM own JOIN docs USING (doc_id)
            WHERE file IS NOT NULL GROUP BY folder),
        near AS (
            SELECT d.folder, max((length(l.at), l.at, l.license)) AS near
            FROM (SELECT DISTINCT folder FROM docs) d
            JOIN licensed l ON d.folder = l.at OR starts_with(d.folder, l.at || '/')
            GROUP BY d.folder)
        SELECT d.doc_id, d.path, coalesce(n_notices, 0) AS n_notices, best[2] AS own_license,
               -best[1] AS own_score, file IS NOT NULL AS is_license_file,
               coalesce(best[2], near[3]) AS license,
               CASE WHEN best IS NULL THEN near[2] END AS inherited_from
        FROM docs d LEFT JOIN own o ON d.doc_id = o.doc_id LEFT JOIN near n ON d.folder = n.folder
    """


ORACLE_SQL = {
    "op6_license_scan": _license_sql(),
    "op4_line_dedup": """
        WITH docs AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        spread AS (
            SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM docs),
        keyed AS (
            SELECT doc_id, pos, line,
                   translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM spread),
        shared AS (
            SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
            GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
        marked AS (
            SELECT y.doc_id, y.pos, y.line, s.k IS NOT NULL AND y.doc_id <> s.keeper AS dropped
            FROM keyed y LEFT JOIN shared s ON y.k = s.k)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    # The given pages hold no canonical link and no redirect, so every address
    # is a component of its own; a page's aliases are its other spellings (no path has dot segments).
    "op10_url_filter": r"""
        WITH rules(verdict, rhost, rpath) AS (
            VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                   ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
        rests AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
            FROM pages),
        parts AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
                   array_to_string(list_filter(
                       string_split(coalesce(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), ''), '&'),
                       lambda x: x <> '' AND NOT regexp_matches(x, '^(utm(_[a-z]+)?|gclid|fbclid)(=|$)')), '&') AS query
            FROM rests),
        spots AS (
            SELECT DISTINCT host, path, query,
                   CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') ||
                       regexp_replace(regexp_replace(path, '(\.html?|/)$', ''), '/(index)?$', '') ||
                       CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS node
            FROM parts),
        fits AS (
            SELECT s.host, s.path, r.verdict, r.rhost || r.rpath AS rule,
                   row_number() OVER (PARTITION BY s.host, s.path ORDER BY length(r.rhost || r.rpath) DESC) AS nth
            FROM (SELECT DISTINCT host, path FROM parts) s JOIN rules r
              ON (s.host = r.rhost OR s.host LIKE '%.' || r.rhost) AND starts_with(s.path, r.rpath)),
        best AS (SELECT host, path, verdict, rule FROM fits WHERE nth = 1),
        spread AS (
            SELECT node, bool_or(verdict = 'allow') AS allowed FROM spots JOIN best USING (host, path) GROUP BY node)
        SELECT p.page_id, p.host, p.path, b.rule,
               coalesce(b.verdict, CASE WHEN a.allowed THEN 'allow' WHEN NOT a.allowed THEN 'block' END, 'allow') AS verdict
        FROM parts p
        LEFT JOIN best b ON p.host = b.host AND p.path = b.path
        LEFT JOIN spots s ON p.host = s.host AND p.path = s.path AND p.query = s.query
        LEFT JOIN spread a ON s.node = a.node
    """,
    # Windows start from their word that is rarest in the table; every other word
    # must stand in its place, or for the proximity matches within two of it.
    "op11_decontamination": r"""
        WITH docs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents),
        stands AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS p FROM docs),
        items AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark),
        cut AS (
            SELECT DISTINCT item, list_slice(words, k + 1, k + 10) AS ws
            FROM (SELECT item, words, unnest(range(greatest(len(words) - 10, 0) + 1)) AS k
                  FROM items WHERE len(words) > 0)),
        windows AS (SELECT row_number() OVER () AS win, item, ws, len(ws) AS n FROM cut),
        terms AS (SELECT win, item, n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM windows),
        df AS (SELECT w, count(*) AS c FROM stands GROUP BY w),
        anchors AS (
            SELECT win, arg_min(w, (c, i)) AS w, arg_min(i, (c, i)) AS i
            FROM terms JOIN df USING (w) GROUP BY win HAVING count(*) = any_value(n)),
        starts AS (
            SELECT DISTINCT a.win, stands.r, stands.p - a.i + s.s AS p0
            FROM anchors a JOIN stands ON stands.w = a.w, (SELECT unnest(range(-2, 3)) AS s) s),
        found AS (
            SELECT s.win, t.item, t.n, s.r, s.p0, count(DISTINCT t.i) FILTER (stands.p = s.p0 + t.i) = t.n AS exact
            FROM starts s JOIN terms t ON s.win = t.win
            JOIN stands ON stands.r = s.r AND stands.w = t.w AND stands.p BETWEEN s.p0 + t.i - 2 AND s.p0 + t.i + 2
            GROUP BY s.win, t.item, t.n, s.r, s.p0 HAVING count(DISTINCT t.i) = t.n),
        hit AS (
            SELECT r, count(DISTINCT p) AS n_hit
            FROM (SELECT r, unnest(range(p0, p0 + n)) AS p FROM found WHERE exact) GROUP BY r),
        by_item AS (
            SELECT r, count(*) AS n_near_items, count(*) FILTER (exact) AS n_items,
                   sha256(coalesce(string_agg(item, ',' ORDER BY item) FILTER (exact), '')) AS items_sha256
            FROM (SELECT r, item, bool_or(exact) AS exact FROM found GROUP BY r, item) GROUP BY r)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
        FROM docs LEFT JOIN hit USING (r) LEFT JOIN by_item USING (r)
    """,
}
