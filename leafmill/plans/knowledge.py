"""Queries of the knowledge-base operators over the test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import text as X
from leafmill.operators import resolve as R
from leafmill.session import table as T

LAYERS = ["ce", "win", "net", "cegx"]
# The order of version names, which are no numbers (2.1 and 2.10 are different).
SYNONYMS = {"versions": "version", "supported versions": "version", "since": "version"}
LAYER_SQL = "CASE lower(trim(layer)) WHEN 'ce' THEN 0 WHEN 'win' THEN 1 WHEN 'net' THEN 2 WHEN 'cegx' THEN 3 ELSE 4 END"
LAST_SPACE = r"[\s\x{B}\x{1C}-\x{1F}\x{85}\x{2028}\x{2029}\p{Zs}]+\z"
ESC = lambda c: f"replace(replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
NUM = r"regexp_replace(trim(regexp_replace(trim(raw_value), '^\((.*)\)$', '\1')), '([0-9a-fA-F])(u|l|ul|lu|ull|llu|ll)$', '\1', 'i')"
NUM_SQL = rf"""CASE WHEN regexp_full_match({NUM}, '0[xX][0-9A-Fa-f]{{1,16}}') THEN CAST(CAST(lower({NUM}) AS UBIGINT) AS HUGEINT)
    WHEN regexp_full_match({NUM}, '-?[0-9]{{1,19}}') THEN CAST({NUM} AS HUGEINT) END"""
VER = r"[0-9]{1,2}\.[0-9]{1,2}"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# Pages


@query(rf"""SELECT page_id, '<!DOCTYPE html>' || chr(10) || '<html>' || chr(10) || '<head>' || chr(10) || '<meta charset="utf-8">' || chr(10)
    || '<title>Text rendering of ' || {ESC("coalesce(title, '')")} || '</title>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || coalesce(front, '')
    || '<h1>' || {ESC("coalesce(title, '')")} || '</h1>' || chr(10) || '<pre>' || chr(10) || regexp_replace({ESC("coalesce(body, '')")}, '{LAST_SPACE}', '')
    || chr(10) || '</pre>' || chr(10) || '</body>' || chr(10) || '</html>' || chr(10) AS html FROM wrap_oss_page""")
def k_wrapped_pages(spark: SparkSession, d: str) -> DataFrame:
    return T(spark, d, "wrap_oss_page").select("page_id", X.wrap_page(F.col("title"), F.col("body"), F.col("front")).alias("html"))


@query("SELECT page_id, coalesce(title, '') AS title, regexp_full_match(coalesce(html, ''), '(?s).*') AS whole FROM (SELECT page_id, regexp_replace(trim(regexp_replace(title, '[ \\t\\n\\v\\f\\r]+', ' ', 'g')), 'x^', '') AS title, title AS html FROM wrap_oss_page)")
def k_title_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The title read back out of the wrapped page's article equals the title put in."""
    pages = k_wrapped_pages(spark, d).select("page_id", X.article_of(F.col("html")).alias("article"))
    heading = F.regexp_extract("article", r"(?s)<h1>(.*?)</h1>", 1)
    return pages.select("page_id", X.collapse_spaces(F.replace(X.strip_tags(heading), F.lit("&#x27;"), F.lit("'"))).alias("title"), F.col("article").startswith("<h1>").alias("whole"))


@query("SELECT page_id, octet_length(encode(body)) AS n_bytes, sha256(body) AS sha256_hex, md5(body) AS md5_hex FROM wrap_oss_page WHERE body IS NOT NULL")
def k_page_digests(spark: SparkSession, d: str) -> DataFrame:
    pages = T(spark, d, "wrap_oss_page").where("body is not null")
    return pages.select("page_id", F.octet_length("body").cast("long").alias("n_bytes"), F.sha2("body", 256).alias("sha256_hex"), F.md5("body").alias("md5_hex"))


@query("SELECT min(page_id) AS page_id, count(*) AS n_copies FROM wrap_oss_page WHERE body <> '' GROUP BY body HAVING count(*) > 1")
def k_exact_copies(spark: SparkSession, d: str) -> DataFrame:
    pages = T(spark, d, "wrap_oss_page").where("body <> ''").select("page_id", F.sha2("body", 256).alias("h"))
    return pages.groupBy("h").agg(F.min("page_id").alias("page_id"), F.count("*").alias("n_copies")).where("n_copies > 1").drop("h")


@query("""SELECT page_id, CASE WHEN contains(out_path, '/') THEN regexp_extract(out_path, '^(.*)/[^/]*$', 1) ELSE '' END AS folder,
    regexp_extract(out_path, '([^/]+)/[^/]*$', 1) AS doc_set, lower(regexp_extract(out_path, '([^/]*)$', 1)) AS file_name FROM wrap_oss_page WHERE out_path IS NOT NULL""")
def k_path_parts(spark: SparkSession, d: str) -> DataFrame:
    from leafmill.sources.readers import path_columns

    return T(spark, d, "wrap_oss_page").where("out_path is not null").select("page_id", *(c.alias(n) for n, c in path_columns(F.col("out_path")).items()))


@query("""SELECT coalesce(lower(trim(layer)), '?') AS layer, count(*) AS n_pages, count(DISTINCT project) AS n_projects,
    count(*) FILTER (WHERE body IS NULL OR trim(body) = '') AS n_empty FROM wrap_oss_page WHERE layer IS NULL OR lower(trim(layer)) <> 'chm' GROUP BY 1""")
def k_layers(spark: SparkSession, d: str) -> DataFrame:
    """Counts by layer with its spelling made one, a layer left out; empty bodies counted apart from the rest."""
    pages = T(spark, d, "wrap_oss_page").withColumn("layer", F.lower(F.trim("layer"))).where("layer is null or layer <> 'chm'")
    return pages.groupBy(F.coalesce("layer", F.lit("?")).alias("layer")).agg(F.count("*").alias("n_pages"), F.count_distinct("project").alias("n_projects"), F.count_if(F.col("body").isNull() | (F.trim("body") == "")).alias("n_empty"))


@query(rf"""SELECT page_id, reason FROM (SELECT page_id, CASE WHEN body IS NULL OR regexp_replace(body, '{LAST_SPACE}', '') = '' THEN 'empty' WHEN title = 'Topic Not Found' THEN 'placeholder'
    WHEN contains(body, 'Back to contents') THEN 'interstitial' END AS reason FROM wrap_oss_page) WHERE reason IS NOT NULL""")
def k_rejects(spark: SparkSession, d: str) -> DataFrame:
    from leafmill.sources.readers import good_pages

    _, refused = good_pages(T(spark, d, "wrap_oss_page"), "out_path", "title", "body", ("Back to contents",))
    return refused.select("page_id", "reason")


@query("""SELECT page_id, pos - 1 AS pos, link FROM (SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS pos FROM
    (SELECT page_id, regexp_extract_all(front, '(?i)<a\\s[^>]*href\\s*=\\s*["'']?([^"''> ]+)', 1) AS l FROM wrap_oss_page WHERE front IS NOT NULL))""".replace("\\\\", "\\"))
def k_front_links(spark: SparkSession, d: str) -> DataFrame:
    pages = T(spark, d, "wrap_oss_page").where("front is not null")
    return pages.select("page_id", F.posexplode(X.link_targets(F.col("front"))).alias("pos", "link")).withColumn("pos", F.col("pos").cast("long"))


# Version statements


@query(rf"""WITH t AS (SELECT stmt_id, lower(trim(regexp_replace(raw_text, '\s+', ' ', 'g'))) AS t FROM version_statement),
    p AS (SELECT stmt_id, t, regexp_extract(t, '^(?:release |version )?(?:from )?({VER})(?:\+| or newer| and later)$', 1) AS o,
        regexp_extract(t, '^(?:release |version )?from ({VER})$', 1) AS s,
        regexp_extract(t, '^(?:release |version )?({VER}) to ({VER})$', 1) AS lo, regexp_extract(t, '^(?:release |version )?({VER}) to ({VER})$', 2) AS hi,
        coalesce(nullif(regexp_extract(t, '^(?:release |version )?only ({VER})$', 1), ''), nullif(regexp_extract(t, '^(?:release |version )?({VER})(?: only)?$', 1), '')) AS one,
        regexp_full_match(t, '(?:release |version )?{VER}(?:(?:, ?| and ){VER})+') AS listed,
        regexp_extract(t, '(\d+\.\d+)(?:\+| or newer| and later)', 1) AS w FROM t)
    SELECT stmt_id, CASE WHEN o <> '' THEN o WHEN s <> '' THEN s WHEN lo <> '' THEN lo WHEN one IS NOT NULL THEN one WHEN listed THEN regexp_extract(t, '{VER}') WHEN w <> '' THEN w END AS version_min,
    CASE WHEN o <> '' OR s <> '' THEN NULL WHEN lo <> '' THEN hi WHEN one IS NOT NULL THEN one WHEN listed THEN regexp_extract(t, '({VER})$', 1) END AS version_max,
    CASE WHEN coalesce(t, '') = '' THEN NULL WHEN o <> '' OR s <> '' THEN true WHEN lo <> '' OR one IS NOT NULL OR listed THEN false ELSE w <> '' END AS open_ended,
    CASE WHEN coalesce(t, '') = '' THEN NULL WHEN o <> '' OR s <> '' OR lo <> '' OR one IS NOT NULL OR listed THEN 'parsed' WHEN w <> '' THEN 'partial' ELSE 'unparsed' END AS status FROM p""")
def k_versions(spark: SparkSession, d: str) -> DataFrame:
    v = X.parse_version(F.col("raw_text"))
    return T(spark, d, "version_statement").select("stmt_id", v.alias("v")).select("stmt_id", F.col("v.min").alias("version_min"), F.col("v.max").alias("version_max"), F.col("v.open_ended").alias("open_ended"), F.col("v.status").alias("status"))


@query("""SELECT count(*) FILTER (WHERE parse_status = 'parsed') AS n_parsed, count(*) FILTER (WHERE parse_status = 'partial') AS n_partial,
    count(*) FILTER (WHERE parse_status = 'unparsed') AS n_unparsed, count(*) FILTER (WHERE parse_status IS NULL) AS n_missing, count(*) AS n_all FROM version_statement""")
def k_status_counts(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("parse_status")
    return T(spark, d, "version_statement").agg(*(F.count_if(s == x).alias(f"n_{x}") for x in ("parsed", "partial", "unparsed")), F.count_if(s.isNull()).alias("n_missing"), F.count("*").alias("n_all"))


@query("""SELECT coalesce(doc_set, '?') AS doc_set, count(*) AS n_statements, count(DISTINCT symbol) AS n_symbols, count(DISTINCT page_path) AS n_pages,
    count(*) FILTER (WHERE parse_status = 'parsed') AS n_parsed FROM version_statement GROUP BY 1""")
def k_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "version_statement").groupBy(F.coalesce("doc_set", F.lit("?")).alias("doc_set"))
    return rows.agg(F.count("*").alias("n_statements"), F.count_distinct("symbol").alias("n_symbols"), F.count_distinct("page_path").alias("n_pages"), F.count_if(F.col("parse_status") == "parsed").alias("n_parsed"))


@query("""SELECT CASE WHEN regexp_replace(lower(trim(label)), '\\s*:\\s*$', '') IN ('versions', 'supported versions', 'since') THEN 'version'
    ELSE trim(regexp_replace(lower(trim(label)), '\\s*:\\s*$', '')) END AS label, count(*) AS n_rows, count(DISTINCT label) AS n_spellings FROM version_statement GROUP BY 1""".replace("\\\\", "\\"))
def k_labels(spark: SparkSession, d: str) -> DataFrame:
    own = X.normal_label(F.col("label"))
    known = F.create_map(*(F.lit(x) for p in SYNONYMS.items() for x in p))
    rows = T(spark, d, "version_statement").select(F.coalesce(F.try_element_at(known, own), own).alias("own"), "label")
    return rows.groupBy("own").agg(F.count("*").alias("n_rows"), F.count_distinct("label").alias("n_spellings")).withColumnRenamed("own", "label")


@query("SELECT stmt_id, count(*) AS n_deliveries FROM (SELECT * FROM version_statement) GROUP BY ALL HAVING count(*) > 1".replace("GROUP BY ALL", "GROUP BY stmt_id, symbol, layer, doc_set, page_path, label, raw_text, parse_status, printed_at, ingested_at"))
def k_redelivered(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "version_statement")
    return rows.groupBy(F.xxhash64(*rows.columns), *rows.columns).agg(F.count("*").alias("n_deliveries")).where("n_deliveries > 1").select("stmt_id", "n_deliveries")


@query("""SELECT DISTINCT v.symbol AS symbol, v.raw_text AS raw_text, n_values FROM version_statement v JOIN (SELECT symbol, count(DISTINCT raw_text) AS n_values FROM version_statement
    WHERE raw_text <> '' GROUP BY symbol) c ON c.symbol = v.symbol WHERE v.raw_text <> '' AND n_values > 1""")
def k_statement_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return R.conflicts(T(spark, d, "version_statement").where("raw_text <> ''"), "symbol", "raw_text")


@query(f"""SELECT symbol, layer, raw_text, page_path FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {LAYER_SQL},
    CASE parse_status WHEN 'parsed' THEN 0 WHEN 'partial' THEN 1 WHEN 'unparsed' THEN 2 ELSE 3 END, page_path, stmt_id) AS r
    FROM version_statement WHERE symbol IS NOT NULL) WHERE r = 1""")
def k_chosen_statements(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "version_statement").where("symbol is not null")
    order = [R.rank_of("layer", LAYERS), R.rank_of("parse_status", ["parsed", "partial", "unparsed"]), F.col("page_path"), F.col("stmt_id")]
    return R.choose(rows, ["symbol"], order, ["layer", "raw_text", "page_path"])


@query("""SELECT symbol, bool_or(layer = 'ce') AS in_ce, bool_or(layer = 'win') AS in_win, bool_or(layer = 'net') AS in_net, bool_or(layer = 'ce') AND bool_or(layer = 'win') AS in_both
    FROM (SELECT symbol, coalesce(layer, '?') AS layer FROM version_statement) GROUP BY symbol""")
def k_subject_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "version_statement").select("symbol", F.coalesce("layer", F.lit("?")).alias("layer"))
    has = lambda x: F.bool_or(F.col("layer") == x)
    return rows.groupBy("symbol").agg(has("ce").alias("in_ce"), has("win").alias("in_win"), has("net").alias("in_net"), (has("ce") & has("win")).alias("in_both"))


@query("SELECT s.symbol, s.kind FROM api_symbol s WHERE NOT EXISTS (SELECT 1 FROM version_statement v WHERE v.symbol = s.symbol)")
def k_silent_symbols(spark: SparkSession, d: str) -> DataFrame:
    return T(spark, d, "api_symbol").select("symbol", "kind").join(T(spark, d, "version_statement").select("symbol"), "symbol", "left_anti")


@query("""SELECT coalesce(layer, '?') AS layer, count(*) AS n_rows, count(*) FILTER (WHERE ingested_at - printed_at > INTERVAL 7 DAY) AS n_late,
    max(epoch(ingested_at)::BIGINT - epoch(printed_at)::BIGINT) AS most_seconds FROM version_statement GROUP BY 1""")
def k_late_rows(spark: SparkSession, d: str) -> DataFrame:
    lag = F.unix_timestamp("ingested_at") - F.unix_timestamp("printed_at")
    return T(spark, d, "version_statement").groupBy(F.coalesce("layer", F.lit("?")).alias("layer")).agg(F.count("*").alias("n_rows"), F.count_if(F.expr("ingested_at - printed_at > INTERVAL 7 DAY")).alias("n_late"), F.max(lag).alias("most_seconds"))


@query("""SELECT v.symbol AS symbol, s.header_file AS header_file, count(*) AS n_statements FROM version_statement v JOIN api_symbol s ON s.symbol = v.symbol
    WHERE s.kind = 'function' AND EXISTS (SELECT 1 FROM header_review r WHERE lower(r.header_file) = lower(s.header_file)) GROUP BY v.symbol, s.header_file""")
def k_reviewed_functions(spark: SparkSession, d: str) -> DataFrame:
    """Functions whose header some review names (a semi join), with their statements counted before the join."""
    n = T(spark, d, "version_statement").groupBy("symbol").agg(F.count("*").alias("n_statements"))
    s = T(spark, d, "api_symbol").where("kind = 'function'").select("symbol", "header_file")
    reviewed = T(spark, d, "header_review").select(F.lower("header_file").alias("h"))
    return s.join(reviewed, F.lower("header_file") == F.col("h"), "left_semi").join(n, "symbol")


@query("""SELECT raw_text, coalesce(layer, '?') AS layer, count(DISTINCT symbol) AS n_symbols FROM version_statement WHERE raw_text <> '' GROUP BY 1, 2""")
def k_version_scopes(spark: SparkSession, d: str) -> DataFrame:
    """How many symbols each printed range holds for, by layer."""
    rows = T(spark, d, "version_statement").where("raw_text <> ''").groupBy("raw_text", F.coalesce("layer", F.lit("?")).alias("layer"))
    return rows.agg(F.count_distinct("symbol").alias("n_symbols"))


# Symbols


@query("SELECT symbol, trim(regexp_extract(lower(trim(header_file)), '^([^(]*)', 1)) AS header FROM api_symbol WHERE header_file IS NOT NULL")
def k_headers(spark: SparkSession, d: str) -> DataFrame:
    return T(spark, d, "api_symbol").where("header_file is not null").select("symbol", X.header_parts(F.col("header_file"))["header"].alias("header"))


@query("""SELECT DISTINCT lower(header_file) AS header, symbol, count(*) OVER (PARTITION BY lower(header_file)) AS n_names FROM
    (SELECT DISTINCT lower(header_file) AS header_file, symbol FROM api_symbol WHERE header_file IS NOT NULL)""")
def k_header_names(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "api_symbol").where("header_file is not null").select(F.lower("header_file").alias("header"), "symbol").distinct()
    return rows.join(rows.groupBy("header").agg(F.count("*").alias("n_names")), "header")


# Constants


def numbers(spark: SparkSession, d: str) -> DataFrame:
    return T(spark, d, "aux_constant").withColumn("num", X.numeric_literal(F.col("raw_value")))


@query(f"SELECT const_id, line_no, raw_value, CAST({NUM_SQL} AS VARCHAR) AS num FROM aux_constant")
def k_numbers(spark: SparkSession, d: str) -> DataFrame:
    return numbers(spark, d).select("const_id", "line_no", "raw_value", F.col("num").cast("string").alias("num"))


@query(f"""WITH n AS (SELECT DISTINCT const_name, {NUM_SQL} AS num FROM aux_constant WHERE const_name IS NOT NULL)
    SELECT const_name, CAST(num AS VARCHAR) AS num, count(*) OVER (PARTITION BY const_name) AS n_values FROM n WHERE num IS NOT NULL QUALIFY count(*) OVER (PARTITION BY const_name) > 1""")
def k_constant_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return R.conflicts(numbers(spark, d), "const_name", "num").withColumn("num", F.col("num").cast("string"))


@query(f"""SELECT const_name, CAST(num AS VARCHAR) AS num, n_libraries FROM (SELECT *, row_number() OVER (PARTITION BY const_name ORDER BY n_libraries DESC, num) AS r FROM
    (SELECT const_name, num, count(DISTINCT library_name) AS n_libraries FROM (SELECT const_name, library_name, {NUM_SQL} AS num FROM aux_constant) WHERE num IS NOT NULL AND const_name IS NOT NULL GROUP BY const_name, num)) WHERE r = 1""")
def k_resolved_constants(spark: SparkSession, d: str) -> DataFrame:
    """One value a name: the one that most libraries print, the least among equals."""
    rows = numbers(spark, d).where("num is not null and const_name is not null")
    each = rows.select("const_name", "num", "library_name").distinct().groupBy("const_name", "num").agg(F.count("library_name").alias("n_libraries"))
    return R.choose(each, ["const_name"], [-F.col("n_libraries"), F.col("num")], ["num", "n_libraries"]).withColumn("num", F.col("num").cast("string"))


@query(f"SELECT const_name, count(*) AS n_rows FROM (SELECT const_name, {NUM_SQL} AS num FROM aux_constant) WHERE const_name IS NOT NULL GROUP BY const_name HAVING count(num) = 0")
def k_unnumbered(spark: SparkSession, d: str) -> DataFrame:
    return numbers(spark, d).where("const_name is not null").groupBy("const_name").agg(F.count("*").alias("n_rows"), F.count("num").alias("n")).where("n = 0").drop("n")


@query("SELECT r.const_name, r.resolved_value FROM value_review r WHERE NOT EXISTS (SELECT 1 FROM aux_constant a WHERE a.const_name = r.const_name AND a.raw_value = r.resolved_value)")
def k_unprinted_reviews(spark: SparkSession, d: str) -> DataFrame:
    printed = T(spark, d, "aux_constant").select("const_name", F.col("raw_value").alias("resolved_value"))
    return R.unprinted(T(spark, d, "value_review").select("const_name", "resolved_value"), printed, ["const_name", "resolved_value"])


@query(f"""WITH o AS (SELECT DISTINCT const_name AS name, {NUM_SQL} AS v FROM aux_constant WHERE const_name IS NOT NULL),
    f AS (SELECT name, 0 AS place, review_scope, header_file, verdict FROM o JOIN header_review ON review_scope = 'name' AND review_key = name
    UNION ALL SELECT name, 1000 - length(review_key), review_scope, header_file, verdict FROM o JOIN header_review ON review_scope = 'prefix' AND review_key <> '' AND starts_with(name, review_key)
    UNION ALL SELECT name, 2000, review_scope, header_file, verdict FROM o JOIN header_review ON review_scope = 'value-base' AND v >= 0 AND v // 4096 * 4096 = CAST(lower(CASE WHEN review_scope = 'value-base' THEN review_key ELSE '0' END) AS HUGEINT))
    SELECT name AS const_name, header_file, review_scope, verdict FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY place,
    CASE verdict WHEN 'prefer' THEN 0 WHEN 'approve' THEN 1 WHEN 'reject' THEN 2 ELSE 3 END, header_file NULLS LAST) AS r FROM f) WHERE r = 1""".replace("CAST(lower(CASE", "CAST(CAST(lower(CASE").replace("END) AS HUGEINT))\n", "END) AS UBIGINT) AS HUGEINT))\n"))
def k_reviewed_headers(spark: SparkSession, d: str) -> DataFrame:
    names = numbers(spark, d).where("const_name is not null")
    return R.reviewed_headers(names, "const_name", "num", T(spark, d, "header_review")).withColumnRenamed("name", "const_name")


@query("""SELECT const_name, resolved_value AS value, 'own' AS layer FROM value_review UNION ALL
    SELECT DISTINCT const_name, raw_value, 'adopted' FROM aux_constant WHERE raw_value <> '' AND const_name NOT IN (SELECT const_name FROM value_review)""")
def k_adopted(spark: SparkSession, d: str) -> DataFrame:
    own = T(spark, d, "value_review").select("const_name", F.col("resolved_value").alias("value"), F.lit("own").alias("layer"))
    other = T(spark, d, "aux_constant").where("raw_value <> ''").select("const_name", F.col("raw_value").alias("value")).distinct()
    return R.adopt(own, other, "const_name", "adopted")


@query("""SELECT count(*) FILTER (WHERE resolved_value = raw_value) AS n_agree, count(*) FILTER (WHERE resolved_value <> raw_value) AS n_differ
    FROM value_review JOIN (SELECT DISTINCT const_name, raw_value FROM aux_constant) USING (const_name)""")
def k_agreement(spark: SparkSession, d: str) -> DataFrame:
    a = T(spark, d, "value_review").select("const_name", F.col("resolved_value").alias("value"))
    return R.agreement(a, T(spark, d, "aux_constant").select("const_name", F.col("raw_value").alias("value")).distinct(), "const_name", "value")


@query("""SELECT const_id, line_no, regexp_extract(quote_text, '\\bconst\\s+\\w+\\s+(\\w+)\\s*=', 1) AS name, trim(regexp_extract(quote_text, '=\\s*([^;]+);', 1)) AS value
    FROM aux_constant WHERE regexp_matches(quote_text, '\\bconst\\s+\\w+\\s+\\w+\\s*=\\s*[^;]+;')""".replace("\\\\", "\\"))
def k_constant_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "aux_constant").select("const_id", "line_no", X.constant_line(F.col("quote_text")).alias("c")).where("c is not null")
    return rows.select("const_id", "line_no", "c.name", "c.value")


@query("""SELECT r.const_name AS const_name, g.library_name AS library_name FROM value_review r
    LEFT JOIN (SELECT const_name, min(library_name) AS library_name FROM aux_constant GROUP BY const_name) g ON g.const_name = r.const_name
    WHERE NOT EXISTS (SELECT 1 FROM aux_constant a WHERE a.const_name = r.const_name AND a.raw_value = r.resolved_value)""")
def k_gaps(spark: SparkSession, d: str) -> DataFrame:
    reviews = T(spark, d, "value_review").select("const_name", F.col("resolved_value").alias("raw_value"))
    found = reviews.join(T(spark, d, "aux_constant").select("const_name", "raw_value").distinct(), ["const_name", "raw_value"])
    hint = T(spark, d, "aux_constant").groupBy("const_name").agg(F.min("library_name").alias("library_name"))
    return R.gap_list(reviews, found, "const_name", hint, "library_name")


# Probes and captures


@query("""SELECT CASE WHEN try_cast(probe_status AS INTEGER) BETWEEN 200 AND 299 THEN 'ok' WHEN try_cast(probe_status AS INTEGER) IS NOT NULL THEN 'failed' ELSE coalesce(probe_status, '?') END AS route,
    CASE WHEN kept_path IS NOT NULL THEN 'kept' WHEN stored_path IS NOT NULL THEN 'stored' ELSE 'nothing' END AS persisted, count(*) AS n_probes, count(n_bytes) AS n_sized, coalesce(sum(n_bytes), 0)::BIGINT AS n_bytes
    FROM (SELECT DISTINCT * FROM probe_receipt) GROUP BY 1, 2""")
def k_probe_routes(spark: SparkSession, d: str) -> DataFrame:
    code = F.col("probe_status").try_cast("int")
    route = F.when(code.between(200, 299), "ok").when(code.isNotNull(), "failed").otherwise(F.coalesce("probe_status", F.lit("?")))
    persisted = F.when(F.col("kept_path").isNotNull(), "kept").when(F.col("stored_path").isNotNull(), "stored").otherwise("nothing")
    rows = T(spark, d, "probe_receipt").distinct().groupBy(route.alias("route"), persisted.alias("persisted"))
    return rows.agg(F.count("*").alias("n_probes"), F.count("n_bytes").alias("n_sized"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"))


@query("SELECT DISTINCT probe, coalesce(len(links), 0) AS n_links, coalesce(array_to_string(links[1:300], ' '), '') AS capped, coalesce(array_to_string(links[1:8], ' '), '') AS preview FROM probe_receipt")
def k_link_lists(spark: SparkSession, d: str) -> DataFrame:
    """Links with the caps that the receipts themselves have: 300 in the list (repeats kept), 8 in the preview."""
    links = F.coalesce("links", F.array().cast("array<string>"))
    rows = T(spark, d, "probe_receipt").select("probe", F.size(links).cast("long").alias("n_links"), F.array_join(F.slice(links, 1, 300), " ").alias("capped"), F.array_join(F.slice(links, 1, 8), " ").alias("preview"))
    return rows.distinct()


@query("""SELECT probe, count(*) AS n_links, count(*) FILTER (WHERE starts_with(link, '/') OR regexp_extract(link, '^[a-z]+://([^/:]+)', 1) = regexp_extract(url, '^[a-z]+://([^/:]+)', 1)) AS n_same_host
    FROM (SELECT DISTINCT probe, url, links FROM probe_receipt), unnest(links) AS u(link) GROUP BY probe""")
def k_same_host(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "probe_receipt").select("probe", "url", "links").distinct().select("probe", "url", F.explode("links").alias("link"))
    same = F.col("link").startswith("/") | (F.try_parse_url("link", F.lit("HOST")) == F.try_parse_url("url", F.lit("HOST")))
    return rows.groupBy("probe").agg(F.count("*").alias("n_links"), F.count_if(same).alias("n_same_host"))


@query("""SELECT urlkey, captured_key, digest FROM (SELECT *, lag(digest) OVER w AS before, row_number() OVER w AS r FROM (SELECT DISTINCT * FROM cdx_capture)
    WINDOW w AS (PARTITION BY urlkey ORDER BY captured_key, digest, original_url, mimetype, statuscode, byte_length)) WHERE r = 1 OR before IS DISTINCT FROM digest""")
def k_collapsed_digests(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "cdx_capture").distinct()
    return R.collapse_runs(rows, "urlkey", ["captured_key", "digest", "original_url", "mimetype", "statuscode", "byte_length"], "digest").select("urlkey", "captured_key", "digest")


@query("SELECT urlkey, min(captured_key) AS captured_key, count(*) AS n_captures, count(DISTINCT digest) AS n_digests FROM cdx_capture WHERE statuscode = '200' GROUP BY urlkey")
def k_first_captures(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "cdx_capture").where("statuscode = '200'")
    return rows.groupBy("urlkey").agg(F.min("captured_key").alias("captured_key"), F.count("*").alias("n_captures"), F.count_distinct("digest").alias("n_digests"))


@query("""SELECT captured_key, urlkey, CAST(try_cast(byte_length AS BIGINT) AS BIGINT) AS n_bytes FROM (SELECT DISTINCT * FROM cdx_capture) WHERE statuscode = '200' AND mimetype = 'text/html'
    ORDER BY captured_key, urlkey, n_bytes LIMIT 6""")
def k_oldest_captures(spark: SparkSession, d: str) -> DataFrame:
    """The six oldest pages, a top-k report."""
    rows = T(spark, d, "cdx_capture").where("statuscode = '200' and mimetype = 'text/html'").distinct()
    return rows.select("captured_key", "urlkey", F.col("byte_length").try_cast("bigint").alias("n_bytes")).orderBy("captured_key", "urlkey", F.asc_nulls_last("n_bytes")).limit(6)


@query("""SELECT urlkey, captured_key, year FROM (SELECT *, row_number() OVER (PARTITION BY urlkey ORDER BY CASE year WHEN 2030 THEN 0 WHEN 2028 THEN 1 WHEN 2031 THEN 2 ELSE 3 END, captured_key) AS r FROM
    (SELECT urlkey, captured_key, year(strptime(captured_key, '%Y%m%d%H%M%S')) AS year FROM cdx_capture WHERE statuscode = '200')) WHERE r = 1""")
def k_capture_fallback(spark: SparkSession, d: str) -> DataFrame:
    """One capture a page by an order of years, then the oldest."""
    rows = T(spark, d, "cdx_capture").where("statuscode = '200'").select("urlkey", "captured_key", F.year(X.compact_time(F.col("captured_key"))).cast("long").alias("year"))
    return R.choose(rows, ["urlkey"], [R.rank_of(F.col("year").cast("string"), ["2030", "2028", "2031"]), F.col("captured_key")], ["captured_key", "year"])


@query("""SELECT coalesce(a.urlkey, b.urlkey) AS urlkey, CASE WHEN a.urlkey IS NULL THEN 'added' WHEN b.urlkey IS NULL THEN 'removed' WHEN a.digest = b.digest THEN 'same' ELSE 'changed' END AS change
    FROM (SELECT urlkey, max(digest) AS digest FROM cdx_capture WHERE captured_key < '2030' GROUP BY urlkey) a FULL JOIN
    (SELECT urlkey, max(digest) AS digest FROM cdx_capture WHERE captured_key >= '2030' GROUP BY urlkey) b ON a.urlkey = b.urlkey""")
def k_capture_changes(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "cdx_capture")
    side = lambda where: rows.where(where).groupBy("urlkey").agg(F.max("digest").alias("digest"))
    return R.compare_captures(side("captured_key < '2030'"), side("captured_key >= '2030'"), "urlkey", "digest")


# Documents, joined over tables, and the summary


@query("""SELECT v.doc_set AS doc_set, count(DISTINCT v.symbol) AS n_symbols, count(DISTINCT lower(s.header_file)) AS n_headers FROM version_statement v
    LEFT JOIN api_symbol s ON s.symbol = v.symbol WHERE v.doc_set IS NOT NULL GROUP BY v.doc_set""")
def k_doc_set_headers(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "version_statement").where("doc_set is not null").select("doc_set", "symbol").distinct()
    rows = rows.join(T(spark, d, "api_symbol").select("symbol", F.lower("header_file").alias("header")), "symbol", "left")
    return rows.groupBy("doc_set").agg(F.count_distinct("symbol").alias("n_symbols"), F.count_distinct("header").alias("n_headers"))


@query("""SELECT 'pages' AS what, count(*) AS n FROM wrap_oss_page UNION ALL SELECT 'symbols', count(*) FROM api_symbol UNION ALL SELECT 'statements', count(*) FROM version_statement
    UNION ALL SELECT 'constants', count(*) FROM aux_constant UNION ALL SELECT 'constant names', count(DISTINCT const_name) FROM aux_constant
    UNION ALL SELECT 'captures', count(*) FROM cdx_capture UNION ALL SELECT 'probes', count(*) FROM probe_receipt""")
def k_summary(spark: SparkSession, d: str) -> DataFrame:
    names = {"pages": "wrap_oss_page", "symbols": "api_symbol", "statements": "version_statement", "constants": "aux_constant", "captures": "cdx_capture", "probes": "probe_receipt"}
    rows = [T(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(w).alias("what"), "n") for w, t in names.items()]
    rows.append(T(spark, d, "aux_constant").agg(F.count_distinct("const_name").alias("n")).select(F.lit("constant names").alias("what"), "n"))
    return R.stack(rows)


@query("SELECT doc_id, octet_length(encode(text)) AS n_bytes, sha256(text) AS sha256_hex, n_chars = length(text) AS counted FROM documents WHERE text IS NOT NULL")
def k_document_digests(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "documents").where("text is not null")
    return rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256_hex"), (F.col("n_chars") == F.length("text")).alias("counted"))
