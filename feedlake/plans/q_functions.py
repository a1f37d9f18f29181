"""Proof queries: scalar functions FN1-FN13."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..functions import dates
from ..operators.dictionary import stock_pairs_join
from ..sources import dictionaries
from ..sources.tables import table
from .registry import query

ZONE = "Asia/Shanghai"


@query("fn_intercept", """
SELECT doc_id,
  CASE WHEN length(text) > 300 THEN substring(text, 1, 300) WHEN length(text) < 300 THEN text ELSE '' END AS cut_ref,
  CASE WHEN length(text) > 300 THEN substring(text, 1, 300) ELSE text END AS cut_keep,
  CASE WHEN length(text) > n_chars % 400 THEN substring(text, 1, 200)
       WHEN length(text) < 200 THEN text ELSE '' END AS cut_200
FROM documents""")
def q_fn_intercept(spark, d):
    """FN1 both rules (reference: exact length -> ''; pipeline: keep)."""
    doc = table(spark, d, "documents")
    return doc.select(
        "doc_id",
        fn.intercept("text", 300, exact_len_empty=True).alias("cut_ref"),
        fn.intercept("text", 300).alias("cut_keep"),
        F.when(F.length("text") > F.col("n_chars") % 400, F.substring("text", 1, 200))
         .when(F.length("text") < 200, F.col("text")).otherwise(F.lit("")).alias("cut_200"))


@query("fn_before_first", """
SELECT doc_id, split_part(text, chr(10), 1) AS first_line,
       split_part(source, 'c', 1) AS src_head
FROM documents""")
def q_fn_before_first(spark, d):
    """FN2."""
    doc = table(spark, d, "documents")
    return doc.select("doc_id", fn.before_first("text", "\n").alias("first_line"),
                      fn.before_first("source", "c").alias("src_head"))


@query("fn_before_last", """
SELECT page_id,
  CASE WHEN strpos(url, '/') > 0 THEN left(url, length(url) - strpos(reverse(url), '/')) ELSE url END AS url_dir,
  CASE WHEN strpos(html, '. ') > 0
       THEN left(html, length(html) - strpos(reverse(html), ' .') - 1) ELSE html END AS html_before_last_sentence
FROM pages""")
def q_fn_before_last(spark, d):
    """FN3, single- and multi-char signs."""
    p = table(spark, d, "pages")
    return p.select("page_id", fn.before_last("url", "/").alias("url_dir"),
                    fn.before_last("html", ". ").alias("html_before_last_sentence"))


@query("fn_date_string", """
SELECT event_id,
  strftime(timezone('Asia/Shanghai', ts AT TIME ZONE 'UTC'), '%Y%m%d%H%M%S') AS date_cn,
  strftime(ts, '%Y%m%d%H%M%S') AS date_utc
FROM events""")
def q_fn_date_string(spark, d):
    """FN4: epoch ms -> yyyyMMddHHmmss in a given zone."""
    e = table(spark, d, "events")
    ms = fn.ntz_to_millis("ts")
    return e.select("event_id", fn.millis_to_string(ms, dates.FMT_TASK, ZONE).alias("date_cn"),
                    fn.millis_to_string(ms, dates.FMT_TASK, "UTC").alias("date_utc"))


@query("fn_to_millis", """
SELECT event_id,
  epoch_ms(timezone('Asia/Shanghai', strptime(strftime(ts, '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M'))) AS ms_action,
  epoch_ms(timezone('Asia/Shanghai', strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d'))) AS ms_day,
  epoch_ms(timezone('Asia/Shanghai', strptime(strftime(ts, '%Y年%m月%d日 %H:%M:%S'), '%Y年%m月%d日 %H:%M:%S'))) AS ms_cn,
  CAST(NULL AS BIGINT) AS ms_bad
FROM events""")
def q_fn_to_millis(spark, d):
    """FN5/FN6: the three fixed formats parsed as Asia/Shanghai wall clock;
    unparsable text -> NULL."""
    e = table(spark, d, "events")
    out = [F.col("event_id")]
    for name, fmt in [("ms_action", dates.FMT_ACTION), ("ms_day", dates.FMT_DAY), ("ms_cn", dates.FMT_CN)]:
        out.append(fn.string_to_millis(F.date_format("ts", fmt), fmt, ZONE).alias(name))
    out.append(fn.string_to_millis("props", dates.FMT_ACTION, ZONE).alias("ms_bad"))
    return e.select(*out)


@query("fn_last_segment", """
SELECT page_id, string_split(regexp_replace(url, '/+$', ''), '/')[-1] AS last_segment
FROM pages""")
def q_fn_last_segment(spark, d):
    """FN7."""
    p = table(spark, d, "pages")
    return p.select("page_id", fn.last_segment("url").alias("last_segment"))


@query("fn_query_param", """
SELECT page_id,
  CASE WHEN strpos(url, 'page=') > 0 THEN regexp_extract(url, 'page=([^&#]*)', 1) END AS page_param,
  CASE WHEN len(string_split(url, '.example.')) > 1 THEN string_split(url, '.example.')[2] END AS after_host,
  string_split(url, '?')[1] AS before_query
FROM pages""")
def q_fn_query_param(spark, d):
    """FN8: query parameter, text after / before a marker."""
    p = table(spark, d, "pages")
    return p.select("page_id", fn.query_param("url", "page").alias("page_param"),
                    fn.after_marker("url", ".example.").alias("after_host"),
                    fn.before_marker("url", "?").alias("before_query"))


STOCK_SQL = f"""
WITH dict AS ({dictionaries.SQL['stock_dictionary']}),
lists AS (
  SELECT c.c_custkey, n.n_name || ',' || r.r_name
         || CASE WHEN c.c_mktsegment = 'MACHINERY' THEN ',' || c.c_mktsegment ELSE '' END AS names
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
ex AS (SELECT c_custkey, unnest(range(len(string_split(names, ',')))) AS i,
              unnest(string_split(names, ',')) AS name FROM lists),
j AS (SELECT ex.c_custkey, ex.i, ex.name || '=' || list_filter(d.aliases, lambda x: x <> d.name)[1] AS p
      FROM ex LEFT JOIN dict d ON ex.name = d.name)
SELECT c_custkey, CASE WHEN count(p) = count(*) THEN string_agg(p, '&' ORDER BY i) END AS stock
FROM j GROUP BY c_custkey"""


@query("fn_stock_pairs", STOCK_SQL)
def q_fn_stock_pairs(spark, d):
    """FN9: nation,region[,segment] -> name=code&...; unknown names fail the row."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    lists = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
             .select("c_custkey", F.concat_ws(",", "n_name", "r_name",
                                              F.when(F.col("c_mktsegment") == "MACHINERY",
                                                     F.col("c_mktsegment"))).alias("names")))
    return stock_pairs_join(lists, "c_custkey", "names", dictionaries.stock_dictionary(spark, d))


@query("fn_strings", """
SELECT page_id, starts_with(url, 'https://') AS is_https, contains(url, '?') AS has_query,
  replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '.', '_') AS host_key,
  trim('  ' || regexp_extract(html, '<title>([^<]*)</title>', 1) || ' ') AS title_trim,
  substring(regexp_extract(html, '<title>([^<]*)</title>', 1), 3, 10) AS title_sub,
  regexp_replace(url, '[0-9]+', '#', 'g') AS url_shape
FROM pages""")
def q_fn_strings(spark, d):
    """FN10: contains / startsWith / replace / trim / substring / replaceAll."""
    p = table(spark, d, "pages")
    t = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return p.select(
        "page_id", F.col("url").startswith("https://").alias("is_https"),
        F.col("url").contains("?").alias("has_query"),
        F.replace(F.regexp_extract("url", "^https?://([^/?#]+)", 1), F.lit("."), F.lit("_")).alias("host_key"),
        F.trim(F.concat(F.lit("  "), t, F.lit(" "))).alias("title_trim"),
        F.substring(t, 3, 10).alias("title_sub"),
        F.regexp_replace("url", "[0-9]+", "#").alias("url_shape"))


@query("fn_casts", """
SELECT event_id,
  TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
  TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value_back,
  TRY_CAST(event_type AS INTEGER) AS bad_int,
  CAST((epoch_us(ts) // 1000) // 1000 AS BIGINT) AS ts_s,
  TRY_CAST(json_extract_string(props, '$.k') AS SMALLINT) AS k_short
FROM events""")
def q_fn_casts(spark, d):
    """FN11: numeric text -> number (bad text -> NULL), ms -> s."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", fn.try_int(k).alias("k_int"),
                    fn.try_double(F.col("value").cast("string")).alias("value_back"),
                    fn.try_int("event_type").alias("bad_int"),
                    F.floor(fn.ntz_to_millis("ts") / 1000).cast("bigint").alias("ts_s"),
                    k.try_cast("smallint").alias("k_short"))


@query("fn_json_default", """
WITH j AS (SELECT event_id, regexp_replace(props, '}$', ', "z": null}') AS doc FROM events)
SELECT event_id,
  CASE WHEN json_extract(doc, '$.k') IS NULL THEN '' ELSE json_extract_string(doc, '$.k') END AS k,
  CASE WHEN json_extract(doc, '$.missing') IS NULL THEN '0' ELSE json_extract_string(doc, '$.missing') END AS missing,
  CASE WHEN json_extract(doc, '$.z') IS NULL THEN '0' ELSE json_extract_string(doc, '$.z') END AS json_null,
  TRY_CAST(CASE WHEN json_extract(doc, '$.k') IS NULL THEN '0' ELSE json_extract_string(doc, '$.k') END AS INTEGER) AS k_int
FROM j""")
def q_fn_json_default(spark, d):
    """FN12: missing key -> default; JSON null stays NULL."""
    e = table(spark, d, "events").select(
        "event_id", F.regexp_replace("props", "}$", ', "z": null}').alias("doc"))
    return e.select("event_id", fn.json_get_or_default("doc", "k", "").alias("k"),
                    fn.json_get_or_default("doc", "missing", "0").alias("missing"),
                    fn.json_get_or_default("doc", "z", "0").alias("json_null"),
                    fn.json_int_or_default("doc", "k", 0).alias("k_int"))


# FN13: user path between the escaped host prefix and '?refer_flag', then
# the escapes removed. Links are built from the feed's users and events.
REFER_PATTERN = r"http:\\/\\/[a-z.]+\\/((?:u\\/)?\w+)\?refer_flag"


@query("fn_regex_refer", r"""
WITH l AS (SELECT event_id,
  'see http:\/\/feed.example\/u\/' || CAST(user_id AS VARCHAR) || '?refer_flag=' || CAST(event_id AS VARCHAR)
  || ' and http:\/\/feed.example\/' || event_type || '?refer_flag=0\' AS link FROM events)
SELECT event_id, array_to_string(list_transform(regexp_extract_all(link, 'http:\\/\\/[a-z.]+\\/((?:u\\/)?\w+)\?refer_flag', 1),
                                 lambda x: replace(x, '\', '')), ',') AS user_paths
FROM l""")
def q_fn_regex_refer(spark, d):
    """FN13."""
    e = table(spark, d, "events")
    link = F.concat(F.lit("see http:\\/\\/feed.example\\/u\\/"), F.col("user_id").cast("string"),
                    F.lit("?refer_flag="), F.col("event_id").cast("string"),
                    F.lit(" and http:\\/\\/feed.example\\/"), F.col("event_type"),
                    F.lit("?refer_flag=0\\"))
    found = F.regexp_extract_all(link, F.lit(REFER_PATTERN), 1)
    return e.select("event_id", F.array_join(
        F.transform(found, lambda x: F.replace(x, F.lit("\\"), F.lit(""))), ",").alias("user_paths"))
