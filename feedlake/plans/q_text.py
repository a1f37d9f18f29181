"""Proof queries: text enrichment (NLP1-NLP9)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import text as tx
from ..sources.dictionaries_text import KEYWORD_SQL, PHRASE_SQL, keyword_dictionary, phrase_dictionary
from ..sources.tables import table
from . import enrich
from .registry import query

TS = tx.TOKEN_SPLIT
SN = tx.SENTENCE.replace("\n", "\\n")


def tok_sql(src: str, id_col: str = "doc_id", text_col: str = "text") -> str:
    return (f"SELECT * FROM (SELECT {id_col}, unnest(regexp_split_to_array(lower({text_col}), '{TS}')) "
            f"AS token FROM {src}) t WHERE token <> ''")


def nb_sql(train_tok: str, train_docs: str, score_tf: str, score_docs: str) -> str:
    """DuckDB twin of nb_train + nb_predict. ``train_tok(doc_id, label,
    token)``, ``train_docs(doc_id, label)``, ``score_tf(doc_id, token, tf)``,
    ``score_docs(doc_id)``."""
    return f"""
pairs AS (SELECT label, token, count(*) AS n FROM {train_tok} GROUP BY label, token),
vsz AS (SELECT count(DISTINCT token) AS v FROM pairs),
cdocs AS (SELECT label, count(*) AS n_docs FROM {train_docs} GROUP BY label),
ctok AS (SELECT label, sum(n) AS n_tokens FROM pairs GROUP BY label),
cls AS (SELECT c.label, ln(c.n_docs / (SELECT count(*) FROM {train_docs})) AS log_prior,
               ln(coalesce(t.n_tokens, 0) + (SELECT v FROM vsz)) AS log_norm
        FROM cdocs c LEFT JOIN ctok t USING (label)),
inv AS (SELECT * FROM {score_tf} WHERE token IN (SELECT token FROM pairs)),
tdoc AS (SELECT doc_id, sum(tf) AS t_doc FROM inv GROUP BY doc_id),
sparse AS (SELECT i.doc_id, p.label, sum(i.tf * ln(p.n + 1)) AS s FROM inv i JOIN pairs p USING (token)
           GROUP BY i.doc_id, p.label),
scored AS (SELECT d.doc_id, c.label,
             c.log_prior - coalesce(t.t_doc, 0) * c.log_norm + coalesce(s.s, 0) AS score
           FROM {score_docs} d CROSS JOIN cls c LEFT JOIN tdoc t ON t.doc_id = d.doc_id
           LEFT JOIN sparse s ON s.doc_id = d.doc_id AND s.label = c.label),
best AS (SELECT doc_id, label AS predicted, score FROM (
           SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn FROM scored) x
         WHERE rn = 1)"""


DIGEST_SQL = f"""
sents AS (SELECT doc_id, unnest(range(len(regexp_extract_all(text, '{SN}', 0)))) AS sent_pos,
                 unnest(regexp_extract_all(text, '{SN}', 0)) AS sentence FROM documents),
st AS ({tok_sql('sents', 'doc_id, sent_pos', 'sentence')}),
stf AS (SELECT doc_id, token, count(*) AS tf FROM st GROUP BY doc_id, token),
sscore AS (SELECT s.doc_id, s.sent_pos, round(avg(f.tf), 6) AS score FROM st s JOIN stf f USING (doc_id, token)
           GROUP BY s.doc_id, s.sent_pos),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, sent_pos) AS r
                       FROM sscore) x WHERE r <= 3),
dg AS (SELECT t.doc_id, string_agg(trim(s.sentence), ' ' ORDER BY t.sent_pos) AS digest
       FROM top t JOIN sents s USING (doc_id, sent_pos) GROUP BY t.doc_id),
digests AS (SELECT d.doc_id, CASE WHEN d.text = '' THEN '' ELSE dg.digest END AS temp_digest
            FROM documents d LEFT JOIN dg USING (doc_id))"""


@query("nlp_tokens", f"""
WITH t AS ({tok_sql('documents')}),
stops AS (SELECT token FROM (SELECT token, count(*) AS n FROM t GROUP BY token) s
          ORDER BY n DESC, token LIMIT 50)
SELECT token, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM t
WHERE token NOT IN (SELECT token FROM stops) GROUP BY token""")
def q_nlp_tokens(spark, d):
    """NLP3: tokens with the 50 most frequent corpus tokens as stop words."""
    toks = tx.doc_tokens(table(spark, d, "documents").select("doc_id", "text"))
    kept = tx.remove_stop_words(toks, tx.stop_words(toks, 50))
    return kept.groupBy("token").agg(F.count(F.lit(1)).alias("n"),
                                     F.countDistinct("doc_id").alias("n_docs"))


@query("nlp_dictionary_tags", f"""
WITH t AS ({tok_sql('documents')}), kd AS ({KEYWORD_SQL}),
hits AS (SELECT t.doc_id, t.token, kd.facet FROM t JOIN kd ON kd.term = t.token),
agg AS (SELECT doc_id,
  array_to_string(list_sort(list_distinct(list(token) FILTER (WHERE facet = 'stock'))), ',') AS stock,
  array_to_string(list_sort(list_distinct(list(token) FILTER (WHERE facet = 'industry'))), ',') AS industry,
  array_to_string(list_sort(list_distinct(list(token) FILTER (WHERE facet = 'section'))), ',') AS section
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.stock, '') AS stock, coalesce(a.industry, '') AS industry,
       coalesce(a.section, '') AS section
FROM documents d LEFT JOIN agg a USING (doc_id)""")
def q_nlp_dictionary_tags(spark, d):
    """NLP4: three facets of dictionary terms per document."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return tx.dictionary_tags(tx.doc_tokens(docs), keyword_dictionary(spark, d), docs)


@query("nlp_phrase_tags", f"""
WITH w AS (SELECT doc_id, ' ' || array_to_string(list_filter(regexp_split_to_array(lower(text), '{TS}'), lambda x: x <> ''), ' ')
             || ' ' AS words FROM documents),
kd AS ({PHRASE_SQL}),
hits AS (SELECT doc_id, term, facet FROM w JOIN kd ON contains(words, ' ' || term || ' ')),
agg AS (SELECT doc_id,
  array_to_string(list_sort(list(term) FILTER (WHERE facet = 'stock')), ',') AS stock,
  array_to_string(list_sort(list(term) FILTER (WHERE facet = 'industry')), ',') AS industry,
  array_to_string(list_sort(list(term) FILTER (WHERE facet = 'section')), ',') AS section FROM hits GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.stock, '') AS stock, coalesce(a.industry, '') AS industry, coalesce(a.section, '') AS section
FROM documents d LEFT JOIN agg a USING (doc_id)""")
def q_nlp_phrase_tags(spark, d):
    """NLP4: the facets of two-word terms, by a keyword automaton."""
    return tx.phrase_tags(table(spark, d, "documents").select("doc_id", "text"), phrase_dictionary(spark, d))


#: A character of the unspaced scripts for each letter, to write documents in them.
LETTERS, HAN = "abcdefghijklmnopqrstuvwxyz", "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收ひかカタ"


@query("nlp_tokens_unspaced", f"""
WITH c AS (SELECT doc_id, translate(lower(text), '{LETTERS}', '{HAN}') AS text FROM documents),
r AS (SELECT doc_id, unnest(regexp_split_to_array(
  regexp_replace(text, '([\\p{{Han}}\\p{{Hiragana}}\\p{{Katakana}}]+)', ' \\1 ', 'g'), '{TS}')) AS t FROM c),
b AS (SELECT doc_id, CASE WHEN regexp_matches(t, '^[\\p{{Han}}\\p{{Hiragana}}\\p{{Katakana}}]') AND length(t) > 1
  THEN list_transform(range(1, length(t)), lambda i: substring(t, i, 2)) ELSE [t] END AS ts FROM r WHERE t <> '')
SELECT token, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM (SELECT doc_id, unnest(ts) AS token FROM b) GROUP BY token""")
def q_nlp_tokens_unspaced(spark, d):
    """NLP3 on texts in scripts without spaces (the documents, their letters a-z as
    characters of such scripts; accented letters and digits stay): character bigrams."""
    docs = table(spark, d, "documents").select("doc_id", F.translate(F.lower("text"), LETTERS, HAN).alias("text"))
    return tx.token_stats(docs)


def _lang_model(spark, d):
    docs = tx.spread(table(spark, d, "documents").select("doc_id", "text", F.col("lang").alias("label")))
    return docs, tx.nb_train(tx.term_counts(docs, keep=("label",)), docs.select("doc_id", "label"))


def _ok(spark, d, digests=enrich.digests):
    return enrich.cuts(digests(table(spark, d, "documents").select("doc_id", "text")))


LANG_NB = f"""
WITH t AS ({tok_sql('documents')}),
ttok AS (SELECT t.doc_id, d.lang AS label, t.token FROM t JOIN documents d USING (doc_id)),
tdocs AS (SELECT doc_id, lang AS label FROM documents),
tf AS (SELECT doc_id, token, count(*) AS tf FROM t GROUP BY doc_id, token),
{nb_sql('ttok', 'tdocs', 'tf', 'documents')}"""


@query("nlp_nb_train", LANG_NB + """
SELECT p.label, p.token, p.n, round(ln(p.n + 1) - c.log_norm, 6) AS log_p
FROM pairs p JOIN cls c USING (label)""")
def q_nlp_nb_train(spark, d):
    """NLP5 training: language classes over all documents."""
    _, (model, _) = _lang_model(spark, d)
    return model.select("label", "token", "n", F.round("log_p", 6).alias("log_p"))


@query("nlp_nb_predict", LANG_NB + "\nSELECT doc_id, predicted, round(score, 4) AS score FROM best")
def q_nlp_nb_predict(spark, d):
    """NLP5 scoring of every document."""
    docs, (model, classes) = _lang_model(spark, d)
    pred = tx.nb_predict(tx.term_counts(docs), model, classes, docs)
    return pred.select("doc_id", "predicted", F.round("score", 4).alias("score"))


@query("nlp_digest", f"WITH {DIGEST_SQL}\nSELECT doc_id, temp_digest AS digest FROM digests")
def q_nlp_digest(spark, d):
    """NLP1: 3-sentence extractive digest per document."""
    return enrich.digests(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.col("temp_digest").alias("digest"))


@query("nlp_digest_cuts", f"""WITH {DIGEST_SQL}
SELECT doc_id,
  CASE WHEN length(temp_digest) > 300 THEN substring(temp_digest, 1, 300) ELSE temp_digest END AS summary,
  CASE WHEN length(split_part(temp_digest, chr(9), 1)) > 500 THEN substring(split_part(temp_digest, chr(9), 1), 1, 500)
       ELSE split_part(temp_digest, chr(9), 1) END AS digest
FROM digests WHERE temp_digest IS NOT NULL""")
def q_nlp_digest_cuts(spark, d):
    """NLP2: summary = digest cut 300; digest = text before the first tab, cut 500."""
    return _ok(spark, d).select("doc_id", "summary", F.col("short_digest").alias("digest"))


SENTI_NB = f"""
WITH {DIGEST_SQL},
ok AS (SELECT * FROM digests WHERE temp_digest IS NOT NULL AND temp_digest <> ''),
w AS ({tok_sql('ok', 'doc_id', 'temp_digest')}),
wtf AS (SELECT doc_id, token, count(*) AS tf FROM w GROUP BY doc_id, token),
lab AS (SELECT l.doc_id, CASE WHEN l.quality = 0 THEN 'neg' ELSE 'pos' END AS label, d.text
        FROM labels l JOIN documents d USING (doc_id)),
lt AS (SELECT x.doc_id, x.token, l.label FROM ({tok_sql('lab')}) x JOIN lab l USING (doc_id)),
ldocs AS (SELECT doc_id, label FROM lab),
okdocs AS (SELECT doc_id FROM ok),
{nb_sql('lt', 'ldocs', 'wtf', 'okdocs')}"""


@query("nlp_sentiment", SENTI_NB + """
SELECT g.doc_id, CASE WHEN g.temp_digest = '' THEN -1 WHEN b.predicted = 'neg' THEN 0 ELSE 1 END AS sentiment
FROM digests g LEFT JOIN best b USING (doc_id) WHERE g.temp_digest IS NOT NULL""")
def q_nlp_sentiment(spark, d):
    """NLP6: 'neg' -> 0, otherwise 1; empty digest -> -1."""
    return enrich.sentiment(_ok(spark, d, enrich.digests_once), table(spark, d, "documents"), table(spark, d, "labels"))


STOCK_SQL = f"""
WITH {DIGEST_SQL},
ok AS (SELECT * FROM digests WHERE temp_digest IS NOT NULL AND temp_digest <> ''),
w AS ({tok_sql('ok', 'doc_id', 'temp_digest')}),
kd AS ({KEYWORD_SQL}),
stk AS (SELECT DISTINCT w.doc_id, w.token FROM w JOIN kd ON kd.term = w.token AND kd.facet = 'stock'),
pairs AS (SELECT stk.doc_id, string_agg(stk.token || '=' || list_filter(kd.aliases, lambda x: x <> kd.term)[1], '&'
                                        ORDER BY stk.token) AS s
          FROM stk JOIN kd ON kd.term = stk.token GROUP BY stk.doc_id),
cut AS (SELECT doc_id, s, substring(s, 1, 500) AS c FROM pairs)
SELECT g.doc_id, coalesce(CASE WHEN length(s) > 500 THEN
          CASE WHEN strpos(c, '&') > 0 THEN left(c, length(c) - strpos(reverse(c), '&')) ELSE c END
        ELSE s END, '') AS stock
FROM digests g LEFT JOIN cut USING (doc_id) WHERE g.temp_digest IS NOT NULL"""


@query("nlp_stock_string", STOCK_SQL)
def q_nlp_stock_string(spark, d):
    """NLP7: stock names -> name=code pairs, cut 500 (tail dropped only when cut)."""
    kd = keyword_dictionary(spark, d)
    return enrich.stock_strings(enrich.tags(_ok(spark, d, enrich.digests_once), kd), kd)


def _with_unscorable(spark, d):
    """All documents, and for every tenth one more row with its words taken out."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    bare = docs.where(F.col("doc_id") % 10 == 0).select(
        (-1 - F.col("doc_id")).alias("doc_id"), F.regexp_replace("text", r"[\p{L}\p{N}]", "-").alias("text"))
    return docs.unionByName(bare)


@query("nlp_rejects", f"""WITH documents AS (SELECT doc_id, text FROM documents UNION ALL
  SELECT -1 - doc_id, regexp_replace(text, '[\\p{{L}}\\p{{N}}]', '-', 'g') FROM documents WHERE doc_id % 10 = 0),
{DIGEST_SQL}
SELECT doc_id, 'no_digest' AS reason FROM digests WHERE temp_digest IS NULL""")
def q_nlp_rejects(spark, d):
    """NLP9: rows whose digest failed are not written."""
    return enrich.rejects(enrich.digests(_with_unscorable(spark, d)))


NEWS_SQL = SENTI_NB + f""",
kd AS ({KEYWORD_SQL}),
hits AS (SELECT w.doc_id, w.token, kd.facet FROM w JOIN kd ON kd.term = w.token),
tags AS (SELECT doc_id,
  array_to_string(list_sort(list_distinct(list(token) FILTER (WHERE facet = 'stock'))), ',') AS stock,
  array_to_string(list_sort(list_distinct(list(token) FILTER (WHERE facet = 'industry'))), ',') AS industry,
  array_to_string(list_sort(list_distinct(list(token) FILTER (WHERE facet = 'section'))), ',') AS section
  FROM hits GROUP BY doc_id)
SELECT 2 AS type, 40004 AS platform, split_part(d.text, chr(10), 1) AS title,
  '{schemas.URLS[40004]['blog']}' || CAST(g.doc_id AS VARCHAR) AS url,
  1460000000000 + g.doc_id * 60000 AS news_time,
  coalesce(t.industry, '') AS industry, coalesce(t.section, '') AS section, coalesce(t.stock, '') AS stock,
  CASE WHEN length(split_part(g.temp_digest, chr(9), 1)) > 500 THEN substring(split_part(g.temp_digest, chr(9), 1), 1, 500)
       ELSE split_part(g.temp_digest, chr(9), 1) END AS digest,
  CASE WHEN length(g.temp_digest) > 300 THEN substring(g.temp_digest, 1, 300) ELSE g.temp_digest END AS summary,
  CASE WHEN g.temp_digest = '' THEN -1 WHEN b.predicted = 'neg' THEN 0 ELSE 1 END AS sentiment,
  '{schemas.PLATFORMS[3][1]}' AS source
FROM digests g JOIN documents d USING (doc_id) LEFT JOIN tags t USING (doc_id)
LEFT JOIN best b USING (doc_id)
WHERE g.temp_digest IS NOT NULL"""


def _news(spark, d):
    return enrich.news(table(spark, d, "documents"), table(spark, d, "labels"), keyword_dictionary(spark, d))


@query("nlp_news_rows", NEWS_SQL)
def q_nlp_news_rows(spark, d):
    """NLP8: the news row (13 columns less the clock column, which is
    added at the sink)."""
    _, news = _news(spark, d)
    return news.drop("doc_id")


@query("snk_chained_write", f"""SELECT g.doc_id, x.stock, g.stock_names, g.summary, g.whole AS digest FROM ({STOCK_SQL}) x
JOIN (WITH {DIGEST_SQL}, kd AS ({KEYWORD_SQL}),
  ok AS (SELECT * FROM digests WHERE temp_digest <> ''), w AS ({tok_sql('ok', 'doc_id', 'temp_digest')}),
  names AS (SELECT doc_id, array_to_string(list_sort(list_distinct(list(token))), ',') AS s
            FROM w JOIN kd ON kd.term = w.token WHERE facet = 'stock' GROUP BY doc_id)
  SELECT doc_id, coalesce(s, '') AS stock_names, split_part(temp_digest, chr(9), 1) AS whole,
    CASE WHEN length(temp_digest) > 300 THEN substring(temp_digest, 1, 300) ELSE temp_digest END AS summary
  FROM digests LEFT JOIN names USING (doc_id) WHERE temp_digest IS NOT NULL) g USING (doc_id)""")
def q_snk_chained_write(spark, d):
    """SNK11: the digest row is written first; the news row is written only
    for digests that were written (read back), in that order."""
    from ..operators import sinks
    from ..session import scratch_path
    info, news = _news(spark, d)
    info_path, news_path = scratch_path(spark, "article_info"), scratch_path(spark, "news_info")
    sinks.append(info, info_path)
    written = spark.read.parquet(info_path)
    sinks.append(news.join(written.select("doc_id"), "doc_id", "left_semi"), news_path)
    return (spark.read.parquet(news_path).select("doc_id", "summary", F.col("stock").alias("stock_names"))
            .join(written.select("doc_id", "digest", "stock"), "doc_id"))
