"""Golden vectors (the reference's own unit tests) and property tests for
the scalar helpers."""
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake import functions as fn
from feedlake.functions import dates
from feedlake.operators import messages


def one(spark, col, data, schema="s string"):
    return spark.createDataFrame(data, schema).select(col.alias("r")).collect()


def test_intercept_golden(spark):
    cjk = "中文字符测试"
    assert one(spark, fn.intercept("s", 4, exact_len_empty=True), [(cjk,)])[0].r == cjk[:4]
    # reference rule: exactly n chars -> "" ; pipeline default keeps the text
    assert one(spark, fn.intercept("s", 6, exact_len_empty=True), [(cjk,)])[0].r == ""
    assert one(spark, fn.intercept("s", 6), [(cjk,)])[0].r == cjk
    assert one(spark, fn.intercept("s", 10), [(cjk,)])[0].r == cjk
    assert one(spark, fn.intercept("s", 3), [(None,)])[0].r is None


def test_date_string_golden(spark):
    r = one(spark, fn.millis_to_string(F.col("ms"), dates.FMT_TASK, "Asia/Shanghai"),
            [(1468463935000,)], "ms long")
    assert r[0].r == "20160714103855"


def test_to_millis_golden(spark):
    r = one(spark, fn.string_to_millis("s", "yyyy-MM-dd:HH-mm-ss", "Asia/Shanghai"),
            [("2016-07-14:10-38-55",), ("garbage",)])
    assert r[0].r == 1468463935000
    assert r[1].r is None


def test_crawl_task_golden(spark):
    r = one(spark, messages.crawl_task(F.lit(5), F.lit("http://www/baidu.com"), 3), [(1,)], "x int")
    d = json.loads(r[0].r)
    assert d == {"id": "", "attrid": "5", "cookie": "", "referer": "", "url": "http://www/baidu.com",
                 "result": "3"}


def test_article_task_golden(spark):
    r = one(spark, messages.article_task(F.lit("5"), F.lit("http://www/baidu.com"), F.lit(3)), [(1,)], "x int")
    d = json.loads(r[0].r)
    assert d == {"islogin": 3, "attrid": 5, "depth": 2, "cur_depth": 2, "method": 2,
                 "url": "http://www/baidu.com"}


def test_regex_refer_golden(spark):
    from feedlake.plans.q_functions import REFER_PATTERN
    src = "http:\\/\\/weibo.com\\/u\\/1937547281?refer_flag=2307710005_5902256596\\"
    found = F.regexp_extract_all(F.col("s"), F.lit(REFER_PATTERN), 1)
    r = one(spark, F.transform(found, lambda x: F.replace(x, F.lit("\\"), F.lit(""))), [(src,)])
    assert r[0].r == ["u/1937547281"]


def test_last_segment_trailing_slash(spark):
    r = one(spark, fn.last_segment("s"), [("http://a/b/c/",), ("http://a/b/c",)])
    assert [x.r for x in r] == ["c", "c"]


def _py_before_first(s, sign):
    return s[:s.index(sign)] if sign in s else s


def _py_before_last(s, sign):
    return s[:s.rindex(sign)] if sign in s else s


def _py_intercept(s, n):
    if len(s) > n >= 0:
        return s[:n]
    if len(s) < n:
        return s
    return ""


texts = st.lists(st.text(alphabet="ab/&.中 ", max_size=12), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None)
@given(texts, st.sampled_from(["/", "&", ". ", "ab"]), st.integers(min_value=0, max_value=8))
def test_string_helpers_property(spark, xs, sign, n):
    df = spark.createDataFrame([(x,) for x in xs], "s string")
    rows = df.select("s", fn.before_first("s", sign).alias("f"), fn.before_last("s", sign).alias("l"),
                     fn.intercept("s", n, exact_len_empty=True).alias("i")).collect()
    for r in rows:
        assert r.f == _py_before_first(r.s, sign)
        assert r.l == _py_before_last(r.s, sign)
        assert r.i == _py_intercept(r.s, n)
