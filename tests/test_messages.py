"""Notice classification, routing and the page lookup rules."""
import json

from feedlake import schemas
from feedlake.operators import lookup, messages


def _msgs(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "msg_seq long, value string")


def test_classify_reasons(spark):
    good = json.dumps({"attr_id": "40002", "key_name": "40002", "pos_name": "http://a/1"})
    vals = [good, "", None, '{"attr_id": "4000', json.dumps({"attr_id": "40002", "key_name": "t"}),
            json.dumps({"attr_id": "abc", "key_name": "t", "pos_name": "u"}),
            json.dumps({"attr_id": "40009", "key_name": "t", "pos_name": "u"}),
            json.dumps({"attr_id": 40001, "key_name": "t", "pos_name": "u"})]
    g, rej = messages.parse(_msgs(spark, vals))
    routed, unknown = messages.route(g, schemas.platforms(spark))
    reasons = {r.msg_seq: r.reason for r in rej.collect()}
    assert reasons == {1: "empty", 2: "empty", 3: "not_json", 4: "missing_key", 5: "bad_platform_id"}
    assert [r.msg_seq for r in unknown.collect()] == [6]
    # a numeric attr_id is accepted (the reference killed the task; we route it)
    assert sorted((r.msg_seq, r.platform_id, r.platform_name) for r in routed.collect()) == [
        (0, 40002, "中金博客"), (7, 40001, "雪球")]


def test_lookup_needs_both_cells(spark):
    store = spark.createDataFrame([
        ("t", "k1", "http://a/1", "<p>x</p>"),
        ("t", "k2", None, "<p>y</p>"),        # url cell missing -> whole result NULL
        ("t", "k3", "http://a/3", ""),        # empty body: a hit under NULL-only, a miss otherwise
    ], "table_name string, row_key string, url string, html string")
    req = spark.createDataFrame([("t", "k1"), ("t", "k2"), ("t", "k3"), ("t", "k4")], "key_name string, pos_name string")
    lk = lookup.lookup(req, store)
    rows = {r.pos_name: (r.page_url, r.page_html) for r in lk.collect()}
    assert rows == {"k1": ("http://a/1", "<p>x</p>"), "k2": (None, None), "k3": ("http://a/3", ""), "k4": (None, None)}
    hits_strict, _ = lookup.split_hits(lk, lookup.MISS_NULL_OR_EMPTY)
    hits_loose, _ = lookup.split_hits(lk, lookup.MISS_NULL)
    assert sorted(r.pos_name for r in hits_strict.collect()) == ["k1"]
    assert sorted(r.pos_name for r in hits_loose.collect()) == ["k1", "k3"]


def test_list_page_tasks(spark):
    rows = messages.list_page_tasks(spark).orderBy("page_no").collect()
    assert len(rows) == 2024 and rows[0].page_no == 1
    assert '"attrid":"40003"' in rows[0].task and 'sortType=time&page=1"' in rows[0].task
