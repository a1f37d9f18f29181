"""Schemas, the platform dimension and message contracts."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the surveyed application's: platform ids and
# display names, and the task-message constants.
# ---------------------------------------------------------------------------
PLATFORMS = [
    # platform_id, name, feed_kind, marker_kind, needs_login
    (40001, "雪球", "statuses_json", "url", 0),
    (40002, "中金博客", "list_items", "title", 0),
    (40003, "摩尔金融", "table_items", "title", 0),
    (40004, "淘股吧", "actions_json", "ts", 0),
    (40005, "微博", "cards", "head", 1),
]
TASK_DEPTH = 2
TASK_CUR_DEPTH = 2
TASK_METHOD = 2
RESULT_CRAWL = 0      # please crawl
RESULT_PARSED = 1     # parsed, acknowledge
RESULT_RECRAWL = 2    # failed / recrawl / list-page request

PLATFORM_SCHEMA = T.StructType([
    T.StructField("platform_id", T.IntegerType(), False),
    T.StructField("platform_name", T.StringType(), False),
    T.StructField("feed_kind", T.StringType(), False),
    T.StructField("marker_kind", T.StringType(), False),
    T.StructField("needs_login", T.IntegerType(), False),
])


def platforms(spark: SparkSession) -> DataFrame:
    """Five-row dimension; always safe to broadcast."""
    return spark.createDataFrame(PLATFORMS, PLATFORM_SCHEMA)


# JSON field names of the page documents below.
# Action page (platform 40004), one JSON document per page.
ACTION_RECORD = T.StructType([
    T.StructField("actionName", T.StringType()),
    T.StructField("actionID", T.StringType()),
    T.StructField("objectName", T.StringType()),
    T.StructField("objectID", T.StringType()),
    T.StructField("userID", T.StringType()),
    T.StructField("userName", T.StringType()),
    T.StructField("actionDate", T.StringType()),
    T.StructField("images", T.ArrayType(T.StringType())),
    T.StructField("flashs", T.StringType()),
    T.StructField("voices", T.ArrayType(T.StringType())),
    T.StructField("OtherID", T.StringType()),
    T.StructField("portrait", T.StringType()),
    T.StructField("body", T.StringType()),
])
ACTION_PAGE = T.StructType([
    T.StructField("sfNum", T.IntegerType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("perPageNum", T.IntegerType()),
    T.StructField("pageNo", T.IntegerType()),
    T.StructField("actionID", T.IntegerType()),
    T.StructField("record", T.ArrayType(ACTION_RECORD)),
])

# Follower list (platform 40001).
LIST_USER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("followers_count", T.IntegerType()),
    T.StructField("screen_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("profile_image_url", T.StringType()),
])
USER_LIST_PAGE = T.StructType([T.StructField("users", T.ArrayType(LIST_USER))])

# ---------------------------------------------------------------------------
# Task url prefixes per platform (a task url is prefix + id).
# ---------------------------------------------------------------------------
URLS = {
    40001: {
        "friend_list": "http://xueqiu.com/friendships/groups/members.json?page=1&count=2000&gid=0&uid=",
        "home_page": "https://xueqiu.com/",
        "status": "http://xueqiu.com/about/mobile-xueqiu/",
        "vip_image": "http://xavatar.imedao.com/",
        "image": "https://xavatar.imedao.com/",
    },
    40002: {
        "home_page": "http://blog.cnfol.com/",
        "article_list": "http://blog.cnfol.com/index.php/article/blogarticlelist/",
    },
    40003: {
        "list_page": "http://moer.jiemian.com/investment_findPageList.htm?onColumns=all&industrys=all&fieldColumn=all&price=all&authorType=1&sortType=time&page=",
        "author": "http://moer.jiemian.com/authorHome.htm?theId=",
        "article": "http://moer.jiemian.com/articleDetails.htm?articleId=",
        "home_page": "http://moer.jiemian.com/",
    },
    40004: {
        "home_page": "http://www.taoguba.com.cn/",
        "user_info": "http://www.taoguba.com.cn/getBlogerInfo?userID=",
        "friend_list": "http://www.taoguba.com.cn/getFriends?userID=",
        "blog": "http://www.taoguba.com.cn/blog/",
        "article": "http://www.taoguba.com.cn/Article/",
        "image": "http://image.taoguba.com.cn/img/",
        "top_page": "http://www.taoguba.com.cn/viewMoreTop?topFlag=R&pageNo=",
    },
    40005: {
        "home_page": "http://weibo.com/",
    },
}
# Operating constants.
FOCUS_LIST = "/myfocus/friend"   # 40002: the accounts a user follows, after the home page
TOPK_ARTICLES = 3000          # recrawl and summary back-fill
LIST_PAGES_40003 = 2024       # list pages seeded for platform 40003
TOP_PAGES_40004 = 5           # pages of top writers seeded for platform 40004
FOLLOWER_GATE_EXPAND = 100    # > 100: expand (40001)
FOLLOWER_GATE_VIP = 500       # > 500: VIP candidate (40002); < 500: badge check
SUMMARY_CUT_40005 = 200
SUMMARY_CUT = 300             # 40001 and 40004
DIGEST_CUT = 500              # digest and stock string (40004)
HEADLINE_CUT = 30
OWNER_MARK = "- 雪球"          # page title: owner before it (40001)
CARDS_SCRIPT = "pl.content.homefeed.index"   # script that holds the cards (40005)
DETAIL_SCRIPT = "pl.content.weiboDetail.index"   # script that holds an article (40005)
SCRIPT_HEAD, SCRIPT_TAIL = "<script>FM.view(", ")</script>"   # around a script's document (40005)
DETAIL_TITLE_SUFFIX = "- 微博"   # removed from page titles (40005)
OWN_TOPIC = (40001,)          # platforms whose article tasks go to a topic of their own
MOER_HOST = "http://moer.jiemian.com/"
WEIBO_HOST = "http://weibo.com"
# Cells of a card's handle bar (40005).
PERMALINK_MARK = "?ref=home&rid="
LABEL_FORWARD, LABEL_COMMENT, LABEL_LIKE, SHIFT_MARK = "转发", "评论", "赞", "ñ"
VIP_IMAGE_SUFFIX = "!50x50.png"   # removed from profile image names (40001)
TITLE_SUFFIX = "的观点："        # title fallback suffix (40001, 40005)
ACTION_TITLE_SUFFIX = "的观点: "  # action title suffix (40004)
