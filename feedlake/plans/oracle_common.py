"""Shared DuckDB SQL fragments for the oracle side."""
from __future__ import annotations

from .. import schemas
from ..operators import extract


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PLATFORMS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({pid}, {_q(name)}, {_q(fk)}, {_q(mk)}, {nl})" for pid, name, fk, mk, nl in schemas.PLATFORMS
) + ") AS t(platform_id, platform_name, feed_kind, marker_kind, needs_login)"

LI_HREF = _q(extract.LI_HREF)
LI_TEXT = _q(extract.LI_TEXT)
ORIGIN = _q(extract.ORIGIN)


def absolute_sql(page_url: str, href: str) -> str:
    return (f"CASE WHEN {href} LIKE '/%' THEN regexp_extract({page_url}, {ORIGIN}, 1) || {href} "
            f"ELSE {href} END")


def article_task_sql(platform_id: str, url: str, islogin: str) -> str:
    return (f"to_json({{'islogin': CAST({islogin} AS INTEGER), 'attrid': CAST({platform_id} AS INTEGER), "
            f"'depth': {schemas.TASK_DEPTH}, 'cur_depth': {schemas.TASK_CUR_DEPTH}, "
            f"'method': {schemas.TASK_METHOD}, 'url': {url}}})::VARCHAR")


def crawl_task_sql(platform_id: str, url: str, result: str) -> str:
    return (f"to_json({{'id': '', 'attrid': CAST({platform_id} AS VARCHAR), 'cookie': '', "
            f"'referer': '', 'url': {url}, 'result': CAST({result} AS VARCHAR)}})::VARCHAR")


# Parsed notices (MSG1/MSG2) on the DuckDB side.
PARSED_SQL = """
  SELECT msg_seq, value,
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.attr_id') END AS attr_id,
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.key_name') END AS key_name,
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.pos_name') END AS pos_name,
    CASE WHEN value IS NULL OR length(value) = 0 THEN 'empty'
         WHEN NOT json_valid(value) THEN 'not_json'
         WHEN json_extract_string(value, '$.attr_id') IS NULL
           OR json_extract_string(value, '$.key_name') IS NULL
           OR json_extract_string(value, '$.pos_name') IS NULL THEN 'missing_key'
         WHEN TRY_CAST(json_extract_string(value, '$.attr_id') AS INTEGER) IS NULL THEN 'bad_platform_id'
    END AS reason
  FROM messages"""
