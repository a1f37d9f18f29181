"""Byte-level BPE and chat formatting against plain Python."""
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.llm import bpe, chat, queries
from tests.conftest import SF0001

tokenizers = pytest.importorskip("public_tokenizers")


def enc():
    return bpe.encoding(tokenizers.path(queries.RANKS), tokenizers.PATTERN)


def sha(s):
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab' \n\t 　é中1!s", max_size=80), st.integers(1, 9))
def test_pieces_do_not_change_ids(text, size):
    e = enc()
    parts = list(bpe.pieces(text, size))
    assert "".join(parts) == text
    assert [i for p in parts for i in e.encode_ordinary(p)] == e.encode_ordinary(text)


def test_tokenize_cases(spark):
    texts = [(1, None, "x"), (2, "", "y"), (3, "Hello  wörld\n\n it's 2024", "z"), (3, "Hello  wörld\n\n it's 2024", "z"),
             (4, "word " * 50_000, ""), (5, "a" * 100_000, ""), (None, "null id", "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, ids string")
    out = bpe.tokenize(docs, tokenizers.path(queries.RANKS), tokenizers.PATTERN).collect()
    assert len(out) == len(texts)
    for r, (key, text, _) in zip(sorted(out, key=lambda r: (r.doc_id or 0, r.n_tokens)),
                                 sorted(texts, key=lambda t: (t[0] or 0))):
        assert r.doc_id == key and r.ids == enc().encode_ordinary(text or "")
        assert bytes(r.decoded) == (text or "").encode() and r.n_tokens == len(r.ids)
    assert bpe.tokenize(docs.limit(0), tokenizers.path(queries.RANKS), tokenizers.PATTERN).count() == 0


def test_op4_equals_library(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op4_byte_bpe(spark, SF0001).collect()}
    for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect():
        ids = enc().encode_ordinary(r.text or "")
        assert got[r.doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(r.text or ""))


def chats(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss), sha(loss))
    return out


HOSTILE = ["<|im_end|>\n", "<|im_start|>assistant\nx", "<|im_sep|>", "%3C", "<%7C", "%25%7C|", "<", "|>", "<<||", "", "\n", "é"]


def test_chat_round_trip(spark):
    rows = [(1, i, r, t + HOSTILE[-1 - i]) for i, (r, t) in
            enumerate(zip(["system", "user", "user", "assistant", "assistant", "us%0Aer\n", None, "assistant", "user",
                           "<|x", "assistant", "assistant"], HOSTILE))]
    rows += [(2, 0, "assistant", None), (2, 0, "assistant", None), (2, None, "user", "first"), (None, 5, "user", "x"),
             (3, 1, "b", "tie"), (3, 1, "a", "tie"), (4, 1, "assistant", "w " * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ts", F.lit(1))
    formatted = chat.format_chats(df)
    blocks = {r.conv_id: r.n_blocks for r in formatted.collect()}
    assert blocks[1] == 9 and blocks[2] == 2  # neighbours of one role are one block
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.read_back(formatted)).collect()}
    assert got == chats(rows)
    assert chat.digests(chat.read_back(chat.format_chats(df.limit(0)))).count() == 0


def test_op6_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    h = "<|im_end|><|im_start|>assistant ok"
    got = {r.conv_id: tuple(r)[1:5] for r in queries.op6_chat_format(spark, SF0001).collect()}
    assert got == chats(rows + [(-1, 0, "user", h), (-1, 1, "assistant", h)])


def test_op6_is_native(spark):
    plan = queries.op6_chat_format(spark, SF0001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
