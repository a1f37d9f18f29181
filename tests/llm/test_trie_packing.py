"""Prefix trie, packing and cross-tokenizer alignment against brute force."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.llm import alignment, bpe, packing, queries, trie
from tests.conftest import SF0001

tokenizers = pytest.importorskip("public_tokenizers")
SPACES = " \t\n\x0b\x0c\r"


def n_words(text):
    for c in SPACES:
        text = text.replace(c, " ")
    return len([w for w in text.split(" ") if w])


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:trie.UNIT]


def brute_trie(rows):
    """Rows (conv_id, turn, role, text) -> node tuples, by grouping whole prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rest = -(-c % 20) if c < 0 else c % 20
        built[c] = own.get(c - rest, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, ms in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(ms) - 1) * (n_words(n[-1][1]) if n else 0)
    out = []
    for n, ms in members.items():
        ends = ",".join(map(str, sorted(c for c in ms if len(built[c]) == len(n))))
        out.append((min(ms), len(n), min(members[n[:-1]]) if n else None, len(ms), children[n], leaves[n], saved[n],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def trie_rows(df, **kw):
    return sorted((tuple(r) for r in trie.nodes(trie.conversations_of(df), **kw).collect()), key=str)


ODD = [(0, 1, "user", "a b"), (0, 2, "x", None), (0, None, None, "first"), (1, 1, "user", "a b"), (1, 1, "user", "a b"),
       (3, 5, "user", "tie"), (3, 5, "bot", "tie"), (22, 1, "q", "\x0bw\tw w"), (-3, 1, "user", "neg"), (-20, 0, "user", "base"),
       (None, 1, "user", "nobody"), (41, 0, "u", ""), (44, 3, "", ""), (45, 3, None, None), (60, 1, "u", "w " * 100_000)]


def test_trie_odd_rows(spark):
    df = turns(spark, ODD).withColumn("key", F.lit(1)).withColumn("words", F.lit("x")).withColumn("node", F.lit(0))
    assert trie_rows(df) == brute_trie(ODD)
    assert trie_rows(df, block_rows=1) == brute_trie(ODD)
    assert trie.nodes(trie.conversations_of(df.limit(0))).count() == 0


def test_trie_random_blocks(spark):
    """Few different turns, so long shared prefixes, copies and cuts through groups."""
    rnd = random.Random(5)
    rows = []
    for c in range(240):
        if c % 3 == 0:
            rows += [(c, i, "user", f"hot {i}") for i in range(3)]  # a third are one conversation
        else:
            rows += [(c, i, rnd.choice("ab"), rnd.choice(["x", "y y"])) for i in range(rnd.randrange(1, 9))]
    rows += [(999, i, "user", "long") for i in range(700)]
    want = brute_trie(rows)
    df = turns(spark, rows).repartition(7)
    for block in (1, 2, 5, 50, 10_000):
        assert trie_rows(df, block_rows=block) == want
    assert trie_rows(df, block_turns=9) == want


def test_only_turnless_conversations(spark):
    """No turn is left when the first h go and the base is absent."""
    rows = [(c, 0, "user", "x") for c in range(1, 19) if zlib.crc32(str(c).encode()) % 4]
    assert trie_rows(turns(spark, rows)) == brute_trie(rows)
    assert len(brute_trie(rows)) == 1


def test_op11_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in queries.op11_prefix_trie(spark, SF0001).collect()), key=str)
    assert got == brute_trie(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=6), min_size=1, max_size=25))
def test_extents(seqs):
    keys = sorted(bytes(x for v in s for x in [v] * trie.UNIT) for s in seqs)
    length = np.array([len(k) // trie.UNIT for k in keys])
    lcp = trie.neighbour_lcp(keys, length)
    assert lcp[1:].tolist() == [trie.common_turns(a, b) for a, b in zip(keys, keys[1:])]
    table = trie.sparse_table(lcp)
    for j, k in enumerate(keys):
        for d in range(len(k) // trie.UNIT + 1):
            same = [i for i, o in enumerate(keys) if o[:d * trie.UNIT] == k[:d * trie.UNIT]]
            at = np.array([j]), np.array([d])
            assert (trie.extent_left(table, *at)[0], trie.extent_right(table, *at)[0]) == (same[0], same[-1])


# --- packing -----------------------------------------------------------------

def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))


def ranks_50k():
    return tokenizers.path(queries.RANKS_50K), tokenizers.PATTERN


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_first_fit_decreasing(lengths):
    bins = packing.first_fit_decreasing(lengths, 64)
    # the plain form: each item into the first sequence with room
    plain, room = [], []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        at = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
        if at == len(room):
            plain.append([])
            room.append(64)
        plain[at].append(i)
        room[at] -= lengths[i]
    assert bins == plain
    made = packing.close_gaps(bins, lengths, 64)
    held = defaultdict(list)
    for s in made:
        n = sum(k for *_, k in s)
        assert n == 64 or n & (n - 1) == 0
        for i, start, k in s:
            held[i].append((start, k))
    for i, n in enumerate(lengths):
        at = 0
        for start, k in sorted(held[i]):
            assert start == at and k > 0
            at += k
        assert at == n


def check_packing(pieces, texts, size=1024):
    """``texts``: (key, text) rows. Every id lies in one piece, at its place."""
    tk = library()
    want = Counter()
    for key, text in texts:
        want[(key, tuple(tk.encode(text or "", add_special_tokens=False).ids + [0]))] += 1
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        by_doc[r.doc_id].append((r.start, r.doc_tokens, ids))
        sequences[r.sequence_id].append((r.offset, len(ids)))
    for key in {k for k, _ in want}:
        whole = [list(ids) for (k, ids), n in want.items() if k == key for _ in range(n)]
        assert sum(len(ids) for *_, ids in by_doc[key]) == sum(map(len, whole))
        if len(whole) == 1:
            assert [i for _, _, ids in sorted(by_doc[key]) for i in ids] == whole[0]
        else:  # repeated keys: as many ids at each place as documents have
            places = Counter((s + o, i) for s, _, ids in by_doc[key] for o, i in enumerate(ids))
            assert places == Counter((o, i) for w in whole for o, i in enumerate(w))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


TEXTS = [(1, None), (2, ""), (3, "Hello  wörld\n\n it's 2024 中文 <|endoftext|>x"), (4, "word " * 30_000), (5, "a" * 5000),
         (6, "dup"), (6, "dup"), (None, "no key"), (None, "no key either"), (7, "x<|endoftext|><|endoftext|>"),
         *[(k, "some words of a text " * (k % 90)) for k in range(10, 200)]]


def test_packing_odd_rows(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("group", F.lit(2))
    for group in (2048, 16, 1):
        pieces = packing.pack(docs, *ranks_50k(), group=group).collect()
        assert check_packing(pieces, TEXTS) == 0
    assert packing.pack(docs.limit(0), *ranks_50k()).count() == 0


def test_op12_equals_library(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = queries.op12_packing(spark, SF0001).collect()
    pieces = packing.pack(docs, *ranks_50k()).collect()
    assert check_packing(pieces, [(r.doc_id, r.text) for r in docs.collect()]) == 0
    want = Counter((r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in pieces)
    assert Counter(tuple(r) for r in rows) == want


def test_ranks_equal_the_library():
    """The rank file gives the library's ids, over all scripts."""
    tk, enc = library(), bpe.encoding(*ranks_50k())
    tk.encode_special_tokens = True
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(chars), 9973):
        text = " ".join(f"a{c}1 {c}{c}" for c in chars[k:k + 600])
        assert enc.encode_ordinary(text) == tk.encode(text, add_special_tokens=False).ids


# --- alignment ---------------------------------------------------------------

def files():
    return (*ranks_50k(), tokenizers.path(queries.PIECES_32K))


def brute_alignment(rows):
    """Rows (key, text) -> the result, token by token; A by the tokenizers library."""
    import sentencepiece
    tk = library()
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=files()[2])
    _, _, of_a, of_b, _, _ = alignment.tokenizers(*files())
    docs, count = [], Counter()
    for key, text in rows:
        a = tk.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(of_a[i] for i in a) != raw or b"".join(of_b[i] for i in b) != raw:
            a, b = [], []
        spans = []
        for ids, of in ((a, of_a), (b, of_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(of[i]), i))
                at += len(of[i])
            spans.append(out)
        links, j0 = [], 0
        for s, e, i in spans[0]:
            while j0 < len(spans[1]) and spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][0] < e:
                links.append((i, spans[1][j][2]))
                j += 1
        shared = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, lo = [], 0
        for end in shared:
            groups.append("|".join(",".join(str(i) for s, e, i in sp_ if lo < e <= end) for sp_ in spans))
            lo = end
        docs.append((key, len(a), len(b), len(groups), links, ";".join(groups)))
        count.update(links)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return Counter((key, na, nb, g, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), text)
                   for key, na, nb, g, links, text in docs)


ALIGN = [(1, None), (2, ""), (3, "Hello  wörld\n\n it's 2024 中文 <|endoftext|> <s> </s> <0x0A>"), (4, "▁under"), (5, " lead  and trail  "),
         (6, "a" * 300), (7, "dup dup"), (7, "dup dup"), (None, "\tkey\x00less\r\n"), (8, "🙂🙃 é é 　x"), (9, "x"), (10, " "),
         (11, "straße " * 40)]


def test_alignment_odd_rows(spark):
    docs = spark.createDataFrame(ALIGN, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("block", F.lit(2))
    want = brute_alignment(ALIGN)
    for work, block in ((1024, 1 << 24), (1, 1), (7, 50)):
        got = alignment.align_documents(docs, *files(), work=work, block_bytes=block).collect()
        assert Counter(tuple(r) for r in got) == want
    assert alignment.align_documents(docs.limit(0), *files()).count() == 0


def test_op13_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter({(*k[:7], hashlib.sha256(k[7].encode()).hexdigest() if k[1] else ""): n
                    for k, n in brute_alignment(rows).items()})
    got = alignment.align_documents(docs, *files(), result="digests").collect()
    assert Counter(tuple(r) for r in got) == want
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    full = queries.op13_alignment(spark, SF0001)
    assert full.columns == cols and full.count() == spark.read.parquet(f"{SF0001}/documents.parquet").count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é中  \n<1s>", max_size=30), min_size=1, max_size=5), st.integers(1, 9))
def test_segments_do_not_change_ids(words, size):
    text = " ".join(words)
    tok = alignment.tokenizers(*files())
    whole, parts = alignment.encode(tok, text, 1 << 20), alignment.encode(tok, text, size)
    assert (whole is None) == (parts is None)
    if text and whole is not None:
        for k in (0, 1):
            assert np.concatenate([p[k] for p in parts]).tolist() == whole[0][k].tolist()


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(1, 8))
def test_merge_path(a, b, work):
    a, b = (np.array(sorted(x | {61})) for x in (a, b))
    order = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    i0, j0 = alignment.merge_path(a, b, work)
    for i, j in zip(i0, j0):
        head = order[:i + j]
        assert i == sum(k == 0 for _, k in head) and j == sum(k for _, k in head)
    from_b, i, j, shared = alignment.merge(a, b, work)
    assert from_b.tolist() == [bool(k) for _, k in order]
    assert i.tolist() == [sum(k == 0 for _, k in order[:n]) for n in range(len(order))]
    assert shared.tolist() == [bool(k) and x in set(a.tolist()) for x, k in order]
