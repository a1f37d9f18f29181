"""Chat formatting with Spark expressions only.

A conversation is the array of its turns, sorted by (turn, role, text). Runs of
adjacent turns of one role are merged into one block by array aggregation:

    <|im_start|>role\\nfirst text<|im_sep|>second text<|im_end|>\\n

Control strings cannot come from a text or a role: ``%`` is written ``%25`` and
``<|`` is written ``<%7C`` (a line break in a role: ``%0A``), which is undone
when the output is read back. ``<|im_sep|>`` keeps the turns of a merged block
apart, so reading back gives every turn again.

The loss mask covers the texts of assistant turns, without role lines and
control strings.

Defined results: null text and null role are empty; null turns sort first;
turns with equal numbers sort by role, then text; repeated rows stay; rows with
null ``conv_id`` form one conversation of that id. A conversation is one row of
output, so it has to fit in memory as one string, as any chat template needs.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: control strings of the template ---------------------------
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("<%7C"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("%7C"), F.lit("|")), F.lit("%25"), F.lit("%"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("%0A"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("%0A"), F.lit("\n")))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, n_blocks, formatted`` of rows ``conv_id, turn, role, text``."""
    rows = turns.select(
        "conv_id", F.struct(F.col("turn").alias("turn"),
                            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    sorted_ = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    # where a new block starts; the last element is one past the end
    starts = F.expr("""concat(filter(sequence(1, size(ts)),
                        i -> i = 1 or ts[i - 1].role <> ts[greatest(i - 2, 0)].role),
                        array(size(ts) + 1))""")
    blocks = sorted_.select("conv_id", "ts", starts.alias("at"))

    def body(part: Column) -> Column:
        """Texts of one block, merged left to right."""
        return F.array_join(F.aggregate(
            part, F.array().cast("array<string>"),
            lambda acc, x: F.concat(acc, F.array(escape(x["text"])))), SEP)

    def one(at: Column, i: Column) -> Column:
        part = F.slice(F.col("ts"), at, F.get(F.col("at"), i + 1) - at)
        return F.concat(F.lit(START), escape_role(F.get(part, F.lit(0))["role"]), F.lit("\n"), body(part), F.lit(END))

    n = F.size("at") - 1
    return blocks.select(
        "conv_id", n.alias("n_blocks"),
        F.array_join(F.transform(F.slice("at", F.lit(1), n), one), "").alias("formatted"))


def read_back(chats: DataFrame) -> DataFrame:
    """``conv_id, turns, formatted_chars``: the turns (role, text) parsed from ``formatted`` alone."""
    blocks = F.filter(F.split(F.col("formatted"), F.lit(_quoted(START))), lambda b: b != "")

    parsed = F.flatten(F.transform(blocks, _turns_of))
    return chats.select("conv_id", parsed.alias("turns"),
                        F.char_length("formatted").cast("long").alias("formatted_chars"))


def _quoted(s: str) -> str:
    return r"\Q" + s + r"\E"


def _turns_of(block: Column) -> Column:
    eol = F.instr(block, "\n")
    role = unescape_role(F.substring(block, F.lit(1), eol - 1))
    body = F.substring(block, eol + 1, F.char_length(block) - eol - len(END))
    return F.transform(F.split(body, F.lit(_quoted(SEP))),
                       lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))


def digests(read: DataFrame) -> DataFrame:
    """Digest columns of read-back chats; the loss mask covers assistant texts."""
    all_turns = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == TRAINED_ROLE),
                                    lambda t: t["text"]), "")
    d = read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), all_turns.alias("a"),
                    loss.alias("l"), "formatted_chars")
    return d.select("conv_id", "n_turns", F.sha2("a", 256).alias("turns_sha256"),
                    F.char_length("l").cast("long").alias("loss_chars"), F.sha2("l", 256).alias("loss_sha256"),
                    "formatted_chars")
