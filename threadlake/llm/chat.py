r"""Chat formatting: turns to one training string per conversation, and back.

Template.  A run of adjacent turns of one role is one message::

    <|im_start|>ROLE\nTEXT<|im_sep|>TEXT...<|im_end|>\n

Turns inside a merged message are parted by ``<|im_sep|>``, so the original
turns can be read back.  Inside texts and roles every ``<|`` (and ``<\|``,
``<\\|``, ...) gets one more backslash, which keeps control strings out of the
content and is undone by taking one away.

Everything is a Spark expression.  Turn structs are collected and sorted per
block of ``BLOCK`` turn numbers, never per whole conversation; a block learns
from the small table of block borders whether its first message goes on from
the block before.  Only the finished string of a conversation is one row.

Defined cases: null text or role is the empty string; null turn numbers come
first; equal turn numbers are ordered by role and text and all kept; a null
conv_id is a conversation of its own; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
BLOCK = 256
LOSS_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """Roles end at the newline of the header, so theirs are written ``\\n``."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\", -1)  # at every pair of backslashes, from the left
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, block, turns: sorted array of structs) with the last role of
    the block before and the first role of the one after."""
    rows = turns.select(
        F.col("conv_id"), F.floor(F.coalesce(F.col("turn"), F.lit(0)) / BLOCK).alias("block"),
        F.struct(F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
                 F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("t"))
    got = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    ends = Window.partitionBy("conv_id").orderBy("block")
    border = got.select("conv_id", "block", F.col("turns")[0]["role"].alias("first"),
                        F.element_at("turns", -1)["role"].alias("last"))
    border = border.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"),
                           F.lag("last").over(ends).alias("before"), F.lead("first").over(ends).alias("after"))
    return got.join(border, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b"))).drop("_c", "_b")


def messages(turns: Column) -> Column:
    """Sorted turns to messages: adjacent turns of one role merged by an array
    aggregation.  Each message is (role, texts)."""
    empty = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def add(acc, t):
        last = F.try_element_at(acc, F.lit(-1))
        return F.when(
            last["role"] == t["role"],
            F.concat(F.slice(acc, 1, F.size(acc) - 1),
                     F.array(F.struct(t["role"].alias("role"),
                                      F.concat(last["texts"], F.array(t["text"])).alias("texts"))))
        ).otherwise(F.concat(acc, F.array(F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts")))))

    return F.aggregate(turns, empty, add)


def format_chats(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) → conv_id, formatted, loss_spans.

    ``loss_spans`` is the loss mask: (start, length) in code points of
    ``formatted``, one span per assistant turn, without template marks.
    Columns other than the four are ignored.
    """
    b = blocks(turns).withColumn("m", messages(F.col("turns")))
    n = F.size("m")
    # pieces: template marks (no loss) and escaped texts, in order
    mark = lambda s: F.struct(s.alias("s"), F.lit(False).alias("loss"))

    def pieces(m, i):
        goes_on = (i == 0) & F.coalesce(F.col("before") == m["role"], F.lit(False))
        head = F.when(goes_on, F.lit(SEP)).otherwise(F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n")))
        stays = (i == n - 1) & F.coalesce(F.col("after") == m["role"], F.lit(False))
        loss = m["role"].isin(*LOSS_ROLES)
        body = F.transform(m["texts"], lambda t, j: F.array(
            mark(F.when(j == 0, head).otherwise(F.lit(SEP))), F.struct(escape(t).alias("s"), loss.alias("loss"))))
        return F.concat(F.flatten(body), F.array(mark(F.when(stays, F.lit("")).otherwise(F.lit(END)))))

    b = b.withColumn("p", F.flatten(F.transform("m", pieces)))
    b = b.withColumn("piece", F.array_join(F.transform("p", lambda x: x["s"]), ""))
    zero = F.struct(F.lit(1).cast("long").alias("at"),
                    F.array().cast("array<struct<start:bigint,len:bigint>>").alias("spans"))
    walk = F.aggregate("p", zero, lambda a, x: F.struct(
        (a["at"] + F.char_length(x["s"])).alias("at"),
        F.when(x["loss"], F.concat(a["spans"], F.array(F.struct(
            a["at"].alias("start"), F.char_length(x["s"]).cast("long").alias("len"))))).otherwise(a["spans"]).alias("spans")))
    b = b.select("conv_id", "block", "piece", walk["spans"].alias("spans"), F.char_length("piece").cast("long").alias("n"))
    done = b.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "piece", "spans", "n"))).alias("b"))
    zero_at = F.struct(F.lit(0).cast("long").alias("at"),
                       F.array().cast("array<array<struct<start:bigint,len:bigint>>>").alias("spans"))
    shifted = F.aggregate("b", zero_at, lambda a, x: F.struct(
        (a["at"] + x["n"]).alias("at"),
        F.concat(a["spans"], F.array(F.transform(x["spans"], lambda s: F.struct(
            (s["start"] + a["at"]).alias("start"), s["len"].alias("len"))))).alias("spans")))
    return done.select("conv_id", F.array_join(F.transform("b", lambda x: x["piece"]), "").alias("formatted"),
                       F.flatten(shifted["spans"]).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """Formatted string to its turns: array of (role, text), one per turn."""
    said = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda x: x != "")

    def turns_of(x):
        body = F.substr(x, F.lit(len(START) + 1))
        cut = F.locate("\n", body)
        role = unescape_role(F.substr(body, F.lit(1), cut - 1))
        return F.transform(F.split(F.substr(body, cut + 1), r"<\|im_sep\|>"),
                           lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(said, turns_of))


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"].cast("int"), s["len"].cast("int"))))


def digests(chats: DataFrame) -> DataFrame:
    """What can be read back from ``format_chats``: counts and SHA-256."""
    x = chats.select("conv_id", "formatted", read_back(F.col("formatted")).alias("t"),
                     F.array_join(masked_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    all_turns = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return x.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"),
        F.sha2(F.encode(all_turns, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode(F.col("loss"), "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
