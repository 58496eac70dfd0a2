"""Prefix-target expansion of conversations, in DataFrame functions only.

Every assistant turn becomes an example: the formatted turns before it as context, and its own
text as the only part under the loss mask.  The template marks turns; control strings inside roles
and texts are escaped, so that the turns can be read back from the formatted text as they were.

A conversation of more than ``block_turns`` turns is put in order and formatted in blocks of so
many turns.  ``examples`` gives its replies within their blocks, and ``whole`` each of them with all
turns before it, as those of shorter conversations are.  The texts of a conversation's examples
grow with the square of its length, and a row holds at most one conversation; they are written out by
block, so that several tasks share them, and none is kept.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import settle, workspace
from jobtide.llm.turns import cut

HEAD, COLON, END = "### ", ": ", "</turn>\n"
REPLIES = "assistant"
BLOCK_TURNS = 64
_ORDER = ["turn", "role", "text"]


def escaped(text: Column) -> Column:
    """``text`` without the template's control strings."""
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    text = F.replace(text, F.lit("</"), F.lit("&lt;/"))
    return F.replace(text, F.lit("##"), F.lit("&num;&num;"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(":"), F.lit("&colon;"))


def unescaped(text: Column) -> Column:
    """What ``escaped`` and ``escaped_role`` were given."""
    for name, sign in (("&colon;", ":"), ("&num;", "#"), ("&lt;", "<"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def _in_order(turns: DataFrame, *keys: str) -> DataFrame:
    """``keys, pieces``: the formatted turns of each group in order."""
    ordered = F.sort_array(F.collect_list(F.struct(*_ORDER)))
    return turns.groupBy(*keys).agg(ordered.alias("turns")).select(
        *keys,
        F.transform(
            "turns",
            lambda t: F.struct(
                F.concat(F.lit(HEAD), escaped_role(t["role"]), F.lit(COLON)).alias("head"),
                escaped(t["text"]).alias("body"),
                (t["role"] == REPLIES).alias("reply"),
            ),
        ).alias("pieces"),
    )


def _written(pieces: Column) -> Column:
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""
    )


def _expanded(blocks: DataFrame) -> DataFrame:
    """The examples of blocks ``conv_id, block, context_turns, context_chars, pieces``."""
    places = F.sequence(F.lit(1), F.size("pieces"))
    kept = F.filter(
        places, lambda i: (i == F.size("pieces")) | F.element_at(F.col("pieces"), i)["reply"]
    )
    target = F.element_at("pieces", F.col("at"))
    exploded = blocks.select("*", F.explode(kept).alias("at"))
    return exploded.select(
        "conv_id",
        "block",
        (F.col("context_turns") + F.col("at") - 1).alias("target"),
        "context_chars",
        _written(F.slice("pieces", 1, F.col("at"))).alias("text"),
        target["reply"].alias("trainable"),
        F.when(target["reply"], F.length(target["body"])).otherwise(0).cast("bigint").alias("loss_chars"),
        (F.col("at") == F.size("pieces")).alias("closes"),
    ).select(
        "conv_id",
        "block",
        "target",
        "context_chars",
        "text",
        "trainable",
        # The reply ends where its closing mark begins.
        (F.length("text") - len(END) - F.col("loss_chars")).cast("bigint").alias("loss_start"),
        "loss_chars",
        "closes",
    )


def prepared(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def examples(
    conversations: DataFrame, block_turns: int = BLOCK_TURNS, folder: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Examples of the short conversations, and within their blocks of the long ones, or None.

    ``whole`` gives those of the long ones all their context.

    Both have ``conv_id, block, target, context_chars, text, trainable, loss_start, loss_chars,
    closes``.  ``conversations`` needs ``conv_id, turn, role, text``; other columns are not read.
    Turns follow each other by ``turn`` (null first), then role and text; a repeated row is a turn
    of its own.  A null role or text counts as empty, a null ``conv_id`` is an id like any other.
    ``target`` is the place of the last turn in ``text``, from 0.  The loss mask covers
    ``loss_chars`` characters from ``loss_start``, the body of that turn (none if it is empty).
    A block that does not end with an assistant's turn is closed by a row that is not trainable,
    so that the output holds all turns.  An empty table gives no rows.
    """
    folder = folder or workspace(conversations.sparkSession)
    short, long_ = cut(prepared(conversations), _ORDER, block_turns, folder)
    none = F.lit(0).cast("bigint")
    whole = _expanded(
        _in_order(short, "conv_id").select(
            "conv_id", none.alias("block"), none.alias("context_turns"), none.alias("context_chars"), "pieces"
        )
    )
    if long_ is None:
        return whole, None
    block = F.floor(F.col("place") / block_turns).alias("block")
    blocks = settle(_in_order(long_.select("*", block), "conv_id", "block"), folder, "blocks")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    chars = F.length(_written(F.col("pieces"))).cast("bigint")
    starts = (
        blocks.select("conv_id", "block", chars.alias("chars"))
        .select(
            F.col("conv_id").alias("own_id"),
            F.col("block").alias("own_block"),
            F.coalesce(F.sum("chars").over(before), none).alias("context_chars"),
        )
    )
    same = F.col("conv_id").eqNullSafe(F.col("own_id")) & (F.col("block") == F.col("own_block"))
    return whole, _expanded(
        blocks.join(starts, same).select(
            "conv_id", "block", (F.col("block") * block_turns).alias("context_turns"), "context_chars", "pieces"
        )
    )


def turns_of(text: Column) -> Column:
    """The turns (``role``, ``text``) that a formatted text holds."""
    pieces = F.filter(F.split(text, END), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.substring(p, F.lit(len(HEAD) + 1), F.instr(p, F.lit(COLON)) - len(HEAD) - 1)).alias("role"),
            unescaped(F.substring(p, F.instr(p, F.lit(COLON)) + len(COLON), F.length(p))).alias("text"),
        ),
    )


def whole(short: DataFrame, long_: DataFrame | None) -> DataFrame:
    """Every example with its whole context in ``text``: the rows that ``examples`` gives without a cut.

    The formatted turns of a long conversation come together once.  Each block then gets them up to
    its end, and its examples are beginnings of that: they meet it by their lengths, without texts.
    """
    if long_ is None:
        return short
    none = F.lit(0).cast("bigint")
    end = (F.col("context_chars") + F.length("text")).alias("end")
    closed = F.sort_array(F.collect_list(F.when(F.col("closes"), F.struct("block", end, "text"))))
    told = (
        long_.groupBy(F.col("conv_id").alias("own_id"))
        .agg(closed.alias("closed"))
        .select(
            "own_id",
            F.array_join(F.col("closed")["text"], "").alias("all"),
            F.size("closed").alias("blocks"),
            F.posexplode(F.col("closed")["end"]).alias("own_block", "own_end"),
        )
        .select(
            "own_id",
            "own_block",
            (F.col("own_block") == F.col("blocks") - 1).alias("ends"),
            F.substring("all", F.lit(1), F.col("own_end").cast("int")).alias("told"),
        )
    )
    same = F.col("conv_id").eqNullSafe(F.col("own_id")) & (F.col("block") == F.col("own_block"))
    lengths = long_.withColumn("end", end).drop("text")
    # The beginnings are many times as large as what they are estimated by.
    joined = told.join(lengths.hint("shuffle_hash"), same)
    return short.unionByName(
        joined.where(F.col("trainable") | F.col("ends")).select(
            "conv_id",
            none.alias("block"),
            "target",
            none.alias("context_chars"),
            F.substring("told", F.lit(1), F.col("end").cast("int")).alias("text"),
            "trainable",
            (F.col("context_chars") + F.col("loss_start")).alias("loss_start"),
            "loss_chars",
            (F.col("closes") & F.col("ends")).alias("closes"),
        )
    )


def _read(found: DataFrame) -> DataFrame:
    """What the rows of whole examples say about the turns of each conversation."""
    mask = F.substring("text", F.col("loss_start") + 1, F.col("loss_chars"))
    said = F.transform(
        turns_of(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    rows = found.select(
        "conv_id",
        "target",
        F.when(F.col("trainable"), unescaped(mask)).alias("loss"),
        F.when(F.col("closes"), said).alias("said"),
        F.length("text").cast("bigint").alias("chars"),
    )
    learnt = F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("target", "loss"))))
    return rows.groupBy("conv_id").agg(
        F.sum(F.when(F.col("loss").isNotNull(), F.col("chars"))).alias("chars"),
        F.max(F.struct("target", F.col("loss").isNull().alias("rest"), F.col("chars").alias("all"))).alias("last"),
        F.array_join(learnt["loss"], "").alias("loss"),
        F.sum(F.size("said")).alias("n_turns"),
        F.max("said").alias("said"),
    ).withColumn("said", F.array_join("said", ""))


def digests(short: DataFrame, long_: DataFrame | None) -> DataFrame:
    """One row per conversation, read back from its whole examples.

    ``formatted_chars`` counts every example with its whole context, and for a conversation
    that does not end with a reply all of its turns once more.  A digest runs over a whole
    conversation, so its text comes together here.
    """
    read = _read(whole(short, long_))
    rest = F.when(F.col("last")["rest"], F.col("last")["all"]).otherwise(0)
    return read.select(
        "conv_id",
        F.col("n_turns").cast("bigint").alias("n_turns"),
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        (F.coalesce("chars", F.lit(0)) + rest).cast("bigint").alias("formatted_chars"),
    )
