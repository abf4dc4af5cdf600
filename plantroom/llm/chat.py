"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only the reply is under the
loss mask. Turns behind the last reply go into one more example without a mask, so that nothing of a conversation is
lost. Texts are marked up as `<|role|>text<|end|>`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>"
_HEADER = r"^<\|((?:[^\\|]++|\\.)*+)\|>"


def escape_text(text: Column) -> Column:
    """No `<|` is left in the result, so it holds no marker: `\\` becomes `\\\\`, `<|` becomes `<\\|`."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    """As texts, but every bar is escaped: the role ends at the first bar without a backslash."""
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def unescape(text: Column) -> Column:
    """A backslash stands before the character it protects."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def expand_replies(conversations: DataFrame) -> DataFrame:
    """Examples of conversations with the columns conv_id, turn, role, text.

    Returns conv_id, example (from 1), is_last, text, loss_start, loss_end (code points of `text`, end exclusive; both
    null in the example without a reply). Turns are ordered by turn, ties by role and text, a null turn first; repeated
    rows are turns of their own. Null roles and texts are empty; rows without conv_id are one conversation. Further
    columns are ignored. A conversation is held in one row, as its longest example is.
    """
    turns = (
        conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    )
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit("<|"), escape_role(t["role"]), F.lit("|>")).alias("head"),
            F.concat(escape_text(t["text"]), F.lit(END)).alias("body"),
            (t["role"] == "assistant").alias("reply"),
        ),
    )
    marked = turns.select("conv_id", pieces.alias("pieces"))
    wanted = F.filter(
        F.sequence(F.lit(1), F.size("pieces")),
        lambda i: F.element_at("pieces", i)["reply"] | (i == F.size("pieces")),
    )
    at = F.element_at("pieces", F.col("at"))
    context = F.array_join(
        F.transform(F.slice("pieces", F.lit(1), F.col("at") - 1), lambda p: F.concat(p["head"], p["body"])), ""
    )
    return (
        marked.select("conv_id", "pieces", F.posexplode(wanted).alias("n", "at"))
        .select(
            "conv_id",
            (F.col("n") + 1).alias("example"),
            (F.col("at") == F.size("pieces")).alias("is_last"),
            context.alias("context"),
            at["head"].alias("head"),
            at["body"].alias("body"),
            at["reply"].alias("reply"),
        )
        .select(
            "conv_id",
            "example",
            "is_last",
            F.concat("context", "head", "body").alias("text"),
            F.when(F.col("reply"), F.length("context") + F.length("head")).alias("loss_start"),
            F.when(F.col("reply"), F.length("context") + F.length("head") + F.length("body") - len(END)).alias("loss_end"),
        )
    )


def read_turns(text: Column) -> Column:
    """The turns of an example, as an array of (role, text)."""
    segments = F.filter(F.split(text, r"<\|end\|>", -1), lambda s: s != "")
    return F.transform(
        segments,
        lambda s: F.struct(
            unescape(F.regexp_extract(s, _HEADER, 1)).alias("role"),
            unescape(F.substr(s, F.length(F.regexp_extract(s, _HEADER, 0)) + 1)).alias("text"),
        ),
    )


def read_loss(text: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped; empty without a mask."""
    return F.coalesce(unescape(F.substr(text, start + 1, end - start)), F.lit(""))


def digests(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, read back from their texts (the contract of the op4 query)."""
    turns = F.when(F.col("is_last"), read_turns(F.col("text")))
    per_example = examples.select(
        "conv_id",
        "example",
        F.length("text").cast("long").alias("chars"),
        turns.alias("turns"),
        read_loss(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"),
    ).select(
        "conv_id",
        "example",
        "chars",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("sha"),
        "loss",
    )
    grouped = per_example.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("sha").alias("turns_sha256"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
