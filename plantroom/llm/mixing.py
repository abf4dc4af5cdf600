"""Mixing sources to target weights by hierarchical budgeting.

A token budget is handed down a tree domain - language - source. Siblings share their parent's budget by weight; a
node that holds less than its share gives the rest to its siblings first, and only what all siblings together cannot
take is missing at their parent, where it goes to the parent's siblings. Each leaf spends its budget on whole seeded
epochs of its documents and on a token prefix of one more epoch. Built-in DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantroom.llm.shared import stored

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """Targets: weights are whole numbers above 0, names that are not listed weigh `other`."""

    domains: Mapping[str, int] = field(default_factory=lambda: {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1})
    langs: Mapping[str, int] = field(default_factory=lambda: {"en": 5, "de": 2, "fr": 2, "es": 1})
    sources: Mapping[str, int] = field(default_factory=dict)
    other: int = 1
    #: Tokens to select, as a fraction (numerator, denominator) of those the corpus holds.
    share: tuple[int, int] = (3, 5)
    #: A leaf gives its tokens so many times at most.
    max_epochs: int = 4
    seed: int = 7


def domain_of(source: Column) -> Column:
    """Documents name no domain: sources are dealt to four by a checksum of their name."""
    return F.concat(F.lit("domain"), F.pmod(F.crc32(F.encode(source, "UTF-8")), F.lit(4)).cast("string"))


def count_tokens(text: Column) -> Column:
    """Runs of characters that are no ASCII white space; 0 for null."""
    blank = r"[\x20\x09-\x0D]"
    runs = F.size(F.split(text, blank + "+", -1)) - F.rlike(text, F.lit("^" + blank)).cast("int") - F.rlike(text, F.lit(blank + r"\z")).cast("int")
    return F.when(text.isNull() | (text == ""), 0).otherwise(runs).cast("long")


def _weight(name: Column, weights: Mapping[str, int], other: int) -> Column:
    chosen = F.lit(other)
    for key, weight in weights.items():
        chosen = F.when(name == key, weight).otherwise(chosen)
    return chosen.cast("decimal(10,0)")


def share_out(nodes: DataFrame, parents: list[str], name: str, weights: Mapping[str, int], other: int) -> DataFrame:
    """Split each parent's `budget` among its children by weight, none above its `cap`; adds `part`.

    Children are filled in the order of cap by weight; a child whose share reaches its cap is full, the others divide
    what is left. Whole tokens: what rounding leaves goes one by one to the first names. Exact integer arithmetic.
    """
    exact = "decimal(20,0)"
    by_ratio = Window.partitionBy(*parents).orderBy("ratio", name)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy(*parents)
    rest = F.col("budget").cast(exact) - F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(exact)
    open_weight = F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(before), F.lit(0))
    sized = (
        nodes.withColumn("w", _weight(F.col(name), weights, other))
        .withColumn("ratio", F.col("cap").cast("double") / F.col("w").cast("double"))
        .withColumn("full", F.col("cap").cast(exact) * open_weight.cast("decimal(12,0)") <= rest * F.col("w"))
    )
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everyone), F.lit(0))
    weight_left = F.sum(F.when(~F.col("full"), F.col("w"))).over(everyone)
    split = sized.withColumn("left", left.cast("long")).withColumn(
        "part",
        F.when(F.col("full"), F.col("cap")).otherwise(
            F.floor(F.col("left").cast(exact) * F.col("w") / weight_left.cast("decimal(12,0)")).cast("long")
        ),
    )
    over = F.col("left") - F.coalesce(F.sum(F.when(~F.col("full"), F.col("part"))).over(everyone), F.lit(0))
    turn = F.row_number().over(Window.partitionBy(*parents, "full").orderBy(name))
    return (
        split.withColumn("over", over)
        .withColumn("part", F.col("part") + F.when(~F.col("full") & (turn <= F.col("over")), 1).otherwise(0))
        .drop("w", "ratio", "full", "left", "over", "budget")
    )


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Tokens to take from each leaf (domain, lang, source, tokens): adds `budget`.

    The tree's inner nodes are sums of leaves, so everything here is as small as the list of sources.
    """
    capped = leaves.withColumn("cap", F.col("tokens") * mix.max_epochs)
    total, share = F.sum("tokens"), mix.share
    root = capped.agg(
        F.least(F.floor(total * share[0] / share[1]).cast("long"), F.sum("cap")).alias("budget")
    ).withColumn("root", F.lit(1))
    domains = capped.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("root", F.lit(1)).join(root, "root")
    domains = share_out(domains, ["root"], "domain", mix.domains, mix.other).select("domain", F.col("part").alias("budget"))
    langs = capped.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(domains, "domain")
    langs = share_out(langs, ["domain"], "lang", mix.langs, mix.other).select("domain", "lang", F.col("part").alias("budget"))
    sources = capped.join(langs, ["domain", "lang"])
    return share_out(sources, ["domain", "lang"], "source", mix.sources, mix.other).withColumnRenamed("part", "budget").drop("cap")


def mixed(documents: DataFrame, mix: Mix | None = None) -> DataFrame:
    """How often each document is used: doc_id, domain, lang, source, n_tokens, epochs, part_tokens, taken.

    `epochs` whole copies and the first `part_tokens` tokens of one more; the tokens taken of a leaf add up to its
    budget exactly. A leaf's order in an epoch follows from a digest of seed, epoch and doc_id, ties by doc_id and
    tokens. Null or empty texts have no tokens and are never taken; a null lang or source is the empty name; rows with
    the same doc_id are documents of their own; further columns are ignored.

    Running sums are taken within 4,096 ranges of the digest for each leaf, so that a leaf with most of the corpus is
    no single task.
    """
    return _drawn(stored(documents.select(*_skinny()), "mix"), mix or Mix()).drop("text_key", "number")


def selected(documents: DataFrame, mix: Mix | None = None) -> DataFrame:
    """The documents that are used at all, whole, with all their columns and domain, n_tokens, epochs, part_tokens.

    Rows are numbered and written to the shared folder once, so equal rows keep apart: each has numbers of its own,
    and the tokens of the result add up to the budget as in `mixed`. Columns of documents that have the name of an
    added one are replaced.
    """
    added = ("domain", "n_tokens", "epochs", "part_tokens")
    names = [c for c in documents.columns if c not in added]
    whole = F.struct(*names).alias("whole")
    rows = stored(documents.select(*_skinny(), F.monotonically_increasing_id().alias("number"), whole), "mix")
    used = _drawn(rows.drop("whole"), mix or Mix()).where("taken > 0").select("number", *added)
    return rows.select("number", "whole").join(used, "number").select("whole.*", *added)


def _skinny() -> list[Column]:
    """What the draw needs of a document."""
    source = F.coalesce("source", F.lit(""))
    return [
        F.col("doc_id"),
        domain_of(source).alias("domain"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        source.alias("source"),
        count_tokens(F.col("text")).alias("n_tokens"),
        F.xxhash64("text").alias("text_key"),
    ]


def _drawn(skinny: DataFrame, mix: Mix) -> DataFrame:
    """`mixed` of stored rows of `_skinny`, with their `number` if they have one."""
    if "number" not in skinny.columns:
        skinny = skinny.withColumn("number", F.lit(0))
    leaves = skinny.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, mix).select(
        *LEVELS,
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("epochs"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("rest"),
    )
    drawn = skinny.join(budgets, list(LEVELS)).withColumn(
        "draw", F.md5(F.concat_ws(":", F.lit(str(mix.seed)), (F.col("epochs") + 1).cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    )
    drawn = drawn.withColumn("range", F.substring("draw", 1, 3))
    offsets = (
        drawn.groupBy(*LEVELS, "range")
        .agg(F.sum("n_tokens").alias("held"))
        .withColumn(
            "offset",
            F.coalesce(
                F.sum("held").over(Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .drop("held")
    )
    within = Window.partitionBy(*LEVELS, "range").orderBy("draw", "doc_id", "n_tokens", "text_key", "number").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("offset") + F.col("ahead")
    return (
        drawn.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(offsets, [*LEVELS, "range"])
        .withColumn("part_tokens", F.least(F.col("n_tokens"), F.greatest(F.col("rest") - before, F.lit(0))))
        .select(
            "doc_id", *LEVELS, "n_tokens", F.col("epochs").cast("long").alias("epochs"), F.col("part_tokens").cast("long").alias("part_tokens"),
            (F.col("epochs") * F.col("n_tokens") + F.col("part_tokens")).cast("long").alias("taken"), "text_key", "number",
        )
    )
