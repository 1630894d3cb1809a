"""Mixing sources to target weights by temperature.

The weight of a source is its share of all tokens to the power of an exponent from 0 (all
alike) to 1 (as it is), made to sum to one. The exponent is found by bisection: the one
with a target entropy (in nats), or the smallest whose most repeated source is passed
through at most `max_repeats` times. All sums behind a step are one aggregate over the
sources, whose number is not bounded.

Weights are realised within a token budget. A source is dealt into blocks by a hash of its
documents; each epoch is a permutation of its blocks. Epochs that fit the quota are taken
whole; the last one stops at the document that would go beyond it. Without a budget it is
the smallest one that leaves no document out: the source that gets least passes once.

Tokens are words. Defined results: a null source is the source named ''; a source without
tokens is taken once, as it costs nothing; equal rows are separate documents; a null doc_id
is ordered as the empty string; an empty table gives an empty schedule; extra columns pass
through, save those with the names of the three columns added, which they replace; a very
long text is one document, never cut. If the budget asks for more than max_repeats of
everything, it is lowered to that.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import cut, words

#: A step cuts the interval in so many parts; so many steps.
PARTS, STEPS = 16, 12
#: Quotas go to all tasks up to this size, measured; larger ones are joined by source and
#: one of so many salts.
QUOTA_BYTES, SALTS = 32 << 20, 64


@dataclass(frozen=True)
class Target:
    """One of the two: entropy of the weights in nats, or passes through a source."""

    entropy: float | None = None
    max_repeats: float | None = None
    budget: int | None = None

    def __post_init__(self):
        if (self.entropy is None) == (self.max_repeats is None):
            raise ValueError("give entropy or max_repeats")


def _hash(*parts: Column) -> Column:
    """An order that any engine computes alike."""
    return F.md5(F.concat_ws(":", *parts))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


@dataclass(frozen=True)
class Fit:
    """The exponent, what the powers of the shares sum to, all tokens, the budget."""

    exponent: float
    total_power: float
    tokens: int
    budget: float


def fit_exponent(sources: DataFrame, target: Target) -> Fit:
    """sources: `tokens` for each source."""
    filled = sources.filter("tokens > 0")
    row = filled.agg(
        F.sum("tokens").alias("all"), F.min("tokens").alias("least"), F.max("tokens").alias("most")
    ).first()
    if not row["all"]:
        return Fit(1.0, 1.0, 0, 0.0)
    share = F.col("tokens") / F.lit(float(row["all"]))
    least, most = row["least"] / row["all"], row["most"] / row["all"]

    def too_flat(a: float, z: float, h: float) -> bool:
        """Whether an exponent is below the one that is looked for."""
        if target.entropy is not None:
            return log(z) - a * h / z > target.entropy
        if target.budget is not None:
            return least ** (a - 1) * target.budget / (z * row["all"]) > target.max_repeats
        return (most / least) ** (1 - a) > target.max_repeats

    low, high = 0.0, 1.0
    for _ in range(STEPS):
        tried = [low + (high - low) * i / PARTS for i in range(PARTS + 1)]
        powers = [F.pow(share, F.lit(a)) for a in tried]
        sums = filled.agg(
            *[F.sum(p).alias(f"z{i}") for i, p in enumerate(powers)],
            *[F.sum(p * F.log(share)).alias(f"h{i}") for i, p in enumerate(powers)],
        ).first()
        flat = [too_flat(a, sums[f"z{i}"], sums[f"h{i}"]) for i, a in enumerate(tried)]
        at = sum(flat)  # they fall from true to false
        if at in (0, len(tried)):
            high = tried[min(at, PARTS)]
            break
        low, high = tried[at - 1], tried[at]
    z = filled.agg(F.sum(F.pow(share, F.lit(high)))).first()[0]
    if target.budget is None:  # one pass of the source that gets least
        budget = row["most"] * z / most**high
    elif target.max_repeats is None:
        budget = float(target.budget)
    else:
        budget = min(float(target.budget), target.max_repeats * row["all"])
    return Fit(high, z, row["all"], budget)


def _few(counts: DataFrame) -> bool:
    size = counts.agg(F.sum(F.octet_length("_source") + 128)).first()[0]
    return (size or 0) <= QUOTA_BYTES


def _with_quota(df: DataFrame, quotas: DataFrame, few: bool, spread: str) -> DataFrame:
    """df with the quota of its source, such that no task gets all rows of a source; `spread`
    tells rows of a source apart."""
    if few:
        return df.join(F.broadcast(quotas), "_source")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    return (
        df.withColumn("_salt", salt)
        .join(quotas.withColumn("_salt", salts), ["_source", "_salt"])
        .drop("_salt")
    )


def _placed(blocks: DataFrame) -> DataFrame:
    """Adds to the blocks of each source and epoch, in the order of `_rank`, their place
    (`block`, from 0) and the tokens before them (`before`).

    A range shuffle puts the blocks in order, however many a source has; what a partition
    holds of each source and epoch is one row, and the rows before it move its places. The
    ordered blocks are written, since range bounds are sampled."""
    order = ["_source", "epoch", "_rank", "_block"]
    group = ["_source", "epoch", "_part"]
    ordered = cut(
        blocks.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_part"))
    )
    inside = Window.partitionBy(*group).orderBy("_rank", "_block")
    earlier = (
        Window.partitionBy("_source", "epoch")
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    held = ordered.groupBy(*group).agg(F.count("*").alias("n"), F.sum("tokens").alias("held"))
    moved = held.select(
        *group,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n"),
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("_held"),
    )
    local = ordered.withColumn("block", F.row_number().over(inside) - 1).withColumn(
        "before", F.sum("tokens").over(inside) - F.col("tokens")
    )
    return (
        local.join(moved, group)
        .withColumn("block", (F.col("block") + F.col("_n")).cast("int"))
        .withColumn("before", F.col("before") + F.col("_held"))
        .drop("_part", "_n", "_held")
    )


def schedule(
    docs: DataFrame, target: Target, block_docs: int = 1024, seed: int = 7
) -> DataFrame:
    """docs with `n_tokens`, `epoch` (from 0) and `block` (its place in the permutation of
    the epoch, from 0): a row for each time that a document is taken."""
    names = [c for c in docs.columns if c not in ("n_tokens", "epoch", "block")]
    text = F.coalesce("text", F.lit(""))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    sized = docs.select(
        F.struct(*names).alias("_row"),
        F.coalesce("source", F.lit("")).alias("_source"),
        _hash(F.lit(seed), name, F.md5(text)).alias("_order"),
        F.size(words(text)).cast("long").alias("_tokens"),
    )
    counts = cut(
        sized.groupBy("_source").agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("docs"))
    )
    fit = fit_exponent(counts, target)
    weight = F.pow(F.col("tokens") / F.lit(float(fit.tokens or 1)), F.lit(fit.exponent))
    per_pass = F.greatest("tokens", F.lit(1))
    quotas = (
        counts.withColumn("_blocks", F.ceil(F.col("docs") / block_docs).cast("long"))
        .withColumn("quota", F.round(weight / fit.total_power * fit.budget).cast("long"))
        .withColumn("quota", F.when(F.col("tokens") == 0, 1).otherwise(F.col("quota")))
        .withColumn("whole", F.floor(F.col("quota") / per_pass).cast("int"))
        .withColumn("rest", F.col("quota") % per_pass)
        .select("_source", "_blocks", "whole", "rest")
    )
    few = _few(counts)
    dealt = _with_quota(sized, quotas.select("_source", "_blocks"), few, "_order").withColumn(
        "_block", _number(F.col("_order")) % F.col("_blocks")
    )
    blocks = dealt.groupBy("_source", "_block").agg(F.sum("_tokens").alias("tokens"))
    last = F.col("whole") - F.when(F.col("rest") > 0, 0).otherwise(1)
    left = F.when(F.col("epoch") < F.col("whole"), 2**62).otherwise(F.col("rest") - F.col("before"))
    ranked = (
        _with_quota(blocks, quotas.drop("_blocks"), few, "_block")
        .withColumn("_last", last)
        .filter("_last >= 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), "_last")))
        .withColumn("_rank", _hash(F.lit(seed), F.col("_source"), F.col("epoch"), F.col("_block")))
    )
    plan = (
        _placed(ranked)
        .withColumn("_left", left)
        .filter("_left > 0")
        .select("_source", "_block", "epoch", "block", "_left")
    )
    within = (
        Window.partitionBy("_source", "_block", "epoch")
        .orderBy("_order")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        dealt.join(plan, ["_source", "_block"])
        .withColumn("_so_far", F.sum("_tokens").over(within))
        .filter("_so_far <= _left")
        .select("_row.*", F.col("_tokens").alias("n_tokens"), "epoch", "block")
    )
