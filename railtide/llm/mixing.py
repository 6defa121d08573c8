"""Mixing sources to target weights by a temperature on their token shares.

A source with token share ``p`` gets weight ``p ** exponent``, normalised. The exponent is bisected
until the weights have a wanted entropy, or no source is passed through more often than allowed.
The weights are then realised: every source is read in passes, each pass a permutation of its
blocks and of the rows inside them, until its part of the token budget is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtide.llm.common import spread_join
from railtide.session import store

# The exponent is sought between 0 (equal weights) and this.
LARGEST_EXPONENT = 8.0
# Halvings of that range, and how many of them one job decides.
HALVINGS, HALVINGS_PER_JOB = 30, 5
ROWS_PER_BLOCK = 4096


def token_count(text: Column) -> Column:
    """Words between ASCII white space plus one for the end, so that no row is free."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 1


def source_name(source: Column) -> Column:
    """A null source counts as the source with the empty name."""
    return F.coalesce(source.cast("string"), F.lit(""))


def source_tokens(docs: DataFrame) -> DataFrame:
    return docs.groupBy(source_name(F.col("source")).alias("mix_source")).agg(
        F.sum(token_count(F.col("text"))).alias("tokens"), F.count(F.lit(1)).alias("rows"))


def _facts(shares: DataFrame, exponents: list[float]) -> DataFrame:
    """Per exponent: norm, entropy in nats, and the most passes per token of budget share."""
    powers = shares.withColumn("exponent", F.explode(F.array(*[F.lit(x) for x in exponents]))).withColumn(
        "w", F.pow("share", F.col("exponent")))
    sums = powers.groupBy("exponent").agg(
        F.sum("w").alias("norm"), F.sum(F.col("w") * F.log("w")).alias("wlogw"),
        F.max(F.col("w") / F.col("share")).alias("most"))
    return sums.select("exponent", "norm", (F.log("norm") - F.col("wlogw") / F.col("norm")).alias("entropy"),
                       (F.col("most") / F.col("norm")).alias("most"))


def find_exponent(shares: DataFrame, entropy: float | None = None, repeats: float | None = None,
                  budget_share: float | None = 1.0) -> float:
    """The exponent at which the target is just met, by bisection.

    ``entropy`` in nats: the largest exponent whose weights still have it. ``repeats``: the smallest
    exponent, up to 1, at which no source is passed through more than so often; ``budget_share`` is
    the token budget over all tokens, None for the smallest budget that reads every source once.
    With both, the limit on repeats wins. Rounded to six places.
    """
    def bisect(low: float, high: float, too_high) -> float:
        """Entropy and passes both fall as the exponent grows; one job decides several halvings."""
        for _ in range(HALVINGS // HALVINGS_PER_JOB):
            parts = 1 << HALVINGS_PER_JOB
            grid = [low + (high - low) * i / parts for i in range(1, parts)]
            answers = {r["exponent"]: too_high(r) for r in _facts(shares, grid).collect()}
            left, right = 0, parts
            while right - left > 1:
                middle = (left + right) // 2
                left, right = (left, middle) if answers[grid[middle - 1]] else (middle, right)
            low, high = low + (high - low) * left / parts, low + (high - low) * right / parts
        return low, high

    found = []
    if entropy is not None:
        found.append(bisect(0.0, LARGEST_EXPONENT, lambda r: r["entropy"] < entropy)[0])
    if repeats is not None:
        scale = budget_share
        if scale is None:
            # Most over fewest passes: the largest source is read once.
            largest = shares.agg(F.max("share")).first()[0]
            passes = lambda r: r["most"] * r["norm"] / largest ** (r["exponent"] - 1)
        else:
            passes = lambda r: r["most"] * scale
        found.append(bisect(0.0, 1.0, lambda r: passes(r) <= repeats)[1])
    return round(max(found), 6)


def source_weights(docs: DataFrame, entropy_part: float | None = None, repeats: float | None = None,
                   budget: int | None = None, cover: bool = False) -> DataFrame:
    """Per source: mix_source, tokens, rows, share, exponent, weight, budget (its tokens).

    ``entropy_part`` is the wanted entropy as a part of that of equal weights. ``budget`` defaults
    to all tokens; with ``cover`` it is the smallest one that reads every source at least once.
    """
    found = store(source_tokens(docs), "sources")
    total, sources = found.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    shares = found.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    if not sources:
        exponent, norm, largest = 1.0, 1.0, 1.0
    else:
        target = None if entropy_part is None else entropy_part * math.log(sources)
        part = None if cover else (budget or total) / total
        exponent = find_exponent(shares, target, repeats, part) if sources > 1 else 1.0
        norm, largest = (shares.agg(F.sum(F.pow("share", F.lit(exponent))), F.max("share")).first())
    tokens = budget or total or 0
    if cover and sources:
        # Passes are w T / n; the largest source has the fewest when the exponent is at most one.
        tokens = math.ceil(total * largest ** (1 - min(exponent, 1.0)) * norm)
    weight = F.round(F.pow("share", F.lit(exponent)) / F.lit(norm), 9)
    least = F.col("tokens") if cover else F.lit(0)
    return shares.select(
        "mix_source", "tokens", "rows", "share", F.lit(exponent).alias("exponent"), weight.alias("weight"),
        F.greatest(F.floor(weight * F.lit(float(tokens))).cast("long"), least).alias("budget"))


def _drawn(*parts) -> Column:
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


ADDED = ["mix_source", "n_tokens", "exponent", "weight", "budget", "pass", "block", "block_rank", "start"]


def schedule(docs: DataFrame, weights: DataFrame, seed: int = 17, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Every reading of every row, with all its columns but those of the names in ``ADDED``, which are
    replaced: see ``readings``."""
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ADDED]
    return readings(docs, weights, seed, rows_per_block).select(*kept, *ADDED)


def readings(docs: DataFrame, weights: DataFrame, seed: int = 17, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Every reading of every row: ``row`` holds all its columns.

    Adds mix_source, n_tokens, exponent, weight, budget, pass (from 0), block, block_rank (place of
    the block in the pass), start (tokens of the source read before in this pass). Full passes read
    every row; the last one reads rows while the budget is not used up, so it may exceed it by less
    than one row. A row no pass reads is left out: that is what the weights ask for. Repeated rows
    are rows of their own.
    """
    named = docs.select(
        F.struct(*docs.columns).alias("row"), "doc_id", source_name(F.col("source")).alias("mix_source"),
        token_count(F.col("text")).alias("n_tokens"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("_text"))
    plan = weights.select(
        "mix_source", "exponent", "weight", "budget", F.col("tokens").alias("_tokens"),
        F.ceil(F.col("rows") / rows_per_block).cast("long").alias("_blocks"),
        F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("_full"))
    # Rows of one id, or of none, are told apart by their texts.
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_text")
    cell = F.conv(F.substring(_drawn(F.lit(str(seed)), key), 1, 8), 16, 10).cast("long")
    read = spread_join(named, plan, ["mix_source"], "inner").withColumn("block", F.pmod(cell, F.col("_blocks")))
    read = read.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("_full"))))
    group = ["mix_source", "pass", "block"]
    inside = Window.partitionBy(*group).orderBy("_draw", "doc_id", "n_tokens").rowsBetween(
        Window.unboundedPreceding, -1)
    read = read.withColumn("_draw", _drawn(F.lit(str(seed)), F.col("pass").cast("string"), key)).withColumn(
        "_before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))

    # One row per block: a source has one for every few thousand rows.
    light = spread_join(named.select("mix_source", "doc_id", "n_tokens", "_text"), plan, ["mix_source"], "inner")
    sums = light.withColumn("block", F.pmod(cell, F.col("_blocks"))).groupBy("mix_source", "block").agg(
        F.sum("n_tokens").alias("_size"), F.first("_full").alias("_passes"))
    sums = store(sums, "blocks").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("_passes"))))
    order = Window.partitionBy("mix_source", "pass").orderBy(
        _drawn(F.lit(str(seed)), F.col("pass").cast("string"), F.lit("block"), F.col("block").cast("string")))
    places = sums.select(
        *group, (F.row_number().over(order) - 1).alias("block_rank"),
        F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    placed = read.join(places, group).withColumn("start", F.col("_start") + F.col("_before"))
    wanted = (F.col("pass") < F.col("_full")) | (F.col("start") < F.col("budget") - F.col("_full") * F.col("_tokens"))
    return placed.where(wanted).select("row", *ADDED)
