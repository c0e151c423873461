"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

1. ``source_targets``: every source's share of all words, stopping at ``cap`` times its size.
2. ``apportion`` gives blocks of ``block_words`` words to sources, and each source's blocks to its shards, by the
   highest quotients weight / (2k - 1).
3. Inside a shard documents stand in a seeded order and are cut into blocks of equal words; the quota takes every
   block so many whole times, and once more the blocks of a seeded stretch.

A block is a stretch of word numbers, so its selection is arithmetic on each document's own numbers: no block is ever
a row. The only sorts are one per shard (about ``shard_words`` words) and one over the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """``sizes`` (source, source_size), one row per source, with the column ``target``.

    Sources in code-point order, null last, weigh ``weights`` in turn. The level at which capped sources and weights
    together use up all words is found in one pass over sources sorted by cap / weight: the sources before the first
    one that stays below its cap are full."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (turn + 1).cast("int"))
    full = F.lit(cap).cast("bigint") * F.col("source_size")
    by_ratio = Window.orderBy(F.col("_full") / F.col("_w"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    used = F.coalesce(F.sum("_full").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_w").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - used).cast("double") / rest
    ranked = (sizes.withColumn("_w", w).withColumn("_full", full).withColumn("_level", level)
              .withColumn("_fits", F.col("_level") <= F.col("_full") / F.col("_w")))
    # the source of the lowest ratio that stays below its cap sets the level of all sources after it
    first = F.min(F.when(F.col("_fits"), F.struct((F.col("_full") / F.col("_w")).alias("r"), F.col("_level").alias("l")))).over(everything)["l"]
    return (ranked.withColumn("_share", first * F.col("_w"))
            .withColumn("target", F.when(F.col("_share") < F.col("_full"), F.col("_share")).otherwise(F.col("_full").cast("double")))
            .select("source", "source_size", "target"))


def apportion(parties: DataFrame, within: list[str], weight: str, seats: str, most: str, name: str) -> DataFrame:
    """Sainte-Lague seats for ``parties``, separately for each value of ``within``; adds the column ``name``.

    The highest quotients weight / (2k - 1) win. Seats that win for sure need no look: with S parties, no party's
    final number is further from its rounded share than S / 2 times its share of the weight plus one, so only the
    quotients in that range are ranked, about four a party. ``most`` bounds a party's seats. A party without
    weight gets none. Equal quotients go to the party that comes first in order of its remaining columns."""
    keys = [c for c in parties.columns if c not in (weight, seats, most)]
    group = Window.partitionBy(*within)
    share = F.when(F.sum(weight).over(group) > 0, F.col(weight) / F.sum(weight).over(group)).otherwise(F.lit(0.0))
    known = (parties.withColumn("_share", share)
             .withColumn("_near", F.floor(F.col("_share") * F.col(seats) + 0.5))
             .withColumn("_span", F.ceil(F.col("_share") * F.count(F.lit(1)).over(group) / 2) + 2)
             .withColumn("_low", F.greatest(F.lit(0), F.least(F.col("_near") - F.col("_span"), F.col(most))))
             .withColumn("_left", F.col(seats) - F.sum("_low").over(group)))
    quotas = known.withColumn("_k", F.explode_outer(F.when(F.col(weight) > 0, F.filter(
        F.sequence(F.col("_low") + 1, F.greatest(F.col("_low") + 1, F.col("_near") + F.col("_span"))), lambda k: k <= F.col(most)))))
    order = [F.when(F.col("_k").isNotNull(), F.col(weight) / (2 * F.col("_k") - 1)).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in keys]]
    won = quotas.withColumn("_won", (F.row_number().over(group.orderBy(*order)) <= F.col("_left")) & F.col("_k").isNotNull())
    return (won.groupBy(*keys, weight, most)
            .agg((F.first("_low") + F.sum(F.col("_won").cast("bigint"))).cast("bigint").alias(name)))


def _number(text: Column, n: Column) -> Column:
    """A seeded number from 0 to n - 1."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint") % n


def mix(docs: DataFrame, size: Column, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block_words: int = 16,
        shard_words: int = 100_000, most_shards: int = 4096, seed: int = 17) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: how many words of each row of ``docs`` the mix takes.

    ``size`` is an integer column expression. A source's taken words differ from its target by its rounding to blocks
    and by short last blocks of its shards, at most one per shard. A row's ``taken`` is ``cap`` times its size at most.
    A null source is a source like any other, last in order. Rows without words take part with nothing. Equal rows
    share their place in the order, so which of them is cut short is not told apart. An empty table gives no rows.
    A source is split into about source_size / ``shard_words`` shards, ``most_shards`` of them at most: that bounds
    the ranking of a source's shards, and shards of a very large source grow instead."""
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))   # a key that is never null keeps one partitioning throughout
    sized = stored(docs.select(F.col("doc_id"), F.col("source"), size.cast("bigint").alias("size"), key.alias("_src")), "mix-sizes")
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    total = Window.partitionBy(F.lit(0))
    blocks = F.floor(F.sum("source_size").over(total) / block_words + 0.5).cast("bigint")
    won = apportion(sources.withColumn("_all", F.lit(0)).withColumn("_seats", blocks)
                    .withColumn("_most", F.ceil(F.col("source_size") / block_words).cast("bigint") * cap),
                    ["_all"], "target", "_seats", "_most", "_blocks")
    shards = F.greatest(F.lit(1), F.least(F.lit(most_shards), F.ceil(F.col("source_size") / shard_words))).cast("bigint")
    sources = stored(won.select(key.alias("_src"), "source_size", "target", "_blocks", shards.alias("_shards")), "mix-sources")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    placed = (sized.join(sources, "_src").withColumn("_order", order)
              .withColumn("_shard", F.conv(F.substring("_order", 1, 7), 16, 10).cast("bigint") % F.col("_shards")))
    by_shard = (placed.groupBy("_src", "_shard").agg(F.sum("size").alias("_words"), F.first("_blocks").alias("_seats"))
                .withColumn("_most", F.ceil(F.col("_words") / block_words).cast("bigint") * cap))
    quotas = (apportion(by_shard, ["_src"], "_words", "_seats", "_most", "_quota")
              .withColumn("_n", F.greatest(F.lit(1), F.ceil(F.col("_words") / block_words).cast("bigint")))
              .withColumn("_whole", F.floor(F.col("_quota") / F.col("_n")))
              .withColumn("_more", F.col("_quota") % F.col("_n"))
              .withColumn("_from", _number(F.concat_ws("/", F.lit(str(seed)), "_src", "_shard"), F.col("_n")))
              .select("_src", "_shard", "_n", "_whole", "_more", "_from"))
    line = Window.partitionBy("_src", "_shard").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("_end", F.sum("size").over(line)).withColumn("_start", F.col("_end") - F.col("size"))

    def inside(low: Column, high: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("_end"), high * block_words) - F.greatest(F.col("_start"), low * block_words))

    last = F.col("_from") + F.col("_more")
    taken = F.col("size") * F.col("_whole") + inside(F.col("_from"), F.least(last, F.col("_n"))) + inside(F.lit(0), last - F.col("_n"))
    return (numbered.join(quotas, ["_src", "_shard"])
            .select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken")))


def mixed(docs: DataFrame, size: Column, **settings) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, all columns kept: each row as many whole times as it is taken, and once
    more where the rest is at least half of it. Rows of one doc_id, source and size are taken alike, as the one taken most."""
    with_size = docs.withColumn("_size", size.cast("bigint"))
    taken = (mix(docs, size, **settings).groupBy("doc_id", "source", "size").agg(F.max("taken").alias("_taken"))
             .where("size > 0").select(F.col("doc_id").alias("_id"), F.col("source").alias("_from"), F.col("size").alias("_s"), F.floor(F.col("_taken") / F.col("size") + 0.5).alias("_times"))
             .where("_times > 0"))
    return (with_size.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_from")) & (F.col("_size") == F.col("_s")))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns]))
