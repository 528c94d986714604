"""Aggregates of the compiled records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.operators import ordered
from annalist.operators.lineage import parts_of


def upper_median(c: Column) -> Column:
    """The upper median of a group's values, `sorted[n // 2]` (trap T1); nulls don't count.

    percentile_disc at the first rank above one half gives it by a streaming aggregate only for odd counts, so the
    values are gathered: use it per place or district, not over a table.
    """
    xs = F.array_sort(F.collect_list(c))
    return F.get(xs, F.floor(F.size(xs) / 2).cast("int"))


def low_decile(c: Column) -> Column:
    """`sorted[n // 10]`, the left margin of a group of lines."""
    xs = F.array_sort(F.collect_list(c))
    return F.get(xs, F.floor(F.size(xs) / 10).cast("int"))


def rational_sum(num: str, den: str) -> tuple[Column, Column]:
    """The exact sum of fractions as numerator and denominator (D2, trap T5), over one common denominator.

    Distinct denominators are few, so partial sums by denominator are combined, not the rows. Use after
    `sums_by_denominator`.
    """
    pairs = F.collect_list(F.struct(F.col(num).cast("decimal(38,0)").alias("n"), F.col(den).cast("decimal(38,0)").alias("d")))
    step = lambda a, x: F.struct((a["n"] * x["d"] + x["n"] * a["d"]).cast("decimal(38,0)").alias("n"), (a["d"] * x["d"]).cast("decimal(38,0)").alias("d"))
    total = F.aggregate(pairs, F.struct(F.lit(0).cast("decimal(38,0)").alias("n"), F.lit(1).cast("decimal(38,0)").alias("d")), step)
    return total["n"], total["d"]


def share_overflow(holdings: DataFrame, place: str = "place", num: str = "num", den: str = "den") -> DataFrame:
    """(place, n_shares): places whose shares sum to more than 1. Dealt out by place once, for both steps."""
    by_den = holdings.select(place, num, den).repartition(parts_of(holdings), place).groupBy(place, den).agg(F.sum(num).alias(num), F.count("*").alias("k"))
    n, d = rational_sum(num, den)
    return by_den.groupBy(place).agg(n.alias("n"), d.alias("d"), F.sum("k").alias("n_shares")).where("n > d").select(place, "n_shares")


def duplicates(rows: DataFrame, key: str, line: str) -> DataFrame:
    """(key, line, first_line) of every row after the first of its key."""
    firsts = rows.groupBy(key).agg(F.min(line).alias("first_line"), F.count("*").alias("n")).where("n > 1")
    return rows.join(firsts.select(F.col(key).alias("__k"), "first_line"), F.col(key) == F.col("__k")).where(F.col(line) > F.col("first_line")).select(key, line, "first_line")


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the first in order (D5). Keys are dealt out to partitions that grow with the files read."""
    rest = [c for c in rows.columns if c not in keys]
    kept = rows.repartition(parts_of(rows), *keys).groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return kept.select(*[c if c in keys else F.col(f"row.{c}").alias(c) for c in rows.columns])


def mode_fill(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """`rows` with blank values filled by the key's most frequent one, the first seen of equals."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    modes = counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), "seen")).alias("__mode")).withColumnRenamed(key, "__k")
    return rows.join(modes, F.col(key) == F.col("__k"), "left").select(*[F.coalesce(value, "__mode").alias(value) if c == value else c for c in rows.columns])


def holder_rank(holdings: DataFrame) -> DataFrame:
    """(holder, n, rank): holders by number of holdings, then id."""
    n = holdings.groupBy("holder").agg(F.count("*").alias("n"))
    return ordered.ranked(n, [F.desc("n"), F.asc("holder")])


#: Tenures by precedence.
TENURES = ("domain", "fief", "clergy", "safeguard")


def main_tenure(holdings: DataFrame) -> DataFrame:
    """(place, tenure): the tenure of highest precedence at each place."""
    order = F.array(*map(F.lit, TENURES))
    best = holdings.groupBy("place").agg(F.min(F.array_position(order, F.col("tenure"))).alias("p"))
    return best.select("place", F.element_at(order, F.col("p").cast("int")).alias("tenure"))


def is_shared(share: Column) -> Column:
    """part, 1/2 and joint only (trap T11)."""
    return share.isin("part", "1/2", "joint")


def legend_counts(holdings: DataFrame) -> DataFrame:
    """(tenure, places, mixed): places by main tenure, and those of several tenures."""
    kinds = holdings.groupBy("place").agg(F.count_distinct("tenure").alias("k"))
    both = main_tenure(holdings).join(kinds.withColumnRenamed("place", "p"), F.col("place") == F.col("p"))
    return both.groupBy("tenure").agg(F.count("*").alias("places"), F.count_if(F.col("k") > 1).alias("mixed"))


def ramp_totals(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, total, shade): sums and their square-root share of the largest, at least 1."""
    totals = rows.groupBy(key).agg(F.sum(value).alias("total"))
    top = totals.agg(F.greatest(F.max("total"), F.lit(1)).alias("top"))
    return totals.join(F.broadcast(top)).select(key, "total", F.round(F.sqrt(F.col("total") / F.col("top")), 6).alias("shade"))


def multi_parent(tops: DataFrame) -> DataFrame:
    """(node, n): nodes in more than one top division."""
    return tops.groupBy("node").agg(F.count_distinct("top").alias("n")).where("n > 1")


def merge_same_item(rows: DataFrame, item: str, ident: str, variants: str) -> DataFrame:
    """(item, ident, variants): rows of one item become one, of the smallest id, with all variants."""
    return rows.where(F.col(item).isNotNull()).groupBy(item).agg(F.min(ident).alias(ident), F.array_sort(F.collect_set(variants)).alias(variants))


def nested(rows: DataFrame, key: str, order: list[str], fields: list[str], name: str) -> DataFrame:
    """(key, name): the rows of each key as an ordered array of structs."""
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("x")))), lambda s: s["x"]).alias(name))
