"""Operators over rows in order (E1-E12, G1): each is a window or a short walk within one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.operators.lineage import cut


def out_of_sequence(rows: DataFrame, group: str, number: str, line: str) -> DataFrame:
    """Rows whose number is not above that of the row before."""
    w = Window.partitionBy(group).orderBy(line)
    return rows.withColumn("before", F.lag(number).over(w)).where(F.col(number) <= F.col("before"))


def carry(rows: DataFrame, group: str, line: str, heading: str) -> DataFrame:
    """`heading` carried forward to the rows below it."""
    w = Window.partitionBy(group).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(heading, F.last(heading, ignorenulls=True).over(w))


def continues(text: Column, before: Column) -> Column:
    """Whether a line goes on from the one before: a small letter, a hyphen, or no full stop before it."""
    return before.isNotNull() & (text.rlike(r"^\p{Ll}") | before.endswith("-") | ~before.rlike(r"[.!?:;]\s*$"))


def paragraphs(rows: DataFrame, group: str, line: str, text: str) -> DataFrame:
    """(group, first_line, n_lines, lines): lines grouped to paragraphs by `continues`."""
    w = Window.partitionBy(group).orderBy(line)
    start = (~F.coalesce(continues(F.col(text), F.lag(text).over(w)), F.lit(False))).cast("int")
    marked = rows.withColumn("start", start).withColumn("block", F.sum("start").over(w))
    parts = marked.groupBy(group, "block").agg(F.min(line).alias("first_line"), F.count("*").alias("n_lines"), F.array_sort(F.collect_list(F.struct(line, text))).alias("x"))
    return parts.select(group, "first_line", "n_lines", F.transform("x", lambda s: s[text]).alias("lines"))


def gaps(rows: DataFrame, group: str, number: str) -> DataFrame:
    """(group, low, high, missing): the gaps between neighbouring numbers of a group."""
    w = Window.partitionBy(group).orderBy(number)
    nxt = rows.select(group, F.col(number).alias("low"), F.lead(number).over(w).alias("high"))
    return nxt.where("high - low > 1").withColumn("missing", F.col("high") - F.col("low") - 1)


def missing_numbers(rows: DataFrame, number: str, last: int) -> DataFrame:
    """(no): the numbers 1 to `last` that no row has (G1)."""
    return rows.sparkSession.range(1, last + 1).select(F.col("id").alias("no")).join(rows.select(F.col(number).alias("n")), F.col("no") == F.col("n"), "left_anti")


def nearest_readable(rows: DataFrame, group: str, line: str, value: str, reach: int = 3) -> DataFrame:
    """`value` before and after each row within `reach` rows, as before_value and after_value."""
    w = Window.partitionBy(group).orderBy(line)
    return rows.withColumns(
        {
            "before_value": F.last(value, ignorenulls=True).over(w.rowsBetween(-reach, -1)),
            "after_value": F.first(value, ignorenulls=True).over(w.rowsBetween(1, reach)),
        }
    )


def trailing_run(rows: DataFrame, group: str, line: str, flag: Column) -> DataFrame:
    """`in_run`: whether this row and all below it in the group hold `flag` (footnotes at a page's end, E8)."""
    w = Window.partitionBy(group).orderBy(F.desc(line)).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("in_run", F.min(flag.cast("int")).over(w) == 1)


def physical_rows(rows: DataFrame, page: str, top: str, bottom: str, overlap: float = 0.5) -> DataFrame:
    """`row`: fragments of a page that overlap the running row by more than `overlap` of the smaller height."""
    w = Window.partitionBy(page).orderBy(top, bottom)
    low = F.max(bottom).over(w.rowsBetween(Window.unboundedPreceding, -1))
    height = F.least(F.col(bottom) - F.col(top), low - F.col(top) + (F.col(bottom) - F.col(top)))
    start = (~F.coalesce((low - F.col(top)) > overlap * height, F.lit(False))).cast("int")
    return rows.withColumn("start", start).withColumn("row", F.sum("start").over(w)).drop("start")


def assign_parts(pages: DataFrame, starts: list[tuple[int, str]], page: str, part: str) -> DataFrame:
    """The part that each page lies in: the last one that starts at or before it (E9); starts are a book's few parts."""
    c = F.lit(None).cast("string")
    for first, name in sorted(starts):
        c = F.when(F.col(page) >= first, name).otherwise(c)
    return pages.withColumn(part, c)


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """`rows` with their place in a global order, from 1.

    Rows are dealt out by ranges of the order and numbered within each; the few ranges' sizes give the offsets. So no
    task sees all rows, as it would under a window without a partition.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__range", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    dealt = cut(dealt)
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("n"), F.min("__at").alias("first"))
    before = sizes.select(F.col("__range").alias("__r"), "first", (F.sum("n").over(Window.orderBy("__range")) - F.col("n")).alias("before"))
    placed = dealt.join(F.broadcast(before), F.col("__range") == F.col("__r"))
    return placed.select(*rows.columns, (F.col("before") + F.col("__at") - F.col("first") + 1).alias(name))
