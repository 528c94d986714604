"""What the training-data operators share: scratch storage, safe names, text pieces and components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts, `[\x20\x09-\x0D]`, as trim characters and as a pattern.
WS = " \t\n\x0b\f\r"
WS_RUN = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data directory, read by Spark so that any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of `df` has (Spark's names ignore case)."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; `lower` is the quick way where all characters are ASCII."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words_of(c: Column) -> Column:
    """The runs of non-white-space characters of a text; null and blank texts have none."""
    inner = F.btrim(F.coalesce(c, F.lit("")), F.lit(WS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WS_RUN))


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), 0)


#: Elements that `running` folds at once: it copies a block's list for each of them, never the whole list.
RUN_BLOCK = 256


def running(values: Column, combine, start) -> Column:
    """The running results of an associative `combine` over an array of bigint, first to last; `start` changes nothing.

    Blocks of RUN_BLOCK elements are folded by themselves, then their last values, so a list of n costs n * RUN_BLOCK
    / 2 + (n / RUN_BLOCK)^2 / 2 copies of a reference and not n^2 / 2.
    """
    zero = F.array(F.lit(start).cast("bigint"))

    def fold(part: Column) -> Column:
        grown = F.aggregate(part, zero, lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), x))))
        return F.slice(grown, 2, F.size(part))

    def blocks_of(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size(v) - 1) / RUN_BLOCK), F.lit(0)).cast("int"))
        return F.transform(starts, lambda k: fold(F.slice(v, k * RUN_BLOCK + 1, F.lit(RUN_BLOCK))))

    def joined(blocks: Column) -> Column:
        tops = F.transform(blocks, lambda b: F.element_at(b, -1))
        before = F.aggregate(tops, zero, lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), x))))
        return let(before, lambda p: F.flatten(F.transform(blocks, lambda b, k: F.transform(b, lambda x: combine(F.get(p, k), x)))))

    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<bigint>")).when(F.size(v) <= RUN_BLOCK, fold(v)).otherwise(let(blocks_of(v), joined)))


def match_spans(text: Column, kind: str, pattern: str, keep=None) -> Column:
    """All leftmost non-overlapping matches as array<struct<kind, start, end, match>>, code points, end exclusive.

    The pieces between the matches come from `split`, the matches from `regexp_extract_all`; both walk the
    text in the same way, so the running sum of their lengths gives the places. `keep` filters by the match.
    """
    span = "array<struct<kind:string,start:bigint,end:bigint,match:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(ms: Column) -> Column:
        steps = F.zip_with(ms, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(ms)), lambda m, p: (F.length(p) + F.length(m)).cast("bigint"))
        ends = running(steps, lambda a, b: a + b, 0)
        return F.zip_with(ms, ends, lambda m, e: F.struct(F.lit(kind).alias("kind"), (e - F.length(m)).alias("start"), e.alias("end"), m.alias("match"))).cast(span)

    out = let(found, placed)
    if keep is not None:
        out = F.filter(out, lambda s: keep(s["match"]))
    return F.when(text.rlike(pattern), out).otherwise(F.array().cast(span))


def spans_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined in array order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def plain_columns(df: DataFrame):
    """`df` with its columns named c0, c1 ..., and a function that gives the names back to the first columns of a result.

    An Arrow stage takes a name with a dot for a field of another column.
    """
    names = df.columns
    plain = df.toDF(*[f"c{k}" for k in range(len(names))])
    return plain, lambda out: out.toDF(*names, *out.columns[len(names) :])


class Scratch:
    """Tables written in the shared folder that the session names in `spark.checkpoint.dir`.

    They cut lineage and outlive a lost executor. A local temporary folder serves only where the setting is absent
    (tests). `drop` frees a table's space as soon as nothing reads it any more; what is left, as a result may still read
    it, goes when the driver ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            root = "file://" + tempfile.gettempdir() + "/annalist-scratch"
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        self.root = f"{root.rstrip('/')}/annalist-{uuid.uuid4().hex}"
        path, fs = self._file("")
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _file(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        path, fs = self._file(name)
        fs.delete(path, True)


def files_for(rows: int) -> int:
    """How many files to write so many small rows to: few for a small table, however many partitions a session shuffles to."""
    return max(8, rows // 50_000)


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the smallest node reachable.

    Alternating large-star and small-star rounds: each keeps connectivity, moves links to smaller nodes, and ends
    with stars, in rounds that grow with the logarithm of the nodes. A hub's links are only min-aggregated and
    joined, never collected, and each round is written out and the one before dropped. Their number stays in proportion.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = scratch.save(e, "cc-0")
    before, files = None, files_for(e.count())
    for k in range(1, max_rounds + 1):
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "u")
        large = both.join(low, both.a == low.u).where("b > u").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(low2, large.a == low2.u).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        e2 = scratch.save(small.select("x.*").where("a <> b").distinct().coalesce(files), f"cc-{k}")
        now = e2.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).cast("string")).first()
        scratch.drop(f"cc-{k - 1}")
        e = e2
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
