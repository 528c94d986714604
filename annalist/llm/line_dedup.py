"""Line dedup (3): levelled sorted runs of line hashes, in Spark operators only.

Documents come in batches of falling doc_id. A run is a sorted Parquet table (key, n, holder) of one batch: the
documents that hold the key and, for keys that no earlier run has (an anti-join against the runs), the largest
doc_id of the batch, which is then the largest of all. When a level has FAN runs they are merged into one sorted
run of the next level. The last merge yields the keys to drop. A key is 16 bytes (MD5 of the normalised line).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from annalist.llm.common import WS, Scratch, ascii_lower, fresh, table

MIN_CHARS, MIN_DOCS = 40, 5
BATCHES, FAN = 4, 3
#: Keys to drop are broadcast up to so many rows (32 bytes each), and shuffled beyond.
BROADCAST_KEYS = 100_000


def line_key(line: Column, min_chars: int = MIN_CHARS) -> Column:
    """The key of a line as hexadecimal text, null where the stripped line is too short."""
    bare = F.btrim(line, F.lit(WS))
    return F.when(F.length(bare) >= min_chars, F.md5(ascii_lower(bare)))


class LineRuns:
    """The runs of the batches added so far."""

    def __init__(self, spark: SparkSession, scratch: Scratch, fan: int = FAN):
        self.spark, self.scratch, self.fan = spark, scratch, fan
        self.levels: list[list[tuple[str, DataFrame]]] = []
        self.made = 0

    def _save(self, df: DataFrame) -> tuple[str, DataFrame]:
        self.made += 1
        name = f"run-{self.made}"
        return name, self.scratch.save(df.sortWithinPartitions("key"), name)

    def all(self) -> DataFrame | None:
        out = None
        for _, r in (x for level in self.levels for x in level):
            out = r if out is None else out.unionAll(r)
        return out

    @staticmethod
    def merged(runs: DataFrame) -> DataFrame:
        return runs.groupBy("key").agg(F.sum("n").alias("n"), F.max("holder").alias("holder"))

    def add(self, pairs: DataFrame, falling: bool = True) -> None:
        """Adds a batch of (key, doc_id) pairs, whose doc_ids are all smaller than those before; if they are not, every run
        names a holder, and the largest counts."""
        batch = pairs.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("holder"))
        known = self.all() if falling else None
        if known is not None:
            keys = known.where("holder IS NOT NULL").select(F.col("key").alias("k"), F.lit(True).alias("seen"))
            batch = batch.join(keys, batch.key == keys.k, "left").select("key", "n", F.when(F.col("seen").isNull(), F.col("holder")).alias("holder"))
        self._push(0, self._save(batch))

    def _push(self, level: int, run: tuple[str, DataFrame]) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan:
            old, self.levels[level] = self.levels[level], []
            union = old[0][1]
            for _, r in old[1:]:
                union = union.unionAll(r)
            merged = self._save(self.merged(union))
            for name, _ in old:
                self.scratch.drop(name)
            self._push(level + 1, merged)


def dropped_keys(runs: LineRuns, min_docs: int = MIN_DOCS) -> DataFrame:
    """(key, holder) of the keys in at least `min_docs` documents."""
    return LineRuns.merged(runs.all()).where(F.col("n") >= min_docs).select("key", "holder")


def dedup_lines(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """`docs` with the lines left in `text`, and `n_lines` (before) and `n_dropped` added.

    Lines are split at \\n; a null or empty text is one empty line, and its text becomes empty. Keys of lines of at
    least `min_chars` code points (stripped, A-Z lower-cased) that at least `min_docs` documents hold lose all their
    lines except in the largest doc_id that holds them. Rows that repeat a doc_id are one document of many rows: its
    keys count once, and all its rows lose the same lines. Rows of a null doc_id are left alone and not counted.
    Batches of a doc_id that is no number are cut by its hash; "largest" is then by its own order. An empty table stays
    empty. Extra columns pass through; columns named n_lines or n_dropped are replaced.
    """
    scratch = Scratch(spark)
    own_id, key, keys, lines, lost = fresh(docs, "own_id", "key", "drop_keys", "lines_of", "lost")
    t = F.coalesce(F.col(text), F.lit(""))
    hashed = F.array_compact(F.array_distinct(F.transform(F.split(t, "\n", -1), lambda x: line_key(x, min_chars))))
    ids = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"))
    falling = isinstance(docs.schema[doc_id].dataType, NumericType)
    quantiles = ids.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1_000)).first()[0] if falling and batches > 1 else []
    bounds = ids.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("d")).first()
    cuts = sorted(set(quantiles or []))
    batch = sum(((F.col("doc_id") <= c).cast("int") for c in cuts), F.lit(0))  # 0: the largest ids
    if not falling:
        batch, cuts = F.pmod(F.xxhash64("doc_id"), F.lit(batches)), [None] * (batches - 1)
    pairs = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.explode_outer(hashed).alias("key")).where("key IS NOT NULL")  # a plain explode hashes twice
    pairs = pairs.select("doc_id", F.unhex("key").alias("key"), batch.alias("batch"))
    if bounds["n"] != bounds["d"]:
        pairs = pairs.distinct()
    pairs = scratch.save(pairs, "pairs", ["batch"])
    runs = LineRuns(spark, scratch)
    for b in range(len(cuts) + 1):
        runs.add(pairs.where(F.col("batch") == b).select("key", "doc_id"), falling)
    gone = scratch.save(dropped_keys(runs, min_docs), "gone")
    n_gone = gone.count()
    hit = gone.withColumnRenamed("key", "k")
    hit = F.broadcast(hit) if n_gone <= BROADCAST_KEYS else hit
    drops = pairs.join(hit, pairs.key == hit.k).where("doc_id < holder").groupBy("doc_id").agg(F.collect_set(F.lower(F.hex("key"))).alias(keys)).withColumnRenamed("doc_id", own_id)
    drops = scratch.save(drops, "drops")
    scratch.drop("pairs")
    # drops grow with the corpus: never a broadcast, whatever this input's size
    out = docs.join(drops.hint("merge"), docs[doc_id] == drops[own_id], "left").withColumn(lines, F.split(t, "\n", -1))
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col(keys), line_key(x, min_chars)), F.lit(False)))
    out = out.withColumn(lost, F.when(F.col(keys).isNull(), F.col(lines)).otherwise(kept))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(
        *[F.array_join(lost, "\n").alias(text) if c == text else F.col(f"`{c}`") for c in names],
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(lost)).cast("bigint").alias("n_dropped"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: what is left of every document."""
    out = dedup_lines(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, u.i AS i, string_split(coalesce(text, ''), chr(10))[u.i] AS line
  FROM documents, LATERAL (SELECT unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i) u
), k AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), g AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), j AS (
  SELECT k.doc_id, k.i, k.line, (g.key IS NOT NULL AND k.doc_id <> g.holder) AS gone FROM k LEFT JOIN g ON k.key = g.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
