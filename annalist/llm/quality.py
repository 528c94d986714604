"""Quality rules (7): text counts, and a hashed n-gram log-likelihood ratio, in Spark operators only.

Two scans of the texts. The first counts the hashed 1- and 2-grams of words and signs of all documents (raw corpus) and of the
trusted ones (target) into BUCKETS multinomials, pre-aggregated in each task. The second looks each n-gram's ratio
up by its place in one array of BUCKETS ratios, which every task holds, and sums them within the row: no n-gram becomes
a row, and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm.common import WS, fresh, table, words_of

BUCKETS = 1 << 14
#: The target multinomial is fitted on so many trusted documents at most, those of the smallest hashes of doc_id.
MAX_TARGET_DOCS = 20_000
SMOOTHING = 0.5
#: Least mean log ratio per n-gram of a kept document.
THRESHOLD = -0.35
SYMBOLS = "[#*$%&|<>]"
SPAN = 8
#: The n-grams' words: runs of letters and digits, and runs of other signs, each by itself. Signs glued to words are then
#: a few frequent words of their own, whatever the corpus' size, and not many rare ones that share others' buckets.
PIECE = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
#: What `features` adds.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns COUNTS and `base_failed`; null texts count as empty. Columns of these names are replaced."""
    words, hashes, windows, twice = fresh(df, "words_of", "word_hashes", "window_hashes", "twice")
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn(words, words_of(F.col(text)))
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    starts = F.sequence(F.lit(0), F.size(words) - SPAN)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(SPAN)]))
    df = df.withColumn(windows, F.when(F.size(words) >= SPAN, hashed).otherwise(F.array().cast("array<bigint>")))
    # the windows found twice stand side by side once sorted; most texts have none, which a hash set tells
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn(twice, F.when(F.size(F.array_distinct(windows)) < F.size(windows), pairs))
    same = lambda x, i: F.coalesce(F.get(F.col(twice), i)["h"] == x["h"], F.lit(False))
    places = F.sort_array(F.transform(F.filter(twice, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("total"), F.lit(-SPAN).alias("last")),
        lambda acc, p: F.struct((acc["total"] + F.least(F.lit(SPAN), p - acc["last"])).alias("total"), p.alias("last")),
        lambda acc: acc["total"],
    )
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WS)) != "")
    df = df.withColumns(
        {
            "n_words": F.size(words).cast("bigint"),
            "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
            "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("bigint"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
            "n_repeat_words": F.coalesce(F.when(F.col(twice).isNotNull(), covered), F.lit(0)).cast("bigint"),
        }
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop(words, hashes, windows, twice)


def pieces_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0))


def _buckets(words: Column) -> Column:
    """The buckets of all words and of all pairs of neighbours, as an array.

    Where it is exploded, it is made before, as a row that carried the words along would copy them for each n-gram; and
    by explode_outer, as for a plain explode Spark infers a filter on the array and evaluates it below the projections,
    words and all, for each element.
    """
    bucket = lambda *ws: F.pmod(F.xxhash64(*ws), F.lit(BUCKETS)).cast("int")
    return F.concat(F.transform(words, lambda w: bucket(w)), F.transform(F.slice(words, 2, F.lit(1 << 30)), lambda w, i: bucket(F.get(words, i), w)))


def ratio_array(docs: DataFrame, target_ids: DataFrame, text: str = "text") -> DataFrame:
    """One row (ratios): the log ratio of target to raw of every bucket in order, in millionths, so that sums are exact.

    docs: (doc_id, text), all of them. target_ids: (target_id), MAX_TARGET_DOCS rows at most.
    """
    marked = docs.join(F.broadcast(target_ids), docs.doc_id == target_ids.target_id, "left")
    own = marked.select(F.col("target_id").isNotNull().alias("trusted"), pieces_of(F.col(text)).alias("w"))
    grams = own.select("trusted", _buckets(F.col("w")).alias("b")).select("trusted", F.explode_outer("b").alias("bucket"))
    counts = grams.where("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("trusted").alias("target"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("place"))
    full = every.join(counts, every.place == counts.bucket, "left").select("place", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    one = full.agg(F.sort_array(F.collect_list(F.struct("place", "raw", "target"))).alias("rows"), F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))
    part = lambda n, total: F.log((n + SMOOTHING) / (F.col(total) + SMOOTHING * BUCKETS))
    llr = lambda x: F.when(F.col("all_target") > 0, part(x["target"], "all_target") - part(x["raw"], "all_raw")).otherwise(0.0)
    return one.select(F.transform("rows", lambda x: F.round(llr(x) * 1e6).cast("bigint")).alias("ratios"))


def trusted_ids(labels: DataFrame, limit: int = MAX_TARGET_DOCS) -> DataFrame:
    """The bounded sample of trusted documents: quality 1, not toxic; by hash of doc_id, so it is the same each time."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).select(F.col("doc_id").alias("target_id"))


def judge_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, COUNTS, base_failed, n_grams, score, kept.

    score: mean log ratio of the text's n-grams (0 without n-grams). kept: base_failed is false and score is at least
    `threshold`. Null texts have no words and fail. Rows that repeat a doc_id, and rows of a null doc_id, are judged
    each by their own text. Without trusted documents every ratio is 0, and only base_failed decides. Other columns
    are ignored. An empty table gives no rows.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = ("doc_id", *COUNTS, "base_failed")
    rows = features(plain).select(*names, pieces_of(F.col("text")).alias("w"))
    rows = rows.select(*names, _buckets(F.col("w")).alias("b"), ratio_array(plain, trusted_ids(labels)).scalar().alias("ratios"))
    summed = F.aggregate("b", F.lit(0).cast("bigint"), lambda total, k: total + F.get(F.col("ratios"), k))
    out = rows.select(*names, F.size("b").cast("bigint").alias("n_grams"), summed.alias("micro"))
    out = out.withColumn("score", F.when(F.col("n_grams") > 0, F.round(F.col("micro") / F.col("n_grams") / 1e6, 6)).otherwise(0.0))
    return out.select(*names, "n_grams", "score", (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the counts and the verdict of every document."""
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
