"""Gazetteer readers (A9-A12): tab-separated place files, item rows folded to one per item, and a tiled data source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Columns of the public tab-separated gazetteer dump.
GAZETTEER = "geonameid bigint, name string, asciiname string, alternatenames string, lat double, lon double, feature_class string, feature_code string, country string, cc2 string, admin1 string, admin2 string, admin3 string, admin4 string, population bigint, elevation int, dem int, timezone string, modified string"


def read_gazetteer(spark: SparkSession, path: str, box: tuple[float, float, float, float], classes: tuple[str, ...] = ("P", "S")) -> DataFrame:
    """(geonameid, name, lat, lon, country, feature, names) of the features in a box (south, west, north, east) (A10)."""
    raw = spark.read.schema(GAZETTEER).option("sep", "\t").option("quote", "").csv(path)
    inside = raw.where(F.col("lat").between(box[0], box[2]) & F.col("lon").between(box[1], box[3]) & F.col("feature_class").isin(*classes))
    names = F.filter(F.array_distinct(F.concat(F.array("name"), F.split(F.coalesce("alternatenames", F.lit("")), ","))), lambda x: x != "")
    return inside.select("geonameid", "name", "lat", "lon", "country", F.col("feature_code").alias("feature"), names.alias("names"))


def fold_items(rows: DataFrame) -> DataFrame:
    """(qid, lat, lon, types, labels): a row per item of many result rows; types as a set, the first label per language.

    rows: (qid, lat, lon, type, lang, label).
    """
    labels = rows.where("label IS NOT NULL").groupBy("qid", "lang").agg(F.min("label").alias("label")).groupBy("qid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "label")))).alias("labels"))
    items = rows.groupBy("qid").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"), F.array_sort(F.collect_set("type")).alias("types"))
    return items.join(labels, "qid", "left")


def seed_points(rows: DataFrame) -> DataFrame:
    """Located rows of an earlier geocoding whose method is not a guess."""
    return rows.where(F.col("lat").isNotNull() & ~F.col("method").isin("approximate", "unlocated", "territory"))


def kept(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at `path`, made and written by `make` where it is not there yet (A9, A11): a service is asked once."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


class Tile(InputPartition):
    """The arguments of one request."""


class TiledSource(DataSource):
    """A service asked part by part (A9, A11): one partition for each request, rows from a function by import path.

    Options: fetch ("module:function"), schema, and either box ("south,west,north,east") with size (degrees), for calls
    (south, west, size), or prefixes ("0,1,2"), for calls (prefix), of ids by their first signs; retries (3) and wait
    (seconds before the second try, doubled each time). Executors ask for their own parts; a lost one asks again.
    """

    @classmethod
    def name(cls) -> str:
        return "annalist_tiles"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema) -> DataSourceReader:
        return TiledReader(self.options)


class TiledReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        if "prefixes" in self.options:
            return [Tile((p,)) for p in self.options["prefixes"].split(",")]
        south, west, north, east = map(float, self.options["box"].split(","))
        size = float(self.options.get("size", 0.5))
        rows, cols = max(1, -int(-(north - south) // size)), max(1, -int(-(east - west) // size))
        return [Tile((south + i * size, west + j * size, size)) for i in range(rows) for j in range(cols)]

    def read(self, partition):
        from importlib import import_module
        from time import sleep

        module, _, function = self.options["fetch"].partition(":")
        fetch, tries, wait = getattr(import_module(module), function), int(self.options.get("retries", 3)), float(self.options.get("wait", 1.0))
        for k in range(tries + 1):
            try:
                rows = list(fetch(*partition.value))  # whole before any row goes on, so that a second try repeats none
                break
            except OSError:
                if k == tries:
                    raise
                sleep(wait * 2**k)
        yield from rows
