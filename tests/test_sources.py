"""Sources asked part by part, hand-kept tables, kept tables, reports and overrides."""

import os

import pytest
from pyspark.sql import functions as F

from annalist.operators import ordered, records
from annalist.plans import query
from annalist.sources import gazetteers, tables


def tile(south, west, size):
    yield (f"{south}:{west}", size)


def by_prefix(prefix):
    """Fails the first time that a prefix is asked for."""
    mark = os.path.join(os.environ["TILE_MARKS"], prefix) if "TILE_MARKS" in os.environ else f"/tmp/annalist-test-{os.getppid()}-{prefix}"
    if not os.path.exists(mark):
        open(mark, "w").close()
        raise OSError("busy")
    os.remove(mark)
    yield (prefix, 1.0)


def test_tiled_source(spark):
    spark.dataSource.register(gazetteers.TiledSource)
    read = lambda **o: spark.read.format("annalist_tiles").option("schema", "name string, size double").options(**o).load()
    assert sorted(r.name for r in read(fetch="tests.test_sources:tile", box="48,6,49,6.5", size="0.5").collect()) == ["48.0:6.0", "48.5:6.0"]
    assert sorted(r.name for r in read(fetch="tests.test_sources:by_prefix", prefixes="0,1,2", wait="0.01").collect()) == ["0", "1", "2"]


def test_kept_and_manual(spark, tmp_path):
    asked = []
    make = lambda: asked.append(1) or spark.range(3)
    for _ in range(2):
        assert gazetteers.kept(spark, f"{tmp_path}/kept", make).count() == 3
    assert len(asked) == 1
    ddl = "row_id string, printed string, entry string"
    assert tables.read_manual(spark, f"{tmp_path}/none.csv", ddl, ["row_id", "printed"]).count() == 0
    (tmp_path / "m.csv").write_text("row_id,printed,entry\na,1,2\na,3,4\n")
    assert tables.read_manual(spark, f"{tmp_path}/m.csv", ddl, ["row_id", "printed"]).count() == 2
    (tmp_path / "m.csv").write_text("row_id,printed,entry\na,1,2\na,1,4\n")
    with pytest.raises(Exception, match="repeated decision: a, 1"):
        tables.read_manual(spark, f"{tmp_path}/m.csv", ddl, ["row_id", "printed"]).collect()


def test_unused_override_is_an_error(spark):
    lines = spark.createDataFrame([("1", 1, "a"), ("1", 2, "b")], "page string, line int, text string")
    good = spark.createDataFrame([("1", "b", ["x", "y"])], "page string, old string, parts array<string>")
    assert [(r.line, r.part, r.text) for r in records.override_lines(lines, good).orderBy("line", "part").collect()] == [(1, 0, "a"), (2, 0, "x"), (2, 1, "y")]
    bad = spark.createDataFrame([("2", "b", ["x"])], "page string, old string, parts array<string>")
    with pytest.raises(Exception, match="unused override: 2: b"):
        records.override_lines(lines, bad).collect()


def test_ranked_over_many_partitions(spark):
    rows = spark.range(5000).select("id", (F.col("id") * 7919 % 613).alias("k"), F.when(F.col("id") % 9 > 0, F.concat(F.lit("n"), F.col("id").cast("string"))).alias("no"))
    got = {r.id: r["rank"] for r in ordered.ranked(rows.repartition(7), [F.desc("k"), F.asc("id")]).collect()}
    want = sorted(got, key=lambda i: (-(i * 7919 % 613), i))
    assert [got[i] for i in want] == list(range(1, 5001))
    assert ordered.ranked(rows.limit(0), [F.asc("id")]).count() == 0


def test_listed_and_version(spark):
    names = spark.createDataFrame([("nancy",), ("nansy",), ("toul",)], "slug string")
    known = spark.createDataFrame([("nancy",), ("metz",)], "slug string")
    assert sorted(r[0] for r in records.listed(names, known).collect()) == ["nancy", "nansy"]
    import hashlib

    files = spark.createDataFrame([("b", "two"), ("a", "one"), ("c", None)], "name string, content string")
    assert query.version(files).first()[0] == hashlib.sha256(b"onetwo").hexdigest()[:12]
