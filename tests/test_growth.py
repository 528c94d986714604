"""What keeps a task's memory and a join's pairs from growing with the tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from annalist.operators import lineage, reconcile, records, spatial
from annalist.plans import views


def test_holdings_partitions_follow_the_files(spark, monkeypatch, tmp_path):
    lines = [(k % 40, 7, k % 70, k % 7 + 1, "ANR"[k % 3]) for k in range(400)]
    spark.createDataFrame(lines + lines[:50], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, k % 9) for k in range(40)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    want = {(f"c{o % 9}", {"A": "domain", "N": "fief"}.get(f, "clergy"), f"h{s % 50}", 1, 2 + n, o) for o, _, s, n, f in lines}
    monkeypatch.setattr(lineage, "BYTES_A_PART", 100)
    got = views.view(spark, str(tmp_path), "holdings")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert got.rdd.getNumPartitions() > 20


def points(spark, n, prefix, seed):
    r = random.Random(seed)
    spots = [(round(48 + r.random() / 3, 4), round(6 + r.random() / 3, 4)) for _ in range(12)] + [(49.5, 7.5)]
    return spark.createDataFrame([(f"{prefix}{k}", *spots[k * k % len(spots)]) for k in range(n)], "id string, lat double, lon double")


def km(a, b):
    h = math.sin(math.radians(b.lat - a.lat) / 2) ** 2 + math.cos(math.radians(a.lat)) * math.cos(math.radians(b.lat)) * math.sin(math.radians(b.lon - a.lon) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(h))


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_of_many_copies_makes_no_pairs_of_copies(spark, monkeypatch, k):
    a, b = points(spark, 60, "a", 1), points(spark, 70, "b", 2)
    want = set()
    for x in a.collect():
        near = sorted((round(km(x, y), 9), y.id) for y in b.collect() if km(x, y) <= 20)
        want |= {(x.id, y, n + 1) for n, (_, y) in enumerate(near[:k])}
    joined = []
    plain = spatial.radius_join
    monkeypatch.setattr(spatial, "radius_join", lambda p, q, *r, **kw: joined.append(p.count() * q.count()) or plain(p, q, *r, **kw))
    got = spatial.nearest(a, b, 20.0, k).select("a_id", "b_id", "rank")
    assert {tuple(r) for r in got.collect()} == want
    assert joined and max(joined) <= 13 * 13
    joined.clear()
    far = {r.id for r in spatial.far_from(a, b, 3.0).collect()}
    assert far == {x.id for x in a.collect() if all(km(x, y) > 3 for y in b.collect())} and max(joined) <= 13 * 13


def test_cells_and_label_points_of_copies(spark):
    spots = [(0.0, 0.0), (4000.0, 500.0), (1500.0, 5000.0)]
    p = spark.createDataFrame([(k, *spots[k % 3], k % 4 > 0) for k in range(24)], "id long, x double, y double, listed boolean")
    cells = spatial.voronoi_cells(p)
    got = {r.id: (r.area, r.ring) for r in cells.collect()}
    one = {r.x: (r.area, r.ring) for r in spatial.voronoi_cells(p.groupBy("x", "y").agg(F.min("id").alias("id"), F.lit(True).alias("listed"))).join(p.select("id", "x"), "id").collect()}
    assert got == {k: one[spots[k % 3][0]] for k in range(24) if k % 4}
    labels = {r.id: (r.x, r.y) for r in spatial.label_points_of(cells).collect()}
    assert labels == {k: spatial.label_point([[ring]]) for k, (_, ring) in got.items()}


@pytest.mark.parametrize("name, stage", [("heading_rules", "p_partkey"), ("loose_numbers", "n")])
def test_heavy_expressions_over_small_files_use_every_core(spark, tmp_path, name, stage):
    import __spark_entry__

    spark.createDataFrame([(k, "red ring") for k in range(1, 30)], "p_partkey long, p_name string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(k,) for k in range(1, 30)], "s_suppkey long").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    df = __spark_entry__.queries()[name](spark, str(tmp_path))
    assert df.rdd.getNumPartitions() >= 4 and df.select(stage).distinct().count() == 29


def test_place_records_count_the_other_places_of_a_number(spark):
    e = [(k % 3, f"p{k % 20}") for k in range(90)] + [(1, "p1"), (None, "p2"), (7, "lone")]
    frames = [spark.createDataFrame(*x) for x in (([(f"p{k}", "x") for k in range(20)] + [("lone", "x")], "id string, name string"), ([("p1", "s", "d")], "place string, source string, spelling string"), (e, "no long, place string"), ([("p1", "t", "h")], "place string, tenure string, holder string"), ([("p1", "n")], "child string, parent string"))]
    names = {r.id: r.entries for r in records.place_records(*frames).collect()}
    want = {k: [(x.no, len(x.others)) for x in xs] for k, xs in names.items()}
    got = records.place_records(*frames, others="count")
    assert {r.id: [tuple(x) for x in r.entries] for r in got.collect()} == want and want["p1"][0] == (0, 19) and want["lone"] == [(7, 0)]
    # no row of the plan holds the places of a number
    assert "collect_set(place" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {r.no: len(r.places) for r in records.entry_places(frames[2]).collect()} == {0: 20, 1: 20, 2: 20, None: 1, 7: 1}


def test_reconcile_broadcasts_no_names(spark):
    names = [(k, f"name {k}") for k in range(30)]
    index = spark.createDataFrame([(k, n, [k]) for k, n in names], "row_id long, name string, numbers array<long>")
    got = reconcile.resolve_numbers(index, spark.createDataFrame(names, "no long, name string"))
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.status for r in got.collect()} == {"agrees"}


def test_pairs_of_copies_are_made_from_pairs_of_positions(spark, monkeypatch):
    from annalist.plans import registry

    a, b = points(spark, 60, "s", 1), points(spark, 70, "c", 2).unionAll(spark.createDataFrame([("c-", None, 6.1)], "id string, lat double, lon double"))
    joined = []
    plain = spatial.radius_join
    monkeypatch.setattr(spatial, "radius_join", lambda p, q, *r, **kw: joined.append(p.count() * q.count()) or plain(p, q, *r, **kw))
    monkeypatch.setattr(spatial, "TOGETHER", 9)
    monkeypatch.setattr(registry, "_two", lambda *_: (a, b))
    got = registry.QUERIES["radius_join"](spark, "")
    want = {(x.id, y.id, round(km(x, y), 6)) for x in a.collect() for y in b.collect() if y.lat is not None and km(x, y) <= 12}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want) > 300
    assert joined and max(joined) < 30 * 30
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_best_near_of_one_anchor_pairs_only_like_names(spark):
    from annalist.functions.fuzzy import ratio, ratio_of

    r = random.Random(5)
    name = lambda: "".join(r.choice("abdeg") for _ in range(r.randrange(3, 8)))
    places = [(k, 48.0, 6.0, name()) for k in range(40)] + [(40, 48.0, 6.0, ""), (41, 48.0, 6.0, None)]
    items = [(k, 48.0 + r.random() / 4, 6.0 + r.random() / 4, places[k % 40][3] if k % 3 else name(), 1.0 + k % 2) for k in range(120)] + [(120, 48.01, 6.0, "", 1.0)]
    p, q = spark.createDataFrame(places, "id long, lat double, lon double, key string"), spark.createDataFrame(items, "id long, lat double, lon double, key string, rank double")
    got = {x.place_id: x.item_id for x in spatial.best_near(p, q, spatial.alike_keys(p, q, ratio, 0.84), 12.0, 0.84).collect()}
    want = {}
    for i, lat, lon, key in places[:41]:
        fits = []
        for j, b_lat, b_lon, b_key, rank in items:
            s = 1.0 if key == b_key else ratio_of(key, b_key)
            d = km(*(type("P", (), {"lat": a, "lon": b}) for a, b in ((lat, lon), (b_lat, b_lon))))
            if s >= 0.84 and d <= 12:
                fits.append((4 * s + 0.15 * rank - 0.5 * d / 12, rank, j))
        if fits:
            want[i] = max(fits)[2]
    assert got == want and len(got) == 18 and got[40] == 120
    # the join is on the name and the cell: names that are not alike make no pair
    plan = spatial.best_near(p, q, spatial.alike_keys(p, q, ratio, 0.84), 12.0, 0.84)._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join Inner" in x and "b_key" in x and "cell_row" in x for x in plan.splitlines())


def test_letter_pairs_are_compared_as_sets(spark, monkeypatch):
    from annalist.functions import text
    from annalist.operators import match

    monkeypatch.setattr(match, "TOGETHER", 2)
    r = random.Random(3)
    a, b = ([*{"".join(r.choice("abehlmé-") for _ in range(r.randrange(1, 7))) for _ in range(60)}, "alal", "alalal", "alalalal", "bb", ""] for _ in range(2))
    df = lambda names, c: spark.createDataFrame([(x,) for x in names], f"{c} string")
    coarse = {x.k: x.c for x in df(a + b, "k").select("k", text.coarse(F.col("k")).alias("c")).collect()}
    pairs = lambda x: {coarse[x][i : i + 2] for i in range(len(coarse[x]) - 1)}
    want = {(x, y, n) for x in a for y in b if (n := len(pairs(x) & pairs(y))) >= max(1, int(0.4 * len(pairs(x))))}
    got = match.qgram_candidates(df(a, "q"), df(b, "key"))
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 300
    # no pair is shuffled, and no side is gathered by the driver
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan
