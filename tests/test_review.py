"""Lookups and reviews on small constructed cases."""

from pyspark.sql import functions as F

from annalist.operators import review


def test_pages(spark):
    q = spark.createDataFrame([(1, "35", "Blamont"), (2, "35", "Nancy"), (3, "35", "Zzz")], "qid int, page string, name string")
    rows = spark.createDataFrame([(10, "36", "Blamont"), (11, "35", "Blamond"), (12, "33", "Nancy"), (13, "90", "Zzz")], "row_id int, page string, name string")
    assert {r.qid: r.row_id for r in review.find_on_pages(q, rows).collect()} == {1: 11, 2: 12}
    df = spark.createDataFrame([("— 4iG —", "416"), ("", "3"), ("53", "35"), ("XVI", "XVI"), ("7", "12")], "h string, l string")
    assert [r[0] for r in df.select(review.agrees(F.col("h"), F.col("l"))).collect()] == [True, None, True, True, False]


def test_headings_and_answers(spark):
    contents = spark.createDataFrame([("Bailliage de Nancy",), ("Comté de Vaudémont",)], "title string")
    heads = spark.createDataFrame([("BAILLIAGE DE NANCI",), ("Autre chose",)], "title string")
    assert [r.title for r in review.unheard_headings(contents, heads).collect()] == ["Comté de Vaudémont"]
    hits = spark.createDataFrame([("q", "Aubocourt", 1), ("q", "Flainval", 2)], "q string, label string, rank int")
    answers = spark.createDataFrame([("q", "Flainvaulx"), ("r", "x")], "q string, answer string")
    assert {r.q: r["rank"] for r in review.answer_ranks(hits, answers).collect()} == {"q": 2, "r": None}


def test_names(spark):
    seats = spark.createDataFrame([("Nancy",), ("Blamontt",), ("Zzz",)], "seat string")
    gaz = spark.createDataFrame([("nancy", "Nancy!"), ("Blamont", "Blâmont")], "old string, modern string")
    assert {r.seat: r.modern for r in review.modern_names(seats, gaz).collect()} == {"Nancy": "Nancy!", "Blamontt": "Blâmont", "Zzz": None}
    pairs = spark.createDataFrame([("Nancy et Blamontt",), ("Nancy et Zzz",), ("Xxx et Zzz",), ("Blamon",)], "seat string")
    assert {r.seat: r.modern for r in review.modern_names(pairs, gaz).collect()} == {"Nancy et Blamontt": "Nancy! et Blâmont", "Nancy et Zzz": "Nancy! et Zzz", "Xxx et Zzz": None, "Blamon": None}
    m = spark.createDataFrame([("Blamont", 2), ("Blamont", 1), ("Blamond", 1), ("Nancy", 1)], "name string, weight int")
    assert {r.name: r.canonical for r in review.canonical_spellings(m).collect()} == {"Blamont": "Blamont", "Blamond": "Blamont", "Nancy": "Nancy"}
    k = spark.createDataFrame([("Charmes-sur-Moselle", ["Charmes", "Zorn"])], "n string, v array<string>").select(review.weighted_keys(F.col("n"), F.col("v")).alias("k")).first().k
    assert [(x.key, x.weight) for x in k] == [("eharmessurmoselle", 1.0), ("eharmes", 0.9), ("zorn", 0.95)]
    t = spark.createDataFrame([(1, "Other", "le ban de Longeville et bois", "Longeville"), (2, "Nancy", "rien", "Nancy")], "id int, name string, text string, target string")
    assert {r.id: r.sim for r in review.text_similarity(t).collect()} == {1: 1.0, 2: 1.0}


def test_placements_and_picks(spark):
    places = spark.createDataFrame([("a", 48.0, 6.0, True), ("b", 48.0, 6.0, False), ("c", 48.0, 6.0, True)], "id string, lat double, lon double, named boolean")
    hits = spark.createDataFrame([("a", "x", 0.9, 49.0, 6.0), ("b", "y", 0.82, 48.01, 6.0), ("c", "z", 0.9, 49.0, 6.0)], "id string, place_id string, score double, lat double, lon double")
    done = spark.createDataFrame([("c",)], "id string")
    assert sorted((r.id, r.bucket) for r in review.review_placements(places, hits, done).collect()) == [("a", "disagree"), ("b", "name")]
    ring = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0]]
    small = [[2.0, 2.0], [4.0, 2.0], [4.0, 4.0], [2.0, 4.0]]
    areas = spark.createDataFrame([("big", 9, ring), ("small", 2, small)], "area string, settlements int, ring array<array<double>>")
    pts = spark.createDataFrame([(1, 3.0, 3.0), (2, 8.0, 8.0), (3, 11.0, 3.0)], "pid int, x double, y double")
    assert {r.pid: r.area for r in review.pick(pts, areas, 3.0).collect()} == {1: "small", 2: "big"}
