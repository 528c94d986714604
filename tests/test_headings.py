"""The rule lists, and a small book read in order."""

from pyspark.sql import functions as F

from annalist.functions import rules
from annalist.operators import headings

BOOK = [
    ("main", "Bailliage de Nancy.", None),
    ("main", "Soubz ce bailliage sont les prévostés qui ensuivent, sçavoir : Nancy, Rosières et Pierrefort", None),
    ("main", "Prévosté de Rosières.", None),
    ("main", "Domaine.", None),
    ("main", "Rosières, ville.", 1),
    ("main", "Ban de Moyen.", None),
    ("main", "Moyen, village, pour la moitié.", 2),
    ("main", "Fiedvez.", None),
    ("main", "Vigneulles, village", 3),
    ("main", "Terre de Haussonville.", None),
    ("main", "Haussonville, chasteau et village", 4),
    ("main", "Clergé.", None),
    ("main", "L'abbaye de Clairlieu, ordre de Cisteaux, de laquelle dépendent les villages cy-après", 5),
    ("main", "Villers, village", 6),
    ("main", "Prévosté d'Einville.", None),
    ("main", "Gagnages.", None),
    ("main", "La Court, gagnage", 7),
    ("main", "La Court de Perle, sçavoir :", None),
    ("main", "Oberperl", 8),
    ("main", "Niderperl", 9),
    ("main", "Prévosté et seigneurie de Pierrefort.", None),
    ("main", "Martincourt, tenu en fiedz par les sieurs de Mamy", 10),
    ("main", "Le clergé de toute la prévosté pour le clergé", None),
    ("main", "Hors des bailliages.", None),
    ("main", "Comté de Bitche.", None),
    ("main", "Bitche, ville", 11),
    ("lists", "Abbayes de religieux", None),
    ("lists", "Beaupré, ordre de Cisteaux", 12),
]
OVERRIDES = [
    {"prefix": "Gagnages.", "prose": True, "section": "domain", "descriptor": "grange"},
    {"prefix": "Hors des bailliages", "outside": True},
    {"prefix": "La Court de Perle", "admin": "court", "level": 3, "seat": "Perl", "last": 8},
]


def test_book(spark):
    rows = [("b", k, p, t, n) for k, (p, t, n) in enumerate(BOOK)]
    blocks = spark.createDataFrame(rows, "doc string, pos long, part string, text string, no long")
    out = headings.read_book(headings.classify_blocks(blocks, OVERRIDES)).collect()
    entries = {r.no: (r.district, r.realm, r.section, r.series) for r in out if r.row == "entry"}
    assert entries == {
        1: ("provostship-rosieres", None, "domain", "main"),
        2: ("ban-moyen", None, "domain", "main"),
        3: ("ban-moyen", None, "fief", "main"),
        4: ("provostship-rosieres", "lordship-haussonville", "fief", "main"),
        5: ("provostship-rosieres", "lordship-haussonville", "clergy", "main"),
        6: ("provostship-rosieres", "temporality-abbey-clairlieu", "clergy", "main"),
        7: ("provostship-einville", None, "domain", "main"),
        8: ("court-perl", None, "other", "main"),
        9: ("provostship-einville", None, "other", "main"),
        10: ("provostship-pierrefort", "lordship-pierrefort", "other", "main"),
        11: ("district-bitche", "county-bitche", "other", "main"),
        12: (None, None, "", "abbeys_m"),
    }
    t = {r.key: r for r in out if r.row == "territory"}
    assert t["lordship-haussonville"].ressort == "provostship-rosieres" and t["temporality-abbey-clairlieu"].ressort == "provostship-rosieres"
    assert t["provostship-pierrefort"].counterpart == "lordship-pierrefort" and t["provostship-pierrefort"].basis == "heading"
    assert t["district-bitche"].parent == "duchy-root" and t["county-bitche"].basis == "slot"
    assert [r.hint for r in out if r.row == "entry" and r.no == 7] == ["grange"]


def test_entry_rules(spark):
    rows = [
        ("Vigneulles, village et chasteau, pour la moitié de Bar.",),
        ("La ville de Forbach, bourg",),
        ("Beaupré, abbaye de l'ordre de Cisteaux",),
        ("Llagécourt (partie), en partie",),
        ("Martincourt, tenu en fiedz par les sieurs de Mamy.",),
    ]
    t = F.col("t")
    got = spark.createDataFrame(rows, "t string").select(rules.entry_name(t).alias("n"), rules.entry_descriptors(t).alias("d"), rules.entry_order(t, F.lit(False)).alias("o"), rules.entry_share(t).alias("s"), rules.holder_words(t).alias("h")).collect()
    assert [r.n for r in got] == ["Vigneulles", "La ville de Forbach", "Beaupré", "Llagécourt", "Martincourt"]
    assert [r.d for r in got] == [["castle", "village"], ["town", "small_town"], ["abbey"], [], []]
    assert [r.o for r in got] == [None, None, "cistercian", None, None]
    assert [tuple(r.s) for r in got] == [("1/2", "pour la moitié de Bar"), (None, ""), (None, ""), ("part", "partie), en partie"), (None, "")]
    assert got[4].h == "les sieurs de Mamy"


def test_corrections(spark):
    rows = [
        ("P. 224, art. Lengelsheim, lisez 2144, au lieu de 2145.", 0, ("renumber", "Lengelsheim", "2145", "2144", True)),
        ("P. 190, Bethingen, au lieu de Selbac, lisez : Selbach.", 0, ("replace", "Bethingen", "Selbac", "Selbach", True)),
        ("P. 200, ajoutez après l'art. Bures", 1, ("add", "Bures", None, None, True)),
        ("Supprimez l'art. Hugen", 0, ("delete", "Hugen", None, None, True)),
        ("Domange doit venir après Dieue", 0, ("move", "Domange", None, "après Dieue", False)),
        ("P. 183, ajoutez à l'art. Hattigny le n° 1200", 0, ("renumber", "Hattigny", None, "1200", True)),
        ("Une remarque.", 0, ("other", None, None, None, False)),
    ]
    got = spark.createDataFrame([r[:2] for r in rows], "t string, n int").select(rules.correction(F.col("t"), F.col("n")).alias("c")).collect()
    assert [tuple(r.c) for r in got] == [r[2] for r in rows]


def test_pastures_and_ladders(spark):
    rows = [("Est la montagne ou chaulme appellée communément Fonyer, en allemand Schinnbsberg, une giste.",), ("La plaine du Hault, aliàs Hobeneck,",)]
    got = spark.createDataFrame(rows, "t string").select(rules.pasture(F.col("t"), {"Fonyer": "Fonier"}).alias("p"), rules.pasture_ends(F.col("t")).alias("e")).collect()
    assert [tuple(r.p) for r in got] == [("Fonier", ["Schinnbsberg"], 1), ("La plaine du Hault", ["Hobeneck"], None)] and all(r.e for r in got)
    one = spark.range(1)
    names = one.select(rules.territory_names(F.lit("office"), F.lit("Einville"), F.lit("office"), F.lit("Amt (alt)"), F.lit("office")).alias("x"), rules.territory_names(F.lit("office"), F.lit("Hombourg"), F.lit("office"), F.lit("Amt"), F.lit("office"))["fr"].alias("y")).first()
    assert tuple(names.x) == ("Office d'Einville", "Amt Einville", "Office of Einville") and names.y == "Office de Hombourg"
    kinds = spark.createDataFrame([("ferme", ["town"]), (None, ["castle"]), (None, ["castle", "village"]), ("", [])], "k string, d array<string>")
    assert [r[0] for r in kinds.select(rules.place_type(F.col("k"), F.col("d"))).collect()] == ["farmstead", "castle", "village", "village"]
    assert [r[0] for r in spark.createDataFrame([("Pr.",), ("Luxembourg",), ("Meuse",), (None,)], "r string").select(rules.country_of(F.col("r"))).collect()] == ["DE", "LU", "FR", "FR"]
    assert one.select(rules.renamed_in(F.lit("see bar-2 and bar"), F.lit("bar"), F.lit("baz"))).first()[0] == "see bar-2 and baz"


def test_small_tables_of_many_books_use_every_core(spark, monkeypatch):
    """Books are walked in streams of rows, not in a Python call each, and keep their own state."""
    monkeypatch.setattr(headings, "ROWS", 3)
    lines = ["Bailliage de X.", "Prévosté de Y{}.", "Domaine.", "A, village", "B, village"]
    rows = [(d, k, "main", t.format(d), k if k > 2 else None) for d in range(40) for k, t in enumerate(lines)] + [(40, 0, "main", "C, village", 7)]
    blocks = spark.createDataFrame(rows, "doc long, pos long, part string, text string, no long").coalesce(1)
    classified = headings.classify_blocks(blocks)
    book = headings.read_book(classified)
    assert classified.rdd.getNumPartitions() >= 4 and book.rdd.getNumPartitions() >= 4
    assert "FlatMapGroupsInPandas" not in book._jdf.queryExecution().executedPlan().toString()
    got = {(r.doc, r.pos): (r.district, r.section) for r in book.where("row = 'entry'").collect()}
    assert got == {(d, k): (f"provostship-y{d}", "domain") for d in range(40) for k in (3, 4)} | {(40, 0): (None, "other")}
    assert [(r.key, r.pos) for r in book.where("row = 'territory' AND doc = 7").orderBy("pos").collect()] == [("duchy-root", 0), ("bailiwick-x", 1), ("provostship-y7", 2)]
