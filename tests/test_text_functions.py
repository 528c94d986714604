"""Literal cases of the name, number and clean-up functions."""

import difflib

import pytest
from pyspark.sql import functions as F

from annalist.functions import fuzzy, text


def run(spark, f, values, ddl="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {ddl}")
    return [r[0] for r in df.coalesce(1).orderBy("k").select(f(F.col("v"))).collect()]


def test_fold_slug_and_keys(spark):
    assert run(spark, text.fold, ["Hœlling", "Ænæ", "Épinal ÀÉÎÕÜ ç", "ﬁ"])[:3] == ["hoelling", "aenae", "epinal aeiou c"]
    assert run(spark, lambda c: text.fold(c, False), ["œ"]) == ["œ"]
    assert run(spark, text.slug, [" Saint-Dié, (la) ", "--"]) == ["saint-die-la", ""]
    assert run(spark, text.name_key, ["La Malgrange", "Malgrange (la)", "Sainct-Dié", "L'Isle", "Weiller"]) == ["malgrange", "malgrange", "sainldie", "isle", "weiler"]
    assert run(spark, text.geo_key, ["Robrbacb"]) == run(spark, text.geo_key, ["Rohrbach"])
    assert run(spark, text.base_name, ["Charmes-sur-Moselle", "Nancy"]) == ["Charmes", "Nancy"]


def test_display_and_fixes(spark):
    assert run(spark, text.display_name, ["Malgrange (la)", "Abbaye (l')", "Oberkirchen* (anciennement X)", "llagécourt", "Nancy 12"]) == ["La Malgrange", "L'Abbaye", "Oberkirchen", "Hagécourt", "Nancy"]
    assert run(spark, text.fix_circumflex, ["Chàtelet", "jusquesàunchesne", "à"]) == ["Châtelet", "jusquesàunchesne", "à"]
    assert run(spark, text.strip_trailing_specks, ["Le Moncel.j", "Vaul. '", "village. Il"]) == ["Le Moncel.", "Vaul.", "village. Il"]
    assert run(spark, lambda c: text.fix_words(c, {"el": "et", "cbasteau": "chasteau"}), ["el El EL hotel el-x", "CBASTEAU"])[1] == "CHASTEAU"
    assert run(spark, text.normalize_spaces, ["a\xa0 b , c ( d"]) == ["a b, c (d"]


def test_dehyphenate(spark):
    got = run(spark, text.dehyphenate, [["Féné-", "trange"], ["Saint-", "Avold"], ["Kerling-", "lès-Sierck"], ["a", "", " b"], [], ["x -", "y"]], "array<string>")
    assert got == ["Fénétrange", "Saint-Avold", "Kerling-lès-Sierck", "a b", "", "x - y"]


def test_numbers_and_pages(spark):
    assert run(spark, text.expand_numbers, [["1475", "1537", "38"], ["2240", "67", "2355", "2402"], ["709-715"], ["1098", "13"], ["12-14", "9-9"]], "array<string>") == [[1475, 1537, 1538], [2240, 2267, 2355, 2402], list(range(709, 716)), [1098, 1113], [12, 13, 14, 19]]
    assert run(spark, text.page_list, ["36", "34-36;116", "1; 3-4"]) == [[36], [34, 35, 36, 116], [1, 3, 4]]
    assert run(spark, text.entry_number, ["12", "x-3-1", None]) == [12, None, None]
    assert run(spark, text.share_value, ["1/3", "part", None])[1:] == [None, None]
    assert run(spark, text.to_roman, [1, 4, 9, 19, 26], "int") == ["I", "IV", "IX", "XIX", "XXVI"]
    pairs = [p for q in text.CONFUSED_VARIANTS for p in (q, q[::-1])]
    for n, got in zip([10, 135, 2487], run(spark, text.digit_variants, [10, 135, 2487], "bigint")):
        s = str(n)
        want = {s[:i] + y + s[i + 1 :] for i, d in enumerate(s) for x, y in pairs if d == x}
        assert got == sorted(int(w) for w in want if not w.startswith("0") and int(w) != n)
    (near,) = run(spark, text.digit_neighbours, [21], "bigint")
    assert {1, 2, 11, 20, 29, 121, 210, 219}.issubset(near) and 21 not in near and len(near) == len(set(near))


def test_dictionary_keys(spark):
    assert run(spark, text.spelling_key, ["Flainvaulx", "Sainct-Nicolas", "La Croix", "St-Dié"]) == ["flainval", "saintnicola", "croi", "saintdie"]
    assert run(spark, lambda c: text.bigrams(text.coarse(c)), ["flain"]) == run(spark, lambda c: text.bigrams(c), ["hein"])
    assert run(spark, lambda c: F.map_entries(text.attrs(c)), ["gistes=2; also=A|B;x", ""])[1] == []


def test_attrs(spark):
    got = run(spark, text.attrs, ["gistes=2; provostship=Arches; also=A|B; gistes=3; flag"])
    assert got == [{"gistes": ["3"], "provostship": ["Arches"], "also": ["A", "B"], "flag": [""]}]


def test_distances(spark):
    km = spark.range(1).select(text.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))).first()[0]
    assert km == pytest.approx(111.1949, abs=1e-3)
    x, y = spark.range(1).select(*text.laea(F.lit(50.0), F.lit(5.0))).first()
    assert (x, y) == (pytest.approx(3962799.45, abs=0.05), pytest.approx(2999718.85, abs=0.05))  # the published test point of EPSG:3035


def test_fuzzy(spark):
    assert fuzzy.number_cost_of("1546", 1546) == 0 and fuzzy.number_cost_of("l546", 1546) == pytest.approx(0.2)
    assert fuzzy.number_cost_of("3", 5) == pytest.approx(0.3) and fuzzy.number_cost_of("45-", 45) == pytest.approx(0.35)
    assert fuzzy.ocr_distance_of("hainvau", "flainvau") == pytest.approx(0.35)
    assert fuzzy.ocr_similarity_of("abc", "") == 0.0
    df = spark.createDataFrame([("charmes", "charme"), ("abcd", "bcde")], "a string, b string")
    for r in df.select("a", "b", fuzzy.ratio("a", "b").alias("s")).collect():
        assert r.s == pytest.approx(difflib.SequenceMatcher(None, r.a, r.b).ratio())
