"""The closest keys of many, held against brute force, in blocks of a few rows."""

import random

from annalist.functions.fuzzy import ratio_of
from annalist.operators import nearest, review


def names(seed, n):
    r, out = random.Random(seed), ["", "a", "x" * 70, "ab" * 40, "ab" * 40 + "c", "é" * 5 + "ab"]
    for _ in range(n):
        w = [r.choice("abde") for _ in range(r.randrange(2, 12))]
        out.append("".join(w))
        w[r.randrange(len(w))] = r.choice("abx")
        out.append("".join(w[r.randrange(2) :]))
    return sorted(set(out))


def test_common_letters_against_the_plain_way():
    keys = names(1, 60)
    common = nearest.Common(keys)

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            old, row = row, [0]
            for j, y in enumerate(b):
                row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
        return row[-1]

    for q in names(2, 60):
        assert common.of(q).tolist() == [plain(q, k) for k in keys]


def closest(spark, monkeypatch, query_first, least):
    monkeypatch.setattr(nearest, "KEYS", 7)
    monkeypatch.setattr(nearest, "QUERIES", 9)
    keys = [("g" if k % 3 else "h", x, 1 + k * 7 % 20, k * 31 % 50) for k, x in enumerate(names(3, 60))]
    asked = [("g" if k % 2 else "h", x, k % 4 * 6) for k, x in enumerate(names(4, 40))] + [("none", "ab", 0)]
    want = {}
    for g, q, floor in asked:
        fits = []
        for h, key, w, o in keys:
            r = 1.0 if q == key else (ratio_of(q, key) if query_first else ratio_of(key, q)) if q and key else 0.0
            if h == g and w > floor and r >= 0.6:
                fits.append((r, w, -o if least else o, key))
        if fits:
            want[g, q, floor] = max(fits)[0], max(fits)[3]
    got = nearest.closest_keys(spark.createDataFrame(asked, "g string, q string, floor bigint"), spark.createDataFrame(keys, "g string, key string, w bigint, o bigint"), 0.6, query_first, least)
    assert {(x.g, x.q, x.floor): (x.ratio, x.key) for x in got.collect()} == want and len(want) > 40


def test_closest_keys_of_the_largest(spark, monkeypatch):
    closest(spark, monkeypatch, True, False)


def test_closest_keys_of_the_least(spark, monkeypatch):
    closest(spark, monkeypatch, False, True)


def scores_every_pair(df):
    """Whether a join's pairs go to Python one by one."""
    return "ArrowEvalPython" in df._jdf.queryExecution().executedPlan().toString()


def test_canonical_spellings_score_few_pairs(spark):
    m = spark.createDataFrame([("Blamont", 2), ("Blamont", 1), ("Blamond", 1), ("Blam0nt", 9), ("Plamont", 1), ("Blamonts", 1), ("B", 1)], "name string, weight int")
    got = review.canonical_spellings(m)
    assert {r.name: r.canonical for r in got.collect()} == {"Blamont": "Blamont", "Blamond": "Blamont", "Blam0nt": "Blam0nt", "Plamont": "Plamont", "Blamonts": "Blamont", "B": "B"}
    assert not scores_every_pair(got)


def test_page_lookup_scores_few_pairs(spark):
    rows = spark.createDataFrame([(1, "10", "Nancy"), (2, "10", "Nancy"), (3, "11", "Toul"), (4, "13", "Metz"), (5, "15", "Metz"), (6, "12", "")], "row_id long, page string, name string")
    asked = [(1, "10", "Nanci"), (2, "10", "Toul"), (3, "13", "Mets"), (4, "15", "Meiz"), (5, "12", ""), (6, None, "Toul"), (7, "10", None), (8, "40", "Toul"), (9, "14", "Metz")]
    got = review.find_on_pages(spark.createDataFrame(asked, "qid long, page string, name string"), rows)
    assert {r.qid: (r.row_id, r.ratio) for r in got.collect()} == {1: (1, 0.8), 2: (3, 1.0), 3: (4, 0.75), 4: (5, 0.75), 5: (6, 1.0), 9: (4, 1.0)}
    assert not scores_every_pair(got)


def test_like_keys_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nearest, "KEYS", 7)
    monkeypatch.setattr(nearest, "QUERIES", 9)
    a, b = names(5, 40), names(6, 60)
    pairs = lambda x: {x[i : i + 2] for i in range(len(x) - 1)}
    want = {(q, k) for q in a for k in b if len(pairs(q) & pairs(k)) >= max(1, int(0.4 * len(pairs(q)))) and (q == k or ratio_of(k, q) >= 0.7)}
    got = nearest.like_keys(spark.createDataFrame([(x,) for x in a], "q string"), spark.createDataFrame([(x,) for x in b], "key string"), 0.7, 0.4)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 30
