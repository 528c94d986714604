"""The name queries without SQL over a whole small table, every row a query, held against brute force."""

import difflib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from annalist.functions import text
from annalist.functions.fuzzy import number_cost_of, ratio_of
from annalist.operators import match, review
from annalist.plans import registry

WORDS = "large ring|hot bolt|blue ring|old plate|cold plate|hot gear|small gizmo|red widget".split("|")


@pytest.fixture(scope="module")
def part(spark, tmp_path_factory):
    """(folder, entries, index rows) of a table of 61 parts; names with their keys."""
    d = str(tmp_path_factory.mktemp("part"))
    spark.createDataFrame([(k, WORDS[k * 5 % 8]) for k in range(1, 62)], "p_partkey long, p_name string").write.parquet(f"{d}/part.parquet")
    p, index = registry._names(spark, d)
    key = lambda c: (text.name_key(F.col(c)).alias("key"), text.name_key(text.base_name(F.col(c))).alias("base"), text.coarse(text.spelling_key(F.col(c))).alias("coarse"), text.spelling_key(F.col(c)).alias("spelling"))
    return d, p.select("*", *key("name")).collect(), index.select("*", *key("name")).collect()


def rows(spark, name, d):
    return [tuple(r) for r in registry.QUERIES[name](spark, d).collect()]


def score(a, b):
    return 1.0 if a == b else ratio_of(a, b) if a and b else 0.0


def sim(e, r):
    return max(score(e.key, r.key), score(e.key, r.base))


def variants(spark, numbers, f):
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    return {r.n: set(r.v) for r in df.select("n", f(F.col("n")).alias("v")).collect()}


def ladder(entries, index, confused):
    """The reference's Matcher.match; ties go to the smaller row_id."""
    out = {}
    for e in entries:
        top = lambda rs: max(((sim(e, r), -r.row_id) for r in rs), default=(-9.0, 0))  # noqa: B023, E731
        exact = [r for r in index if e.no in r.numbers]
        x, c = top(exact), top([r for r in index if r not in exact and confused[e.no] & set(r.numbers)])
        near = [r for r in index if r not in exact and (not r.numbers_ok or any(number_cost_of(str(m), e.no) <= 1.0 for m in r.numbers))]
        loose, by_name = top(near), top(index) if len(e.key) >= 5 else (-9.0, 0)
        if c[0] >= 0.75 and (not exact or c[0] >= x[0] + 0.3):
            got = c, "confused number", "medium"
        elif exact and x[0] < 0.4 and by_name[0] >= 0.9:
            got = by_name, "name", "medium"
        elif x[0] >= 0.5:
            got = x, "number+name", "high"
        elif len(exact) == 1 and x[0] >= 0.25:
            got = x, "number", "medium"
        elif c[0] >= 0.8:
            got = c, "confused number", "medium"
        elif loose[0] >= 0.82:
            got = loose, "loose number", "medium"
        elif by_name[0] >= 0.9:
            got = by_name, "name", "low"
        else:
            got = (0.0, None), "none", "low"
        (s, r), how, conf = got
        out[e.no] = (None if r is None else -r, how, round(s, 6), conf)
    return out


def test_match_ladder(spark, part):
    d, entries, index = part
    want = ladder(entries, index, variants(spark, [e.no for e in entries], text.digit_variants))
    assert {r[0]: r[1:] for r in rows(spark, "match_ladder", d)} == want


def test_reconcile(spark, part):
    d, entries, index = part
    numbers = {n for r in index for n in r.numbers}
    misread, near = variants(spark, numbers, text.digit_variants), variants(spark, numbers, text.digit_neighbours)
    names = {e.no: e for e in entries}
    found = defaultdict(list)
    for r in index:
        for n in r.numbers:
            for no in {n} | misread[n] | near[n]:
                if no in names:
                    s = sim(names[no], r)
                    level = (1 if s >= 0.75 else 2 if s >= 0.3 else 5) if no == n else 3 if no in misread[n] and s >= 0.75 else 4 if no not in misread[n] and s >= 0.8 else None
                    if level:
                        found[r.row_id, n].append((level, -s, no))
    claimed = {no for xs in found.values() for level, _, no in xs if level <= 2}
    status = {1: "agrees", 2: "spelling differs", 3: "corrected", 4: "corrected", 5: "unresolved"}
    want = {}
    for r in index:
        for n in r.numbers:
            level, _, no = min((x for x in found[r.row_id, n] if x[0] in (1, 2, 5) or x[2] not in claimed), default=(6, 0, None))
            want[r.row_id, n] = (no if level < 5 else None, status.get(level, "no entry"))
    assert {r[:2]: r[2:] for r in rows(spark, "reconcile", d)} == want


def test_canonical_spellings(spark, part):
    d, entries, index = part
    n, key = Counter(), {}
    for x, w in [(e, 2) for e in entries] + [(r, 1) for r in index]:
        n[x.name] += w
        key[x.name] = x.key
    want = {}
    for a in n:
        near = [(score(key[a], key[b]), n[b], b) for b in n if n[b] >= 2 and n[b] > n[a] and b != a and key[a][0] == key[b][0] and abs(len(key[a]) - len(key[b])) <= 1]
        want[a] = max((x for x in near if x[0] >= 0.8), default=(0, 0, a))[2]
    assert dict(rows(spark, "canonical_spellings", d)) == want


def test_page_lookup(spark, part):
    d, entries, index = part
    page = lambda k: str(k % 90 + 10)
    want = {}
    for e in entries:
        p = page(e.no)
        others = {str(int(p) - 1), str(int(p) + 1), p.replace("3", "5"), p.replace("5", "3")}
        near = [(page(r.row_id) != p, -score(r.key, e.key), r.row_id) for r in index if page(r.row_id) in others | {p}]
        best = min((x for x in near if -x[1] >= 0.7), default=None)
        if best:
            want[e.no] = (best[2], round(-best[1], 6))
    assert {r[0]: r[1:] for r in rows(spark, "page_lookup", d)} == want


def test_fuzzy_best_name(spark, part):
    d, entries, index = part
    best = {e.no: max((sim(e, r), -r.row_id) for r in index) for e in entries if len(e.key) >= 5}
    assert {r[0]: r[1:] for r in rows(spark, "fuzzy_best_name", d)} == {k: (-r, round(s, 6)) for k, (s, r) in best.items() if s >= 0.9}


def test_qgram_candidates(spark, part):
    d, entries, index = part
    pairs = lambda k: {k[i : i + 2] for i in range(len(k) - 1)}
    want = set()
    for e in entries:
        need = max(1, int(0.4 * len(pairs(e.coarse))))
        want |= {(e.spelling, r.spelling, n) for r in index if (n := len(pairs(e.coarse) & pairs(r.coarse))) >= need}
    assert set(rows(spark, "qgram_candidates", d)) == want


def test_twins(spark, part):
    d, entries, index = part
    ids = {}
    for r in index:
        ids[r.key] = min(r.row_id, ids.get(r.key, r.row_id))
    want = {e.no: ids[hit[0]] for e in entries if (hit := difflib.get_close_matches(e.key, list(ids), n=1, cutoff=0.88))}
    assert dict(rows(spark, "twins", d)) == want


def damaged(seed, n):
    """Names of 1 to 12 letters and copies with letters changed, dropped and added anywhere."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        w = [rng.choice("abdegilmnor") for _ in range(rng.randrange(1, 13))]
        out.append("".join(w))
        for _ in range(rng.randrange(1, 4)):
            k = rng.randrange(len(w))
            w[k : k + rng.randrange(2)] = rng.choice(["", "a", "r", "x"])
            w = w or ["a"]
        out.append("".join(w))
    return [*out, "dlainville", "blainville", "aaaaaa", "aaaaa", "ababab", "babab"]


@pytest.mark.parametrize("cutoff", [0.82, 0.85, 0.88, 0.9])
def test_ratio_pairs_lose_nothing(spark, cutoff):
    a, b = damaged(1, 150), damaged(1, 150)[::-1] + damaged(2, 100)
    got = {tuple(r) for r in match.ratio_pairs(spark.createDataFrame([(x,) for x in a], "q string"), spark.createDataFrame([(x,) for x in b], "key string"), cutoff).collect()}
    assert {(x, y) for x in a for y in b if max(ratio_of(x, y), ratio_of(y, x)) >= cutoff} <= got


def test_a_misread_first_letter_keeps_its_twin(spark):
    df = lambda *names: spark.createDataFrame(list(enumerate(names)), "id int, name string")
    assert [tuple(r) for r in match.twins(df("Dlainville"), df("Nancy", "Blainville")).collect()] == [(0, 1)]
    seats = spark.createDataFrame([("Brainville",), ("Dlainville",)], "seat string")
    gazetteer = spark.createDataFrame([("Bainville", "Bainville!")], "old string, modern string")
    assert {r.seat: r.modern for r in review.modern_names(seats, gazetteer).collect()} == {"Brainville": "Bainville!", "Dlainville": None}


def test_unheard_headings_against_all(spark):
    a, b = damaged(3, 30), damaged(4, 30)
    want = sorted(x for x in a if not difflib.get_close_matches(x, b, n=1, cutoff=0.6))
    df = lambda names: spark.createDataFrame([(x,) for x in names], "title string")
    assert sorted(r.title for r in review.unheard_headings(df(a), df(b)).collect()) == want


def test_garbled_numbers_match_by_name(spark):
    """Rows of numbers_ok false are loose matches from 0.82 on, short keys and old forms included."""
    names = {1: "Dun", 2: "Blainvilla", 3: "Charmanges", 4: "Marchainville", 5: "Vaudemont"}
    entries = spark.createDataFrame(list(names.items()), "no long, name string")
    shown = [(11, "Dun", [900], False), (12, "Blainville la Grande", [900], False), (13, "Charmonjes", [], False), (14, "Xyz", [901], False), (15, "Vaudamont", [902], True)]
    index = spark.createDataFrame(shown, "row_id long, name string, numbers array<long>, numbers_ok boolean")
    forms = spark.createDataFrame([("Marchainville", "Xyz (vieux)")], "old string, modern string")
    got = {r.no: (r.row_id, r.how, r.confidence) for r in match.match_ladder(entries, index, forms).collect()}
    assert got == {1: (11, "loose number", "medium"), 2: (12, "loose number", "medium"), 3: (None, "none", "low"), 4: (14, "loose number", "medium"), 5: (None, "none", "low")}
