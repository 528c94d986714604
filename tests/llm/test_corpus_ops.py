"""Operators 3, 5, 6, 7, 9 and the pipeline, held against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from annalist.llm import decontaminate, language_id, line_dedup, quality, simhash
from annalist.llm.common import Scratch, components
from tests.llm.conftest import EDGES

WS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 3 ---------------------------------------------------------------------------------------


def line_docs():
    rng = random.Random(4)
    shared = [f"This is the shared line number {k} of the little corpus, É." for k in range(6)]
    rows = []
    for i in range(60):
        lines = [f"own line {i} {rng.random()} padded to be long enough, really" for _ in range(3)]
        lines += [rng.choice([s, "  " + s.upper().replace("É", "É") + "\t", s + " "]) for k, s in enumerate(shared) if i % (k + 2) == 0] + ["short"] * 2
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows


def plain_line_dedup(rows):
    key = lambda s: s.strip(WS).translate(LOWER)
    where = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for s in (t or "").split("\n"):
                if len(key(s)) >= 40:
                    where[key(s)].add(i)
    hot = {k: max(v) for k, v in where.items() if len(v) >= 5}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = lines if i is None else [s for s in lines if hot.get(key(s), i) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_line_dedup(spark, batches):
    rows = line_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in line_dedup.dedup_lines(spark, df, batches=batches).select("doc_id", "text", "n_lines", "n_dropped").collect()]
    assert sorted(got, key=str) == plain_line_dedup(rows)


def test_line_dedup_of_text_ids(spark):
    rows = [(f"d{i:03d}", t) for i, t in line_docs()]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id string, text string, n_lines int, `a.b` int")
    out = line_dedup.dedup_lines(spark, df)
    assert out.columns == ["doc_id", "text", "a.b", "n_lines", "n_dropped"]
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()], key=str) == plain_line_dedup(rows)


def test_line_dedup_edges(spark, edge_docs, no_docs):
    line = "a line that is repeated in many documents of this test\n"
    more = [(k, line * 2 + "x", "en", "s", 1) for k in (20, 21, 22, 23, 23, None)]
    df = edge_docs.unionAll(spark.createDataFrame(more, edge_docs.schema)).unionAll(spark.createDataFrame([(24, line + "y", "en", "s", 1)], edge_docs.schema))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    out = line_dedup.dedup_lines(spark, df)
    assert out.columns == ["doc_id", "text", "lang", "source", "key", "n_lines", "n_dropped"]
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()], key=str) == plain_line_dedup(rows)
    assert line_dedup.dedup_lines(spark, no_docs).count() == 0


# --- 5 ---------------------------------------------------------------------------------------


def plain_fingerprint(t):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    if not w:
        return 0
    grams = [" ".join(w[k : k + 4]) for k in range(len(w) - 3)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(fps, radius=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(k) for k in range(len(fps))]


def test_simhash_documents(spark, edge_docs, no_docs):
    rng = random.Random(2)
    base = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(200)) for _ in range(12)]
    rows = [(100 + k, t) for k, t in enumerate(base)] + [(200 + k, t + " tail") for k, t in enumerate(base)] + [(300 + k, t.upper()) for k, t in enumerate(base)]
    df = edge_docs.where("doc_id IS NOT NULL").select("doc_id", "text").distinct().unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    docs = sorted((r.doc_id, r.text) for r in df.collect() if r.text is not None) + [(r.doc_id, r.text) for r in df.collect() if r.text is None]
    docs.sort(key=lambda x: x[0])
    fps = [plain_fingerprint(t) for _, t in docs]
    want = {docs[i][0]: (fps[i], docs[g][0]) for i, g in enumerate(groups(fps))}
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(spark, df).collect()}
    assert got == want
    assert simhash.near_duplicates(spark, no_docs).count() == 0
    kept = simhash.keep_first(spark, edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([1, 2, 5, 6, 7, None], key=str)


def test_keep_first_of_repeated_ids(spark):
    """Of a doc_id's rows the one stays whose own text names its group, wherever the rows stand."""
    a, b = "a text that many copy word for word in this small table", "the only one of its kind, with nothing else like it here"
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "x"), (6, a, "y"), (6, b, "y"), (7, "one more text of its own, seven times seven words", "z"), (7, "one more text of its own, seven times seven words", "y")]
    want = [(3, a, "x"), (5, b, "x"), (7, "one more text of its own, seven times seven words", "y")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, source string")
        assert sorted(tuple(r) for r in simhash.keep_first(spark, df).collect()) == want


@pytest.mark.parametrize("seed", [0, 1])
def test_simhash_links_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    fps = set()
    for _ in range(120):
        x = rng.getrandbits(64)
        for d in range(7):
            fps.add(x)
            for b in rng.sample(range(64), d):
                x ^= 1 << b
    core = rng.getrandbits(64)
    for _ in range(150):  # a dense group, beyond SMALL
        x = core
        for b in rng.sample(range(64), rng.randrange(4)):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    scratch = Scratch(spark)
    links = simhash.fingerprint_links(spark, spark.createDataFrame([(x,) for x in signed], "fp long"), scratch)
    root = {r.node: r.root for r in components(spark, links, scratch).collect()}
    mine, plain = defaultdict(set), defaultdict(set)
    for k, g in enumerate(groups(fps)):
        plain[g].add(k)
        mine[root.get(signed[k], signed[k])].add(k)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, plain.values()))


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert all(got[k] == 0 for k in range(1, 41)) and all(got[100 + k] == 100 for k in range(1, 50))


# --- 6 ---------------------------------------------------------------------------------------

QUESTION = "If Anna has 12 apples and Ben gives her 30 kg of flour on the first day, how many apples does Anna keep when she pays 12 coins?"


def test_decontaminate(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (2, "four short words here"), (3, None), (None, "an item without any id at all, which is still an item")], "item_id long, text string")
    other = QUESTION.replace("Anna", "Marie").replace("12", "15").replace("30 kg", "7 lb")
    rows = [
        (30, "Before. " + QUESTION + " After."),
        (31, "Some words first. " + other),  # other names, numbers, unit: consistent
        (32, other.replace("Marie keep", "Lea keep").replace("15 coins", "16 coins")),  # one name stands for two
        (33, QUESTION[: len(QUESTION) // 3]),
        (34, "This says an item without any id at all, which is still an item indeed."),
    ]
    df = edge_docs.select("doc_id", "text").unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    for block in (500_000, 10):
        got = {(r.doc_id, r.item_id, r.exact) for r in decontaminate.find_leaks(df, bench, block_words=block).collect()}
        assert got == {(30, 1, True), (31, 1, False), (34, None, True)}
    kept = decontaminate.drop_leaks(df, bench)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([r[0] for r in EDGES] + [32, 33], key=str)
    assert decontaminate.drop_leaks(no_docs, bench).count() == 0
    assert decontaminate.find_leaks(no_docs, bench).count() == 0
    assert decontaminate.find_leaks(df, bench.limit(0)).count() == 0


def test_anchors_survive_what_similarity_allows(spark):
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(45)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    changed = list(words)
    changed[4] = "zzz"
    inserted = words[:20] + ["extra"] + words[20:]
    rows = [(1, " ".join(["lead"] * 7 + changed)), (2, " ".join(inserted))]
    got = {r.doc_id: r.similarity for r in decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1: pytest.approx(36 / 41, abs=1e-6), 2: pytest.approx(37 / 41, abs=1e-6)}


@pytest.mark.parametrize("size", range(5, 10))
def test_short_items(spark, size):
    """Each word changed in turn, at the start, inside a sentence and lower-cased: found where 0.8 of the windows stay."""
    words = "Where stands the old capital of France beside rivers".split()[:size]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    rows, want = [], set()
    for changed in (None, *range(size)):
        w = ["xyz" if k == changed else x for k, x in enumerate(words)]
        kept = sum(changed is None or not at <= changed < at + 5 for at in range(size - 4))
        for before in ("", "he asked, ", "the question ", "He wrote 3 letters to Anna. "):
            for t in (" ".join(w), " ".join(w).lower()):
                rows.append((len(rows), before + t + " and no more"))
                if kept >= 0.8 * (size - 4):
                    want.add((len(rows) - 1, round(kept / (size - 4), 6)))
    got = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert want <= {(r.doc_id, r.similarity) for r in got} and {r.doc_id for r in got} == {k for k, _ in want}
    assert len(want) == (24 if size == 9 else 8)


def test_anchors_outnumber_what_may_be_missing(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefghijk") * 3 for _ in range(rng.randint(5, 60))) for _ in range(40)]
    items = decontaminate.items_of(spark.createDataFrame(list(enumerate(texts)), "item_id long, text string"))
    got = Counter(r.item_key for r in decontaminate.anchors(items).select("item_key", "hash").distinct().collect())
    for r in items.collect():
        n = len({tuple(r.item_plain[k : k + 5]) for k in range(len(r.item_plain) - 4)})
        assert got[r.item_key] == int(n * 0.2 + 1e-9) + 1


def plain_template(t):
    """Words with their slots' marks, by the definitions."""
    import regex

    t = regex.sub(r"[\x01-\x03]", " ", t or "")
    t = regex.sub(r"(?<=[\p{Ll},;] )(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])", "\x01\\1", t)
    if regex.search(r"\p{N}", t):
        t = regex.sub(r"(\p{N}+(?:[.,]\p{N}+)*)", " \x02\\1 ", t).lower()
        t = regex.sub(rf"(\x02[\p{{N}}.,]+) +({decontaminate.UNITS.replace(' ', '|')})(?![\p{{L}}\p{{N}}])", "\\1 \x03\\2", t)
    return regex.sub(r"(?<!\p{N})[.,]|[.,](?!\p{N})|[^\p{L}\p{N}\x01-\x03.,]+", " ", t.lower()).split()


def plain_leaks(text, item):
    """None, or (similarity, exact) of the best of all ways to lay the item along the text."""
    slot = lambda w: w[0] in "\x01\x02\x03"
    temp = lambda ws: [w[0] if slot(w) else w for w in ws]
    bare = lambda ws: [w[1:] if slot(w) else w for w in ws]
    wins = lambda ws: [tuple(ws[k : k + 5]) for k in range(len(ws) - 4)]
    own, its = plain_template(text), plain_template(item)
    if len(its) < 5:
        return None
    want_p, order = set(wins(bare(its))), wins(temp(its))
    want_t = {w for w in order if any(len(x) > 1 or x not in "\x01\x02\x03" for x in w)}
    slack, best = -int(-(len(its) * (1 - 0.8) + 5) // 1), None
    doc_p, doc_t = wins(bare(own)), wins(temp(own))
    starts = {j - i for ws, ds in ((order, doc_t), (wins(bare(its)), doc_p)) for i, w in enumerate(ws) for j, d in enumerate(ds) if w == d}
    for s in starts:
        first = max(s - slack, 0)
        last = s + len(its) + slack
        sp, st, words = doc_p[first : last - 4], doc_t[first : last - 4], own[first:last]
        p = len(want_p & set(sp)) / len(want_p)
        t = len(want_t & set(st)) / len(want_t) if want_t else 0.0
        if p >= 0.8:
            best = max(best or (0, False), (max(p, t), True))
        elif t >= 0.8:
            off, low, pairs, covered = s - first, 0, set(), set()
            for i, w in enumerate(order):
                near = [i + off] if i + off >= low and i + off < len(st) and st[i + off] == w else [j for j in range(low, min(len(st), max(i + off, low) + slack + 1)) if st[j] == w]
                if near:
                    off, low = near[0] - i, near[0] + 1
                    for k in range(5):
                        if slot(its[i + k]):
                            covered.add(i + k)
                            pairs.add((its[i + k], words[near[0] + k]))
            if len(covered) >= 0.8 * sum(map(slot, its)) and len({a for a, _ in pairs}) == len(pairs):
                best = max(best or (0, False), (t, False))
    return best


def test_leaks_equal_brute_force(spark):
    rng = random.Random(12)
    names, common = ["Anna", "Paul", "Marie", "Oslo"], "the how many of a cost when coins box each gives does next train leaves keep".split()
    fill = lambda n: [rng.choice(common) if rng.random() < 0.75 else rng.choice([rng.choice(names), str(rng.randint(2, 40)), f"{rng.randint(2, 9)} km", "word" + chr(97 + rng.randint(0, 20))]) for _ in range(n)]
    items = [" ".join(fill(rng.randint(5, 40))) for _ in range(12)] + ["1 2 3 4 5 6 7", "What is 10 plus 3 and then again 10 times 3 when both are 10 of a kind"]
    docs = []
    for k in range(220):
        words = rng.choice(items).split(" ")
        if k % 3 == 0:  # other values: by a rule, or at random
            one = {}
            words = [one.setdefault(w, str(rng.randint(50, 99))) if w.isdigit() and k % 2 else str(rng.randint(50, 99)) if w.isdigit() else rng.choice(names) if w in names and k % 2 == 0 else w for w in words]
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1])] = [rng.choice(["zzz", "extra", "77", "Lea"])]
        docs.append((k, " ".join(fill(rng.randint(0, 30)) + words + fill(rng.randint(0, 30)))))
    docs += [(900, " ".join(map(str, range(60)))), (901, None), (902, "")]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.exact) for r in decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    want = {(i, j): x for i, t in docs for j, item in enumerate(items) if (x := plain_leaks(t, item))}
    assert len(want) > 100 and any(not e for _, e in want.values())
    assert set(got) == set(want)
    assert {k: e for k, (_, e) in got.items()} == {k: e for k, (_, e) in want.items()}


def test_slots_of_a_value_in_two_places(spark):
    item = "Anna has 10 apples in the red box and then she buys 10 pears for the blue box today"
    rows = [
        (1, item.replace("10", "12")),
        (2, item.replace("10 apples", "12 apples").replace("10 pears", "99 pears")),
        (3, item.replace("10 apples", "12 apples").replace("10 pears", "99 pears").replace("box today", "box right today")),
        (4, item.replace("10", "12").replace("box today", "box right today")),
    ]
    twice = "count 10 and go on to the left side count 10 and go on to the right side"
    rows += [(5, twice.replace("10", "7")), (6, twice.replace("10", "7", 1).replace("10", "8"))]
    bench = spark.createDataFrame([(1, item), (2, twice)], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.exact) for r in decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 1, False), (4, 1, False), (5, 2, False)}


def test_drop_leaks_judges_rows(spark):
    rows = [(None, QUESTION), (None, "a clean text without an id"), (1, QUESTION), (1, "another text of the same id"), (2, None)]
    docs = spark.createDataFrame([(*r, 3, 4) for r in rows], "doc_id long, text string, leaks int, `a.b` int")
    bench = spark.createDataFrame([("q", QUESTION), ("r", "some other item with enough words in it")], "item_id string, text string")
    for block in (250_000, 10):
        kept = decontaminate.drop_leaks(docs, bench, block_words=block)
        assert kept.columns == docs.columns
        assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


# --- 7 ---------------------------------------------------------------------------------------


def plain_counts(t):
    t = t or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
    c = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if c[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    seen, dup = set(), 0
    for s in t.split("\n"):
        if s.strip(WS):
            dup += s in seen
            seen.add(s)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), dup, len(covered)


def test_quality_score_equals_plain_version(spark, tmp_path):
    import math

    import regex
    import xxhash

    rng = random.Random(6)
    words = "alpha beta gamma delta the of, x1 ## é".split()
    rows = [(k, None if k == 5 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for k in range(60)]
    labels = [(k, k % 2, int(k % 6 == 1)) for k in range(0, 60, 1)] + [(None, 1, 0)]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    def buckets(t):
        ws = regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+", t or "")
        h = lambda s, seed: (x := xxhash.xxh64_intdigest(s.encode(), seed)) - (x >> 63 << 64)
        unsigned = lambda x: x % (1 << 64)
        return [h(w, 42) % quality.BUCKETS for w in ws] + [h(b, unsigned(h(a, 42))) % quality.BUCKETS for a, b in zip(ws, ws[1:])]

    good = {i for i, q, toxic in labels if i is not None and q == 1 and not toxic}
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(buckets(t))
        if i in good:
            target.update(buckets(t))
    part = lambda c, k: math.log((c[k] + 0.5) / (sum(c.values()) + 0.5 * quality.BUCKETS))
    for r in quality.query(spark, str(tmp_path)).collect():
        grams = buckets(dict(rows)[r.doc_id])
        score = sum(part(target, k) - part(raw, k) for k in grams) / len(grams) if grams else 0.0
        assert r.n_grams == len(grams) and r.score == pytest.approx(score, abs=2e-6)
        assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)


def test_quality(spark, edge_docs, no_docs):
    rng = random.Random(5)
    good = [(100 + k, " ".join(rng.choice("the of and town river people house".split()) for _ in range(80))) for k in range(30)]
    bad = [(200 + k, " ".join(rng.choice("BUY!! ### $$$ click|here %%% NOW".split()) for _ in range(80))) for k in range(30)]
    rep = [(300, " ".join(f"w{k % 11}" for k in range(40))), (301, "a b c d e f g h " * 2 + "x y " * 30 + "\nl\nl\n \n ")]
    df = edge_docs.select("doc_id", "text").unionAll(spark.createDataFrame(good + bad + rep, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:15]] + [(i, 0, 0) for i, _ in bad[:5]] + [(None, 1, 0), (good[0][0], 1, None)], "doc_id long, quality int, toxic int")
    out = quality.judge_quality(df, labels).collect()
    texts = sorted(plain_counts(r.text) for r in df.collect())
    assert sorted(tuple(r[c] for c in quality.COUNTS) for r in out) == texts
    for r in out:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    by = {r.doc_id: r for r in out}
    assert all(by[i].kept for i, _ in good) and not any(by[i].kept for i, _ in bad)
    none = quality.judge_quality(df, labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in none)
    assert quality.judge_quality(no_docs, labels).count() == 0


# --- 9 ---------------------------------------------------------------------------------------


def test_language_id(spark, edge_docs, no_docs):
    rng = random.Random(6)
    parts = {"aa": "ba be bi bo bu".split(), "bb": "kra kre kri kro".split(), "cc": "ñoz ñaz ñez".split()}
    rows = [(1000 * n + k, " ".join("".join(rng.choices(p, k=3)) for _ in range(25)), lang, "s", 1) for n, (lang, p) in enumerate(parts.items()) for k in range(60)]
    df = spark.createDataFrame(rows, edge_docs.schema)
    profiles = language_id.learn_profiles(spark, df.where(~language_id.held_out("doc_id")))
    assert set(profiles) == set(parts) and all(sorted(p.values()) == list(range(len(p))) for p in profiles.values())
    got = language_id.predict(df, profiles).collect()
    assert all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in got)
    edge = language_id.predict(edge_docs, profiles)
    assert edge.columns == [*edge_docs.columns, "lang_pred", "score", "distance"]
    by = {r.doc_id: r.lang_pred for r in edge.collect()}
    assert by[2] == by[3] == by[4] == "und" and by[5] != "und"
    assert language_id.predict(no_docs, profiles).count() == 0
    assert language_id.learn_profiles(spark, no_docs) == {}
    assert {r.lang_pred for r in language_id.predict(df, {}).collect()} == {"und"}


def grams_of(word):
    s = f" {word} "
    return [s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i : i + n] != " "]


def test_language_profiles_equal_plain_counts(spark):
    rows = [("abc abd é", "x"), ("abc", "x"), ("zz top", "y"), (None, "x"), ("nolang", None)]
    got = language_id.learn_profiles(spark, spark.createDataFrame(rows, "text string, lang string"), top=12)
    mixed = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 400)) + " 漢字 a-b_c É"
    assert language_id.count_grams(mixed) == Counter(g for w in re.findall(r"[^\W\d_]+", mixed.lower()) for g in grams_of(w))
    for lang in ("x", "y"):
        c = Counter(g for t, k in rows if k == lang and t for w in re.findall(r"[^\W\d_]+", t.lower()) for g in grams_of(w))
        want = [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:12]]
        assert [g for g, _ in sorted(got[lang].items(), key=lambda x: x[1])] == want


def plain_distance(t, profiles, top=language_id.DOC_TOP):
    """The out-of-place distance of a text's own n-grams to each profile."""
    c = Counter(g for w in re.findall(r"[^\W\d_]+", t.lower()) for g in grams_of(w))
    own = [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:top]]
    most = max(map(len, profiles.values()))
    return {k: sum(min(abs(p[g] - i), most) if g in p else most for i, g in enumerate(own)) / (most * len(own)) for k, p in profiles.items()}


ENGLISH = "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood. Everyone has the right to life, liberty and security of person. "
FRENCH = "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité. Tout individu a droit à la vie, à la liberté et à la sûreté de sa personne. "
FOREIGN = {
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "vi": "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều được tạo hóa ban cho lý trí và lương tâm.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
    "ru with an English word": "Все люди рождаются свободными и равными в своем достоинстве и правах. the Они наделены разумом и совестью и должны поступать в духе братства.",
    "consonants": "xkq zvr pwd qqx fgh jkl mnb vcx zsd rtp wqk xzv bnm hjk lkj gfd zxc vbn qwr tps dfg hjl kzx cvb nmq wrt psd",
}


def test_language_distance_counts_unknown_grams(spark):
    rng = random.Random(8)
    profiles = {k: {g: i for i, (g, _) in enumerate(sorted(language_id.count_grams(t).items(), key=lambda x: (-x[1], x[0]))[:400])} for k, t in (("en", ENGLISH), ("fr", FRENCH))}
    judge = language_id.Judge(profiles)
    long = " ".join("".join(rng.choices("abcdeéñжx漢", k=rng.randrange(1, 7))) for _ in range(2000))
    for t in [ENGLISH, FRENCH, ENGLISH[:90], long, *FOREIGN.values()]:
        want = plain_distance(t, profiles)
        lang, _, far = judge(t)
        assert far == pytest.approx(min(want.values())) and want[lang] == min(want.values())


def test_foreign_and_mixed_texts_are_rejected(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choices((ENGLISH if k % 2 else FRENCH).split(), k=60)), "en" if k % 2 else "fr") for k in range(80)]
    foreign = [(1000 + k, t, None) for k, t in enumerate(FOREIGN.values())]
    docs = spark.createDataFrame(rows + foreign, "doc_id long, text string, lang string")
    assert {r.doc_id for r in language_id.filter_languages(spark, docs).collect()} == set(range(80))


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path, edge_docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "decontamination", "tokens"]
    rng = random.Random(7)
    sounds = {"aa": "ba be bi bo bu da de".split(), "bb": "kra kre kri kro kru".split()}
    prose = lambda lang, n: " ".join("".join(rng.choices(sounds[lang], k=rng.randrange(1, 4))) for _ in range(n))
    line = "license line that stands in many of the documents here, word for word"
    item = prose("aa", 30)
    rows = [(k, prose("aa" if k % 2 else "bb", 120) + ("\n" + line if k % 4 == 0 else ""), "aa" if k % 2 else "bb", "s", 0) for k in range(40)]
    rows += [(100 + k, rows[k][1], rows[k][2], "s", 0) for k in range(1, 40, 6)]  # exact copies
    rows += [(200, prose("aa", 40) + " " + item + " " + prose("aa", 40), "aa", "s", 0), (201, "12345 678 !!", "aa", "s", 0), (202, None, None, None, None)]
    d = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, d).collect()}
    left = {r[0]: r[1] for r in rows if r[0] < 100}
    kept = dict((i, t) for i, t, _, _ in plain_line_dedup([(r[0], r[1]) for r in rows if r[0] not in (201, 202)]))
    assert set(got) == set(left)
    for i in left:
        assert got[i].decoded_sha256 == hashlib.sha256(kept[i].encode()).hexdigest()
