"""Lookups and reviews around the matcher."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import text
from annalist.functions.fuzzy import ratio
from annalist.operators import match
from annalist.operators.lineage import cut
from annalist.operators.nearest import closest_keys


def pages_near(page: Column) -> Column:
    """The page, its neighbours, and those that a 3 read as 5 (or the reverse) would give, as (page, priority) (C11)."""
    n = page.cast("int")
    swapped = F.array(F.translate(page, "3", "5"), F.translate(page, "5", "3"))
    others = F.array_except(F.concat(F.array((n - 1).cast("string"), (n + 1).cast("string")), swapped), F.array(page))
    return F.concat(F.array(F.struct(page.alias("page"), F.lit(0).alias("priority"))), F.transform(F.array_distinct(others), lambda p: F.struct(p.alias("page"), F.lit(1).alias("priority"))))


def find_on_pages(queries: DataFrame, rows: DataFrame, cutoff: float = 0.7) -> DataFrame:
    """(qid, row_id, ratio): the closest row on the cited page, else on a page near it (C11). queries: (qid, page, name); rows: (row_id, page, name).

    The pages near are searched only for what the cited one lacks.
    """
    asked = queries.select("qid", "page", text.name_key(F.col("name")).alias("q")).where(F.col("q").isNotNull())
    have = rows.groupBy(F.col("page").alias("g"), text.name_key(F.col("name")).alias("key")).agg(F.min("row_id").alias("o")).where(F.col("g").isNotNull() & F.col("key").isNotNull()).withColumn("w", F.lit(1).cast("bigint"))

    def closest(of: DataFrame) -> DataFrame:
        """(qid, row_id, ratio) of the best row on the pages `g` of (qid, g, q)."""
        near = closest_keys(of.select("g", "q", F.lit(0).cast("bigint").alias("floor")).distinct(), have, cutoff, least=True)
        found = of.join(near.select("g", "q", F.col("o").alias("row_id"), "ratio").hint("merge"), ["g", "q"])
        return found.groupBy("qid").agg(F.min_by(F.struct("row_id", "ratio"), F.struct(-F.col("ratio"), "row_id")).alias("x")).select("qid", "x.*")

    cited = cut(closest(asked.select("qid", F.col("page").alias("g"), "q")))
    others = asked.join(cited.select("qid").hint("merge"), "qid", "left_anti").select("qid", "q", F.explode(pages_near(F.col("page"))).alias("p")).where("p.priority > 0")
    return cited.unionAll(closest(others.select("qid", F.col("p.page").alias("g"), "q")))


def unheard_headings(contents: DataFrame, headings: DataFrame, cutoff: float = 0.6, width: int = 40) -> DataFrame:
    """The contents lines that no heading is like (C31); both (title).

    At this cutoff no shared letter pair is sure, so all of the lines, a book's contents, are compared but for lengths.
    """
    key = lambda c: F.substring(text.slug(F.col(c)), 1, width)
    a, b = contents.select("title", key("title").alias("q")), headings.select(key("title").alias("key")).distinct()
    pairs = a.select("q").distinct().join(b, 2 * F.least(F.length("q"), F.length("key")) >= cutoff * (F.length("q") + F.length("key")))
    heard = pairs.where(ratio("key", "q") >= cutoff).select("q").distinct()
    return a.join(heard, "q", "left_anti").select("title")


def answer_ranks(hits: DataFrame, answers: DataFrame) -> DataFrame:
    """(q, rank): where the answer found by hand stands among the hits; null if it is not there (C32). hits: (q, label, rank); answers: (q, answer)."""
    h = hits.select("q", text.spelling_key(F.col("label")).alias("k"), "rank")
    a = answers.select("q", text.spelling_key(F.col("answer")).alias("k"))
    return a.join(h, ["q", "k"], "left").groupBy("q").agg(F.min("rank").alias("rank"))


#: Least score of a review, of a disagreement, and the distances of near and far in km.
REVIEW, DISAGREE, NEAR_KM, FAR_KM = 0.8, 0.85, 12.0, 15.0


def review_placements(places: DataFrame, hits: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """(id, bucket, place_id, km): placements that the best dictionary hit doubts.

    places: (id, lat, lon, located by name boolean); hits: (id, place_id, score, lat, lon), any number a place. disagree:
    a good hit far from the point; name: a hit near an unnamed point. Reviewed ids stay silent.
    """
    best = hits.where(F.col("score") >= REVIEW).groupBy("id").agg(F.max_by(F.struct("place_id", "score", F.col("lat").alias("h_lat"), F.col("lon").alias("h_lon")), F.struct("score", "place_id")).alias("h"))
    x = places.join(best, "id").select("*", "h.*")
    km = text.haversine_km(F.col("lat"), F.col("lon"), F.col("h_lat"), F.col("h_lon"))
    bucket = F.when((km > FAR_KM) & (F.col("score") >= DISAGREE), "disagree").when((km <= NEAR_KM) & ~F.col("named"), "name")
    out = x.withColumn("km", km).withColumn("bucket", bucket).where("bucket IS NOT NULL").select("id", "bucket", "place_id", "km")
    return out if reviewed is None else out.join(reviewed.select("id"), "id", "left_anti")


#: Fixed value: the least letters of a key that a near one may stand for.
NEAR_LETTERS = 7


def modern_names(seats: DataFrame, gazetteer: DataFrame, cutoff: float = 0.85) -> DataFrame:
    """(seat, modern): the gazetteer's name of equal slug, else of equal loose key, else, for keys of seven letters or more, the
    closest of the same initial letter (C35). gazetteer: (old, modern).

    A seat of several places ("A et B") is put part by part; a part that is not found stays as it is. Null if none is.
    """
    g = gazetteer.groupBy(text.slug(F.col("old")).alias("s")).agg(F.min("modern").alias("by_slug"))
    loose = gazetteer.groupBy(text.name_key(F.col("old")).alias("key")).agg(F.min("modern").alias("by_key"))
    parts = seats.select("seat").distinct().select("seat", F.posexplode(F.split("seat", r"\s+et\s+")).alias("pos", "part"))
    own = parts.select("part").distinct().select("part", text.slug(F.col("part")).alias("s"), text.name_key(F.col("part")).alias("q"))
    near = match.closest(own.where(F.length("q") >= NEAR_LETTERS), loose, cutoff, block=1).select("q", F.col("key").alias("near"))
    exact = loose.select(F.col("key").alias("x_key"), F.col("by_key").alias("by_exact"))
    out = own.join(g, "s", "left").join(exact, F.col("q") == F.col("x_key"), "left").join(near, "q", "left").join(loose, F.col("near") == F.col("key"), "left")
    named = out.select("part", F.coalesce("by_slug", "by_exact", "by_key").alias("modern"))
    whole = parts.join(named, "part", "left").groupBy("seat").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("modern", text.fix_name(F.col("part"))).alias("m")))).alias("x"), F.bool_or(F.col("modern").isNotNull()).alias("found"))
    known = whole.select(F.col("seat").alias("w_seat"), F.when(F.col("found"), F.array_join(F.transform("x", lambda p: p["m"]), " et ")).alias("modern"))
    return seats.join(known, F.col("seat") == F.col("w_seat"), "left").select("seat", "modern")


def canonical_spellings(mentions: DataFrame, cutoff: float = 0.8) -> DataFrame:
    """(name, canonical): rarer spellings put to a clean, more frequent one that is like them.

    mentions: (name, weight), 1 for a mention and 2 for a line of its own. Same initial, lengths within one, at least
    two in weight, and no sign of damage in the canonical one.
    """
    n = mentions.groupBy("name").agg(F.sum("weight").cast("bigint").alias("n")).withColumn("key", text.name_key(F.col("name"))).where("key <> ''")
    n = cut(n)
    clean = n.where((F.col("n") >= 2) & ~F.col("name").rlike(r"[0-9*!|{}\[\]<>^]"))
    # of one key the name of the largest weight, and of those the last, comes before its others for every rarer name
    good = clean.groupBy("key").agg(F.max(F.struct("n", "name")).alias("x")).select("key", F.col("x.n").alias("w"), F.col("x.name").alias("o"))
    rare = n.select(F.col("key").alias("q"), F.col("n").alias("floor")).distinct()
    same = rare.join(good.withColumnRenamed("key", "q").hint("merge"), "q").where("w > floor").select("q", "floor", "w", "o", F.lit(1.0).alias("ratio"))
    same = cut(same)
    block = lambda k, size: F.concat_ws(" ", F.substring(k, 1, 1), size)
    sizes = F.sequence(F.length("q") - 1, F.length("q") + 1)
    left = rare.join(same.select("q", "floor").hint("merge"), ["q", "floor"], "left_anti").select("q", "floor", F.explode(sizes).alias("size"))
    near = closest_keys(left.select(block("q", F.col("size")).alias("g"), "q", "floor"), good.select(block("key", F.length("key")).alias("g"), "key", "w", "o"), cutoff, query_first=True)
    best = same.unionAll(near.select(*same.columns)).groupBy("q", "floor").agg(F.max_by("o", F.struct("ratio", "w", "o")).alias("canonical"))
    return n.join(best.toDF("key", "n", "canonical").hint("merge"), ["key", "n"], "left").select("name", F.coalesce("canonical", "name").alias("canonical"))


def bounding_boxes(rows: DataFrame, ident: str, ring: str) -> DataFrame:
    """(ident, west, south, east, north) of each ring."""
    xs, ys = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
    return rows.select(ident, F.array_min(xs).alias("west"), F.array_min(ys).alias("south"), F.array_max(xs).alias("east"), F.array_max(ys).alias("north"))


def inside(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies in a ring (array<array<double>>): an odd number of edges to its right."""
    after = lambda i: F.get(ring, (i + 1) % F.size(ring))
    crosses = lambda a, i: ((a[1] > y) != (after(i)[1] > y)) & (x < (after(i)[0] - a[0]) * (y - a[1]) / F.nullif(after(i)[1] - a[1], F.lit(0.0)) + a[0])
    return F.size(F.filter(ring, lambda a, i: F.coalesce(crosses(a, i), F.lit(False)))) % 2 == 1


def pick(points: DataFrame, areas: DataFrame, cell: float) -> DataFrame:
    """(pid, area): for each point the smallest area that holds it (C37). areas: (area, settlements, ring).

    Areas go to the grid cells of their bounding boxes, points to theirs; only those that share one are tested.
    """
    box = bounding_boxes(areas, "area", "ring")
    boxed = areas.join(box, "area")
    span = lambda low, high: F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))
    a = boxed.withColumn("cx", F.explode(span("west", "east"))).withColumn("cy", F.explode(span("south", "north")))
    p = points.select("pid", "x", "y", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    hit = p.join(a, ["cx", "cy"]).where(inside(F.col("x"), F.col("y"), F.col("ring")))
    return hit.groupBy("pid").agg(F.min_by("area", F.struct("settlements", "area")).alias("area"))


def header_number(header: Column) -> Column:
    """The number in a running header: Roman letters as they are, else its digits with look-alikes read."""
    core = F.regexp_replace(header, r"(?U)[^\w|!]", "")
    digits = F.regexp_replace(F.translate(core, "lIi!|OoQDGbSsBgq", "1111100006655899"), "[^0-9]", "")
    return F.when(F.upper(core).rlike("^[IVXLC]+$"), F.upper(core)).otherwise(digits)


def agrees(header: Column, label: Column) -> Column:
    """Whether a header confirms a page label; null without a number; 3 and 5, 1 and 4 stand for each other."""
    got, want = header_number(header), F.ltrim(label, F.lit("c"))
    same = lambda i: (F.substring(F.translate(got, "5", "3"), i, F.lit(1)) == F.substring(F.translate(want, "5", "3"), i, F.lit(1))) | F.concat(F.substring(got, i, F.lit(1)), F.substring(want, i, F.lit(1))).isin("14", "41")
    return F.when(got != "", F.when(F.length(got) != F.length(want), False).otherwise(F.forall(F.sequence(F.lit(1), F.length(got)), same)))


def is_page_header(text_: Column, top: Column, height: Column) -> Column:
    """A short line in the top 13 percent of a page."""
    return (top < 0.13 * height) & (F.length(text_) <= 60)


def is_signature(text_: Column, top: Column, height: Column) -> Column:
    """A mark of a few characters below 80 percent of a page."""
    return (top > 0.80 * height) & F.trim(text_).rlike(r"^[0-9*.ivxIVX ]{1,4}$")


def weighted_keys(name: Column, spellings: Column) -> Column:
    """The keys of a place as array<struct<key, weight>>: own name 1.0, its base 0.9, old spellings 0.95, their base 0.85.

    A spelling whose key the own name has already adds nothing.
    """
    pair = lambda k, w: F.struct(k.alias("key"), F.lit(w).alias("weight"))
    full, base = text.name_key(name), text.name_key(text.base_name(name))
    own = F.filter(F.array(pair(full, 1.0), F.when(base != full, pair(base, 0.9))), lambda x: x.isNotNull() & (x["key"] != ""))
    others = F.coalesce(spellings, F.array().cast("array<string>"))
    old = F.flatten(F.transform(others, lambda s: F.array(pair(text.name_key(s), 0.95), F.when(text.name_key(text.base_name(s)) != text.name_key(s), pair(text.name_key(text.base_name(s)), 0.85)))))
    mine = F.transform(own, lambda x: x["key"])
    return F.concat(own, F.array_distinct(F.filter(old, lambda x: x.isNotNull() & (x["key"] != "") & ~F.array_contains(mine, x["key"]))))


def text_similarity(rows: DataFrame) -> DataFrame:
    """(id, sim): how well a text names a place: its name, or the best run of one to three words about as long (H8). rows: (id, name, text, target)."""
    words = F.regexp_extract_all("text", F.lit(r"[^\s,.;:()]+"), F.lit(0))
    run = lambda k: F.when(F.size("w") >= k, F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " "))).otherwise(F.array().cast("array<string>"))
    runs = rows.withColumn("w", words).withColumn("runs", F.concat(run(1), run(2), run(3)))
    want = F.length(text.name_key(F.col("target")))
    each = runs.select("id", "target", F.explode_outer("runs").alias("run")).where(F.length(text.name_key(F.col("run"))) >= F.greatest(F.lit(4), 0.6 * want))
    pairs = each.unionByName(rows.select("id", "target", F.col("name").alias("run"))).distinct()
    return match.similarity(pairs, "run", "target").groupBy("id").agg(F.max("sim").alias("sim"))
