"""Compiled records and small joins around them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import text
from annalist.functions.fuzzy import ratio


def place_points(places: DataFrame) -> DataFrame:
    """(id, lon, lat, place_type): the located settlements as a map takes them."""
    return places.where((F.col("kind") == "settlement") & F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("id", "lon", "lat", "place_type")


def navigation_target(places: DataFrame, areas: DataFrame) -> DataFrame:
    """(id, hierarchy, level): where a map shows a place: its own area's hierarchy and level, null for places without one."""
    a = areas.select(F.col("id").alias("__a"), "hierarchy", "level")
    return places.select("id").join(a, F.col("id") == F.col("__a"), "left").select("id", "hierarchy", "level")


def entry_places(entries: DataFrame) -> DataFrame:
    """(no, places): the places that each number names, once for each number."""
    return entries.groupBy("no").agg(F.array_sort(F.collect_set("place")).alias("places"))


def place_records(places: DataFrame, spellings: DataFrame, entries: DataFrame, holdings: DataFrame, edges: DataFrame, others: str = "names") -> DataFrame:
    """A record for each place (B17): id, name, spellings by source, entries with the other places of each, holdings, members in book order.

    places: (id, name); spellings: (place, source, spelling); entries: (no, place), a number may name several places;
    holdings: (place, tenure, holder); edges: (child, parent). Each part is gathered for itself and joined once.
    others: "names" puts the other places into every record, which grows with the square of the places of a number;
    "count" puts their count as n_others, and `entry_places` has the names once for each number.
    """
    said = spellings.distinct().groupBy(F.col("place").alias("s_id"), "source").agg(F.array_sort(F.collect_set("spelling")).alias("x")).groupBy("s_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "x")))).alias("spellings"))
    if others == "count":
        named = entries.where("no IS NOT NULL AND place IS NOT NULL").distinct()
        both = named.groupBy("no").agg(F.count("*").alias("all"))
        other = (F.col("all") - 1).alias("n_others")
    else:
        named, both = entries, entry_places(entries).withColumnRenamed("places", "all")
        other = F.array_except("all", F.array("place")).alias("others")
    own = named.join(both, "no").groupBy(F.col("place").alias("e_id")).agg(F.array_sort(F.collect_set(F.struct("no", other))).alias("entries"))
    held = holdings.groupBy(F.col("place").alias("h_id")).agg(F.array_sort(F.collect_set(F.struct("tenure", "holder"))).alias("holdings"))
    order = first_entries(entries).withColumnsRenamed({"place": "o_id", "no": "o_no"})
    ranked = edges.join(order, F.col("child") == F.col("o_id"), "left").select("parent", F.struct(F.col("o_no").isNull().alias("none"), F.col("o_no").alias("no"), "child").alias("m"))
    members = ranked.groupBy(F.col("parent").alias("m_id")).agg(F.transform(F.array_sort(F.collect_set("m")), lambda m: m["child"]).alias("members"))
    out = places.select("id", "name")
    for part, key in ((said, "s_id"), (own, "e_id"), (held, "h_id"), (members, "m_id")):
        out = out.join(part, F.col("id") == F.col(key), "left").drop(key)
    return out


def disambiguate(names: DataFrame, places: DataFrame, members: DataFrame) -> DataFrame:
    """(territory, name, place_id): the settlement that a name means: one inside the territory first, else the only one of that name.

    names: (territory, name); places: (id, name); members: (territory, id). Of several inside the first id counts.
    """
    p = places.select(F.col("id").alias("place_id"), text.fold(F.col("name"), ligatures=False).alias("k"))
    asked = names.select("territory", "name", text.fold(F.col("name"), ligatures=False).alias("k")).distinct()
    inside = members.select(F.col("territory").alias("__t"), F.col("id").alias("__i"), F.lit(True).alias("inside")).distinct()
    found = asked.join(p, "k", "left").join(inside, (F.col("territory") == F.col("__t")) & (F.col("place_id") == F.col("__i")), "left")
    best = found.groupBy("territory", "name").agg(F.min(F.when(F.col("inside"), F.col("place_id"))).alias("in_id"), F.min("place_id").alias("any_id"), F.count_distinct("place_id").alias("n"))
    return best.select("territory", "name", F.coalesce("in_id", F.when(F.col("n") == 1, F.col("any_id"))).alias("place_id"))


def listed(names: DataFrame, known: DataFrame, cutoff: float = 0.7) -> DataFrame:
    """The names (slug) that a list holds, exactly or as one of the closest at `cutoff` (C34); both (slug), a book's few lists.

    At this cutoff no shared letter pair is sure, so lengths alone part the pairs.
    """
    a, b = names.select("slug").distinct(), known.select(F.col("slug").alias("k")).distinct()
    exact = a.join(b, F.col("slug") == F.col("k"), "left_semi")
    rest = a.join(exact.select(F.col("slug").alias("x")), F.col("slug") == F.col("x"), "left_anti")
    pairs = rest.join(b, 2 * F.least(F.length("slug"), F.length("k")) >= cutoff * (F.length("slug") + F.length("k")))
    return exact.unionAll(pairs.where(ratio("k", "slug") >= cutoff).select("slug").distinct())


def crosswalk(units: DataFrame, places: DataFrame, entries: DataFrame) -> DataFrame:
    """(unit, other, place_id, name, n_entries, problem): a comparison of two orders of units, with the places and entries it names.

    units: (unit, other, place_id, nos array). problem: a place that is not there, or entries that are not; else null.
    """
    p = places.select(F.col("id").alias("__p"), "name")
    e = entries.select(F.col("no").alias("__n")).distinct()
    nos = units.select("unit", F.explode("nos").alias("no")).distinct().join(e, F.col("no") == F.col("__n"), "left").groupBy(F.col("unit").alias("__u")).agg(F.count("__n").alias("n_entries"), F.count_if(F.col("__n").isNull()).alias("lost"))
    out = units.join(p, F.col("place_id") == F.col("__p"), "left").join(nos, F.col("unit") == F.col("__u"), "left")
    problem = F.when(F.col("place_id").isNotNull() & F.col("__p").isNull(), "unknown place").when(F.coalesce("lost", F.lit(0)) > 0, "unknown entry")
    return out.select("unit", "other", "place_id", "name", F.coalesce("n_entries", F.lit(0)).alias("n_entries"), problem.alias("problem"))


def holdings_rollup(rows: DataFrame, keys: tuple[str, ...] = ("place", "tenure", "holder", "share"), entry: str = "via") -> DataFrame:
    """One holding for each place, tenure, holder and share, with its entry numbers in order."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(entry)).alias(entry))


def group_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, n): counts of rows by any keys (D15): status, method and confidence, kind of match, section by district."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def size_medians(lines: DataFrame, page: str, size: str, words: str) -> DataFrame:
    """(page, body, weighted): a page's median glyph size, interpolated, and the size at half of its characters."""
    by_size = lines.groupBy(page, size).agg(F.sum(F.length(words)).alias("chars"))
    total = by_size.groupBy(F.col(page).alias("__p")).agg((F.sum("chars") / 2).alias("half"), F.array_sort(F.collect_list(F.struct(F.col(size).alias("s"), F.col("chars").alias("c")))).alias("x"))
    step = lambda acc, x: F.struct((acc["seen"] + x["c"]).alias("seen"), F.when(acc["at"].isNull() & (acc["seen"] + x["c"] >= F.col("half")), x["s"]).otherwise(acc["at"]).alias("at"))
    kind = lines.schema[size].dataType
    weighted = total.select("__p", F.aggregate("x", F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast(kind).alias("at")), step, lambda a: a["at"]).alias("weighted"))
    return lines.groupBy(page).agg(F.median(size).alias("body")).join(weighted, F.col(page) == F.col("__p")).select(page, "body", "weighted")


def first_entries(entries: DataFrame) -> DataFrame:
    """(place, no): the smallest entry number of each place (D22); entries without a number come last, as null."""
    return entries.groupBy("place").agg(F.min(F.col("no").try_cast("bigint")).alias("no"))


def seen_with(rows: DataFrame, place: str, *columns: str) -> DataFrame:
    """(place, columns): the different values of each column that a place was seen with, sorted."""
    return rows.groupBy(place).agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns])


def candidate_numbers(printed: DataFrame, known: DataFrame, most: float = 1.0, widest: int | None = None) -> DataFrame:
    """(printed, no): numbers that a printed one may stand for: its digit neighbours, and those of its width that read as it at
    a cost of `most` at most (G4); of the numbers known only. With `widest`, printed numbers of more digits get neighbours alone."""
    if most > 1.0:
        raise ValueError("numbers are listed up to a cost of 1.0")
    p = printed.select("printed").distinct()
    near = p.select("printed", F.explode(text.digit_neighbours(F.col("printed"))).alias("no"))
    read = p if widest is None else p.where(F.length(F.col("printed").cast("string")) <= widest)
    cheap = read.select("printed", F.explode(text.loose_numbers(F.col("printed"))).alias("no")).where(F.length(F.col("no").cast("string")) == F.length(F.col("printed").cast("string")))
    return near.unionAll(cheap.where("no <> printed")).distinct().join(known.select(F.col("no").alias("k")).distinct(), F.col("no") == F.col("k"), "left_semi")


def orphans(places: DataFrame, entries: DataFrame, links: DataFrame) -> DataFrame:
    """Settlements that no entry and no index line names (G5). places: (id, kind); entries and links: (place)."""
    named = entries.select("place").unionAll(links.select("place")).where("place IS NOT NULL").distinct()
    return places.where(F.col("kind") == "settlement").join(named, F.col("id") == F.col("place"), "left_anti")


def unused_rules(rules: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rules whose key no row has."""
    return rules.join(rows.select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_anti")


def override_lines(lines: DataFrame, overrides: DataFrame) -> DataFrame:
    """(page, line, part, text): lines replaced by the lines that an override of (page, old) gives; an override that no line
    uses is an error (A6).

    lines: (page, line, text); overrides: (page, old, parts array).
    """
    o = overrides.select(F.col("page").alias("o_page"), "old", "parts")
    unused = o.join(lines, (F.col("page") == F.col("o_page")) & (F.col("text") == F.col("old")), "left_anti").select(F.count("*").alias("n"), F.min(F.concat_ws(": ", F.col("o_page").cast("string"), "old")).alias("first"))
    out = lines.join(o, (F.col("page") == F.col("o_page")) & (F.col("text") == F.col("old")), "left")
    parts = F.when(F.col("bad").isNotNull(), F.raise_error(F.concat(F.lit("unused override: "), F.col("bad"))).cast("array<string>")).otherwise(F.coalesce("parts", F.array("text")))
    checked = out.join(F.broadcast(unused.select(F.when(F.col("n") > 0, F.col("first")).alias("bad"))))  # one row
    return checked.select("page", "line", F.posexplode(parts).alias("part", "text"))


def report(sections: list[tuple[str, DataFrame, Column]]) -> DataFrame:
    """(section, line): a review report as Markdown (A29): each section's title and count, and its rows as a sorted list.

    sections: (title, rows, line expression).
    """
    parts = []
    for k, (title, rows, line) in enumerate(sections):
        body = rows.select(F.lit(k).alias("section"), F.lit(1).alias("below"), F.concat(F.lit("- "), line).alias("line"))
        head = rows.agg(F.count("*").alias("n")).select(F.lit(k).alias("section"), F.lit(0).alias("below"), F.format_string(f"## {title.replace('%', '%%')} (%d)", "n").alias("line"))
        parts += [head, body]
    return reduce(DataFrame.unionAll, parts).orderBy("section", "below", "line").select("section", "line")
