"""Constraint checks as queries (C1, C2, C20, C21, G1-G5, J1, J2, and the rule catalogue): one function per rule, issue rows out.

An issue is (level, table, row, message). Rules over foreign keys and vocabularies are anti joins; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.operators import aggregate, graph


def issues(rows: DataFrame, level: str, table: str, row, message: Column | str) -> DataFrame:
    text = F.lit(message) if isinstance(message, str) else message
    return rows.select(F.lit(level).alias("level"), F.lit(table).alias("table"), F.col(row).cast("string").alias("row"), text.alias("message"))


def fk_anti(rows: DataFrame, column: str, target: DataFrame, key: str) -> DataFrame:
    """The rows whose non-null value (item by item for arrays) is not in the target."""
    if rows.schema[column].dataType.typeName() == "array":
        rows = rows.withColumn(column, F.explode(column))
    t = target.select(F.col(key).alias("__k")).distinct()
    return rows.where(F.col(column).isNotNull()).join(t, F.col(column) == F.col("__k"), "left_anti")


def vocab_anti(rows: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """The rows whose value a vocabulary lacks (C2); vocabularies are configuration."""
    return rows.where(F.col(column).isNotNull() & ~F.col(column).isin(keys))


def duplicate_ids(rows: DataFrame, table: str, key: str, line: str) -> DataFrame:
    found = aggregate.duplicates(rows, key, line)
    return issues(found, "error", table, line, F.format_string("duplicate %s (line %s)", F.col(key).cast("string"), F.col("first_line").cast("string")))


def without_source(rows: DataFrame, table: str, row: str, source: str = "source_page") -> DataFrame:
    return issues(rows.where(F.coalesce(F.col(source), F.lit("")) == ""), "error", table, row, "no source_page")


def bad_pattern(rows: DataFrame, table: str, row: str, column: str, pattern: str) -> DataFrame:
    return issues(rows.where(F.col(column).isNotNull() & ~F.col(column).rlike(pattern)), "error", table, row, F.concat(F.lit(f"{column}: "), F.col(column)))


def bad_place(places: DataFrame) -> DataFrame:
    """Settlements with fields of territories, half a coordinate, coordinates out of range (B2)."""
    settled = F.col("kind") == "settlement"
    rules = [
        (settled & (F.col("hierarchy").isNotNull() | F.col("holder_id").isNotNull() | F.col("counterpart_id").isNotNull()), "a settlement has fields of a territory"),
        (F.col("lat").isNull() != F.col("lon").isNull(), "lat without lon"),
        ((F.abs(F.col("lat")) > 90) | (F.abs(F.col("lon")) > 180), "coordinates out of range"),
        (~settled & F.col("hierarchy").isNull(), "a territory without hierarchy"),
    ]
    return reduce(DataFrame.unionAll, [issues(places.where(c), "error", "places", "id", m) for c, m in rules])


def mirrored(entries: DataFrame, edges: DataFrame, column: str, relation: str) -> DataFrame:
    """Entries whose district or realm is no edge of their place (C20)."""
    e = edges.where(F.col("relation") == relation).select(F.col("child").alias("__c"), F.col("parent").alias("__p")).distinct()
    return entries.where(F.col(column).isNotNull()).join(e, (F.col("place") == F.col("__c")) & (F.col(column) == F.col("__p")), "left_anti")


def counterpart_check(places: DataFrame) -> DataFrame:
    """(id, problem): counterparts that are missing, not mutual, of the same hierarchy, of another seat or without basis."""
    o = places.select(F.col("id").alias("o_id"), F.col("counterpart_id").alias("o_back"), F.col("hierarchy").alias("o_h"), F.col("seat").alias("o_seat"))
    both = places.where(F.col("counterpart_id").isNotNull()).join(o, F.col("counterpart_id") == F.col("o_id"), "left")
    problem = (
        F.when(F.col("o_id").isNull(), "missing")
        .when(~F.col("o_back").eqNullSafe(F.col("id")), "not mutual")
        .when(F.col("o_h") == F.col("hierarchy"), "same hierarchy")
        .when(F.col("counterpart_basis").isNull(), "no basis")
        .when(~F.col("o_seat").eqNullSafe(F.col("seat")), "other seat")
    )
    return both.withColumn("problem", problem).where(F.col("problem").isNotNull()).select("id", "problem")


def edge_ends(edges: DataFrame, places: DataFrame) -> DataFrame:
    """Edges whose ends are of the wrong kind or hierarchy."""
    p = places.select(F.col("id").alias("p_id"), F.col("kind").alias("p_kind"), F.col("hierarchy").alias("p_h"))
    c = places.select(F.col("id").alias("c_id"), F.col("kind").alias("c_kind"), F.col("hierarchy").alias("c_h"))
    x = edges.join(p, F.col("parent") == F.col("p_id"), "left").join(c, F.col("child") == F.col("c_id"), "left")
    bad = (
        F.when(F.coalesce(F.col("p_kind"), F.lit("")) != "territory", "parent is no territory")
        .when((F.col("relation") == "admin") & (F.col("p_h") != "admin"), "admin edge to a feudal parent")
        .when((F.col("relation") == "feudal") & (F.col("p_h") != "feudal"), "feudal edge to an admin parent")
        .when((F.col("relation") == "ressort") & ((F.col("p_h") != "admin") | (F.col("c_h") != "feudal")), "ressort runs from a realm to a division")
    )
    return issues(x.withColumn("m", bad).where("m IS NOT NULL"), "error", "memberships", "child", F.col("m"))


def cycle_issues(edges: DataFrame) -> DataFrame:
    return issues(graph.cycles(edges), "error", "memberships", "node", "part of a cycle")


def unreachable_issues(nodes: DataFrame, edges: DataFrame, root: str) -> DataFrame:
    return issues(graph.unreachable(nodes, edges, root), "error", "places", "node", "does not reach the root")


def share_issues(holdings: DataFrame) -> DataFrame:
    return issues(aggregate.share_overflow(holdings), "error", "holdings", "place", "shares exceed 1")


def number_range(entries: DataFrame, last: int) -> DataFrame:
    return issues(entries.where(~F.col("no").between(1, last)), "error", "entries", "no", "number out of range")


def unlabelled(vocabulary: DataFrame, languages: tuple[str, ...] = ("en", "fr", "de", "ja")) -> DataFrame:
    """Vocabulary keys that lack a label in a language. vocabulary: (vocab, key, lang, label)."""
    has = vocabulary.where("label IS NOT NULL AND label <> ''").groupBy("vocab", "key").agg(F.collect_set("lang").alias("langs"))
    keys = vocabulary.select("vocab", "key").distinct().join(has, ["vocab", "key"], "left")
    lacks = F.array_except(F.array(*map(F.lit, languages)), F.coalesce("langs", F.array().cast("array<string>")))
    return issues(keys.withColumn("lacks", lacks).where(F.size("lacks") > 0), "error", "vocab", "key", F.concat(F.lit("no label in "), F.array_join("lacks", ", ")))


def holder_on_division(places: DataFrame) -> DataFrame:
    """Administrative divisions with a holder: only realms are held."""
    return issues(places.where((F.col("hierarchy") == "admin") & (F.size(F.coalesce("holder_id", F.array().cast("array<string>"))) > 0)), "error", "places", "id", "a holder on a division")


def realm_without_holder(places: DataFrame) -> DataFrame:
    return issues(places.where((F.col("hierarchy") == "feudal") & (F.size(F.coalesce("holder_id", F.array().cast("array<string>"))) == 0)), "info", "places", "id", "a realm without holder")


def partners_without_share(rows: DataFrame, table: str, row: str) -> DataFrame:
    """Rows that name with whom something is shared, but no share."""
    return issues(rows.where((F.size(F.coalesce("share_with", F.array().cast("array<string>"))) > 0) & F.col("share").isNull()), "warning", table, row, "share_with without share")


def duplicate_edges(edges: DataFrame) -> DataFrame:
    twice = edges.groupBy("child", "parent", "relation").agg(F.count("*").alias("n")).where("n > 1")
    return issues(twice, "warning", "memberships", "child", F.concat(F.lit("edge repeated: "), F.col("parent"), F.lit(" "), F.col("relation")))


def ressort_differs(places: DataFrame, edges: DataFrame) -> DataFrame:
    """Realms with a counterpart that answer to another division than it."""
    r = edges.where(F.col("relation") == "ressort").select(F.col("child").alias("__c"), "parent")
    x = places.where((F.col("hierarchy") == "feudal") & F.col("counterpart_id").isNotNull()).join(r, F.col("id") == F.col("__c")).where(F.col("parent") != F.col("counterpart_id"))
    return issues(x, "warning", "places", "id", F.concat(F.lit("answers to "), F.col("parent"), F.lit(", counterpart "), F.col("counterpart_id")))


def domain_of_another(holdings: DataFrame, owner: str = "duke") -> DataFrame:
    """Domain that another than the owner holds."""
    return issues(holdings.where((F.col("tenure") == "domain") & (F.col("holder") != owner)), "warning", "holdings", "place", F.concat(F.lit("domain held by "), F.col("holder")))


def territory_id_form(places: DataFrame) -> DataFrame:
    """Territories whose id does not begin with their type."""
    return issues(places.where((F.col("kind") == "territory") & ~F.col("id").startswith(F.concat(F.col("place_type"), F.lit("-")))), "warning", "places", "id", "id does not begin with its type")


def member_differences(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(division, only_in, child): members that only one of two counterparts has."""
    own = edges.select("child", "parent").distinct()
    a = pairs.join(own, F.col("division") == F.col("parent")).select("division", "counterpart", "child")
    b = pairs.join(own, F.col("counterpart") == F.col("parent")).select("division", "counterpart", "child")
    keys = ["division", "counterpart", "child"]
    return a.join(b, keys, "left_anti").withColumn("only_in", F.lit("division")).unionAll(b.join(a, keys, "left_anti").withColumn("only_in", F.lit("counterpart")))


def only_in_lists(listed: DataFrame, main: DataFrame, place: str = "place") -> DataFrame:
    """Places of the thematic lists that no main entry names."""
    return listed.select(place).distinct().join(main.select(F.col(place).alias("__p")).distinct(), F.col(place) == F.col("__p"), "left_anti")


def coverage(entries: DataFrame, points: DataFrame) -> DataFrame:
    """One row of counts."""
    a = entries.agg(F.count("*").alias("entries"), F.count_if(F.col("name").isNotNull()).alias("named"), F.count_if(F.col("section") == "domain").alias("domain"))
    b = points.agg(F.count("*").alias("places"), F.count_if(F.col("lat").isNotNull()).alias("located"))
    return a.join(F.broadcast(b))


def validate(rules: list[DataFrame]) -> DataFrame:
    """All issues of several rules."""
    return reduce(DataFrame.unionByName, rules)
