"""Every operator as a query over the generated tables, with the oracle's SQL where SQL can express it.

`QUERIES[name](spark, sf_dir)` gives a DataFrame; `ORACLES[name]` is DuckDB SQL over the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.functions import text
from annalist.operators import aggregate, geocode, graph, match, ordered, parse, reconcile, review, spatial, validate
from annalist.plans import query
from annalist.plans.views import SQL, table, view

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None, views: bool = True):
    def keep(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = (SQL + (", " if oracle.lstrip().startswith("+") else "\n") + oracle.lstrip().lstrip("+")) if views else oracle
        return f

    return keep


def strings(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(rows, ddl)


# --- tables and filters ---------------------------------------------------------------------

_SUBTREE = "+ sub(node) AS (SELECT 'r1' UNION SELECT child FROM edges JOIN sub ON parent = node WHERE relation IN ('admin', 'feudal'))\n"


@register(
    "table_filter_subtree",
    _SUBTREE
    + """, mt AS (SELECT place, min(CASE tenure WHEN 'domain' THEN 1 WHEN 'fief' THEN 2 ELSE 3 END) AS p FROM holdings GROUP BY place)
    SELECT e.no, e.district, e.section, CASE WHEN e.section = 'domain' THEN 'duke' ELSE e.realm END AS holder,
      CASE mt.p WHEN 1 THEN 'domain' WHEN 2 THEN 'fief' WHEN 3 THEN 'clergy' END AS main_tenure
    FROM entries e LEFT JOIN mt ON e.place = mt.place
    WHERE e.district IN (SELECT node FROM sub) AND lower(e.text) LIKE '%order%' AND lower(e.text) LIKE '%urgent%'""",
)
def table_filter_subtree(spark, d):
    entries = view(spark, d, "entries")
    spec = query.QuerySpec(view="table", district="r1", words="order urgent")
    edges = graph_edges_of(spark, d)
    rows = query.filter_entries(entries, spec, edges)
    named = F.when(F.col("section") == "domain", F.array().cast("array<string>")).otherwise(F.array("realm"))
    best = aggregate.main_tenure(view(spark, d, "holdings")).select(F.col("place").alias("p"), F.col("tenure").alias("main_tenure"))
    out = rows.join(best, F.col("place") == F.col("p"), "left")
    return out.select("no", "district", "section", F.get(query.entry_holders(named, F.col("section")), 0).alias("holder"), "main_tenure")


def graph_edges_of(spark, d):
    """Division edges only: entries name divisions, and customers are no districts."""
    return view(spark, d, "edges").where("child NOT LIKE 'c%' AND child NOT LIKE 's%' OR child LIKE 'seg%'")


@register("table_filter_words", "SELECT no, realm FROM entries WHERE series = '1-URGENT' AND section = 'fief' AND lower(text) LIKE '%customer#%' AND lower(concat_ws(' ', text, name)) LIKE '%9%'")
def table_filter_words(spark, d):
    return query.filter_entries(view(spark, d, "entries"), query.QuerySpec(series="1-URGENT", section="fief", words="customer# 9")).select("no", "realm")


@register("direct_members", "SELECT parent, count(DISTINCT child)::BIGINT AS n FROM edges GROUP BY parent")
def direct_members(spark, d):
    return query.direct_members(view(spark, d, "edges"))


@register("holder_overlay", "SELECT place, bool_or(holder <> 'h7') AS shared FROM holdings GROUP BY place HAVING bool_or(holder = 'h7')")
def holder_overlay(spark, d):
    return query.holder_overlay(view(spark, d, "holdings"), "h7")


@register("layer_entries", "SELECT no, series FROM entries WHERE series IN ('1-URGENT', '2-HIGH')")
def layer_entries(spark, d):
    return query.layer_entries(view(spark, d, "entries"), {"first": ("1-URGENT", "2-HIGH")}, "first").select("no", "series")


@register("csv_export", """SELECT no || ',' || CASE WHEN text LIKE '%,%' THEN '"' || text || '"' ELSE text END || ',' || coalesce(name, '') AS line FROM entries""")
def csv_export(spark, d):
    return query.csv_lines(view(spark, d, "entries"), ["no", "text", "name"])


@register("shown_areas", "+ lv AS (SELECT DISTINCT child AS node, 1 AS level FROM edges WHERE parent = 'root' UNION ALL SELECT child, 2 FROM edges WHERE child LIKE 'n%') SELECT node, level FROM lv WHERE level = 2")
def shown_areas(spark, d):
    areas = graph.levels(view(spark, d, "edges").where("relation = 'admin'"), "root").select("node", F.col("level").cast("int").alias("level"), F.lit("admin").alias("hierarchy"), F.lit("division").alias("place_type"))
    return query.shown_areas(areas, "admin", 2).select("node", "level")


# --- checks -----------------------------------------------------------------------------------


@register("fk_anti", "SELECT no, district FROM entries WHERE district NOT IN (SELECT child FROM edges WHERE parent <> 'r2')")
def fk_anti(spark, d):
    return validate.fk_anti(view(spark, d, "entries"), "district", view(spark, d, "edges").where("parent <> 'r2'"), "child").select("no", "district")


@register("vocab_anti", "SELECT no, series FROM entries WHERE series NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def vocab_anti(spark, d):
    return validate.vocab_anti(view(spark, d, "entries"), "series", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select("no", "series")


@register("duplicate_ids", "SELECT place, no AS line, min_no AS first_line FROM (SELECT place, no, min(no) OVER (PARTITION BY place) AS min_no FROM entries) WHERE no > min_no")
def duplicate_ids(spark, d):
    return aggregate.duplicates(view(spark, d, "entries"), "place", "no").select("place", F.col("no").alias("line"), "first_line")


@register("mirrored_membership", "SELECT no, place FROM entries e WHERE NOT EXISTS (SELECT 1 FROM edges g WHERE g.child = e.place AND g.relation = 'admin' AND g.parent = 'n' || (e.no % 25))")
def mirrored_membership(spark, d):
    entries = view(spark, d, "entries").withColumn("claimed", F.concat(F.lit("n"), (F.col("no") % 25).cast("string")))
    return validate.mirrored(entries, view(spark, d, "edges"), "claimed", "admin").select("no", "place")


_PAIRED = "SELECT 's' || s_suppkey AS id, 's' || (CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey + 1 WHEN s_suppkey % 2 = 0 THEN s_suppkey - 1 ELSE s_suppkey + 1 END) AS counterpart_id, CASE WHEN s_suppkey % 2 = 0 THEN 'admin' ELSE 'feudal' END AS hierarchy, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'text' END AS counterpart_basis, 'p' || (s_suppkey // 3) AS seat FROM supplier"


@register(
    "counterpart_check",
    f"+ pl AS ({_PAIRED}) SELECT a.id, CASE WHEN b.id IS NULL THEN 'missing' WHEN b.counterpart_id IS DISTINCT FROM a.id THEN 'not mutual' WHEN a.hierarchy = b.hierarchy THEN 'same hierarchy' WHEN a.counterpart_basis IS NULL THEN 'no basis' ELSE 'other seat' END AS problem FROM pl a LEFT JOIN pl b ON a.counterpart_id = b.id WHERE b.id IS NULL OR b.counterpart_id IS DISTINCT FROM a.id OR a.hierarchy = b.hierarchy OR a.counterpart_basis IS NULL OR a.seat <> b.seat",
)
def counterpart_check(spark, d):
    places = spark.sql(_PAIRED.replace("//", "div").replace("FROM supplier", "FROM {supplier}"), supplier=table(spark, d, "supplier"))
    return validate.counterpart_check(places)


@register("share_overflow", "SELECT place, count(*)::BIGINT AS n_shares FROM holdings GROUP BY place HAVING sum(2520 // den) > 2520")
def share_overflow(spark, d):
    return aggregate.share_overflow(view(spark, d, "holdings"))


@register("missing_numbers", "SELECT u.no FROM (SELECT unnest(generate_series(1, 2487)) AS no) u WHERE u.no NOT IN (SELECT no FROM entries WHERE section = 'fief')")
def missing_numbers(spark, d):
    return ordered.missing_numbers(view(spark, d, "entries").where("section = 'fief'"), "no", 2487)


@register("out_of_sequence", "SELECT conv_id, turn, n, before FROM (SELECT conv_id, turn, length(text)::BIGINT AS n, lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations) WHERE n <= before")
def out_of_sequence(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.length("text").cast("bigint").alias("n"))
    return ordered.out_of_sequence(rows, "conv_id", "n", "turn")


@register(
    "set_difference_members",
    "+ a AS (SELECT DISTINCT 'p' || (o_custkey % 1400) AS child FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT 'p' || (o_custkey % 1400) AS child FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') SELECT 'division' AS only_in, child FROM a WHERE child NOT IN (SELECT child FROM b) UNION ALL SELECT 'counterpart', child FROM b WHERE child NOT IN (SELECT child FROM a)",
)
def set_difference_members(spark, d):
    o = table(spark, d, "orders").withColumn("child", F.concat(F.lit("p"), (F.col("o_custkey") % 1400).cast("string")))
    edges = o.where("o_orderstatus = 'F'").select("child", F.lit("A").alias("parent")).unionAll(o.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").select("child", F.lit("B").alias("parent")))
    return validate.member_differences(edges, strings(spark, [("A", "B")], "division string, counterpart string")).select("only_in", "child")


@register("only_in_lists", "SELECT DISTINCT place FROM entries WHERE series = '5-LOW' AND place NOT IN (SELECT place FROM entries WHERE section = 'domain')")
def only_in_lists(spark, d):
    e = view(spark, d, "entries")
    return validate.only_in_lists(e.where("series = '5-LOW'"), e.where("section = 'domain'"))


@register("number_range", "SELECT 'error' AS level, 'entries' AS \"table\", no::VARCHAR AS row, 'number out of range' AS message FROM entries WHERE no NOT BETWEEN 1 AND 2487")
def number_range(spark, d):
    return validate.number_range(view(spark, d, "entries"), 2487)


@register("coverage", "SELECT (SELECT count(*) FROM entries)::BIGINT AS entries, (SELECT count(name) FROM entries)::BIGINT AS named, (SELECT count(*) FROM entries WHERE section = 'domain')::BIGINT AS domain, (SELECT count(*) FROM points)::BIGINT AS places, (SELECT count(lat) FROM points)::BIGINT AS located")
def coverage(spark, d):
    return validate.coverage(view(spark, d, "entries"), view(spark, d, "points"))


# --- hierarchies ------------------------------------------------------------------------------


@register("closure", "+ sub(node) AS (SELECT child FROM edges WHERE parent = 'r1' AND relation = 'admin' UNION SELECT child FROM edges JOIN sub ON parent = node WHERE relation = 'admin') SELECT node FROM sub")
def closure(spark, d):
    return graph.descendants(view(spark, d, "edges").where("relation = 'admin'"), "r1")


_RING = "SELECT 'k' || o_custkey AS child, 'k' || (CASE WHEN o_custkey % 10 = 9 THEN o_custkey - 9 ELSE o_custkey + 1 END) AS parent FROM (SELECT DISTINCT o_custkey FROM orders)"


@register("cycles", f"+ g AS ({_RING}), up(node, top, n) AS (SELECT child, parent, 1 FROM g UNION SELECT node, parent, n + 1 FROM up JOIN g ON top = child WHERE n < 12) SELECT DISTINCT node FROM up WHERE node = top")
def cycles(spark, d):
    return graph.cycles(spark.sql(_RING.replace("FROM orders", "FROM {orders}"), orders=table(spark, d, "orders")))


@register("unreachable", "+ sub(node) AS (SELECT 'root' UNION SELECT child FROM edges JOIN sub ON parent = node WHERE relation <> 'ressort' AND parent <> 'r3') SELECT DISTINCT child AS node FROM edges WHERE child NOT IN (SELECT node FROM sub)")
def unreachable(spark, d):
    edges = view(spark, d, "edges")
    return graph.unreachable(edges.select(F.col("child").alias("node")).distinct(), edges.where("relation <> 'ressort' AND parent <> 'r3'"), "root")


@register("chains", "SELECT c.child AS node, array_to_string([c.parent, n.parent], '>') AS chain FROM edges c JOIN edges n ON c.parent = n.child AND n.relation = 'admin' WHERE c.relation = 'admin' AND n.parent <> 'root'")
def chains(spark, d):
    admin = view(spark, d, "edges").where("relation = 'admin'")
    nodes = admin.join(admin.where("parent <> 'root'").select(F.col("child").alias("n")), (F.col("parent") == F.col("n")), "left_semi").select(F.col("child").alias("node")).distinct()
    return graph.chains(nodes, admin, "root").select("node", F.array_join("chain", ">").alias("chain"))


@register("levels", "+ lv(node, level) AS (SELECT 'root', 0 UNION ALL SELECT e.child, level + 1 FROM lv JOIN (SELECT DISTINCT child, parent FROM edges WHERE relation = 'admin' AND child NOT LIKE 'c%' AND child NOT LIKE 's%') e ON e.parent = node) SELECT node, level::INTEGER AS level FROM lv WHERE node IN (SELECT parent FROM edges WHERE relation = 'admin')")
def levels(spark, d):
    return graph.levels(view(spark, d, "edges").where("relation = 'admin'"), "root")


@register("top_division", "SELECT n.child AS node, n.parent AS top FROM edges n WHERE n.child LIKE 'n%' AND n.relation = 'admin' UNION ALL SELECT child, child FROM edges WHERE parent = 'root' UNION ALL SELECT c.child, n.parent FROM edges c JOIN edges n ON c.parent = n.child WHERE c.relation = 'admin' AND n.relation = 'admin' AND n.child LIKE 'n%'")
def top_division(spark, d):
    return graph.top_divisions(view(spark, d, "edges").where("relation = 'admin'"), "root")


@register("multi_parent", "SELECT c.child AS node, count(DISTINCT t)::BIGINT AS n FROM edges c JOIN (SELECT child, parent AS t FROM edges WHERE relation IN ('admin', 'ressort') AND (child LIKE 'n%' OR child LIKE 'seg-%')) u ON c.parent = u.child GROUP BY c.child HAVING count(DISTINCT t) > 1")
def multi_parent(spark, d):
    return aggregate.multi_parent(graph.top_divisions(view(spark, d, "edges"), "root"))


@register("shared_lands", "SELECT DISTINCT e.child, 'seg-new' AS parent FROM edges e WHERE e.relation = 'admin' AND e.parent = 'n4' AND e.child NOT IN (SELECT child FROM edges WHERE relation = 'feudal')")
def shared_lands(spark, d):
    return graph.mirror_shared(view(spark, d, "edges"), strings(spark, [("n4", "seg-new")], "division string, counterpart string"), "feudal")


@register("manual_edges", "SELECT child, parent, relation FROM edges UNION ALL SELECT 'x1', 'n1', 'admin'")
def manual_edges(spark, d):
    return graph.manual_edges(view(spark, d, "edges"), strings(spark, [("x1", "n1", "admin"), ("n0", "r0", "admin")], "child string, parent string, relation string"))


# --- aggregates -------------------------------------------------------------------------------


@register("holder_rank", "SELECT holder, n, row_number() OVER (ORDER BY n DESC, holder) AS rank FROM (SELECT holder, count(*)::BIGINT AS n FROM holdings GROUP BY holder)")
def holder_rank(spark, d):
    return aggregate.holder_rank(view(spark, d, "holdings"))


_MAIN = "SELECT place, CASE min(CASE tenure WHEN 'domain' THEN 1 WHEN 'fief' THEN 2 ELSE 3 END) WHEN 1 THEN 'domain' WHEN 2 THEN 'fief' ELSE 'clergy' END AS tenure, count(DISTINCT tenure) AS k FROM holdings GROUP BY place"


@register("main_tenure", f"SELECT place, tenure FROM ({_MAIN})")
def main_tenure(spark, d):
    return aggregate.main_tenure(view(spark, d, "holdings"))


@register("legend_counts", f"SELECT tenure, count(*)::BIGINT AS places, count(*) FILTER (WHERE k > 1)::BIGINT AS mixed FROM ({_MAIN}) GROUP BY tenure")
def legend_counts(spark, d):
    return aggregate.legend_counts(view(spark, d, "holdings"))


@register("tenure_by_holder", "SELECT holder, tenure, count(*)::BIGINT AS n FROM holdings GROUP BY holder, tenure")
def tenure_by_holder(spark, d):
    return query.tenure_by_holder(view(spark, d, "holdings"))


@register("weighted_sum_ramp", "+ t AS (SELECT series, sum(no)::BIGINT AS total FROM entries GROUP BY series) SELECT series, total, round(sqrt(total::DOUBLE / (SELECT greatest(max(total), 1) FROM t)), 6) AS shade FROM t")
def weighted_sum_ramp(spark, d):
    return aggregate.ramp_totals(view(spark, d, "entries"), "series", "no")


@register("dedupe_edges", "SELECT place, tenure, min(via) AS via FROM holdings GROUP BY place, tenure")
def dedupe_edges(spark, d):
    return aggregate.first_wins(view(spark, d, "holdings").select("place", "tenure", "via"), ["place", "tenure"], ["via"])


@register(
    "mode_fill",
    "+ e AS (SELECT no, district, CASE WHEN no % 4 = 0 THEN NULL ELSE series END AS series FROM entries), c AS (SELECT district, series, count(*) AS n, min(no) AS seen FROM e WHERE series IS NOT NULL GROUP BY ALL), m AS (SELECT district, series, row_number() OVER (PARTITION BY district ORDER BY n DESC, seen) AS r FROM c) SELECT e.no, e.district, coalesce(e.series, m.series) AS series FROM e LEFT JOIN m ON e.district = m.district AND m.r = 1",
)
def mode_fill(spark, d):
    e = view(spark, d, "entries").select("no", "district", F.when(F.col("no") % 4 != 0, F.col("series")).alias("series"))
    return aggregate.mode_fill(e, "district", "series", "no")


@register("merge_same_item", "SELECT district AS item, min(no) AS no, array_to_string(list_sort(list(DISTINCT series)), ',') AS series FROM entries GROUP BY district")
def merge_same_item(spark, d):
    out = aggregate.merge_same_item(view(spark, d, "entries").withColumn("item", F.col("district")), "item", "no", "series")
    return out.select("item", "no", F.array_join("series", ",").alias("series"))


@register("nested_compile", "SELECT place, array_to_string(list(no || ':' || section ORDER BY no), ',') AS entries FROM entries GROUP BY place")
def nested_compile(spark, d):
    out = aggregate.nested(view(spark, d, "entries"), "place", ["no"], ["no", "section"], "entries")
    return out.select("place", F.array_join(F.transform("entries", lambda s: F.concat_ws(":", s["no"].cast("string"), s["section"])), ",").alias("entries"))


@register("upper_median_centre", "SELECT nation, round(list_sort(list(lat))[(count(*) // 2 + 1)::BIGINT], 6) AS lat, round(list_sort(list(lon))[(count(*) // 2 + 1)::BIGINT], 6) AS lon, count(*)::BIGINT AS n FROM points GROUP BY nation HAVING count(*) >= 3")
def upper_median_centre(spark, d):
    return spatial.centre(view(spark, d, "points"), "nation").select("nation", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "n")


@register(
    "centre_without_self",
    "+ p AS (SELECT id, nation, lat, lon, count(*) OVER (PARTITION BY nation) AS n FROM points), q AS (SELECT a.id, a.nation, list_sort(list(b.lat)) AS la, list_sort(list(b.lon)) AS lo, count(*) AS k FROM p a JOIN p b ON a.nation = b.nation AND a.id <> b.id WHERE a.n > 3 GROUP BY a.id, a.nation) SELECT id, nation, round(la[(k // 2 + 1)::BIGINT], 6) AS lat, round(lo[(k // 2 + 1)::BIGINT], 6) AS lon FROM q",
)
def centre_without_self(spark, d):
    out = spatial.centre_without_self(view(spark, d, "points"), "nation")
    return out.select("id", "nation", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@register("centroid_label", "SELECT nation, round(CASE WHEN nation % 3 = 0 THEN 48.0 ELSE avg(lat) END, 6) AS lat, round(CASE WHEN nation % 3 = 0 THEN 6.0 ELSE avg(lon) END, 6) AS lon FROM points GROUP BY nation")
def centroid_label(spark, d):
    p = view(spark, d, "points")
    seats = p.where("nation % 3 = 0").select("nation", F.lit(48.0).alias("lat"), F.lit(6.0).alias("lon")).distinct()
    return spatial.label_points(seats, p, "nation").select("nation", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


# --- places -----------------------------------------------------------------------------------

_KM = "2 * 6371 * asin(sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2)))"
_PAIRS = f"+ near AS (SELECT a.id AS a_id, b.id AS b_id, {_KM} AS km FROM points a JOIN points b ON a.id LIKE 's%' AND b.id LIKE 'c%')"


def _two(spark, d):
    p = view(spark, d, "points")
    return p.where("id LIKE 's%'"), p.where("id LIKE 'c%'")


@register("radius_join", _PAIRS + " SELECT a_id, b_id, round(km, 6) AS km FROM near WHERE km <= 12")
def radius_join(spark, d):
    # rounding costs more than a pair, so it is done once for each pair of positions
    near = spatial.near_stacks(*_two(spark, d), 12.0)
    return spatial.unstack(near.withColumn("km", F.round("km", 6))).select("a_id", "b_id", "km")


@register("nearest_k", _PAIRS + " SELECT a_id, b_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY km, b_id) AS rank FROM near WHERE km <= 25) WHERE rank <= 3")
def nearest_k(spark, d):
    return spatial.nearest(*_two(spark, d), 25.0, 3).select("a_id", "b_id", "rank")


@register("knn_country", _PAIRS + " SELECT a_id, nation FROM (SELECT a_id, b_id, row_number() OVER (PARTITION BY a_id ORDER BY km, b_id) AS r FROM near WHERE km <= 15) JOIN points ON b_id = id WHERE r = 1")
def knn_country(spark, d):
    a, b = _two(spark, d)
    return spatial.transfer_nearest(a, b, "nation")


@register("spatial_anti", _PAIRS + " SELECT id FROM points WHERE id LIKE 's%' AND id NOT IN (SELECT a_id FROM near WHERE km <= 0.5)")
def spatial_anti(spark, d):
    return spatial.far_from(*_two(spark, d), 0.5).select("id")


@register("one_per_item", _PAIRS + " SELECT a_id AS place_id, b_id AS item_id, row_number() OVER (PARTITION BY b_id ORDER BY km, a_id) = 1 AS wins FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY km, b_id) AS r FROM near WHERE km <= 25) WHERE r = 1")
def one_per_item(spark, d):
    m = spatial.nearest(*_two(spark, d), 25.0).select(F.col("a_id").alias("place_id"), F.col("b_id").alias("item_id"), "km", F.lit(False).alias("fixed"), F.lit(1.0).alias("similarity"))
    return spatial.one_per_item(m).select("place_id", "item_id", "wins")


@register("zones", "SELECT id FROM points a, (SELECT 48.5 AS lat, 6.2 AS lon) b WHERE " + _KM + " <= 30")
def zones(spark, d):
    z = strings(spark, [(48.5, 6.2, 30.0, None)], "lat double, lon double, radius_km double, country string")
    return spatial.in_zones(view(spark, d, "points").withColumn("country", F.lit("fr")), z).select("id")


@register("voronoi_area")
def voronoi_area(spark, d):
    x, y = text.laea(F.col("lat"), F.col("lon"))
    p = view(spark, d, "points").select("id", x.alias("x"), y.alias("y"), (F.col("nation") % 5 != 0).alias("listed"))
    return spatial.voronoi_cells(p).select("id", F.round("area", 1).alias("area"))


@register("label_point")
def label_point(spark, d):
    x, y = text.laea(F.col("lat"), F.col("lon"))
    p = view(spark, d, "points").select("id", x.alias("x"), y.alias("y"), F.lit(True).alias("listed"))
    return spatial.label_points_of(spatial.voronoi_cells(p))


@register("multi_pass_geocode")
def multi_pass_geocode(spark, d):
    """All points as places: named by their number, with a commune for two in three (a nation's first point of each kind),
    members of their nation's district; items stand near the places, one in ten astray, and some names repeat."""
    p = view(spark, d, "points").withColumn("k", F.regexp_replace("id", "[a-z]", "").cast("bigint"))
    key = lambda n: text.geo_key(F.concat(F.lit("v"), F.translate(n.cast("string"), "0123456789", "abdfghikmn")))
    seat = F.concat(F.lit("seat"), F.translate(F.col("nation").cast("string"), "0123456789", "abdfghikmn"))
    seats = p.groupBy("nation").agg(F.min_by(F.struct("lat", "lon"), "id").alias("x")).select(text.geo_key(seat).alias("key"), "x.lat", "x.lon")
    places = p.select("id", key(F.col("k")).alias("key"), F.when(F.col("k") % 3 > 0, text.geo_key(seat)).alias("commune"), F.lit(None).cast("string").alias("canton"))
    astray = F.when(F.col("k") % 10 == 0, 1.0).otherwise(0.01)
    items = p.select(F.concat(F.lit("q"), "id").alias("id"), (F.col("lat") + astray).alias("lat"), "lon", key(F.col("k") - F.col("k") % 7 % 2).alias("key"), F.lit(3.0).alias("rank"))
    members = p.select("id", F.concat(F.lit("n"), F.col("nation").cast("string")).alias("district"), F.lit("provostship").alias("kind"))
    return geocode.geocode(places, items, seats, members).select("id", "item_id", "method", "confidence", F.round("similarity", 6).alias("similarity"), F.array_join("notes", "; ").alias("notes"))


# --- names and text ---------------------------------------------------------------------------

_LINES = "SELECT doc_id, u.i - 1 AS pos, string_split(text, chr(10))[u.i] AS line FROM documents, LATERAL (SELECT unnest(generate_series(1, len(string_split(text, chr(10))))) AS i) u WHERE text IS NOT NULL"


@register("fold_slug", f"SELECT doc_id, pos, trim(regexp_replace(lower(strip_accents(replace(replace(line, 'œ', 'oe'), 'æ', 'ae'))), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM ({_LINES})", views=False)
def fold_slug(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return lines.select("doc_id", F.col("pos").cast("bigint").alias("pos"), text.slug(F.col("line")).alias("slug"))


@register("name_key", "SELECT p_partkey, translate(regexp_replace(replace(replace(replace(regexp_replace(lower(p_name), '^(la|le|les|l'')\\s+|^l''', ''), 'sainct', 'saint'), 'ssweiller', 'sweiler'), 'weiller', 'weiler'), '[^a-z]', '', 'g'), 'ct', 'el') AS key FROM part", views=False)
def name_key(spark, d):
    return table(spark, d, "part").select("p_partkey", text.name_key(F.col("p_name")).alias("key"))


@register("page_refs", "SELECT s_suppkey, array_to_string(list_concat(generate_series(s_suppkey, s_suppkey + s_suppkey % 4), [900]), ',') AS pages FROM supplier", views=False)
def page_refs(spark, d):
    ref = F.concat(F.col("s_suppkey").cast("string"), F.lit("-"), (F.col("s_suppkey") + F.col("s_suppkey") % 4).cast("string"), F.lit("; 900"))
    return table(spark, d, "supplier").select("s_suppkey", F.array_join(F.transform(text.page_list(ref), lambda x: x.cast("string")), ",").alias("pages"))


_POS = "SELECT n, u.i AS i, n::VARCHAR AS s FROM (SELECT DISTINCT s_suppkey AS n FROM supplier) b, LATERAL (SELECT unnest(generate_series(1, length(n::VARCHAR) + 1)) AS i) u"


@register(
    "digit_variants",
    f"""WITH p AS ({_POS}), c AS (SELECT unnest(['35','14','17','56','68','38','06','09','05']) AS q), cc AS (SELECT q[1] AS a, q[2] AS b FROM c UNION ALL SELECT q[2], q[1] FROM c)
    , v AS (SELECT DISTINCT n, substr(s, 1, i - 1) || b || substr(s, i + 1) AS w FROM p JOIN cc ON substr(s, i, 1) = a)
    SELECT n, count(*)::BIGINT AS k, sum(w::BIGINT)::BIGINT AS total FROM v WHERE w NOT LIKE '0%' AND w::BIGINT <> n GROUP BY n""",
    views=False,
)
def digit_variants(spark, d):
    n = table(spark, d, "supplier").select(F.col("s_suppkey").alias("n")).distinct().select("n", F.explode(text.digit_variants(F.col("n"))).alias("w"))
    return n.groupBy("n").agg(F.count("*").alias("k"), F.sum("w").alias("total"))


@register(
    "digit_neighbours",
    f"""WITH p AS ({_POS}), g AS (SELECT unnest(generate_series(0, 9))::VARCHAR AS g), v AS (
      SELECT DISTINCT n, w FROM (SELECT n, substr(s, 1, i - 1) || g || substr(s, i) AS w FROM p, g UNION ALL SELECT n, substr(s, 1, i - 1) || g || substr(s, i + 1) FROM p, g WHERE i <= length(s) UNION ALL SELECT n, substr(s, 1, i - 1) || substr(s, i + 1) FROM p WHERE i <= length(s)))
    SELECT n, count(*)::BIGINT AS k, sum(w::BIGINT)::BIGINT AS total FROM v WHERE w <> '' AND w NOT LIKE '0%' AND w::BIGINT <> n GROUP BY n""",
    views=False,
)
def digit_neighbours(spark, d):
    n = table(spark, d, "supplier").select(F.col("s_suppkey").alias("n")).distinct().select("n", F.explode(text.digit_neighbours(F.col("n"))).alias("w"))
    return n.groupBy("n").agg(F.count("*").alias("k"), F.sum("w").alias("total"))


@register("continuation_groups", None)
def continuation_groups(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    out = ordered.paragraphs(lines, "doc_id", "pos", "line")
    return out.select("doc_id", "first_line", "n_lines", F.md5(text.dehyphenate(F.col("lines"))).alias("text_md5"))


@register("heading_carry", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS heading FROM conversations", views=False)
def heading_carry(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")).alias("heading"))
    return ordered.carry(rows, "conv_id", "turn", "heading")


@register("gap_fill", "SELECT place, low, high, missing FROM (SELECT place, no AS low, lead(no) OVER (PARTITION BY place ORDER BY no) AS high, lead(no) OVER (PARTITION BY place ORDER BY no) - no - 1 AS missing FROM entries) WHERE missing > 0")
def gap_fill(spark, d):
    return ordered.gaps(view(spark, d, "entries"), "place", "no")


@register("nearest_readable", "SELECT conv_id, turn, last_value(v IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS before_value, first_value(v IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS after_value FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN length(text)::BIGINT END AS v FROM conversations)", views=False)
def nearest_readable(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.length("text").cast("bigint")).alias("v"))
    return ordered.nearest_readable(rows, "conv_id", "turn", "v").drop("v")


@register("prefix_join", "SELECT DISTINCT a.k AS key, b.k AS longer FROM (SELECT regexp_replace(lower(split_part(p_name, ' ', 1)), '[^a-z]', '', 'g') AS k FROM part) a JOIN (SELECT regexp_replace(lower(p_name), '[^a-z]', '', 'g') AS k FROM part) b ON starts_with(b.k, a.k) AND length(b.k) >= length(a.k) + 4 AND length(a.k) >= 4", views=False)
def prefix_join(spark, d):
    p = table(spark, d, "part")
    letters = lambda c: F.regexp_replace(F.lower(c), "[^a-z]", "")
    short = p.select(letters(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("key")).where(F.length("key") >= 4)
    return match.prefix_join(short, p.select(letters(F.col("p_name")).alias("key")))


@register("confused_number_join", "+ c AS (SELECT unnest(['35','14','17','56','68','38','06','09','05']) AS q), cc AS (SELECT q[1] AS a, q[2] AS b FROM c UNION ALL SELECT q[2], q[1] FROM c), n AS (SELECT s_suppkey AS n, u.i AS i, s_suppkey::VARCHAR AS s FROM supplier, LATERAL (SELECT unnest(generate_series(1, length(s_suppkey::VARCHAR))) AS i) u), v AS (SELECT DISTINCT n, (substr(s, 1, i - 1) || b || substr(s, i + 1)) AS w FROM n JOIN cc ON substr(s, i, 1) = a) SELECT n AS no, w::BIGINT AS row_id FROM v WHERE w NOT LIKE '0%' AND w::BIGINT <> n AND w::BIGINT IN (SELECT s_suppkey FROM supplier)")
def confused_number_join(spark, d):
    s = table(spark, d, "supplier")
    out = match.number_pairs(s.select(F.col("s_suppkey").cast("bigint").alias("no")), s.select(F.col("s_suppkey").cast("bigint").alias("row_id"), F.array(F.col("s_suppkey").cast("bigint")).alias("numbers")))
    return out.where("kind = 'confused'").select("no", "row_id")


def _names(spark, d):
    """Numbered names and an index of damaged copies of them, one row in seven with garbled numbers."""
    p = table(spark, d, "part").select(F.col("p_partkey").cast("bigint").alias("no"), F.concat_ws(" ", "p_name", F.translate(F.col("p_partkey").cast("string"), "0123456789", "abdfghikmn")).alias("name"))
    damaged = F.when(F.col("no") % 3 == 0, F.regexp_replace("name", "a", "o")).otherwise(F.translate("name", "el", "ct"))
    shown = F.when(F.col("no") % 5 == 0, F.col("no") + 1).otherwise(F.col("no"))
    index = p.select(F.col("no").alias("row_id"), damaged.alias("name"), F.array(shown).alias("numbers"), (F.col("no") % 7 != 0).alias("numbers_ok"))
    return p, index


def _spelling_sql(name: str) -> str:
    """`text.spelling_key` and `text.coarse` in SQL, for names without articles, old spellings and old endings; runs of up to eight letters."""
    key = f"replace(replace(replace(regexp_replace(lower({name}), '[^a-z]', '', 'g'), 'y', 'i'), 'cq', 'c'), 'ck', 'c')"
    for _ in range(3):
        for c in "abcdefghijklmnopqrstuvwxyz":
            key = f"replace({key}, '{c}{c}', '{c}')"
    return f"regexp_replace({key}, '[sxz]$', '')"


def _coarse_sql(key: str) -> str:
    for a, b in text.COARSE_GROUPS:
        key = f"replace({key}, '{a}', '{b}')"
    return f"translate({key}, '{text.COARSE_FROM}', '{text.COARSE_TO}')"


_NAMES_SQL = "p AS (SELECT p_partkey AS no, p_name || ' ' || translate(p_partkey::VARCHAR, '0123456789', 'abdfghikmn') AS name FROM part), x AS (SELECT CASE WHEN no % 3 = 0 THEN replace(name, 'a', 'o') ELSE translate(name, 'el', 'ct') END AS name FROM p)"
_PAIRS_OF = "SELECT DISTINCT k, substr(c, u.i, 2) AS g FROM {t}, LATERAL (SELECT unnest(generate_series(1, length(c) - 1)) AS i) u"


@register(
    "qgram_candidates",
    f"WITH {_NAMES_SQL}, qk AS (SELECT DISTINCT {_spelling_sql('name')} AS k FROM p), kk AS (SELECT DISTINCT {_spelling_sql('name')} AS k FROM x), q AS (SELECT k, {_coarse_sql('k')} AS c FROM qk), y AS (SELECT k, {_coarse_sql('k')} AS c FROM kk), qg AS ({_PAIRS_OF.format(t='q')}), yg AS ({_PAIRS_OF.format(t='y')}), need AS (SELECT k, greatest(1, floor(0.4 * count(*))) AS need FROM qg GROUP BY k) SELECT qg.k AS q, yg.k AS key, count(*)::BIGINT AS n FROM qg JOIN yg ON qg.g = yg.g JOIN need ON need.k = qg.k GROUP BY qg.k, yg.k, need HAVING count(*) >= need",
    views=False,
)
def qgram_candidates(spark, d):
    p, index = _names(spark, d)
    return match.qgram_candidates(p.select(text.spelling_key(F.col("name")).alias("q")), index.select(text.spelling_key(F.col("name")).alias("key")))


@register("match_ladder")
def match_ladder(spark, d):
    p, index = _names(spark, d)
    return match.match_ladder(p, index).select("no", "row_id", "how", F.round("sim", 6).alias("sim"), "confidence")


@register("fuzzy_best_name")
def fuzzy_best_name(spark, d):
    p, index = _names(spark, d)
    pairs = match.similarity(match.name_pairs(p, index).join(p.select("no", F.col("name").alias("a")), "no").join(index.select("row_id", F.col("name").alias("b")), "row_id"), "a", "b")
    return pairs.where("sim >= 0.9").groupBy("no").agg(F.max_by("row_id", F.struct("sim", (-F.col("row_id")).alias("r"))).alias("row_id"), F.round(F.max("sim"), 6).alias("sim"))


@register("twins")
def twins(spark, d):
    p, index = _names(spark, d)
    return match.twins(p.select(F.col("no").alias("id"), "name"), index.select(F.col("row_id").alias("id"), "name"))


@register("reconcile")
def reconcile_numbers(spark, d):
    p, index = _names(spark, d)
    return reconcile.resolve_numbers(index.select("row_id", "name", "numbers"), p)


@register("ocr_search")
def ocr_search(spark, d):
    p, _ = _names(spark, d)
    places = p.select(F.col("no").alias("place_id"), F.col("name").alias("label"), F.lit(48.5).alias("lat"), F.lit(6.0).alias("lon"), F.lit(False).alias("is_land"))
    asked = p.where("no % 100 = 0").select(F.translate("name", "cl", "et").alias("q"), F.lit(48.6).alias("lat"), F.lit(6.1).alias("lon"))
    return match.search(asked, places).select("q", "place_id", F.round("score", 6).alias("score"), "rank")


@register("beam_numbering")
def beam_numbering(spark, d):
    c = table(spark, d, "conversations")
    tok = F.when(F.col("turn") % 5 == 3, F.lit("Et")).otherwise(F.translate((F.col("turn") + 1).cast("string"), "15", "l3"))
    return parse.number_lines(c.select("conv_id", "turn", tok.alias("token")), "conv_id", "turn", "token", 40)


# --- reviews ----------------------------------------------------------------------------------


@register("point_pick", "SELECT id AS pid, CASE WHEN lon > 6.0005 AND lon < 6.5005 AND lat > 48.2005 AND lat < 48.8005 THEN 'small' ELSE 'big' END AS area FROM points WHERE lon > 5.5005 AND lon < 7.5005 AND lat > 48.0005 AND lat < 49.5005")
def point_pick(spark, d):
    box = lambda w, s, e, n: [[w, s], [e, s], [e, n], [w, n]]
    areas = strings(spark, [("big", 9, box(5.5005, 48.0005, 7.5005, 49.5005)), ("small", 2, box(6.0005, 48.2005, 6.5005, 48.8005))], "area string, settlements int, ring array<array<double>>")
    return review.pick(view(spark, d, "points").select(F.col("id").alias("pid"), F.col("lon").alias("x"), F.col("lat").alias("y")), areas, 0.5)


@register("canonical_spellings")
def canonical_spellings(spark, d):
    p, index = _names(spark, d)
    own = p.select("name", F.lit(2).alias("weight"))
    return review.canonical_spellings(own.unionAll(index.select("name", F.lit(1).alias("weight"))))


@register("page_lookup")
def page_lookup(spark, d):
    p, index = _names(spark, d)
    page = lambda c: (F.col(c) % 90 + 10).cast("string").alias("page")
    return review.find_on_pages(p.select(F.col("no").alias("qid"), page("no"), "name"), index.select("row_id", page("row_id"), "name")).select("qid", "row_id", F.round("ratio", 6).alias("ratio"))
