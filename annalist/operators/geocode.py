"""The multi-pass geocoder (K4, B7, B8, C23, C26-C28, D8): one transformation for each pass, what it did as columns.

A result has id, lat, lon, item_id, similarity, km, method, confidence, anchor (the kind the place was found near),
a_lat and a_lon (that anchor), fixed, far_km and notes. Passes read the results of the one before, which are written
out between them, so that no plan holds more than one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions.fuzzy import ratio
from annalist.functions.text import haversine_km
from annalist.operators import spatial
from annalist.operators.lineage import cut

#: The fit of a sure match, of a context's match for long keys, the length of a short key, the least rank of
#: an item that a name alone finds, and the kinds that are too large to say where a member is.
SURE, CONTEXT, SHORT, NAMED_RANK = 0.95, 0.86, 7, 2.5
TOO_LARGE = ("bailiwick", "duchy")
RESULT = ("id", "key", "lat", "lon", "item_id", "similarity", "km", "method", "confidence", "anchor", "a_lat", "a_lon", "fixed", "far_km", "notes")


def has_no_land(method: Column, confidence: Column, far: Column, confirmed: Column) -> Column:
    """Approximate, unlocated or low places, and far ones that nothing confirms, get no land."""
    return method.isin("approximate", "unlocated") | (confidence == "low") | (F.coalesce(far, F.lit(False)) & ~F.coalesce(confirmed, F.lit(False)))


def places_it(rule: str) -> Column:
    """Whether a rule locates its place."""
    return F.col(f"{rule}.lat").isNotNull() | F.col(f"{rule}.item_id").isNotNull() | F.col(f"{rule}.commune").isNotNull()


def locate(asked: DataFrame, seats: DataFrame) -> DataFrame:
    """(id, s_lat, s_lon): of the seats of a key the one nearest (lat, lon), or the first by place where none is given.

    asked: (id, key, lat, lon); seats: (key, lat, lon), several of a key where names repeat.
    """
    s = seats.select(F.col("key").alias("s_key"), F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
    near = asked.join(s, F.col("key") == F.col("s_key"))
    order = F.struct(F.coalesce(haversine_km(F.col("lat"), F.col("lon"), F.col("s_lat"), F.col("s_lon")), F.lit(0.0)), "s_lat", "s_lon")
    return near.groupBy("id").agg(F.min_by(F.struct("s_lat", "s_lon"), order).alias("x")).select("id", "x.s_lat", "x.s_lon")


def anchors(places: DataFrame, seats: DataFrame) -> DataFrame:
    """`places` with anchor, a_lat and a_lon: the commune of the index nearest its canton, else the canton, else nothing."""
    none = F.lit(None).cast("double")
    cantons = locate(places.where("canton IS NOT NULL").select("id", F.col("canton").alias("key"), none.alias("lat"), none.alias("lon")), seats).toDF("c_id", "c_lat", "c_lon")
    x = places.join(cantons, F.col("id") == F.col("c_id"), "left")
    communes = locate(x.where("commune IS NOT NULL").select("id", F.col("commune").alias("key"), F.col("c_lat").alias("lat"), F.col("c_lon").alias("lon")), seats).toDF("m_id", "m_lat", "m_lon")
    x = x.join(communes, F.col("id") == F.col("m_id"), "left")
    kind = F.when(F.col("m_lat").isNotNull(), "commune").when(F.col("c_lat").isNotNull(), "canton")
    return x.withColumn("anchor", kind).withColumn("a_lat", F.coalesce("m_lat", "c_lat")).withColumn("a_lon", F.coalesce("m_lon", "c_lon")).select(*places.columns, "anchor", "a_lat", "a_lon")


def like_names(places: DataFrame, items: DataFrame) -> DataFrame:
    """The like keys of places and items, at the lowest cutoff of the passes; they are the same in each pass."""
    return cut(spatial.alike_keys(places, items, ratio, spatial.NAME_CUTOFF))


def _found(asked: DataFrame, items: DataFrame, alike: DataFrame, radius_km: float, cutoff) -> DataFrame:
    """(f_id, f_item, f_lat, f_lon, f_sim, f_km) of the best item near each (id, lat, lon, key)."""
    best = spatial.best_near(asked.where("lat IS NOT NULL").select("id", "lat", "lon", "key"), items, alike, radius_km, cutoff)
    at = items.select(F.col("id").alias("i_id"), F.col("lat").alias("f_lat"), F.col("lon").alias("f_lon"))
    return best.join(at, F.col("item_id") == F.col("i_id")).select(F.col("place_id").alias("f_id"), F.col("item_id").alias("f_item"), "f_lat", "f_lon", F.col("similarity").alias("f_sim"), F.col("km").alias("f_km"))


def take(results: DataFrame, when: Column, confidence: Column, method: Column | str, note: Column) -> DataFrame:
    """The item found (f_ columns) put in place of what a result has, where `when` holds."""
    method = F.lit(method) if isinstance(method, str) else method
    put = {"lat": F.col("f_lat"), "lon": F.col("f_lon"), "item_id": F.col("f_item"), "similarity": F.col("f_sim"), "km": F.col("f_km"), "method": method, "confidence": confidence, "notes": F.concat("notes", F.array(note))}
    hit = F.coalesce(when, F.lit(False))
    return results.withColumns({k: F.when(hit, v).otherwise(F.col(k)) for k, v in put.items()})


def first_pass(places: DataFrame, items: DataFrame, alike: DataFrame | None = None) -> DataFrame:
    """Places matched near their anchors; else put at their commune, or at the canton they are the seat of; else found by
    an exact name, surely if all items of the name stand in one spot; the rest unlocated.

    places: of `anchors`, (id, key, canton, anchor, a_lat, a_lon).
    """
    alike = like_names(places, items) if alike is None else alike
    near = [_found(places.where(F.col("anchor") == kind).select("id", F.col("a_lat").alias("lat"), F.col("a_lon").alias("lon"), "key"), items, alike, spatial.ANCHOR_KM[kind], spatial.NAME_CUTOFF) for kind in ("commune", "canton")]
    named = places.where("anchor IS NULL").select(F.col("id").alias("n_id"), "key").join(items.where(F.col("rank") >= NAMED_RANK).select("key", F.col("id").alias("n_item"), F.col("lat").alias("n_lat"), F.col("lon").alias("n_lon"), "rank"), "key")
    spot = F.struct(F.round("n_lat", 1), F.round("n_lon", 1))
    named = named.groupBy("n_id").agg(F.max_by(F.struct("n_item", "n_lat", "n_lon"), F.struct("rank", "n_item")).alias("n"), F.count_distinct(spot).alias("spots"))
    x = places.join(near[0].unionAll(near[1]), F.col("id") == F.col("f_id"), "left").join(named, F.col("id") == F.col("n_id"), "left")
    hit, is_seat = F.col("f_id").isNotNull(), (F.col("anchor") == "canton") & (ratio("key", F.coalesce("canton", F.lit(""))) >= 0.85)
    at_anchor = (F.col("anchor") == "commune") | F.coalesce(is_seat, F.lit(False))
    pick = lambda a, b, c: F.when(hit, a).when(at_anchor, b).otherwise(c)
    method = F.when(hit, F.col("anchor")).when(F.col("anchor") == "commune", "approximate").when(at_anchor, "canton").when(F.col("n_id").isNotNull(), "name").otherwise("unlocated")
    confidence = F.when(hit, F.when(F.col("f_sim") >= SURE, "high").otherwise("medium")).when(F.col("anchor") == "commune", "low").when(at_anchor, "medium").when(F.col("spots") == 1, "medium").otherwise("low")
    null = F.lit(None)
    return x.select(
        "id", "key", pick(F.col("f_lat"), F.col("a_lat"), F.col("n.n_lat")).alias("lat"), pick(F.col("f_lon"), F.col("a_lon"), F.col("n.n_lon")).alias("lon"),
        pick(F.col("f_item"), null, F.col("n.n_item")).alias("item_id"), pick(F.col("f_sim"), F.lit(0.0), F.when(F.col("n_id").isNotNull(), 1.0).otherwise(0.0)).alias("similarity"),
        F.coalesce("f_km", F.lit(0.0)).alias("km"), method.alias("method"), confidence.alias("confidence"), "anchor", "a_lat", "a_lon", F.lit(False).alias("fixed"),
        null.cast("double").alias("far_km"), F.array().cast("array<string>").alias("notes"),
    )


def contexts(results: DataFrame, members: DataFrame, skip: tuple[str, ...] = TOO_LARGE) -> DataFrame:
    """(x_id, x_lat, x_lon): where a place's districts say it is: the mean of the upper medians of their other sure members.

    members: (id, district, kind of the district); kinds of `skip` are too large. Only members located better than low count.
    """
    small = members.where(~F.col("kind").isin(*skip)).select("id", "district").distinct()
    sure = small.join(results.where("lat IS NOT NULL AND confidence <> 'low'").select("id", "lat", "lon"), "id")
    own = spatial.centre_without_self(sure, "district")
    # a place that is no sure member itself leaves nothing out
    whole = spatial.centre(sure, "district").select("district", "lat", "lon")
    other = small.join(sure.select("id", "district"), ["id", "district"], "left_anti").join(whole, "district").select("id", "district", "lat", "lon")
    return own.select("id", "district", "lat", "lon").unionByName(other).groupBy("id").agg(F.avg("lat").alias("x_lat"), F.avg("lon").alias("x_lon")).withColumnRenamed("id", "x_id")


def refine(results: DataFrame, items: DataFrame, members: DataFrame, alike: DataFrame | None = None) -> DataFrame:
    """Weak and far results looked for again near their districts' other members.

    Far is over FAR_KM from there. A sure match near the index's commune or canton stays, however far, and says so in
    far_km; any other far result that nothing better is found for becomes low.
    """
    alike = like_names(results, items) if alike is None else alike
    x = results.join(contexts(results, members), F.col("id") == F.col("x_id"), "left").where("x_id IS NOT NULL AND NOT fixed")
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("x_lat"), F.col("x_lon"))
    x = x.withColumn("d", km).withColumn("far", F.col("lat").isNull() | (km > spatial.FAR_KM))
    x = x.where(F.col("far") | (F.col("confidence") == "low") | (F.col("method") == "name"))
    anchored = F.col("method").isin("commune", "canton") & F.col("item_id").isNotNull()
    stays = anchored & (F.col("confidence") == "high")
    cutoff = F.when(F.length("a_key") < SHORT, SURE).otherwise(CONTEXT)
    found = _found(x.where(~stays).select("id", F.col("x_lat").alias("lat"), F.col("x_lon").alias("lon"), "key"), items, alike, spatial.ANCHOR_KM["context"], cutoff)
    y = x.join(found, F.col("id") == F.col("f_id"), "left").withColumn("hit", F.col("f_id").isNotNull()).withColumn("stays", stays)
    moves = F.col("hit") & (F.col("far") | (F.col("method") == "approximate") | ~F.col("f_item").eqNullSafe(F.col("item_id")))
    y = y.withColumn("moves", moves).withColumn("anchored", anchored)
    y = take(y, F.col("moves"), F.when(F.col("f_sim") >= SURE, "medium").otherwise("low"), "context", F.lit("near its district's other members"))
    left = F.col("far") & F.col("d").isNotNull() & ~F.col("hit")
    confidence = F.when(F.col("moves"), F.col("confidence")).when(F.col("hit") & (F.col("confidence") == "low") & (F.col("f_sim") >= SURE), "medium").when(left & ~F.col("anchored"), "low").otherwise(F.col("confidence"))
    y = y.withColumn("confidence", confidence).withColumn("far_km", F.when(left | (F.col("stays") & F.col("far")), F.col("d")))
    return results.join(y.select(F.col("id").alias("y_id")), F.col("id") == F.col("y_id"), "left_anti").unionByName(y.select(*RESULT))


def settle_items(results: DataFrame, places: DataFrame, items: DataFrame, alike: DataFrame | None = None) -> DataFrame:
    """One place for each item (C28): the one fixed, then of best fit, then of best confidence, then the first keeps it.

    Another keeps it too if its name fits as surely, is like the winner's and has the same canton: one village twice. The
    rest look again near their anchors without any item that is taken, else are unlocated.
    """
    alike = like_names(results, items) if alike is None else alike
    order = F.struct(F.col("fixed").cast("int"), "similarity", F.when(F.col("confidence") == "high", 2).when(F.col("confidence") == "medium", 1).otherwise(0), -F.xxhash64("id"))
    held = results.where("item_id IS NOT NULL AND lat IS NOT NULL")
    best = held.groupBy("item_id").agg(F.max_by("id", order).alias("winner"), F.count("*").alias("n")).where("n > 1").withColumnRenamed("item_id", "w_item")
    said = places.select(F.col("id").alias("p_id"), F.col("key").alias("p_key"), "canton")
    x = held.join(best, F.col("item_id") == F.col("w_item")).where("id <> winner AND NOT fixed").join(said, F.col("id") == F.col("p_id"))
    x = x.join(said.select(F.col("p_id").alias("v_id"), F.col("p_key").alias("v_key"), F.col("canton").alias("v_canton")), F.col("winner") == F.col("v_id"))
    twice = (F.col("similarity") >= SURE) & (F.col("canton") == F.col("v_canton")) & (ratio("p_key", "v_key") >= 0.9)
    lost = x.where(~F.coalesce(twice, F.lit(False))).select(*RESULT, "winner")
    taken = held.select("item_id").distinct()
    point = lost.select("id", F.coalesce("a_lat", "lat").alias("lat"), F.coalesce("a_lon", "lon").alias("lon"), "key")
    found = _found(point, items.join(taken, F.col("id") == F.col("item_id"), "left_anti"), alike, spatial.ANCHOR_KM["canton"], spatial.NAME_CUTOFF)
    y = lost.join(found, F.col("id") == F.col("f_id"), "left")
    hit = F.col("f_id").isNotNull()
    note = F.concat(F.lit("its item went to "), F.col("winner").cast("string"))
    y = take(y, F.lit(True), F.when(hit & (F.col("f_sim") >= SURE), "medium").otherwise("low"), F.when(hit, F.coalesce("anchor", F.lit("context"))).otherwise("unlocated"), note)
    y = y.withColumn("similarity", F.coalesce("similarity", F.lit(0.0))).withColumn("km", F.coalesce("km", F.lit(0.0)))
    return results.join(lost.select(F.col("id").alias("l_id")), F.col("id") == F.col("l_id"), "left_anti").unionByName(y.select(*RESULT))


def check_index(results: DataFrame, places: DataFrame, items: DataFrame, seats: DataFrame, members: DataFrame, alike: DataFrame | None = None) -> DataFrame:
    """Last: a place whose commune or canton the index names must lie there.

    Of seats of one name the one nearest the place's districts is meant, unless that is over FAR_KM away; then the one
    nearest the result. A result outside the kind's radius is looked for again near it, else becomes low, with a note.
    """
    alike = like_names(results, items) if alike is None else alike
    told = places.where("commune IS NOT NULL OR canton IS NOT NULL").select(F.col("id").alias("t_id"), F.coalesce("commune", "canton").alias("where_key"), F.when(F.col("commune").isNotNull(), "commune").otherwise("canton").alias("kind"))
    x = results.where("NOT fixed").join(told, F.col("id") == F.col("t_id")).join(contexts(results, members, TOO_LARGE[1:]), F.col("id") == F.col("x_id"), "left")
    s = seats.select(F.col("key").alias("s_key"), F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
    each = x.join(s, F.col("where_key") == F.col("s_key"), "left")
    by_place, by_result = haversine_km(F.col("x_lat"), F.col("x_lon"), F.col("s_lat"), F.col("s_lon")), haversine_km(F.col("lat"), F.col("lon"), F.col("s_lat"), F.col("s_lon"))
    each = each.withColumn("to_context", by_place).withColumn("to_result", by_result)
    spot = F.struct("s_lat", "s_lon", "to_context", "to_result")
    meant = each.groupBy("id").agg(F.min_by(spot, F.struct("to_context", "s_lat", "s_lon")).alias("c"), F.min_by(spot, F.struct("to_result", "s_lat", "s_lon")).alias("r"), F.count("s_lat").alias("n")).withColumnRenamed("id", "m_id")
    pick = F.when((F.col("n") > 1) & (F.col("c.to_context") <= spatial.FAR_KM), F.col("c")).otherwise(F.col("r"))
    x = x.join(meant, F.col("id") == F.col("m_id")).withColumn("seat", pick)
    radius = F.when(F.col("kind") == "commune", spatial.ANCHOR_KM["commune"]).otherwise(spatial.ANCHOR_KM["canton"])
    x = x.where((F.col("n") == 0) | (F.col("lat").isNotNull() & (F.col("seat.to_result") > radius)))
    found = None
    for kind in ("commune", "canton"):
        one = _found(x.where((F.col("n") > 0) & (F.col("kind") == kind)).select("id", F.col("seat.s_lat").alias("lat"), F.col("seat.s_lon").alias("lon"), "key"), items, alike, spatial.ANCHOR_KM[kind], spatial.NAME_CUTOFF)
        found = one if found is None else found.unionAll(one)
    y = x.join(found, F.col("id") == F.col("f_id"), "left").withColumn("hit", F.col("f_id").isNotNull())
    y = take(y, F.col("hit"), F.when(F.col("f_sim") >= SURE, "high").otherwise("medium"), F.col("kind"), F.concat(F.lit("near the index's "), F.col("kind")))
    missing, astray = F.col("n") == 0, ~F.col("hit") & (F.col("n") > 0)
    note = F.when(missing, F.concat(F.lit("the index's "), F.col("kind"), F.lit(" is not found"))).when(astray, F.concat(F.lit("far from the index's "), F.col("kind")))
    y = y.withColumn("confidence", F.when(astray, "low").otherwise(F.col("confidence"))).withColumn("notes", F.when(note.isNotNull(), F.concat("notes", F.array(note))).otherwise(F.col("notes")))
    return results.join(y.select(F.col("id").alias("y_id")), F.col("id") == F.col("y_id"), "left_anti").unionByName(y.select(*RESULT))


def apply_rules(results: DataFrame, rules: DataFrame) -> DataFrame:
    """Reviewed coordinates put over the automatic ones, which later passes leave. rules: (id, lat, lon, confidence)."""
    r = rules.select(F.col("id").alias("r_id"), F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), F.col("confidence").alias("r_conf"))
    out, hit = results.join(r, F.col("id") == F.col("r_id"), "left"), F.col("r_id").isNotNull()
    put = {"lat": "r_lat", "lon": "r_lon", "confidence": "r_conf"}
    return out.withColumns({k: F.when(hit, F.col(v)).otherwise(F.col(k)) for k, v in put.items()} | {"method": F.when(hit, "rule").otherwise(F.col("method")), "fixed": F.col("fixed") | hit}).drop("r_id", *put.values())


def countries(results: DataFrame, items: DataFrame, default: str = "FR") -> DataFrame:
    """(id, country): of a result's own item, else of the nearest item of rank 2.5 or more within 15 km, else the default."""
    own = results.join(items.select(F.col("id").alias("i_id"), F.col("country").alias("own")), F.col("item_id") == F.col("i_id"), "left").select("id", "lat", "lon", "own")
    near = spatial.transfer_nearest(own.where("own IS NULL AND lat IS NOT NULL"), items.where((F.col("rank") >= NAMED_RANK) & F.col("country").isNotNull()), "country")
    return own.join(near, F.col("id") == F.col("a_id"), "left").select("id", F.coalesce("own", "country", F.lit(default)).alias("country"))


def geocode(places: DataFrame, items: DataFrame, seats: DataFrame, members: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """All passes: near the anchors, rules, districts, one place for each item, the index's check, rules again.

    places: (id, key, commune, canton), the last two keys or null; items: (id, key, lat, lon, rank); seats: (key, lat,
    lon); members: (id, district, kind). Keys are loose keys (H19).
    """
    alike = like_names(places, items)
    out = first_pass(anchors(places, seats), items, alike)
    ruled = (lambda df: apply_rules(df, rules)) if rules is not None else (lambda df: df)
    for step in (ruled, lambda df: refine(df, items, members, alike), lambda df: settle_items(df, places, items, alike), lambda df: check_index(df, places, items, seats, members, alike)):
        out = cut(step(out))
    return ruled(out)
