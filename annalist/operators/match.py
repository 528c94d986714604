"""Resolving records to an index by number and name.

Candidates come from equi joins (numbers, number variants, key blocks); names are scored once per distinct pair; the
ladder of preferences is one conditional aggregation per record.
"""

from __future__ import annotations

from math import comb, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.functions import text
from annalist.functions.fuzzy import ocr_similarity, ratio
from annalist.operators.lineage import cores, spread
from annalist.operators.nearest import like_keys


def number_pairs(entries: DataFrame, index: DataFrame) -> DataFrame:
    """(no, row_id, kind): index rows with the entry's number, or with one confusable digit of it.

    entries: (no, name); index: (row_id, name, numbers array).
    """
    numbers = index.select("row_id", F.explode("numbers").alias("n"))
    exact = entries.join(numbers.hint("merge"), entries.no == numbers.n).select("no", "row_id", F.lit("exact").alias("kind"))
    variants = entries.select("no", F.explode(text.digit_variants(F.col("no"))).alias("v"))
    confused = variants.join(numbers.hint("merge"), variants.v == numbers.n).select("no", "row_id", F.lit("confused").alias("kind"))
    return exact.unionAll(confused.join(exact.select("no", "row_id").hint("merge"), ["no", "row_id"], "left_anti")).distinct()


def loose_pairs(entries: DataFrame, index: DataFrame, old_forms: DataFrame | None = None, cutoff: float = 0.82) -> DataFrame:
    """(no, row_id, "loose"): rows with a number that reads as the entry's at a cost of 1.0, or with garbled numbers.

    A pair may come more than once. The numbers that read so are listed and joined by value. Garbled rows (numbers_ok false) are compared with all
    entries by name, through `named_pairs` at `cutoff`.
    """
    numbers = index.select("row_id", F.explode("numbers").alias("n"))
    near = spread(entries.select("no"), "no").select("no", F.explode(text.loose_numbers(F.col("no"))).alias("v"))
    rows = near.join(numbers.hint("merge"), near.v == numbers.n).select("no", "row_id")
    garbled = named_pairs(entries, index.where(~F.col("numbers_ok")), cutoff, old_forms)
    return rows.unionAll(garbled).withColumn("kind", F.lit("loose"))


def named_pairs(entries: DataFrame, index: DataFrame, cutoff: float, old_forms: DataFrame | None = None) -> DataFrame:
    """(no, row_id): all pairs whose `similarity`, raised by `bridge` if there are old forms, can reach `cutoff`, and some others."""
    a = entries.select("no", text.name_key(F.col("name")).alias("q"))
    keys = F.array_distinct(F.array(text.name_key(F.col("name")), text.name_key(text.base_name(F.col("name")))))
    b = index.select("row_id", F.explode(keys).alias("key"))
    out = a.join(ratio_pairs(a, b, cutoff).hint("merge"), "q").join(b.hint("merge"), "key").select("no", "row_id")
    if old_forms is not None:
        forms = _forms(old_forms)
        led = a.join(forms, a.q == forms.ok).select("no", "mk")
        near = ratio_pairs(forms.select(F.col("mk").alias("q")), b, 0.85)
        out = out.unionAll(led.join(near, led.mk == near.q).join(b, "key").select("no", "row_id"))
    return out.distinct()


def name_pairs(entries: DataFrame, index: DataFrame, cutoff: float = 0.9, old_forms: DataFrame | None = None) -> DataFrame:
    """(no, row_id, "name"): rows whose name can reach a similarity of `cutoff` (C6), for entry keys of 5 letters or more."""
    long = entries.where(F.length(text.name_key(F.col("name"))) >= 5)
    return named_pairs(long, index, cutoff, old_forms).withColumn("kind", F.lit("name"))


def _forms(old_forms: DataFrame) -> DataFrame:
    """(ok, mk): the keys of old forms and of the modern names they lead to."""
    return old_forms.select(text.name_key(F.col("old")).alias("ok"), text.name_key(F.regexp_replace("modern", r"\(.*?\)", "")).alias("mk")).distinct()


def name_keys(name: Column) -> list[Column]:
    """The keys that H3 compares: of the name (nk) and of its base name (bk)."""
    return [text.name_key(name).alias("nk"), text.name_key(text.base_name(name)).alias("bk")]


def can_reach(a: Column, b: Column, cutoff: float) -> Column:
    """Whether two keys can have a ratio of `cutoff`: it leaves (1 - cutoff) of the letters unmatched at most, and so as many edits."""
    return F.levenshtein(a, b) <= F.floor((1 - cutoff) * (F.length(a) + F.length(b)) + 1e-9)


def similarity(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """`pairs` with `sim`: the better ratio of a's key with the key of b or of b's base name (H3).

    Keys are made once for each name, ratios once for each pair of keys.
    """
    own = pairs.select(a).distinct().select(a, text.name_key(F.col(a)).alias("ak"))
    other = pairs.select(b).distinct().select(b, *name_keys(F.col(b)))
    names = spread(pairs.select(a, b).distinct().join(own.hint("merge"), a).join(other.hint("merge"), b), a, b)
    scored = names.withColumn("sim", F.greatest(ratio("ak", "nk"), ratio("ak", "bk")))
    return pairs.join(scored.select(a, b, "sim").hint("merge"), [a, b])


def bridge(pairs: DataFrame, old_forms: DataFrame, entry_name: str, row_name: str) -> DataFrame:
    """`sim` raised to 0.95 where a table of old forms leads from the entry's key to one like the row's."""
    forms = _forms(old_forms)
    own = pairs.withColumn("pid", F.xxhash64(entry_name, row_name))
    hit = own.select(entry_name, row_name, "pid").distinct().join(forms, text.name_key(F.col(entry_name)) == F.col("ok")).where(ratio("mk", text.name_key(F.col(row_name))) > 0.85).select("pid").distinct().withColumn("hit", F.lit(True))
    return own.join(hit, "pid", "left").withColumn("sim", F.when(F.col("hit"), F.greatest("sim", F.lit(0.95))).otherwise(F.col("sim"))).drop("pid", "hit")


def match_ladder(entries: DataFrame, index: DataFrame, old_forms: DataFrame | None = None) -> DataFrame:
    """(no, row_id, how, sim, confidence): the index row of every entry by the ladder of preferences.

    index: (row_id, name, numbers, numbers_ok). Ties go to the smaller row_id.
    """
    pairs = number_pairs(entries, index).unionAll(loose_pairs(entries, index, old_forms=old_forms)).unionAll(name_pairs(entries, index, old_forms=old_forms))
    own = entries.select("no", F.col("name").alias("entry_name"), text.name_key(F.col("name")).alias("ak"))
    named = pairs.join(own.hint("merge"), "no").join(index.select("row_id", F.col("name").alias("row_name"), *name_keys(F.col("name"))).hint("merge"), "row_id")
    # of other kinds than exact numbers only names that reach a step of the ladder count; a name that an old form leads
    # from may do so by the bridge
    least = lambda c: can_reach(F.col("ak"), F.col("nk"), c) | can_reach(F.col("ak"), F.col("bk"), c)
    sieve = F.when(F.col("kind") == "exact", True).when(F.col("kind") == "confused", least(0.75)).when(F.col("kind") == "loose", least(0.82)).otherwise(least(0.9))
    if old_forms is not None:
        led = _forms(old_forms).select(F.col("ok"), F.lit(True).alias("led")).distinct()
        named = named.join(led, F.col("ak") == F.col("ok"), "left")
        sieve = sieve | F.coalesce("led", F.lit(False))
    named = named.where(sieve).withColumn("sim", F.greatest(ratio("ak", "nk"), ratio("ak", "bk"))).select("no", "row_id", "kind", "entry_name", "row_name", "sim")
    if old_forms is not None:
        named = bridge(named, old_forms, "entry_name", "row_name")
    best = lambda kind: F.max(F.when(F.col("kind") == kind, F.struct(F.col("sim").alias("s"), (-F.col("row_id")).alias("r"))))
    top = named.groupBy("no").agg(best("exact").alias("e"), F.count_if(F.col("kind") == "exact").alias("n"), best("confused").alias("c"), best("loose").alias("l"), best("name").alias("m"))
    e, c, loose, m = (F.coalesce(F.col(f"{k}.s"), F.lit(-9.0)) for k in "eclm")
    has_e = F.col("e").isNotNull()
    steps = [
        ((c >= 0.75) & (~has_e | (c >= e + 0.3)), "c", "confused number", "medium"),
        (has_e & (e < 0.4) & (m >= 0.9), "m", "name", "medium"),
        (e >= 0.5, "e", "number+name", "high"),
        ((F.col("n") == 1) & (e >= 0.25), "e", "number", "medium"),
        (c >= 0.8, "c", "confused number", "medium"),
        (loose >= 0.82, "l", "loose number", "medium"),
        (m >= 0.9, "m", "name", "low"),
    ]
    pick = None
    for test, k, how, conf in steps:
        x = F.struct((-F.col(f"{k}.r")).alias("row_id"), F.lit(how).alias("how"), F.col(f"{k}.s").alias("sim"), F.lit(conf).alias("confidence"))
        pick = F.when(test, x) if pick is None else pick.when(test, x)
    none = F.struct(F.lit(None).cast("bigint").alias("row_id"), F.lit("none").alias("how"), F.lit(0.0).alias("sim"), F.lit("low").alias("confidence"))
    chosen = top.select("no", pick.otherwise(none).alias("x"))
    return entries.select("no").join(chosen, "no", "left").select("no", F.coalesce("x", none).alias("x")).select("no", "x.*")


#: Strings that a key may give by leaving out letters, at each number of letters, and the most letters left out.
VARIANTS, MOST_LEFT_OUT = 500, 4


def _matching(a: Column, b: Column, cutoff: float) -> Column:
    """The letters that keys of lengths a and b must match for a ratio of `cutoff`."""
    return F.ceil((a + b) * (cutoff / 2) - 1e-9).cast("int")


def _shortest(n: Column, cutoff: float) -> Column:
    """The least length of a key that can reach `cutoff` with one of length n."""
    return F.ceil(n * (cutoff / (2 - cutoff)) - 1e-9).cast("int")


def _affordable(n: Column) -> Column:
    """How many letters of a key of length n may be left out within VARIANTS strings."""
    most = [max(k for k in range(min(MOST_LEFT_OUT, m) + 1) if all(comb(m, i) <= VARIANTS for i in range(k + 1))) for m in range(256)]
    return F.coalesce(F.get(F.array(*map(F.lit, most)), n), F.lit(0))


def shortened(key: Column, most: Column) -> Column:
    """The different strings that a key gives by leaving out 0 to `most` (MOST_LEFT_OUT at most) letters: array<struct<s, k>>.

    Letters are left out from left to right, so each choice of places is made once.
    """
    state = "array<struct<s:string,at:int>>"

    def step(level: Column) -> Column:
        cut = lambda x, i: F.struct(F.concat(F.substring(x["s"], F.lit(1), i - 1), F.substr(x["s"], i + 1)).alias("s"), i.alias("at"))
        places = lambda x: F.when(F.length(x["s"]) >= x["at"], F.sequence(x["at"], F.length(x["s"]))).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(level, lambda x: F.transform(places(x), lambda i: cut(x, i)))).cast(state)

    def down(level: Column, k: int) -> Column:
        own = F.transform(F.array_distinct(F.transform(level, lambda x: x["s"])), lambda s: F.struct(s.alias("s"), F.lit(k).alias("k")))
        if k == MOST_LEFT_OUT:
            return own
        return F.concat(own, F.when(most > k, text.let(step(level), lambda nxt: down(nxt, k + 1))).otherwise(F.array().cast("array<struct<s:string,k:int>>")))

    return down(F.array(F.struct(key.alias("s"), F.lit(1).alias("at"))).cast(state), 0)


def ratio_pairs(queries: DataFrame, keys: DataFrame, cutoff: float) -> DataFrame:
    """(q, key): all pairs whose ratio can reach `cutoff`, 0.8 or more, and some others.

    A ratio of c over T letters needs M = ceil(c T / 2) matching ones, in the same order in both keys, so both give one
    string of M letters by leaving others out. Where the lengths of a pair allow few such strings, pairs meet in a join
    on them, whose output follows the result. Other pairs (long keys, low cutoffs) meet by length and by letter pairs: in
    T - 2 M + 1 runs at most, M letters keep 3 M - T - 1 pairs (one at least for T of 10 or more, and shorter pairs never
    come here), so at most 4 (1 - c) / (2 - c) a letter of q's are lost,
    and one more than that, the rarest, lead to every such key. At the end the edit distance, T - 2 M at most, sieves.
    """
    if cutoff < 0.8:
        raise ValueError("below 0.8, two keys need not share a pair of letters")
    a = spread(queries.select("q").where("q <> ''").distinct(), "q")
    b = spread(keys.select("key").where("key <> ''").distinct(), "key")
    n, m = F.length("q"), F.length("key")
    met = a.join(b, a.q == b.key).select("q", "key")
    # by strings with letters left out
    left_out = lambda c: F.least(F.length(c) - _matching(F.length(c), _shortest(F.length(c), cutoff), cutoff), _affordable(F.length(c)))
    cut = lambda df, c: df.select(c, F.explode_outer(shortened(F.col(c), left_out(c))).alias("x")).select(c, F.xxhash64("x.s").alias(f"{c}_h"), F.col("x.k").alias(f"{c}_k"))
    need = _matching(n, m, cutoff)
    # both sides grow in an explode that Spark's sizes leave out: shuffled, or the driver would gather one to broadcast it
    close = cut(a, "q").join(cut(b, "key").hint("merge"), F.col("q_h") == F.col("key_h")).where((n - F.col("q_k") == need) & (m - F.col("key_k") == need)).select("q", "key")
    met = met.unionAll(close)
    # by letter pairs, where either key of two such lengths gives too many strings
    many = lambda x, y: (x - _matching(x, y, cutoff) > _affordable(x)) | (y - _matching(x, y, cutoff) > _affordable(y))
    lengths = F.filter(F.sequence(_shortest(n, cutoff), F.floor(n * ((2 - cutoff) / cutoff) + 1e-9).cast("int")), lambda y: many(n, y))
    right = b.select("key", m.alias("length"), F.explode(text.bigrams(F.col("key"))).alias("g"))
    often = right.groupBy("g").agg(F.count("*").alias("often"))
    lost = F.floor(n * (4 * (1 - cutoff) / (2 - cutoff)) + 1e-9).cast("int")
    left = a.where(F.size(lengths) > 0).select("q", F.explode(text.bigrams(F.col("q"))).alias("g")).join(often, "g", "left")
    left = left.groupBy("q").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("n"), "g"))).alias("gs"))
    left = left.select("q", F.explode(F.slice("gs", F.lit(1), lost + 1)).alias("x"), lengths.alias("lengths")).select("q", "x.g", F.explode("lengths").alias("length"))
    sieved = left.join(right.hint("merge"), ["g", "length"]).select("q", "key")
    shared = F.size(F.array_intersect(text.bigrams(F.col("q")), text.bigrams(F.col("key"))))
    sieved = sieved.where(shared >= F.size(text.bigrams(F.col("q"))) - (n + n + m - 3 * need))
    met = met.unionAll(sieved)
    return met.where(F.levenshtein("q", "key") <= n + m - 2 * need).distinct()


def closest(queries: DataFrame, keys: DataFrame, cutoff: float, k: int = 1, block: int = 2) -> DataFrame:
    """(q, key, ratio, rank): the k closest keys of each query key, exact ones first.

    Only keys of the same first `block` letters are compared; with 0 all are, through `ratio_pairs`.
    """
    if block:
        a = queries.select(F.col("q")).distinct().withColumn("b", F.substring("q", 1, block))
        b = keys.select(F.col("key")).distinct().withColumn("b", F.substring("key", 1, block))
        pairs = a.join(b, "b").where(F.abs(F.length("q") - F.length("key")) <= (1 - cutoff) * (F.length("q") + F.length("key")))
    else:
        pairs = ratio_pairs(queries, keys, cutoff)
    scored = pairs.withColumn("ratio", F.when(F.col("q") == F.col("key"), 1.0).otherwise(ratio("key", "q"))).where(F.col("ratio") >= cutoff)
    w = Window.partitionBy("q").orderBy(F.desc("ratio"), F.desc("key"))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("q", "key", "ratio", "rank")


def prefix_join(short: DataFrame, long: DataFrame, extra: int = 4) -> DataFrame:
    """(key, longer): keys that begin with another one and are `extra` letters longer or more (C25), blocked by four letters."""
    a = short.select("key").distinct().withColumn("b", F.substring("key", 1, 4))
    b = long.select(F.col("key").alias("longer")).distinct().withColumn("b", F.substring("longer", 1, 4))
    return a.join(b, "b").where(F.col("longer").startswith(F.col("key")) & (F.length("longer") >= F.length("key") + extra)).select("key", "longer")


#: The letters that a coarse key may have, the words of bits that hold a set of their pairs, and the names in one row of a class.
COARSE_LETTERS = "".join(sorted(set("abcdefghijklmnopqrstuvwxyz".translate(str.maketrans(text.COARSE_FROM, text.COARSE_TO)))))
WORDS, TOGETHER = (len(COARSE_LETTERS) ** 2 + 63) // 64, 256


def _pair_classes(names: DataFrame, c: str) -> DataFrame:
    """(w0, w1 ..., rest, size, names): the names of each set of coarse letter pairs, as bits; rest: pairs of other signs."""
    letter = lambda p, i: F.instr(F.lit(COARSE_LETTERS), F.substring(p, i, 1)) - 1
    known = lambda p: (letter(p, 1) >= 0) & (letter(p, 2) >= 0)
    place = lambda p: letter(p, 1) * len(COARSE_LETTERS) + letter(p, 2)
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("bigint"), place(p) % 64)
    word = lambda k: F.aggregate(F.filter("pairs", lambda p: known(p) & (F.floor(place(p) / 64) == k)), F.lit(0).cast("bigint"), lambda acc, p: acc.bitwiseOR(bit(p)))
    words = [f"w{k}" for k in range(WORDS)]
    sets = names.select(F.col(c).alias("name")).distinct().withColumn("pairs", F.array_sort(text.bigrams(text.coarse(F.col("name")))))
    sets = sets.where(F.size("pairs") > 0).select("name", F.size("pairs").alias("size"), F.filter("pairs", lambda p: ~known(p)).alias("rest"), *[word(k).alias(w) for k, w in enumerate(words)])
    row = F.row_number().over(Window.partitionBy(*words, "rest").orderBy("name"))
    return sets.withColumn("part", F.floor(row / TOGETHER)).groupBy(*words, "rest", "size", "part").agg(F.collect_list("name").alias("names")).drop("part")


def qgram_candidates(queries: DataFrame, keys: DataFrame, share: float = 0.4) -> DataFrame:
    """(q, key, n): keys sharing at least `share` of a query's coarse letter pairs, one at least (C30, first sieve).

    Sets of letter pairs are compared, each with each, as bits, in blocks that are shuffled and may spill; names of one set
    are put out together. The output itself may grow with the square of the names.
    """
    blocks = max(2, isqrt(4 * cores(queries)))
    deal = lambda df: df.repartition(blocks, F.xxhash64("w0", "w1", "rest"))
    a, b = (deal(_pair_classes(df, c)).select(*[F.col(x).alias(f"{side}_{x}") for x in (*(f"w{k}" for k in range(WORDS)), "rest", "size", "names")]) for df, c, side in ((queries, "q", "q"), (keys, "key", "k")))
    n = sum((F.bit_count(F.col(f"q_w{k}").bitwiseAND(F.col(f"k_w{k}"))) for k in range(WORDS)), F.lit(0)) + F.when((F.size("q_rest") > 0) & (F.size("k_rest") > 0), F.size(F.array_intersect("q_rest", "k_rest"))).otherwise(0)
    met = a.join(b.hint("shuffle_replicate_nl"), n >= F.greatest(F.lit(1), F.floor(share * F.col("q_size"))))
    each = met.select("q_names", "k_names", n.cast("bigint").alias("n")).select("q_names", F.explode("k_names").alias("key"), "n")
    return each.select(F.explode("q_names").alias("q"), "key", "n")


def search(queries: DataFrame, places: DataFrame, limit: int = 5) -> DataFrame:
    """(q, place_id, score, rank): ranked dictionary search (C30). queries: (q, lat, lon); places: (place_id, label, lat, lon, is_land)."""
    labels = places.withColumn("key", text.spelling_key(F.regexp_replace("label", r"\s*\(.*?\)", ""))).where(F.length("key") >= 3)
    asked = queries.withColumn("k", text.spelling_key(F.col("q"))).where("k <> ''")
    of = lambda df, x, c: df.select(x).distinct().withColumn(c, text.coarse(F.col(x)))
    own, other = of(asked, "k", "qc"), of(labels, "key", "kc")
    # coarse keys are compared once for all the keys that give them
    like = like_keys(own.select(F.col("qc").alias("q")).distinct(), other.select(F.col("kc").alias("key")).distinct(), 0.7, 0.4).toDF("qc", "kc")
    cand = spread(like.join(own.hint("merge"), "qc").join(other.hint("merge"), "kc").select("k", "key"), "k", "key")
    cand = cand.withColumn("s", ocr_similarity("k", "key")).where("s >= 0.6")
    hits = asked.join(cand.hint("merge"), "k").join(labels.select("key", "place_id", "label", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), "is_land").hint("merge"), "key")
    km = text.haversine_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon"))
    score = F.col("s") - F.coalesce(F.least(km, F.lit(150.0)) / 500, F.lit(0.05)) - F.when(F.col("is_land") | F.col("label").contains("("), 0.08).otherwise(0.0)
    best = hits.withColumn("score", score).groupBy("q", "place_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("q").orderBy(F.desc("score"), "place_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def place_ids(rows: DataFrame, name: str, order: str) -> DataFrame:
    """`place_id`: slug of the name, with -2, -3 ... for later rows of one slug."""
    w = Window.partitionBy("base").orderBy(order)
    n = F.row_number().over(w)
    return rows.withColumn("base", text.slug(F.col(name))).withColumn("n", n).withColumn("place_id", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", "n"))).drop("base", "n")


def rekey(rows: DataFrame, renames: DataFrame, column: str) -> DataFrame:
    """`column` with renamed ids put in place (C18); renames: (old, new)."""
    r = renames.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
    return rows.join(r, F.col(column) == F.col("__old"), "left").withColumn(column, F.coalesce("__new", column)).drop("__old", "__new")


def override(rows: DataFrame, decisions: DataFrame, key: str, column: str) -> DataFrame:
    """`column` replaced by decisions (key, was, now); a decision whose `was` is not what stands there is an error."""
    d = decisions.select(F.col(key).alias("__k"), "was", "now")
    out = rows.join(d, F.col(key) == F.col("__k"), "left")
    wrong = F.col("__k").isNotNull() & ~F.col("was").eqNullSafe(F.col(column))
    value = F.when(wrong, F.raise_error(F.concat(F.lit("stale decision for "), F.col("__k").cast("string")))).when(F.col("__k").isNotNull(), F.col("now")).otherwise(F.col(column))
    return out.withColumn(column, value).drop("__k", "was", "now")


def replace_in_order(rows: DataFrame, rules: DataFrame, key: str, column: str) -> DataFrame:
    """Substring replacements (key, ord, needle, put) applied to `column` in order (C14)."""
    r = rules.groupBy(F.col(key).alias("__k")).agg(F.array_sort(F.collect_list(F.struct("ord", "needle", "put"))).alias("rules"))
    fixed = F.aggregate("rules", F.col(column), lambda acc, x: F.replace(acc, x["needle"], x["put"]))
    return rows.join(r, F.col(key) == F.col("__k"), "left").withColumn(column, F.coalesce(fixed, column)).drop("__k", "rules")


def split_rows(rows: DataFrame, splits: DataFrame, key: str, column: str) -> DataFrame:
    """Rows that a table (key, parts array) splits become one row per part."""
    s = splits.select(F.col(key).alias("__k"), "parts")
    out = rows.join(s, F.col(key) == F.col("__k"), "left")
    return out.withColumn(column, F.explode(F.coalesce("parts", F.array(column)))).drop("__k", "parts")


def twins(listed: DataFrame, main: DataFrame, cutoff: float = 0.88) -> DataFrame:
    """(list_id, main_id): entries of the lists and their main entry, by equal key, else by the closest of all (C9). Both: (id, name)."""
    a = listed.select(F.col("id").alias("list_id"), text.name_key(F.col("name")).alias("q")).where("q <> ''")
    b = main.groupBy(text.name_key(F.col("name")).alias("key")).agg(F.min("id").alias("main_id")).where("key <> ''")
    near = closest(a, b, cutoff, block=0).select("q", "key")
    return a.join(near.hint("merge"), "q").join(b.hint("merge"), "key").select("list_id", "main_id")


def merge_geocoding(places: DataFrame, found: DataFrame) -> DataFrame:
    """Coordinates and names of a geocoding put over the places' own; other names join the variants."""
    f = found.select(F.col("place_id").alias("__k"), *[F.col(c).alias(f"__{c}") for c in ("lat", "lon", "name")])
    out = places.join(f, F.col("id") == F.col("__k"), "left")
    other = F.when(F.col("__name").isNotNull() & (F.col("__name") != F.col("name")), F.array("__name")).otherwise(F.array().cast("array<string>"))
    return out.withColumns({"variants": F.array_union(F.coalesce("variants", F.array().cast("array<string>")), other), "lat": F.coalesce("__lat", "lat"), "lon": F.coalesce("__lon", "lon")}).drop("__k", "__lat", "__lon", "__name")
