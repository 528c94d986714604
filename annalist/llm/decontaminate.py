"""Benchmark decontamination (6): template windows with typed placeholders, looked up by hash, slots checked, in Spark only.

Texts become template words: numbers, units after numbers and names inside a sentence turn into placeholders, so a
re-parameterised question has the windows of its original. The plain lower-cased words stand beside them, as a word
is a name or not by the case and the words around it. Of an item's different five-word windows one more serve as
anchors than a text may lack that keeps 0.8 of them, so such a text keeps one of the anchors whole, wherever its changes
lie; they are those that the fewest items share and that have the fewest placeholders. Windows of placeholders alone
say nothing and count by plain words only.

A block of items, BLOCK_WORDS words at most, is one row: a hash table of the anchors (an array of buckets) and the
items. Every task holds it and looks all windows of a document up within the document's row, compares the stretch around
a hit with the whole item, aligns the two by their windows and holds the values in the slots against each other. So
documents are read once for a block, never exploded or shuffled, at any size; a larger benchmark takes more blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annalist.llm.common import Scratch, fresh, let, table

WINDOW = 5
SIMILARITY = 0.8
#: Words of the items that are held at once (some 30 bytes a word for the table and its items).
BLOCK_WORDS = 250_000
#: Units that count as such after a number.
UNITS = "mm cm m km in ft yd mi mg g kg t lb oz ml cl l ms s sec min h hr hours days weeks months years mph kmh kph w kw j kj v hz khz mhz ghz kb mb gb tb usd eur gbp dollars euros pounds cents percent degrees"
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
_NAMES = r"(?<=[\p{Ll},;] )(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])"
_NUMBERS = r"(\p{N}+(?:[.,]\p{N}+)*)"
_UNITS = rf"(\x02[\p{{N}}.,]+) +({UNITS.replace(' ', '|')})(?![\p{{L}}\p{{N}}])"
_NOISE = r"(?<!\p{N})[.,]|[.,](?!\p{N})|[^\p{L}\p{N}\x01-\x03.,]+"


def with_words(df: DataFrame, text: str, words: str, templates: str) -> DataFrame:
    """Adds the lower-cased words of `text`, slots opening with their mark, and the same with slots as their mark alone.

    The steps are columns of their own, each read more than once by the next, so Spark computes each once.
    """
    a, b = fresh(df, "marked_names", "marked_all")
    t = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x01-\x03]", " ")
    df = df.withColumn(a, F.regexp_replace(t, _NAMES, NAME + "$1"))
    slots = F.regexp_replace(F.lower(F.regexp_replace(a, _NUMBERS, f" {NUMBER}$1 ")), _UNITS, f"$1 {UNIT}$2")
    marked = F.when(F.col(a).rlike(r"\p{N}"), slots).otherwise(F.lower(a))
    df = df.withColumn(b, F.btrim(F.regexp_replace(marked, _NOISE, " ")))
    df = df.withColumn(words, F.when(F.col(b) == "", F.array().cast("array<string>")).otherwise(F.split(b, " +")))
    return df.withColumn(templates, F.transform(words, template)).drop(a, b)


def template(word: Column) -> Column:
    """A slot as its mark alone, any other word as it is."""
    first = F.substring(word, 1, 1)
    return F.when(first.isin(NAME, NUMBER, UNIT), first).otherwise(word)


def unmarked(word: Column) -> Column:
    """The word without a slot's mark."""
    return F.when(F.substring(word, 1, 1).isin(NAME, NUMBER, UNIT), F.substr(word, F.lit(2))).otherwise(word)


def is_slot(word: Column) -> Column:
    return F.substring(word, 1, 1).isin(NAME, NUMBER, UNIT)


def windows_of(words: Column) -> Column:
    """The hashes of all windows of an array of words, in order."""
    last = lambda w: F.size(w) - WINDOW
    hashed = lambda w: F.transform(F.sequence(F.lit(0), last(w)), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    return let(words, lambda w: F.when(last(w) >= 0, hashed(w)).otherwise(F.array().cast("array<bigint>")))


def items_of(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_key, item_id, item_words, item_templates, item_plain): the different items of five words or more."""
    own = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).distinct()
    own = with_words(own.withColumn("item_key", F.xxhash64("item_id", "text")), "text", "item_words", "item_templates")
    return own.drop("text").where(F.size("item_words") >= WINDOW).withColumn("item_plain", F.transform("item_words", unmarked))


def may_lack(n: Column, similarity: float) -> Column:
    """How many of n windows a text may lack that keeps the share `similarity` of them."""
    return F.floor(n * (1 - similarity) + 1e-9).cast("int")


def anchors(items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(item_key, item_at, hash): windows of the items, by templates and by plain words, one more than a text may lack of each kind."""
    out = None
    for words, spoken in (("item_templates", True), ("item_plain", False)):
        own = items.select("item_key", words, F.posexplode_outer(windows_of(F.col(words))).alias("item_at", "hash")).where("hash IS NOT NULL")
        slots = F.size(F.filter(F.slice(words, F.col("item_at") + 1, F.lit(WINDOW)), is_slot))
        own = own.select("item_key", "item_at", "hash", slots.alias("slots"))
        own = (own.where(F.col("slots") < WINDOW) if spoken else own).groupBy("item_key", "hash").agg(F.min("item_at").alias("item_at"), F.min("slots").alias("slots"))
        own = own.withColumn("shared", F.count("*").over(Window.partitionBy("hash"))).withColumn("n", F.count("*").over(Window.partitionBy("item_key")))
        own = own.withColumn("rank", F.row_number().over(Window.partitionBy("item_key").orderBy("shared", "slots", "item_at")))
        own = own.where(F.col("rank") <= may_lack(F.col("n"), similarity) + 1).select("item_key", "item_at", "hash")
        out = own if out is None else out.unionAll(own)
    return out.distinct()


def lookup(items: DataFrame, similarity: float, buckets: int) -> DataFrame:
    """One row: `items`, an array in the order of item_key, and `buckets`, arrays of the anchors (hash, item, at) by the hash's low bits."""
    said = F.filter(F.arrays_zip(F.transform("item_templates", lambda w, i: i), windows_of(F.col("item_templates")).alias("h")), lambda x: x["h"].isNotNull())
    spoken = F.filter(said, lambda x: F.exists(F.slice(F.col("item_templates"), x["0"] + 1, F.lit(WINDOW)), lambda w: ~is_slot(w)))
    each = items.select(
        "item_key",
        "item_id",
        F.size("item_words").alias("size"),
        F.transform("item_words", lambda w: F.when(is_slot(w), w).otherwise("")).alias("slots"),
        windows_of(F.col("item_templates")).alias("all"),
        F.array_distinct(F.transform(spoken, lambda x: x["h"])).alias("templates"),
        F.array_distinct(windows_of(F.col("item_plain"))).alias("plain"),
    )
    held = each.agg(F.sort_array(F.collect_list(F.struct(*each.columns))).alias("items"))
    keys = each.agg(F.sort_array(F.collect_set("item_key")).alias("k")).select(F.posexplode("k").alias("item", "item_key"))
    low = anchors(items, similarity).join(F.broadcast(keys), "item_key").select((F.col("hash").bitwiseAND(buckets - 1)).cast("int").alias("low"), F.struct("hash", "item", F.col("item_at").cast("int").alias("at")).alias("a"))
    full = items.sparkSession.range(buckets).select(F.col("id").cast("int").alias("place"))
    full = full.join(low.groupBy("low").agg(F.sort_array(F.collect_list("a")).alias("found")), F.col("place") == F.col("low"), "left")
    none = F.array().cast("array<struct<hash:bigint,item:int,at:int>>")
    table_ = full.agg(F.sort_array(F.collect_list(F.struct("place", F.coalesce("found", none).alias("found")))).alias("t")).select(F.transform("t", lambda x: x["found"]).alias("buckets"))
    return held.join(table_)  # one row each


def _probe(hashes: Column, buckets: Column, n: int) -> Column:
    """The anchors among a document's windows as array<struct<item, start>>: where the item would begin."""
    found = lambda h: F.get(buckets, h.bitwiseAND(n - 1).cast("int"))
    places = F.array_compact(F.transform(hashes, lambda h, i: F.when(F.exists(found(h), lambda a: a["hash"] == h), i)))
    begin = lambda h, i: F.transform(F.filter(found(h), lambda a: a["hash"] == h), lambda a: F.struct(a["item"].alias("item"), (i - a["at"]).alias("start")))
    return F.flatten(F.transform(places, lambda i: let(F.get(hashes, i), lambda h: begin(h, i))))


def _aligned(want: Column, have: Column, shift: Column, slack: Column) -> Column:
    """The places (i, j) where an item's windows stand in a stretch, in order: array<struct<i, j>>.

    A window is looked for where the last one found lets expect it, else from there on, `slack` places ahead at most.
    """

    def step(acc: Column, i: Column) -> Column:
        h, expect = F.get(want, i), i + acc["off"]
        ahead = F.array_position(F.slice(have, acc["low"] + 1, F.greatest(expect - acc["low"], F.lit(0)) + slack + 1), h).cast("int")
        at = F.when((expect >= acc["low"]) & (F.get(have, expect) == h), expect).when(ahead > 0, acc["low"] + ahead - 1)
        moved = lambda j: F.struct((j - i).alias("off"), (j + 1).alias("low"), F.concat(acc["out"], F.array(F.struct(i.alias("i"), j.alias("j")))).alias("out"))
        return let(at, lambda j: F.when(j.isNull(), acc).otherwise(moved(j)))

    start = F.struct(shift.alias("off"), F.lit(0).alias("low"), F.array().cast("array<struct<i:int,j:int>>").alias("out"))
    places = F.when(F.size(want) > 0, F.sequence(F.lit(0), F.size(want) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, start, step, lambda acc: acc["out"])


def _slots_fit(item: Column, words: Column, matches: Column, similarity: float) -> Column:
    """Whether an item's slots, `similarity` of them at least, stand in the stretch, each value always for the same one."""
    inside = lambda m: F.filter(F.sequence(m["i"], m["i"] + WINDOW - 1), lambda x: F.get(item["slots"], x) != "")
    pairs = F.array_distinct(F.flatten(F.transform(matches, lambda m: F.transform(inside(m), lambda x: F.concat(F.get(item["slots"], x), F.lit("\n"), F.get(words, x - m["i"] + m["j"]))))))
    covered = F.size(F.array_distinct(F.flatten(F.transform(matches, inside))))
    total = F.size(F.filter(item["slots"], lambda x: x != ""))
    fits = lambda p: F.size(F.array_distinct(F.transform(p, lambda x: F.substring_index(x, "\n", 1)))) == F.size(p)
    return (covered >= total * similarity) & let(pairs, fits)


def leaks_of(words: Column, items: Column, buckets: Column, n: int, similarity: float, id_type: str) -> Column:
    """The items that a document's words hold: array<struct<item_id, similarity, exact>>."""
    leaks_type = f"array<struct<item_id:{id_type},similarity:double,exact:boolean>>"

    def judged(w, th, ph, c, item):
        slack = F.ceil(item["size"] * (1 - similarity) + WINDOW).cast("int")
        first = F.greatest(c["start"] - slack, F.lit(0))
        length = c["start"] - first + item["size"] + slack
        cut = lambda hashes: F.slice(hashes, first + 1, F.greatest(length - WINDOW + 1, F.lit(0)))
        share = lambda own, hashes: F.when(F.size(own) > 0, F.size(F.array_intersect(own, hashes)) / F.size(own)).otherwise(0.0)
        plain, shared = share(item["plain"], cut(ph)), share(item["templates"], cut(th))
        fit = lambda: _slots_fit(item, F.slice(w, first + 1, length), _aligned(item["all"], cut(th), c["start"] - first, slack), similarity)
        leak = lambda s, exact: F.struct(item["item_id"].alias("item_id"), s.alias("similarity"), F.lit(exact).alias("exact"))
        return let(F.struct(plain.alias("p"), shared.alias("t")), lambda x: F.when(x["p"] >= similarity, leak(F.greatest(x["p"], x["t"]), True)).when((x["t"] >= similarity) & fit(), leak(x["t"], False)))

    def found(w, th, own_ph, its):
        # a text without slots has the same windows by templates and by plain words
        ph = lambda body: let(F.coalesce(own_ph, th), body)
        probes = let(buckets, lambda b: F.array_distinct(F.concat(_probe(th, b, n), F.when(own_ph.isNull(), F.array().cast("array<struct<item:int,start:int>>")).otherwise(_probe(own_ph, b, n)))))
        none = F.array().cast(leaks_type)
        each = lambda cs: let(its, lambda known: ph(lambda p: F.array_compact(F.transform(cs, lambda c: let(F.get(known, c["item"]), lambda item: judged(w, th, p, c, item))))))
        return let(probes, lambda cs: F.when(F.size(cs) == 0, none).otherwise(each(cs)))

    plain = lambda w: F.when(F.exists(w, is_slot), windows_of(F.transform(w, unmarked)))
    return let(words, lambda w: let(windows_of(F.transform(w, template)), lambda th: let(plain(w), lambda ph: found(w, th, ph, items))))


def _blocks(docs: DataFrame, benchmark: DataFrame, text: str, block_words: int, similarity: float):
    """For each block of items a function that adds a column of its leaks to documents."""
    items = Scratch(docs.sparkSession).save(items_of(benchmark, text=text), "items")
    n_words = items.agg(F.sum(F.size("item_words"))).first()[0] or 0
    blocks = -(-n_words // block_words) or 1
    n = 1 << max(8, min(16, (min(n_words, block_words) // 2).bit_length()))
    kind = items.schema["item_id"].dataType.simpleString()
    for b in range(blocks):
        known = lookup(items.where(F.pmod("item_key", F.lit(blocks)) == b) if blocks > 1 else items, similarity, n)

        def add(df: DataFrame, text: str, leaks: str, known: DataFrame = known) -> DataFrame:
            words, templates, its, buckets = fresh(df, "leak_words", "leak_templates", "leak_items", "leak_buckets")
            kept = [F.col(f"`{c}`") for c in df.columns]
            worded = with_words(df, text, words, templates).select(*kept, words, known.select("items").scalar().alias(its), known.select("buckets").scalar().alias(buckets))
            # the two arrays stand once in the expression, so that Spark puts them in as they are, and no row carries them
            return worded.select(*kept, leaks_of(F.col(words), F.col(its), F.col(buckets), n, similarity, kind).alias(leaks))

        yield add


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, similarity, exact): the documents that hold an item, one row for each pair.

    similarity: share of the item's windows found in the stretch, by templates or by plain lower-cased words, whichever
    is more. A pair counts from `similarity` on if the plain words themselves reach it (exact tells that), or if its
    slots correspond: of the item's slots that share at least stands in the stretch, and an item's value always for the
    same value of the document. Items and documents of fewer than five words, null texts and empty tables have no pairs.
    Repeated items and rows count once; rows of a null doc_id are judged each by its own text and their finds are one
    row for each item; a null item_id stays null. Other columns are ignored.
    """
    plain, out = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), None
    for add in _blocks(docs, benchmark, text, block_words, similarity):
        # through the outer explode, as Spark infers a filter on the array of a plain one and evaluates it twice
        own = add(plain, "text", "leaks").select("doc_id", F.explode_outer("leaks").alias("x")).where("x IS NOT NULL").select("doc_id", "x.*")
        out = own if out is None else out.unionAll(own)
    return out.groupBy("doc_id", "item_id").agg(F.round(F.max("similarity"), 6).alias("similarity"), F.max("exact").alias("exact"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", similarity: float = SIMILARITY, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs` that hold no benchmark item; each is judged by its own text, whatever its doc_id."""
    leaks, clean = fresh(docs, "leaks", "clean")
    names = [F.col(f"`{c}`") for c in docs.columns]
    scratch, k = Scratch(docs.sparkSession), 0
    for k, add in enumerate(_blocks(docs, benchmark, text, block_words, similarity)):
        if k:  # so that no plan holds more than one block
            docs = scratch.save(docs, f"clean-{k}")
        # a flag that goes through an explode is judged once; a plain filter would be evaluated below the projections
        docs = add(docs, text, leaks).select(*names, F.explode_outer(F.array(F.size(leaks) == 0)).alias(clean)).where(clean).drop(clean)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: every document and benchmark item that it holds."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
