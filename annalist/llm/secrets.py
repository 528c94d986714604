"""Secret scans (2): fixed patterns and sliding-window entropy over candidate strings, in Spark expressions only.

One narrow pass over the texts: nothing is shuffled, so a hot source or key costs no more than its rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm.common import let, match_spans, running, spans_text, table

#: The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: A run is whole when nothing of its class stands before it; shorter runs can't pass, so they need not match.
LONG_HEX = r"[0-9a-f]{24,}"
LONG_ACCESS = r"AKIA[A-Z0-9]{16,}"

#: Candidates of the entropy method: whole runs of at least WINDOW token characters that hold a digit and a letter.
WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"
#: Character classes, tried in this order: name, pattern of a whole candidate, alphabet, least bits of some window.
CLASSES = (
    ("hex", "^[0-9A-Fa-f]+$", "0123456789abcdef", 3.0),
    ("alnum", "^[0-9A-Za-z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 3.7),
    ("base64", "", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-", 3.9),
)
#: Suppressed candidates: UUIDs, sequences, documented sample keys, hashes of the empty text, placeholders, plain paths.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
    r"|(?i)example|placeholder|changeme|dummy|your[-_]"
    r"|0123456789|abcdefghijkl|d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709"
)
#: A plain path: what it looks like from its first slash on, how many slashes it needs, and what it never holds.
PATH, NO_PATH = r"^[A-Za-z0-9_-]*+/[a-z0-9_-]++/[a-z0-9_/-]++$", r"//|/[a-z0-9_-]{16}"


def max_window_entropy(s: Column, alphabet: str, window: int = WINDOW) -> Column:
    """The largest Shannon entropy (bits) of any `window` characters of `s`, all of the alphabet.

    The counts of the window's characters change by one in and one out per step, and with them the sum of
    c*log2(c), of which the entropy is log2(window) - sum / window. The counts are kept as a string with one sign for
    each character of the alphabet ("@" for 0, "A" for 1 ...), of which a step overlays one or two, and the text is
    taken apart once, so a step costs the same wherever it stands. A string shorter than the window has 0.
    """
    f = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    count = lambda counts, place: F.ascii(F.substring(counts, place, F.lit(1))) - 64
    put = lambda counts, place, c: F.overlay(counts, F.char(c + 64), place, 1)

    def enter(acc: Column, place: Column) -> Column:
        c = count(acc["counts"], place)
        return F.struct(put(acc["counts"], place, c + 1).alias("counts"), (acc["total"] + F.get(f, c + 1) - F.get(f, c)).alias("total"), acc["low"].alias("low"))

    def leave(acc: Column, place: Column) -> Column:
        c = count(acc["counts"], place)
        return F.struct(put(acc["counts"], place, c - 1).alias("counts"), (acc["total"] + F.get(f, c - 1) - F.get(f, c)).alias("total"), acc["low"].alias("low"))

    def noted(acc: Column) -> Column:
        return F.struct(acc["counts"].alias("counts"), acc["total"].alias("total"), F.least(acc["low"], acc["total"]).alias("low"))

    def walk(places: Column) -> Column:
        start = F.struct(F.lit("@" * len(alphabet)).alias("counts"), F.lit(0.0).alias("total"), F.lit(window * math.log2(window)).alias("low"))
        first = F.aggregate(F.slice(places, 1, window), start, enter, noted)
        pairs = F.zip_with(F.slice(places, F.lit(1), F.size(places) - window), F.slice(places, F.lit(window + 1), F.size(places)), lambda a, b: F.struct(a.alias("out"), b.alias("in")))
        moved = lambda acc, x: F.when(x["out"] == x["in"], acc).otherwise(let(enter(acc, x["in"]), lambda a: let(leave(a, x["out"]), noted)))
        return F.aggregate(pairs, first, moved, lambda acc: F.lit(math.log2(window)) - acc["low"] / window)

    return F.when(F.length(s) < window, F.lit(0.0)).otherwise(let(F.transform(F.split(s, ""), lambda c: F.instr(F.lit(alphabet), c)), walk))


def free_of(found: Column, base: Column) -> Column:
    """The spans of `found` that overlap no span of `base`, by one pass over both, sorted by start, in each direction."""
    row = lambda s, own: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(own).alias("own"), s.alias("span"))

    def kept(rows: Column) -> Column:
        before = running(F.transform(rows, lambda x: F.when(x["own"] == 0, x["end"]).otherwise(F.lit(-1).cast("bigint"))), lambda a, b: F.greatest(a, b), -1)
        far = 1 << 62
        after = F.reverse(running(F.reverse(F.transform(rows, lambda x: F.when(x["own"] == 0, x["start"]).otherwise(F.lit(far).cast("bigint")))), lambda a, b: F.least(a, b), far))
        judged = F.zip_with(F.zip_with(rows, before, lambda x, e: F.struct(x.alias("x"), e.alias("before"))), after, lambda y, s: F.when((y["x"]["own"] == 1) & (y["before"] <= y["x"]["start"]) & (s >= y["x"]["end"]), y["x"]["span"]))
        return F.array_compact(judged)

    merged = F.sort_array(F.concat(F.transform(base, lambda s: row(s, 0)), F.transform(found, lambda s: row(s, 1))))
    return F.when((F.size(found) == 0) | (F.size(base) == 0), found).otherwise(let(merged, kept))


def secret_spans(df: DataFrame, text: str = "text", base: str = "base_spans", spans: str = "secret_spans") -> DataFrame:
    """Adds `base` and `spans`, arrays of struct<kind, start, end, match>, to every row of `df`.

    base: the fixed patterns (assign, access, hex), each kind leftmost non-overlapping, sorted by start, then kind.
    spans: base and the entropy method's finds ("entropy"), which leave out what the allow-list names and what
    overlaps a base span. A null text is empty and has none; so has an empty table. Every row is judged by itself,
    so repeated rows get the same spans. Columns of `df` with the two names are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(match_spans(t, "assign", ASSIGN), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 6)
    ranked = F.concat(assign, match_spans(t, "access", LONG_ACCESS), match_spans(t, "hex", LONG_HEX))
    order = lambda spans: F.transform(
        F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, ("assign", "access", "hex", "entropy"))), s["kind"]).alias("rank"), s.alias("span")))),
        lambda x: x["span"],
    )
    is_path = lambda m: m.rlike(PATH) & ~m.rlike(NO_PATH)
    rough = F.filter(match_spans(t, "entropy", CANDIDATE), lambda s: ~s["match"].rlike(ALLOWED) & ~is_path(s["match"]))

    def random(s: Column) -> Column:
        m = s["match"]
        is_hex, is_alnum = m.rlike(CLASSES[0][1]), m.rlike(CLASSES[1][1])
        return (
            F.when(is_hex, max_window_entropy(F.lower(m), CLASSES[0][2]) >= CLASSES[0][3])
            .when(is_alnum, max_window_entropy(m, CLASSES[1][2]) >= CLASSES[1][3])
            .otherwise(max_window_entropy(m, CLASSES[2][2]) >= CLASSES[2][3])
        )

    out = df.withColumn(base, order(ranked))
    found = F.filter(free_of(rough, F.col(base)), random)
    return out.withColumn(spans, order(F.concat(F.col(base), found)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the spans of every document."""
    out = secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint")
    return out.select(
        "doc_id",
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        spans_text(F.col("secret_spans")).alias("spans"),
    )
