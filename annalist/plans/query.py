"""The application's query layer (B3-B6, B10-B13, B16, F1, F5, D20, D24, D25, A28): a state in, a DataFrame out."""

from __future__ import annotations

from dataclasses import dataclass, fields
from urllib.parse import parse_qsl, urlencode

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.operators import graph

#: The columns that a table sorts by, and the languages a name falls back to.
SORT_COLUMNS = ("no", "name", "district", "realm", "section", "holder", "series")
LANGUAGES = ("fr", "en", "de")


@dataclass(frozen=True)
class QuerySpec:
    """A view's parameters; the defaults are not written into the hash."""

    view: str = "map"
    lang: str = "fr"
    district: str | None = None
    realm: str | None = None
    section: str | None = None
    holder: str | None = None
    series: str | None = None
    words: str = ""
    sort: str | None = None
    level: int = 0

    def to_hash(self) -> str:
        return urlencode([(f.name, getattr(self, f.name)) for f in fields(self) if getattr(self, f.name) not in (f.default, None, "")])

    @classmethod
    def from_hash(cls, text: str) -> QuerySpec:
        known = {f.name: f for f in fields(cls)}
        aliases = {"q": "words", "tenure": "section"}
        got = {aliases.get(k, k): v for k, v in parse_qsl(text.lstrip("#?"))}
        got = {k: v for k, v in got.items() if k in known}
        if "sort" in got and got["sort"].lstrip("-") not in SORT_COLUMNS:
            del got["sort"]
        if "level" in got:
            got["level"] = int(got["level"]) if got["level"].isdigit() else 0
        return cls(**got)


def entry_holders(holders: Column, section: Column, owner: str = "duke") -> Column:
    """The holders named, else the owner for domain and safeguard, else none."""
    none = F.array().cast("array<string>")
    return F.when(F.size(F.coalesce(holders, none)) > 0, holders).when(section.isin("domain", "safeguard"), F.array(F.lit(owner))).otherwise(none)


def filter_entries(entries: DataFrame, spec: QuerySpec, edges: DataFrame | None = None) -> DataFrame:
    """Subtree of a district (admin and feudal edges, not ressort; trap T9), exact realm, section, series, all words.

    The subtree's divisions are few next to the entries: they come as a semi join that Spark may broadcast.
    """
    out = entries
    if spec.district:
        inside = graph.descendants(graph_edges(edges), spec.district)
        inside = inside.unionAll(edges.sparkSession.createDataFrame([(spec.district,)], "node string"))
        out = out.join(inside, F.col("district") == F.col("node"), "left_semi")
    for name in ("realm", "section", "series"):
        if (v := getattr(spec, name)) is not None:
            out = out.where(F.col(name) == v)
    if spec.holder is not None:
        out = out.where(F.array_contains("holders", spec.holder))
    where = F.lower(F.concat_ws(" ", "text", "name"))
    for w in spec.words.lower().split():
        out = out.where(where.contains(w))
    return out


def graph_edges(edges: DataFrame) -> DataFrame:
    """The edges that make a subtree, between divisions: leaves are no districts."""
    return edges.where(F.col("relation").isin("admin", "feudal")).select("child", "parent").distinct()


def sort_key(c: Column) -> Column:
    """Digits padded, so that numbers in text sort by value, base letters only."""
    padded = F.regexp_replace(F.regexp_replace(c.cast("string"), r"([0-9]+)", "000000000000$1"), r"0*([0-9]{12})(?![0-9])", "$1")
    return F.collate(padded, "UNICODE_CI_AI")


def sort_order(sort: str | None) -> list[Column]:
    """The order of a table's rows by a column, "-" before it for falling (F1): blank keys last in both directions, ties by number."""
    name = (sort or "no").lstrip("-")
    down = (sort or "").startswith("-")
    key = F.col("no") if name == "no" else sort_key(F.col(name))
    blank = F.col(name).isNull() | (F.col(name).cast("string") == "")
    return [blank.asc(), key.desc() if down else key.asc(), F.col("no").asc()]


def sort_entries(rows: DataFrame, sort: str | None) -> DataFrame:
    """The rows in order (F1)."""
    return rows.orderBy(*sort_order(sort))


def fallback_name(names: Column, lang: str, default: Column) -> Column:
    """The name in a language, else in the others in order, else the default."""
    return F.coalesce(*[F.nullif(names[x], F.lit("")) for x in dict.fromkeys((lang, *LANGUAGES))], default)


def shown_areas(areas: DataFrame, hierarchy: str, level: int = 0, kind: str | None = None) -> DataFrame:
    """Areas of a kind, which overrides the rest, or of a hierarchy and level (0: all); never the root."""
    out = areas.where(F.col("level") > 0)
    if kind is not None:
        return out.where(F.col("place_type") == kind)
    out = out.where(F.col("hierarchy") == hierarchy)
    return out.where(F.col("level") == level) if level else out


def layer_entries(entries: DataFrame, layers: dict[str, tuple[str, ...]], layer: str) -> DataFrame:
    """The entries of a layer's series."""
    return entries.where(F.col("series").isin(*layers[layer]))


def direct_members(edges: DataFrame) -> DataFrame:
    """(parent, n): members of each division, direct ones only."""
    return edges.groupBy("parent").agg(F.count_distinct("child").alias("n"))


def holder_overlay(holdings: DataFrame, holder: str) -> DataFrame:
    """(place, shared): the places of a holder; shared if others hold there too."""
    per = holdings.groupBy("place").agg(F.bool_or(F.col("holder") == holder).alias("mine"), F.bool_or(F.col("holder") != holder).alias("shared"))
    return per.where("mine").select("place", "shared")


def tenure_by_holder(holdings: DataFrame) -> DataFrame:
    """(holder, tenure, n)."""
    return holdings.groupBy("holder", "tenure").agg(F.count("*").alias("n"))


def csv_lines(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(line): the rows as CSV text; quotes only around quotes, commas and line ends."""
    cell = lambda c: F.when(F.coalesce(F.col(c).cast("string"), F.lit("")).rlike('[",\\n]'), F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return rows.select(F.array_join(F.array(*map(cell, columns)), ",").alias("line"))


def compact_json(rows: DataFrame) -> DataFrame:
    """(json): each row as an object without nulls, false, empty texts and lists; zeros stay."""
    keep = []
    for f in rows.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind == "string":
            c = F.nullif(c, F.lit(""))
        elif kind == "boolean":
            c = F.when(c, c)
        elif kind in ("array", "map"):
            c = F.when(F.size(c) > 0, c)
        keep.append(c.alias(f.name))
    return rows.select(F.to_json(F.struct(*keep)).alias("json"))


def version(files: DataFrame) -> DataFrame:
    """(version): the first 12 hexadecimal digits of the SHA-256 over the files' contents in order of their names.

    files: (name, content), the few compiled files of one release; any other table counts as one file, its rows as JSON in order.
    """
    if set(files.columns) != {"name", "content"}:
        lines = files.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in files.columns])).alias("line"))
        files = lines.agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("content")).select(F.lit("table").alias("name"), "content")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", F.coalesce("content", F.lit("")).alias("content")))), lambda x: x["content"]), "")
    return files.agg(F.substring(F.sha2(joined, 256), 1, 12).alias("version"))
