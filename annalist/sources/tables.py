"""Record tables in and out (A1-A6, A12-A14, A20-A26, B1): schemas, typed CSV with issues, JSON lines, YAML, sinks.

Writers keep Spark's part files; `single` merges them where the reader is a person or a browser and the table small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PROVENANCE = "source_page string, confidence string, notes string"
#: Columns of the record tables in output order; arrays are list cells in CSV.
SCHEMAS = {
    "entries": "no string, text string, name string, descriptors array<string>, district_id string, realm_id string, section string, holder_id array<string>, share string, share_with array<string>, series string, order string, place_id string, " + _PROVENANCE,
    "places": "id string, kind string, name_fr string, name_de string, name_en string, variants array<string>, place_type string, lat double, lon double, wikidata_id string, geonames_id bigint, modern_country string, index_kind string, index_commune string, index_canton string, index_dept string, lost boolean, hierarchy string, holder_id array<string>, counterpart_id string, counterpart_basis string, " + _PROVENANCE,
    "memberships": "child_id string, parent_id string, relation string, share string, " + _PROVENANCE,
    "entities": "id string, name_en string, name_fr string, name_de string, entity_type string, color string, " + _PROVENANCE,
    "holdings": "place_id string, tenure string, holder_id string, share string, share_with array<string>, via_entry array<string>, " + _PROVENANCE,
    "features": "id string, theme string, name string, place_id string, attrs string, " + _PROVENANCE,
    "index_links": "place_id string, entry_no string, index_name string, printed string, status string, " + _PROVENANCE,
}
PATTERNS = {"id": r"^[a-z0-9]+(?:-[a-z0-9]+)*$", "source_page": r"^[0-9]+(?:-[0-9]+)?(?:;\s*[0-9]+(?:-[0-9]+)?)*$", "no": r"^(?:[0-9]+|x-[0-9]+-[0-9]+)$", "share": r"^(?:[0-9]+/[0-9]+|part|joint)$", "color": "^#[0-9a-f]{6}$", "wikidata_id": r"^Q[0-9]+$"}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table].replace(" order string", " `order` string"))


def list_cell(c: Column) -> Column:
    """A |-separated cell as an array, blanks left out (B1)."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|", -1), lambda x: F.trim(x)), lambda x: x != "")


def coerce(raw: DataFrame, table: str) -> DataFrame:
    """Text columns trimmed, blanks null, lists split, types cast; a cell that does not cast is null (B1)."""
    out = []
    for f in schema(table).fields:
        if f.name not in raw.columns:
            out.append((F.array().cast(f.dataType) if f.dataType.typeName() == "array" else F.lit(None).cast(f.dataType)).alias(f.name))
            continue
        c = F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit(""))
        out.append((list_cell(c) if f.dataType.typeName() == "array" else c if f.dataType.typeName() == "string" else c.try_cast(f.dataType)).alias(f.name))
    return raw.select(*out, *[c for c in ("line",) if c in raw.columns])


def read_csv(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows, issues) of a table's CSV (A1). A header of unknown columns rejects the file; a missing file is empty.

    Rows carry their line (header is line 1, for files of one line per row); a row with a bad cell is an issue.
    """
    kind = schema(table)
    empty = spark.createDataFrame([], T.StructType([*kind.fields, T.StructField("line", T.LongType())]))
    bad = "level string, table string, row string, message string"
    try:
        raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return empty, spark.createDataFrame([("warning", table, None, "missing file")], bad)
    unknown = [c for c in raw.columns if c not in kind.names]
    if unknown:
        return empty, spark.createDataFrame([("error", table, "1", f"unknown column {c}") for c in unknown], bad)
    raw = raw.withColumn("line", F.monotonically_increasing_id() + 2)
    rows = coerce(raw, table)
    checks = [(F.col(c).isNotNull() & ~F.col(c).rlike(p), c) for c, p in PATTERNS.items() if c in kind.names]
    typed = [f.name for f in kind.fields if f.dataType.typeName() not in ("string", "array") and f.name in raw.columns]
    checked = rows.join(raw.select("line", *[F.nullif(F.trim(c), F.lit("")).alias(f"raw_{c}") for c in typed]), "line")
    checks += [(F.col(f"raw_{c}").isNotNull() & F.col(c).isNull(), c) for c in typed]
    message = F.array_join(F.array_compact(F.array(*[F.when(test, c) for test, c in checks])), ", ")
    issues = checked.withColumn("m", message).where("m <> ''").select(F.lit("error").alias("level"), F.lit(table).alias("table"), F.col("line").cast("string").alias("row"), F.concat(F.lit("bad value: "), F.col("m")).alias("message"))
    return rows, issues


def read_manual(spark: SparkSession, path: str, ddl: str, keys: list[str] | None = None) -> DataFrame:
    """A hand-kept CSV by an explicit schema, empty if the file is missing (A5). With `keys`, one row for each key: two are an error."""
    kind = T.StructType.fromDDL(ddl)
    try:
        rows = spark.read.schema(kind).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], kind)
    if keys is None:
        return rows
    rest = [c for c in rows.columns if c not in keys]
    one = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.first(F.struct(*rest)).alias("__r"))
    checked = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("repeated decision: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])))).otherwise(F.col("__r"))
    return one.select(*keys, checked.alias("__r")).select(*[c if c in keys else F.col(f"__r.{c}").alias(c) for c in rows.columns])


def read_jsonl(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON lines by an explicit schema (A2)."""
    return spark.read.schema(ddl).json(path)


def load_yaml(text: str):
    """A YAML document where a repeated key is an error (A4, trap T16)."""
    import yaml

    class Unique(yaml.SafeLoader):
        pass

    def mapping(loader, node, deep=False):
        keys = [loader.construct_object(k, deep=True) for k, _ in node.value]
        again = {k for k in keys if keys.count(k) > 1}
        if again:
            raise ValueError(f"repeated key: {sorted(map(str, again))}")
        return yaml.SafeLoader.construct_mapping(loader, node, deep)

    Unique.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    return yaml.load(text, Unique)


def vocabulary(spark: SparkSession, vocab: dict) -> DataFrame:
    """(vocab, key, lang, label, hierarchy) of a vocabulary file."""
    rows = [(v, k, lang, str(label), entry.get("hierarchy")) for v, keys in vocab.items() for k, entry in keys.items() for lang, label in entry.items() if lang != "hierarchy"]
    return spark.createDataFrame(rows, "vocab string, key string, lang string, label string, hierarchy string")


def read_checklist(lines: DataFrame) -> DataFrame:
    """(item, answer) of a checklist: an item's line begins with "- ", its answer's line with "+ " (A13). lines: (line, text)."""
    from pyspark.sql import Window

    w = Window.orderBy("line")  # a document of a person's length
    nxt = lines.withColumn("after", F.lead("text").over(w))
    return nxt.where(F.col("text").startswith("- ") & F.trim("after").startswith("+ ")).select(F.substr("text", F.lit(3)).alias("item"), F.substr(F.trim("after"), F.lit(3)).alias("answer"))


def to_cells(rows: DataFrame, table: str) -> DataFrame:
    """A table's columns as CSV cells in output order."""
    cell = lambda f: F.array_join(f.name, "|") if f.dataType.typeName() == "array" else F.col(f"`{f.name}`").cast("string")
    return rows.select(*[F.coalesce(cell(f), F.lit("")).alias(f.name) for f in schema(table).fields])


def write_csv(rows: DataFrame, path: str, table: str, order: list, single: bool = True) -> None:
    """The table sorted and written as CSV."""
    cells = rows.orderBy(*order)
    out = to_cells(cells.coalesce(1) if single else cells, table)
    out.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def part_text(lines: DataFrame) -> DataFrame:
    """(part, text): each part's lines under [p. N] marks, in order (A23). lines: (part, page, pos, text)."""
    pages = lines.groupBy("part", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda s: s["text"]), "\n").alias("body"))
    marked = pages.select("part", F.struct("page", F.format_string("[p. %s]\n%s", F.col("page").cast("string"), F.col("body")).alias("t")).alias("s"))
    return marked.groupBy("part").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["t"]), "\n").alias("text"))


def geojson(rows: DataFrame, ring: str, properties: list[str], precision: int = 5) -> DataFrame:
    """(json): each row's ring as a GeoJSON feature, coordinates rounded."""
    coords = F.transform(ring, lambda p: F.transform(p, lambda x: F.round(x, precision)))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(coords).alias("coordinates"))
    return rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))).alias("json"))


def json_schema(table: str, enums: dict[str, list[str]] | None = None) -> dict:
    """JSON Schema of a table, with vocabularies as enumerations."""
    names = {"string": "string", "double": "number", "long": "integer", "boolean": "boolean"}
    props = {}
    for f in schema(table).fields:
        kind = f.dataType.typeName()
        inner = {"type": names["string" if kind == "array" else kind]}
        if f.name in PATTERNS and kind != "array":
            inner["pattern"] = PATTERNS[f.name]
        if enums and f.name in enums:
            inner["enum"] = sorted(enums[f.name])
        props[f.name] = {"type": "array", "items": inner} if kind == "array" else inner
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": table, "type": "object", "additionalProperties": False, "properties": props}
