"""Parsing ordered text (H6, H11-H13, K1, A3): index lines, old forms, second readings and numbering.

What looks back over a whole document runs once per document (`applyInPandas`), documents in parallel; line-wise
rules are Column expressions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions.fuzzy import JUNK, LOOKALIKE, number_cost_of

#: Fixed values of the numbering's alignment.
GAP_PENALTY, MAX_COST, LOOKAHEAD, BEAM = 1.0, 1.5, 6, 60
REJECT_CLEAN, REJECT_GARBLED = 2.0, 0.8


def page_lines(pages: DataFrame, parts: list[str]) -> DataFrame:
    """(page, pos, text, part): the body lines of some parts in order (A3). pages: (page, body array<struct<text, part>>)."""
    return pages.select("page", F.posexplode("body").alias("pos", "line")).select("page", "pos", F.col("line.text").alias("text"), F.col("line.part").alias("part")).where(F.col("part").isin(parts))


def align_numbers(tokens: list[str | None], last: int) -> list[tuple[int, float] | None]:
    """The increasing numbering of least total cost for a document's tokens: (number, cost) or None for each (K1).

    A dynamic program over states (last number given): a token is one of the next LOOKAHEAD numbers, at its alignment
    cost and a penalty for each number skipped, or no entry. The BEAM cheapest states go on. Back pointers give the
    path.
    """
    states: dict[int, float] = {0: 0.0}
    back: list[dict[int, tuple[int, float | None]]] = []
    for tok in tokens:
        if tok is None:
            continue
        reject = REJECT_CLEAN if tok.isdigit() else REJECT_GARBLED
        new: dict[int, float] = {}
        come: dict[int, tuple[int, float | None]] = {}
        for m, so_far in states.items():
            if m not in new or so_far + reject < new[m]:
                new[m], come[m] = so_far + reject, (m, None)
            for n in range(m + 1, min(m + LOOKAHEAD, last) + 1):
                c = number_cost_of(tok, n)
                total = so_far + c + GAP_PENALTY * (n - m - 1)
                if c <= MAX_COST and (n not in new or total < new[n]):
                    new[n], come[n] = total, (m, c)
        states = dict(sorted(new.items(), key=lambda x: x[1])[:BEAM])
        back.append(come)
    at = min(states, key=states.get)
    read: list[tuple[int, float] | None] = []
    for come in reversed(back):
        before, c = come[at]
        read.append(None if c is None else (at, c))
        at = before
    path = iter(reversed(read))
    return [None if tok is None else next(path) for tok in tokens]


def number_lines(lines: DataFrame, doc: str, pos: str, token: str, last: int) -> DataFrame:
    """(doc, pos, token, number, cost) for every line, aligned document by document."""
    kind = lines.schema[doc].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        got = align_numbers([None if t is None or t != t else t for t in pdf[token]], last)
        return pd.DataFrame({"doc": pdf[doc], "pos": pdf[pos], "token": pdf[token], "number": pd.array([g and g[0] for g in got], dtype="Int64"), "cost": [g[1] if g else None for g in got]})

    return lines.select(doc, pos, token).groupBy(doc).applyInPandas(run, f"doc {kind}, pos bigint, token string, number bigint, cost double")


def leading_token(text: Column) -> Column:
    """The short token before a line's first full stop if it can be a number, else null (H6)."""
    stop = F.regexp_extract(text, r"(?U)^\s*(\S{1,6}?)\s?\.\s?(?=\S)", 1)
    bare = F.regexp_extract(text, r"^\s*(\d{2,4}\S{0,2})\s+(?=[A-ZÀ-Ý])", 1)
    tok = F.when(stop != "", stop).when((bare != "") & (F.length(F.regexp_replace(bare, r"\D", "")) >= 3), bare)
    like = "".join(sorted(set(LOOKALIKE) | JUNK))
    return F.when(F.length(F.translate(tok, "0123456789" + like, "")) < F.length(tok), tok)


def split_fields(text: Column) -> Column:
    """The comma-separated fields outside parentheses, blank ones left out."""
    parts = F.split(text, ",", -1)
    opened = lambda s: F.length(F.replace(s, F.lit(")"), F.lit(""))) - F.length(F.replace(s, F.lit("("), F.lit("")))

    def step(acc: Column, p: Column) -> Column:
        inside = acc["depth"] > 0
        joined = F.when(inside, F.concat(F.slice(acc["out"], 1, F.size(acc["out"]) - 1), F.array(F.concat(F.element_at(acc["out"], -1), F.lit(","), p)))).otherwise(F.concat(acc["out"], F.array(p)))
        return F.struct((acc["depth"] + opened(p)).alias("depth"), joined.alias("out"))

    walked = F.aggregate(parts, F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("out")), step, lambda a: a["out"])
    return F.filter(F.transform(walked, lambda s: F.trim(s)), lambda s: s != "")


def index_entry(text: Column) -> Column:
    """An index line as struct<name, numbers array<string>, details array<string>, xref>."""
    fields = split_fields(text)
    numeric = lambda s: F.regexp_replace(s, r"^[ .*'’]+|[ .*'’]+$", "").rlike(r"^[0-9]+(-[0-9]+)?$")
    numbers = F.transform(F.filter(fields, lambda s, i: (i > 0) & numeric(s)), lambda s: F.regexp_replace(s, r"[^0-9-]", ""))
    details = F.filter(fields, lambda s, i: (i > 0) & ~numeric(s))
    xref = F.regexp_extract(text, r"(?i)\b(?:v\.|voir|voy\.)\s+(.+?)\s*\.?\s*$", 1)
    return F.struct(F.get(fields, 0).alias("name"), numbers.alias("numbers"), details.alias("details"), F.nullif(xref, F.lit("")).alias("xref"))


def old_form(text: Column) -> Column:
    """"old form, modern name" or "old = modern" as struct<old, modern, ok>."""
    p = r"^\s*(.+?)\s*(?:=|,\s*auj\.|,)\s*(.+?)\s*\.?\s*$"
    old, modern = F.regexp_extract(text, p, 1), F.regexp_extract(text, p, 2)
    return F.struct(F.when(old != "", old).otherwise(F.trim(text)).alias("old"), F.nullif(modern, F.lit("")).alias("modern"), (old != "").alias("ok"))


def merge_reading(first: Column, second: Column) -> Column:
    """A second reading of digits where the first has gaps ("2?17"), if both agree on every digit that was read."""
    agree = (F.length(first) == F.length(second)) & F.forall(F.sequence(F.lit(1), F.length(first)), lambda i: (F.substring(first, i, F.lit(1)) == F.substring(second, i, F.lit(1))) | ~F.substring(first, i, F.lit(1)).rlike("[0-9]"))
    return F.when(second.rlike("^[0-9]+$") & agree, second).otherwise(first)
