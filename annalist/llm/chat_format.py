r"""Chat formatting (1): conversations to marked-up training text with a loss mask, in Spark expressions only.

Template: `<|start|>role<|message|>text` then `<|turn|>text` for each further turn of the same role, then `<|end|>`.
Escaping inside roles and texts: a backslash is doubled, and each control string gets a backslash after its first
character (`</s>` becomes `<\/s>`), so no control string is left in an escaped text and the change can be undone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm.common import table

START, MESSAGE, TURN, END = "<|start|>", "<|message|>", "<|turn|>", "<|end|>"
#: Control strings of common chat templates; `<|` covers every marker of the form `<|name|>`.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>")
#: Turns are gathered by blocks of so many turn numbers first: a conversation of any length is merged in
#: parallel, and the last step sees one row for each block.
BLOCK = 64


def _control_pattern(control=CONTROL) -> str:
    heads: dict[str, list[str]] = {}
    for c in control:
        heads.setdefault(c[0], []).append(c[1:])
    return "|".join(f"(?:{re.escape(h)}(?={'|'.join(re.escape(r) for r in rest)}))" for h, rest in heads.items())


def escape(c: Column, control=CONTROL) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), f"({_control_pattern(control)})", r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\(\\?)", "$1")


def _merge(acc: Column, x: Column) -> Column:
    """Appends a block of turns `x` to `acc`, joining the texts where the role goes on."""
    same = (F.size(acc) > 0) & (F.element_at(acc, -1)["role"] == x["role"])
    last = F.element_at(acc, -1)
    return F.when(same, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(x["role"].alias("role"), F.concat(last["texts"], x["texts"]).alias("texts"))))).otherwise(F.concat(acc, F.array(x)))


def format_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, segments array<struct<text, loss>>, n_turns.

    `formatted` is the segments' texts joined; a segment under the loss mask holds one escaped assistant text.
    Turns are ordered by turn (nulls first), then role, then text, so ties and repeated rows have one order and are
    all kept. A null role or text is empty. Rows of a null conv_id are one conversation. An empty table gives no rows.
    Other columns are ignored, whatever their names.
    """
    rows = df.select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = rows.select("conv_id", F.struct("turn", escape(F.col("role")).alias("role"), escape(F.col("text")).alias("text")).alias("t"))
    # rows without a turn stand in the order of role and text, so they are cut by these
    unnumbered = lambda c: F.when(F.col("t.turn").isNull(), c)
    block = F.struct(F.floor(F.col("t.turn") / BLOCK).alias("n"), unnumbered(F.col("t.role")).alias("role"), unnumbered(F.substring("t.text", 1, 2)).alias("head"))
    rows = rows.select("conv_id", block.alias("block"), "t")
    turns = "array<struct<role:string,texts:array<string>>>"
    blocks = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("ts")).select(
        "conv_id",
        F.struct(
            "block",
            F.aggregate(
                F.transform("ts", lambda t: F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts"))),
                F.array().cast(turns),
                _merge,
            ).alias("turns"),
        ).alias("b"),
    )
    convs = blocks.groupBy("conv_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list("b")), lambda b: b["turns"])).alias("turns"))
    # where two blocks meet, a role may go on: such a turn opens with the inner mark instead of a header
    goes_on = lambda t, i: (i > 0) & (F.get(F.col("turns"), i - 1)["role"] == t["role"])
    stops = lambda t, i: F.coalesce(F.get(F.col("turns"), i + 1)["role"] != t["role"], F.lit(True))
    segment = lambda s, loss: F.struct(s.alias("text"), loss.alias("loss"))

    def pieces(t: Column, i: Column) -> Column:
        return F.concat(
            F.flatten(
                F.transform(
                    t["texts"],
                    lambda x, k: F.array(
                        segment(F.when((k > 0) | goes_on(t, i), F.lit(TURN)).otherwise(F.concat(F.lit(START), t["role"], F.lit(MESSAGE))), F.lit(False)),
                        segment(x, t["role"] == loss_role),
                    ),
                )
            ),
            F.when(stops(t, i), F.array(segment(F.lit(END), F.lit(False)))).otherwise(F.array().cast("array<struct<text:string,loss:boolean>>")),
        )

    out = convs.withColumn("segments", F.flatten(F.transform("turns", pieces)))
    return out.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda a, t: a + F.size(t["texts"])).alias("n_turns"),
    )


def parse_formatted(formatted: Column) -> Column:
    """The turns read back from a formatted conversation: array<struct<role, text>>, unescaped."""
    parts = F.filter(F.split(formatted, re.escape(END), -1), lambda p: p != "")
    turns = lambda p: F.transform(
        F.split(F.substr(p, F.instr(p, MESSAGE) + len(MESSAGE)), re.escape(TURN), -1),
        lambda x: F.struct(unescape(F.substring_index(F.substr(p, F.lit(len(START) + 1)), MESSAGE, 1)).alias("role"), unescape(x).alias("text")),
    )
    return F.flatten(F.transform(parts, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every conversation and the planted one, digested from the formatted output read back."""
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    out = format_conversations(convs).select("conv_id", "formatted", parse_formatted(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    return out.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, lag(role) OVER w AS before
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), f AS (
  SELECT *, length(replace(text, '\', '\\'))
      + (length(text) - length(replace(text, '<|', ''))) // 2
      + (length(text) - length(replace(text, '<s>', ''))) // 3
      + (length(text) - length(replace(text, '</s>', ''))) // 4
      + (length(text) - length(replace(text, '[INST]', ''))) // 6
      + (length(text) - length(replace(text, '[/INST]', ''))) // 7
      + (length(text) - length(replace(text, '<<SYS>>', ''))) // 7
      + (length(text) - length(replace(text, '<</SYS>>', ''))) // 8
      + (length(text) - length(replace(text, '<start_of_turn>', ''))) // 15
      + (length(text) - length(replace(text, '<end_of_turn>', ''))) // 13
      + CASE WHEN before = role THEN 8 ELSE 9 + length(role) + 11 + 7 END AS n
  FROM e
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
