"""PII (4): patterns propose spans, validators (Luhn, mod-97, ranges) confirm them, context words adjust the score.

A narrow Arrow stage over whole texts: memory is one batch, nothing is shuffled. Patterns that could walk a long
run again and again start only where a run starts or the last match ended (\\G), which finds the same matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm.common import table

#: The base kinds in the order of the contract, then those that the method adds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
#: Context words that raise a span's score when they stand within CONTEXT characters before or after it.
CONTEXT = 40
WORDS = {
    "email": ("mail", "e-mail", "email", "contact"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto"),
    "ssn": ("ssn", "social security", "social"),
}
#: Words beside which a number is likely another thing.
OTHERWISE = ("example", "sample", "invoice", "order", "serial", "part number", "reference", "tracking", "isbn")
#: Score of a pattern alone, of a validator that confirms it, of a context word, of a word of another thing, and of a
#: bank code whose country and length are registered; least score of an added span.
START = {"email": 0.6, "ip": 0.4, "card": 0.3, "phone": 0.5, "iban": 0.0, "ssn": 0.0}
CONFIRMED, NEAR, AGAINST, REGISTERED, LEAST = 0.4, 0.2, -0.2, 0.2, 0.5
#: The length of a bank account number (IBAN) in each country of the public registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29,
    "VA": 22, "VG": 24, "XK": 20,
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 mod 97-10 of a bank account number without blanks."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _patterns() -> dict:
    import regex

    local, digit = r"[A-Za-z0-9._%+-]", "[0-9]"
    return {
        "email": regex.compile(rf"(?:(?<!{local})|\G){local}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+"),
        "ip": regex.compile(rf"(?:(?<!{digit})|\G){digit}++(?:\.{digit}+)(?:\.{digit}+)(?:\.{digit}+)"),
        "card": regex.compile(r"[0-9](?:[\x20-]?[0-9])+"),
        "phone": regex.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
        "iban": regex.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}"),
        "ssn": regex.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    }


class Finder:
    """Finds the spans of a text, by kind and then start."""

    def __init__(self):
        import re

        self.patterns = _patterns()
        self.digit = re.compile("[0-9]")
        any_of = lambda ws: re.compile("|".join(rf"\b{re.escape(w)}\b" for w in ws), re.I)
        self.near, self.otherwise = {k: any_of(ws) for k, ws in WORDS.items()}, any_of(OTHERWISE)

    def valid(self, kind: str, m: str) -> bool:
        """Of base kinds: whether the match counts at all. Of added kinds: whether the validator confirms it."""
        if kind == "ip":
            return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.split(".")))
        if kind == "card":
            d = m.replace(" ", "").replace("-", "")
            return 16 <= len(d) <= 19 and luhn(d)
        if kind == "phone":
            return 8 <= sum("0" <= c <= "9" for c in m) <= 15
        if kind == "iban":
            return mod97(m.replace(" ", ""))
        if kind == "ssn":
            a, b, c = m.split("-")
            return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"
        return True

    @staticmethod
    def iban_end(text: str, start: int, stop: int) -> int:
        """Where the bank code ends that begins at `start`, `stop` at most: after the country's number of signs, or, of an
        unregistered country, after the longest reading that mod-97 confirms; else `start`. No sign of a word follows it."""
        ends = [k + 1 for k in range(start, stop) if text[k] != " "]
        known = IBAN_LENGTHS.get(text[start : start + 2])
        for n in [known] if known else range(len(ends), 14, -1):
            if n <= len(ends):
                end = ends[n - 1]
                if (end == len(text) or not (text[end].isascii() and text[end].isalnum())) and mod97(text[start:end].replace(" ", "")):
                    return end
        return start

    def spans(self, text: str) -> list[Span]:
        out: list[Span] = []
        digits = self.digit.search(text)
        for kind, pattern in self.patterns.items():
            if kind == "email" and "@" not in text or kind == "phone" and "+" not in text or kind not in ("email", "phone") and not digits:
                continue
            added, at = kind not in KINDS[:4], 0
            for m in pattern.finditer(text) if kind != "iban" else iter(lambda: pattern.search(text, at), None):
                start, end, score = m.start(), m.end(), START[kind]
                if kind == "iban":
                    end = self.iban_end(text, start, end)
                    at = end if end > start else start + 1
                    score += REGISTERED * (text[start : start + 2] in IBAN_LENGTHS)
                ok = end > start and self.valid(kind, text[start:end])
                if not ok:
                    continue
                around = max(0, start - CONTEXT), min(len(text), end + CONTEXT)
                score += CONFIRMED + NEAR * bool(self.near[kind].search(text, *around)) + AGAINST * bool(self.otherwise.search(text, *around))
                if not added or score >= LEAST - 1e-9:
                    out.append(Span(kind, start, end, round(min(1.0, score), 6)))
        return out


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id and `spans` (by kind, then start; code points, end exclusive, score 0 to 1).

    Base spans (email, ip, card, phone) hold whenever their check passes. Spans of the added kinds need their checksum
    and the least score: a bank code of a registered country has it unless a word of another thing stands near and no
    word of its own; one of another country, and a social security number, only beside such a word. A null text is empty. Null or repeated ids are judged row by row; other columns
    are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        find = Finder()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            got = [[s._asdict() for s in find.spans(t or "")] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, kind)], names=["doc_id", "spans"])

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: the spans of every document."""
    out = find_pii(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:4]))
    return out.select("doc_id", *[n(k).alias(f"n_{k}") for k in KINDS[:4]], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.array_join(F.transform("spans", lambda s: F.format_string("%.1f", s["score"])), ",").alias("scores"))
