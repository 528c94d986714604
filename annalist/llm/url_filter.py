"""URL filters (10): host and path rules, then a weighted vocabulary that an Aho-Corasick automaton counts.

A narrow Arrow stage: one automaton per task reads each URL once, whatever the number of terms. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm.common import table

#: Rules of the contract: verdict, host and path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: One strict term rejects a URL. Of soft terms it takes SOFT_LIMIT different ones whose weights add up to SOFT_WEIGHT.
STRICT = (
    "bestiality bukkake camgirl camsex casino casinos creampie cumshot escort escorts gangbang hentai keygen lolita milf nudes orgy "
    "porn porno pornhub prostitute torrent viagra cialis warez xxx xvideos"
).split()
SOFT = {
    "adult": 0.75, "ads": 1.0, "affiliate": 0.75, "bet": 1.0, "bets": 1.0, "bonus": 0.5, "cheap": 0.5, "click": 0.5, "coupon": 0.5, "crack": 1.0, "cracked": 1.0,
    "dating": 0.75, "deal": 0.5, "diet": 0.5, "erotic": 1.0, "fetish": 1.0, "hardcore": 0.75, "free": 0.5, "gamble": 1.0, "gambling": 1.0, "hacks": 0.75, "hot": 0.5, "jackpot": 1.0,
    "lesbian": 0.75, "loan": 1.0, "loans": 1.0, "lottery": 1.0, "naked": 1.0, "nude": 1.0, "payday": 1.0, "pharmacy": 0.75, "pills": 1.0, "poker": 1.0, "promo": 0.5,
    "replica": 0.75, "slots": 0.75, "sex": 1.0, "sexy": 1.0, "singles": 0.75, "teen": 0.5, "track": 0.5, "webcam": 0.75, "win": 0.5, "xrated": 1.0,
}
SOFT_LIMIT, SOFT_WEIGHT = 2, 1.5
#: Rows that a vocabulary table may have.
MAX_TERMS = 1_000_000


def vocabulary_of(terms: DataFrame, limit: int = MAX_TERMS) -> tuple[list[str], dict[str, float]]:
    """Strict terms and soft terms with weights from a table (term, kind, weight), `limit` rows at most, else an error.

    kind is strict or soft; terms are lower-cased; null or empty terms are left out; a null weight is 1; the largest of several counts.
    """
    rows = terms.where("term IS NOT NULL AND term <> '' AND kind IN ('strict', 'soft')").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a vocabulary of over {limit} terms")
    strict, soft = set(), {}
    for r in rows:
        w = 1.0 if r["weight"] is None else float(r["weight"])
        if r["kind"] == "strict":
            strict.add(r["term"].lower())
        else:
            soft[r["term"].lower()] = max(w, soft.get(r["term"].lower(), 0.0))
    return sorted(strict), soft


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without `://`."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [k for k in (rest.find(c) for c in "/?#") if k >= 0]
    cut = min(ends, default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    ends = [k for k in (tail.find(c) for c in "?#") if k >= 0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return host, tail[: min(ends, default=len(tail))]


class RuleSet:
    """Rules by host: a look-up walks the host's suffixes at label borders, so its cost does not grow with the rules."""

    def __init__(self, rules: Sequence[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        best, suffix = None, host
        while suffix:
            for start, rule, verdict in self.by_host.get(suffix, ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
            suffix = suffix.partition(".")[2]
        return best


class Vocabulary:
    """Counts terms between boundaries (no ASCII letter or digit beside them) in lower-cased URLs."""

    def __init__(self, strict: Sequence[str] = STRICT, soft: dict[str, float] = SOFT, soft_limit: int = SOFT_LIMIT, soft_weight: float = SOFT_WEIGHT):
        import ahocorasick

        self.limit, self.least, self.soft, self.auto = soft_limit, soft_weight, soft, ahocorasick.Automaton()
        for term in soft:
            self.auto.add_word(term, (term, False))
        for term in strict:
            self.auto.add_word(term, (term, True))
        if len(self.auto):
            self.auto.make_automaton()

    def hits(self, url: str | None) -> tuple[set[str], set[str]]:
        """The different strict and soft terms of a URL."""
        s = (url or "").lower()
        strict, soft = set(), set()
        for last, (term, is_strict) in self.auto.iter(s) if len(self.auto) else ():
            first = last - len(term) + 1
            if (first and s[first - 1].isascii() and s[first - 1].isalnum()) or (last + 1 < len(s) and s[last + 1].isascii() and s[last + 1].isalnum()):
                continue
            (strict if is_strict else soft).add(term)
        return strict, soft

    def weight(self, soft: set[str]) -> float:
        """The weights of the different soft terms."""
        return sum(self.soft[t] for t in sorted(soft))

    def blocks(self, strict: set[str], soft: set[str]) -> bool:
        return bool(strict) or (len(soft) >= self.limit and self.weight(soft) >= self.least - 1e-9)


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES, strict: Sequence[str] = STRICT, soft: dict[str, float] = SOFT, soft_limit: int = SOFT_LIMIT, soft_weight: float = SOFT_WEIGHT) -> DataFrame:
    """One row per row: page_id, host, path, rule, verdict, strict_hits, soft_hits (bigint), weight (double).

    The longest rule that fits decides; else the vocabulary, which a null URL passes: one strict term blocks, and so do
    `soft_limit` different soft terms whose weights add up to `soft_weight`. A term counts once, however often and in
    whatever part of the URL it stands. Repeated rows and null ids are judged alike; other columns are ignored; an
    empty table gives no rows. `vocabulary_of` reads a vocabulary from a table.
    """
    kind = pages.schema[page_id].dataType.simpleString()
    schema = f"page_id {kind}, host string, path string, rule string, verdict string, strict_hits bigint, soft_hits bigint, weight double"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known, words = RuleSet(rules), Vocabulary(strict, soft, soft_limit, soft_weight)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for u in batch.column(1).to_pylist():
                host, path = split_url(u)
                found = known.find(host, path)
                a, b = words.hits(u)
                row = (host, path, found and found[0], found[1] if found else "block" if words.blocks(a, b) else "allow", len(a), len(b), words.weight(b))
                for col, v in zip(out, row):
                    col.append(v)
            kinds = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names=["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits", "weight"])

    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: host, path, rule and verdict of every page."""
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits", F.round("weight", 6).alias("soft_weight"))


def _counted(terms) -> str:
    """The sum of the weights of the terms that stand in `u` between boundaries."""
    return " + ".join(f"(CASE WHEN regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') THEN {w} ELSE 0 END)" for t, w in dict(terms).items())


ORACLE = f"""
WITH a AS (
  SELECT page_id, lower(coalesce(url, '')) AS u,
    CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), b AS (
  SELECT page_id, u, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM a
), c AS (
  SELECT *, '.' || host AS h, ({_counted({t: 1 for t in STRICT})})::BIGINT AS strict_hits, ({_counted({t: 1 for t in SOFT})})::BIGINT AS soft_hits, ({_counted(SOFT)})::DOUBLE AS soft_weight FROM b
), d AS (
  SELECT *, CASE
    WHEN h LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN h LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN h LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN h LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN h LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
  FROM c
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN strict_hits >= 1 OR (soft_hits >= {SOFT_LIMIT} AND soft_weight >= {SOFT_WEIGHT}) THEN 'block' ELSE 'allow' END AS verdict, strict_hits, soft_hits, round(soft_weight, 6) AS soft_weight
FROM d
"""
