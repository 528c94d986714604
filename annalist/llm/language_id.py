"""Language ID (9): rank-order profiles of the most frequent character n-grams, compared by out-of-place distance.

Learning counts the n-grams of every training text: each task codes letters as numbers, counts the codes in arrays,
and sends (lang, n-gram, count); Spark adds them up and ranks them. Only the profiles, TOP rows for a
language, reach the driver. Prediction is a narrow Arrow stage.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annalist.llm.common import fresh, plain_columns, table

#: N-gram lengths, length of a language's profile, and of a document's.
SIZES = (1, 2, 3)
TOP = 400
DOC_TOP = 300
#: A document whose best distance is over this share of the largest possible one looks like no learned language. Held-out
#: documents of the learned languages reach 0.52 (sf0.01); Finnish, Polish, Vietnamese and random letters begin at 0.75.
REJECT = 0.65
#: Characters counted at once, and the largest table of n-gram codes; with more letters codes are sorted instead.
CHUNK, TABLE = 1_000_000, 1 << 22


@cache
def _letters():
    """For every code point, whether it is a letter."""
    import numpy as np

    return np.array([chr(c).isalpha() for c in range(0x110000)])


def letter_codes(text: str):
    """The code points of the lower-cased letters, every run of other characters as one 0, a 0 at both ends."""
    import numpy as np

    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), dtype=np.uint32)
    c = np.where(_letters()[c], c, 0)
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    return c[keep]


def _grams(ids, size: int, base: int):
    """The code of every n-gram, a number in base `base`; those with a blank inside or alone are left out."""
    import numpy as np

    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    code, ok = np.zeros(n, dtype=np.int64), ids[:n] != 0 if size == 1 else np.ones(n, dtype=bool)
    for k in range(size):
        part = ids[k : k + n]
        code = code * base + part
        if 0 < k < size - 1:
            ok &= part != 0
    if size == 2:
        ok &= (ids[:n] != 0) | (ids[1:] != 0)
    return code[ok]


def count_grams(text: str) -> Counter:
    """The n-grams of all words of a text, between blanks."""
    import numpy as np

    out: Counter = Counter()
    points = letter_codes(text)
    alphabet = np.unique(points)
    ids, base = np.searchsorted(alphabet, points), len(alphabet)
    for size in SIZES:
        codes = _grams(ids, size, base)
        if base**size <= TABLE:
            counts = np.bincount(codes, minlength=1)
            found = np.flatnonzero(counts)
            counts = counts[found]
        else:
            found, counts = np.unique(codes, return_counts=True)
        chars = [chr(c) if c else " " for c in alphabet]
        digits = [found // base ** (size - 1 - k) % base for k in range(size)]
        for *ds, n in zip(*(d.tolist() for d in digits), counts.tolist()):
            out["".join(chars[d] for d in ds)] += n
    return out


def learn_profiles(spark: SparkSession, docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> dict[str, dict[str, int]]:
    """n-gram -> rank (from 0) for every non-null lang; ties of frequency by the n-gram.

    Every training text is counted, whole. A task counts its texts by language in chunks and sends sums.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total: dict[str, Counter] = {}
        for batch in batches:
            waiting: dict[str, list[str]] = {}
            length: Counter = Counter()
            for t, k in zip(batch.column(0), batch.column(1).to_pylist()):
                t = t.as_py()
                waiting.setdefault(k, []).append(t)
                length[k] += len(t)
                if length[k] >= CHUNK:
                    total.setdefault(k, Counter()).update(count_grams(" ".join(waiting.pop(k))))
                    length[k] = 0
            for k, texts in waiting.items():
                total.setdefault(k, Counter()).update(count_grams(" ".join(texts)))
            if sum(map(len, total.values())) > CHUNK:
                yield from (_batch(pa, k, c) for k, c in total.items())
                total = {}
        yield from (_batch(pa, k, c) for k, c in total.items())

    train = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counted = train.mapInArrow(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1).where(F.col("rank") < top)
    out: dict[str, dict[str, int]] = {}
    for r in ranked.select("lang", "gram", "rank").collect():  # top rows for a language
        out.setdefault(r["lang"], {})[r["gram"]] = r["rank"]
    return out


def _batch(pa, lang: str, grams: Counter):
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], names=["lang", "gram", "n"])


class Judge:
    """Out-of-place distances of a text to the profiles.

    A text's own most frequent n-grams are ranked as the profiles are; one that a profile lacks is as far as can be.
    """

    def __init__(self, profiles: dict[str, dict[str, int]], doc_top: int = DOC_TOP):
        import numpy as np

        self.np, self.top = np, doc_top
        self.langs = sorted(profiles)
        grams = sorted({g for p in profiles.values() for g in p})
        self.missing = max((len(p) for p in profiles.values()), default=0)
        # the last column is any n-gram that no profile has
        self.ranks = np.array([[*(profiles[k].get(g, -1) for g in grams), -1] for k in self.langs]).reshape(len(self.langs), len(grams) + 1)
        letters = sorted({c for g in grams for c in g if c != " "})
        self.base = len(letters) + 2  # 0 is the blank, the last any other letter
        self.ids = np.where(_letters(), self.base - 1, 0).astype(np.int64)
        for k, c in enumerate(letters):
            self.ids[ord(c)] = k + 1
        place = {" ": 0} | {c: k + 1 for k, c in enumerate(letters)}
        self.known = []
        for size in SIZES:
            own = sorted((sum(place[c] * self.base ** (size - 1 - k) for k, c in enumerate(g)), i) for i, g in enumerate(grams) if len(g) == size)
            self.known.append(tuple(np.array([x[k] for x in own], dtype=np.int64) for k in (0, 1)))

    def _own(self, points):
        """Counts of a text's n-grams, numbers that sort as the n-grams do, and their columns of `ranks`."""
        np = self.np
        alphabet = np.unique(points)
        ids, base = np.searchsorted(alphabet, points), len(alphabet)
        counts, keys, columns = [], [], []
        for size, (codes, where) in zip(SIZES, self.known):
            own = _grams(ids, size, base)
            if base**size <= min(TABLE, 8 * len(own)):
                n = np.bincount(own, minlength=1)
                found = np.flatnonzero(n)
                n = n[found]
            else:
                found, n = np.unique(own, return_counts=True)
            key, code = np.zeros(len(found), dtype=np.int64), np.zeros(len(found), dtype=np.int64)
            for k in range(max(SIZES)):
                key *= base + 1
                if k < size:
                    digit = found // base ** (size - 1 - k) % base
                    key += digit + 1
                    code = code * self.base + self.ids[alphabet[digit]]
            column = np.full(len(found), self.ranks.shape[1] - 1)
            if len(codes):
                at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                column = np.where(codes[at] == code, where[at], column)
            counts.append(n)
            keys.append(key)
            columns.append(column)
        return np.concatenate(counts), np.concatenate(keys), np.concatenate(columns)

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, distance as a share of the largest possible one)."""
        np = self.np
        points = letter_codes(text) if text else ()
        if len(points) < 2 or not self.langs:
            return "und", 0.0, 1.0
        counts, keys, columns = self._own(points)
        order = np.lexsort((keys, -counts))[: self.top]
        ranks = self.ranks[:, columns[order]]
        if not (ranks >= 0).any():
            return self.langs[0], 0.0, 1.0
        far = np.where(ranks >= 0, np.minimum(np.abs(ranks - np.arange(len(order))), self.missing), self.missing).sum(axis=1)
        most, by = self.missing * len(order), np.argsort(far, kind="stable")
        second = int(far[by[1]]) if len(by) > 1 else most
        best = int(far[by[0]])
        return self.langs[by[0]], min(1.0, max(0.0, (second - best) / second)) if second else 0.0, best / most


def predict(docs: DataFrame, profiles: dict[str, dict[str, int]], text: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "distance")) -> DataFrame:
    """`docs` with three columns more: language (`und` for null texts and texts without a letter), score, distance.

    score: the margin of the nearest profile over the next, 0 to 1; ties go to the first language by name. Every row
    is judged by its text alone, so repeated rows agree; an empty table stays empty. Columns of these names are
    replaced, the others pass through.
    """
    keep = [c for c in docs.columns if c not in names]
    own, named = plain_columns(docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col(text)])))
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in own.schema)}, {names[0]} string, {names[1]} double, {names[2]} double"
    columns, texts = list(own.columns), f"c{keep.index(text) if text in keep else len(keep)}"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        judge = Judge(profiles)
        for batch in batches:
            got = [judge(t.as_py()) for t in batch.column(texts)]
            more = [pa.array([g[k] for g in got], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*columns, *names])

    return named(own.mapInArrow(run, schema))


def held_out(doc_id):
    """crc32 of the doc_id as text, mod 4, is 2; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def filter_languages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that look like a learned language: not `und`, and within REJECT of the largest distance."""
    profiles = learn_profiles(spark, docs.where(~held_out("doc_id")))
    names = tuple(fresh(docs, "lang_pred", "lang_score", "lang_distance"))
    return predict(docs, profiles, names=names).where((F.col(names[0]) != "und") & (F.col(names[2]) <= REJECT)).drop(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = learn_profiles(spark, docs.where(~held_out("doc_id")))
    out = predict(docs.select("doc_id", "text", held_out("doc_id").alias("held_out")), profiles)
    return out.select("doc_id", "held_out", "lang_pred", F.round("score", 6).alias("score"))
