"""The queries themselves on a small folder of tables, held against plain versions, and the pipeline on odd tables."""

import hashlib
import random
import zlib
from collections import Counter

import pytest

from annalist.llm import registry
from tests.llm.conftest import EDGES
from tests.llm.test_corpus_ops import ENGLISH, FRENCH, groups, plain_distance, plain_fingerprint, plain_leaks, plain_line_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "When Anna has 10 apples and buys 4 more at the old market, how many apples does she have at last"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    rng = random.Random(21)
    d = str(tmp_path_factory.mktemp("small"))
    words = {"en": ENGLISH.split(), "fr": FRENCH.split()}
    rows = [(1000 + k, t, lang, s, 0) for k, (_, t, lang, s) in enumerate(EDGES) if lang != "xx"]
    for k in range(70):
        lang = ("en", "fr")[k % 2]
        t = " ".join(rng.choice(words[lang]) for _ in range(rng.randint(3, 90)))
        if k % 9 == 0:
            t += " " + (ITEM if k % 2 else ITEM.replace("10", "12").replace("Anna", "Lea"))
        rows.append((k, t, lang, "s", len(t)))
    rows += [(200 + k, rows[len(rows) - 1 - k][1], "en", "s", 0) for k in range(5)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, {r[0]: r for r in rows}


def test_simhash_query(spark, small):
    d, rows = small
    ids = sorted(rows)
    fps = [plain_fingerprint(rows[i][1]) for i in ids]
    roots = groups(fps)
    least = {}
    for i, r in zip(ids, roots):
        least[r] = min(i, least.get(r, i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in registry.QUERIES["op5_simhash"](spark, d).collect()}
    assert got == {i: (f"{f:016x}", least[r]) for i, f, r in zip(ids, fps, roots)}


def test_decontaminate_query(spark, small):
    d, rows = small
    got = {(r.doc_id, r.item_id): r.exact for r in registry.QUERIES["op6_decontaminate"](spark, d).collect()}
    assert got == {(i, 1): x[1] for i in rows if (x := plain_leaks(rows[i][1], ITEM))}
    assert set(got.values()) == {True, False}


def test_line_dedup_query(spark, small):
    d, rows = small
    want = {i: (n, gone, sha(t)) for i, t, n, gone in plain_line_dedup([(r[0], r[1]) for r in rows.values()])}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in registry.QUERIES["op3_line_dedup"](spark, d).collect()} == want


def test_bpe_query(spark, small):
    import base64

    import public_tokenizers as p
    import tiktoken

    d, rows = small
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(p.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in registry.QUERIES["op8_bpe"](spark, d).collect()}
    for i, r in rows.items():
        ids = library.encode_ordinary(r[1] or "")
        assert got[i] == (len(ids), sha(" ".join(map(str, ids))), sha(r[1] or ""))


def test_language_query(spark, small):
    from tests.llm.test_corpus_ops import grams_of

    import re

    d, rows = small
    counts = {}
    for i, t, lang, *_ in rows.values():
        if t is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            counts.setdefault(lang, Counter()).update(g for w in re.findall(r"[^\W\d_]+", t.lower()) for g in grams_of(w))
    from annalist.llm.language_id import TOP

    profiles = {k: {g: n for n, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:TOP])} for k, c in counts.items()}
    for r in registry.QUERIES["op9_language_id"](spark, d).collect():
        t = rows[r.doc_id][1]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if not re.search(r"[^\W\d_]", t or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        far = plain_distance(t, profiles)
        best, second = sorted(far.values())[:2]
        assert far[r.lang_pred] == pytest.approx(best) and r.score == pytest.approx((second - best) / second if second else 0.0, abs=2e-6)


def test_pipeline_of_odd_tables(spark, tmp_path):
    import corpus_pipeline

    kinds = "doc_id long, text string, lang string, source string, n_chars long, keep_id int, lang_pred string, leaks int, `a.b` int"
    spark.createDataFrame([(1, ITEM), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/full/benchmark.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    rows = [(k, ENGLISH * 2 + f"number {k} of the day " * (k % 3), "en", "s", 1, 1, "x", 2, 3) for k in range(12)] + [(None, FRENCH, "fr", None, None, None, None, None, None), (None, FRENCH, "fr", None, None, None, None, None, None), (50, ITEM + " " + FRENCH, "fr", "s", 1, 1, "x", 2, 3)]
    spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/full/documents.parquet")
    spark.createDataFrame([], kinds).write.parquet(f"{tmp_path}/none/documents.parquet")
    got = sorted((r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/full").collect()), key=str)
    assert got.count(None) == 2 and 50 not in got and 0 in got
    docs = spark.read.parquet(f"{tmp_path}/full/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, f"{tmp_path}/full")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "keep_id", "lang_pred", "leaks", "a.b"]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_chat_of_many_turns(spark):
    from annalist.llm import chat_format

    rows = [(1, k, ("user", "assistant", "assistant")[k % 3], f"t{k} </s>", 1, 2) for k in range(3000)] + [(2, None, "user", "b", 1, 2), (2, None, "user", "a", 1, 2), (None, 1, None, None, 1, 2)]
    rows += [(3, None, ("user", "assistant")[k % 2], f"{'abc'[k % 3]}\\{k:03d}", 1, 2) for k in range(200)] + [(3, 0, "user", "first with a turn", 1, 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int, n_turns int")
    out = {r.conv_id: r for r in chat_format.format_conversations(df).select("conv_id", "n_turns", chat_format.parse_formatted(chat_format.F.col("formatted")).alias("t")).collect()}
    assert out[1].n_turns == 3000 and [(x.role, x.text) for x in out[1].t] == [(r[2], r[3]) for r in rows[:3000]]
    bare = sorted((r[2], r[3]) for r in rows if r[0] == 3 and r[1] is None)
    assert [(x.role, x.text) for x in out[3].t] == [*bare, ("user", "first with a turn")]
    assert [x.text for x in out[2].t] == ["a", "b"] and [(x.role, x.text) for x in out[None].t] == [("", "")]
