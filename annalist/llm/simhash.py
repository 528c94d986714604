"""SimHash near-dedup (5): fingerprints linked by meet-in-the-middle ball hashing, and their components.

Two fingerprints within RADIUS = 4 bits have a fingerprint in the middle, within 2 of both: if each emits all its
variants within half the radius, they collide, and as any two that share a variant are within 4 bits, one link from
each to the smallest of the bucket keeps the links' components without any pairs.

A full ball has 1 + 64 + 2016 = 2081 variants (33 kB of shuffle a fingerprint), so a sieve of the same kind runs
first. The 64 bits fall into three parts; of at most 4 differing bits some part has two or more, so some union of
two parts differs in at most 2. On each union every fingerprint emits its variants within 1 bit (44 or 43; 132 in
all) and those that share a bucket with another one are verified: in a bucket of at most SMALL fingerprints pair by
pair in memory (only links leave it, one or none for each fingerprint and component of the bucket), while the
members of larger buckets, where pairs would grow with the square, emit their full ball.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annalist.llm.common import Scratch, components, files_for, fresh, table

RADIUS = 4
SHINGLE = 4
#: The low bits of the three parts.
PARTS = (0, 21, 42, 64)
SMALL = 64


def fingerprint_of(text: str | None, size: int = SHINGLE) -> int:
    """Bits set in over half of the shingles' XXH64 (seed 42), unsigned; 0 without words."""
    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < size:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[: len(words) - size])]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], 42) for a, b in zip(starts, ends[size - 1 :])], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(h), 1 << 16):
        counts += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: str | None = None) -> DataFrame:
    """(doc_id, fp bigint) of every row, and its `key`, a bigint column, if given; the fingerprint's bits as a signed number."""
    more = [key] if key else []

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fps = np.array([fingerprint_of(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names=["doc_id", "fp", *more])

    schema = "doc_id bigint, fp bigint" + "".join(f", `{c}` bigint" for c in more)
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), *more).mapInArrow(run, schema)


def _variants(masks, fps):
    """All of fps XOR masks, and the fps they come from."""
    import numpy as np

    return (fps[:, None] ^ masks[None, :]).ravel(), np.repeat(fps, len(masks))


def _emit(kind: str, slots: int):
    """A function for mapInArrow from (fp) to (slot, data): variants and their fingerprints packed by the slot they go to."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        one = np.uint64(1)
        bits = np.array([one << np.uint64(k) for k in range(64)], dtype=np.uint64)
        jobs = []
        if kind == "ball":
            i, j = np.triu_indices(64, 1)
            jobs.append((None, np.concatenate([np.zeros(1, np.uint64), bits, bits[i] | bits[j]]), np.uint64(0)))
        else:
            for k in range(3):  # the union without part k
                inside = np.array([not PARTS[k] <= b < PARTS[k + 1] for b in range(64)])
                union = np.bitwise_or.reduce(bits[inside])
                jobs.append((union, np.concatenate([np.zeros(1, np.uint64), bits[inside]]), bits[PARTS[k]]))
        chunk = max(1, 1_000_000 // sum(len(m) for _, m, _ in jobs))
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for c in range(0, len(all_fps), chunk):
                fps = all_fps[c : c + chunk]
                keys, origin = [], []
                for union, masks, tag in jobs:
                    v, o = _variants(masks, fps)
                    # a union's lowest free bit marks it; where two unions meet all the same, the check tells
                    keys.append(v if union is None else (v & union) | tag)
                    origin.append(o)
                keys, origin = np.concatenate(keys), np.concatenate(origin)
                slot = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(slots)
                order = np.argsort(slot, kind="stable")
                keys, origin, slot = keys[order], origin[order], slot[order]
                ids, first = np.unique(slot, return_index=True)
                ends = [*first[1:], len(slot)]
                data = [np.concatenate([keys[a:b], origin[a:b]]).tobytes() for a, b in zip(first, ends)]
                yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(data, pa.binary())], names=["slot", "data"])

    return run


def _buckets(table_):
    """(keys, fps) of a slot, sorted and without repeats, and where each key that two or more share begins and ends."""
    import numpy as np

    blocks = [np.frombuffer(b.as_buffer(), dtype=np.uint64).reshape(2, -1) for b in table_.column("data").combine_chunks()] if table_.num_rows else []
    if not blocks:
        return None
    both = np.concatenate(blocks, axis=1)
    order = np.lexsort((both[1], both[0]))
    keys, fps = both[0][order], both[1][order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (fps[1:] != fps[:-1])
    keys, fps = keys[new], fps[new]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    ends = np.concatenate([starts[1:], [len(keys)]])
    many = ends - starts > 1
    return fps, starts[many], ends[many]


_LINKS = "a bigint, b bigint, dense boolean"


def _verify(table_):
    """Links of a sieve's slot: (a, b, false); members of a large bucket: (a, a, true)."""
    import numpy as np
    import pyarrow as pa

    found = _buckets(table_)
    a, b, dense = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, bool)]
    if found is not None:
        fps, starts, ends = found
        sizes = ends - starts
        for size in np.unique(sizes[sizes <= SMALL]):  # all buckets of one size at once
            at = starts[sizes == size]
            for c in range(0, len(at), max(1, 200_000 // int(size) ** 2)):
                x = fps[at[c : c + max(1, 200_000 // int(size) ** 2), None] + np.arange(size)]
                near = np.bitwise_count(x[:, :, None] ^ x[:, None, :]) <= RADIUS
                # each fingerprint links to the first one of the bucket that is near it; and every near pair that
                # this leaves in different stars links the two stars' heads through the pair itself
                head = near.argmax(axis=2)
                k, i = np.nonzero(head != np.arange(size))
                a.append(x[k, i])
                b.append(x[k, head[k, i]])
                apart = near & (head[:, :, None] != head[:, None, :]) & (np.arange(size)[:, None] > np.arange(size)[None, :])
                k, i, j = np.nonzero(apart)
                if len(k):  # one link for two heads
                    pair = np.stack([k, head[k, i], head[k, j]], axis=1)
                    _, once = np.unique(pair, axis=0, return_index=True)
                    a.append(x[k[once], i[once]])
                    b.append(x[k[once], j[once]])
        dense = [np.zeros(sum(map(len, a)), bool)]
        large = sizes > SMALL
        if large.any():
            members = np.unique(np.concatenate([fps[s:e] for s, e in zip(starts[large], ends[large])]))
            a.append(members)
            b.append(members)
            dense.append(np.ones(len(members), bool))
    return pa.table({"a": pa.array(np.concatenate(a).view(np.int64)), "b": pa.array(np.concatenate(b).view(np.int64)), "dense": pa.array(np.concatenate(dense))})


def _stars(table_):
    """Links of a slot of full balls: every member of a bucket to its smallest."""
    import numpy as np
    import pyarrow as pa

    found = _buckets(table_)
    if found is None:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "dense": pa.array([], pa.bool_())})
    fps, starts, ends = found
    sizes = ends - starts
    inside = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    pairs = np.unique(np.stack([fps[inside], np.repeat(fps[starts], sizes)], axis=1), axis=0)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pa.table({"a": pa.array(pairs[:, 0].copy().view(np.int64)), "b": pa.array(pairs[:, 1].copy().view(np.int64)), "dense": pa.array(np.zeros(len(pairs), bool))})


def fingerprint_links(spark: SparkSession, fps: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links whose components are those of all pairs of different fingerprints within RADIUS bits.

    Slots of the sieve hold about 20,000 fingerprints' share of the variants, so a slot's arrays stay within some
    tens of MB whatever the table's size.
    """
    n = fps.count()
    slots = max(8, -(-n // 1_500))
    fps = fps.repartition(max(8, min(slots, -(-n // 5_000))), "fp")
    sieve = fps.mapInArrow(_emit("sieve", slots), "slot bigint, data binary")
    links = scratch.save(sieve.groupBy("slot").applyInArrow(_verify, _LINKS), "sieve-links")
    dense = links.where("dense").select(F.col("a").alias("fp")).distinct()
    m = dense.count()
    out = links.where("NOT dense").select("a", "b")
    if m:
        wide = max(8, -(-m // 100))
        balls = dense.repartition(max(8, min(wide, -(-m // 500))), "fp").mapInArrow(_emit("ball", wide), "slot bigint, data binary")
        more = scratch.save(balls.groupBy("slot").applyInArrow(_stars, _LINKS), "ball-links")
        out = out.unionAll(more.select("a", "b"))
    return out.distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: str | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, fp (bigint), component_id, and its `key`, a bigint column, if given.

    component_id is the smallest doc_id that links reach, itself included. Texts without words (null, blank) have
    fingerprint 0 and are linked like others. Exact copies share a fingerprint and count once in the search. Rows
    that repeat a doc_id are linked each by its own text, and such a doc_id takes the smallest component_id of its
    rows only through links. A null doc_id joins its group but never names it; alone it has a null component_id.
    Other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(spark)
    own = scratch.save(fingerprints(docs, doc_id, text, key), "fingerprints")
    first = scratch.save(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    links = fingerprint_links(spark, first.select("fp"), scratch)
    roots = components(spark, links, scratch)
    named = first.join(roots, first.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = scratch.save(named.coalesce(files_for(first.count())), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "r")
    by_fp = named.join(least, named.root == least.r).select(F.col("fp").alias("f"), "component_id")
    return own.join(by_fp, own.fp == by_fp.f).select("doc_id", "fp", "component_id", *([key] if key else []))


def keep_first(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that name their component, one of each group. Of rows that repeat a doc_id one stays.

    Where a doc_id repeats with different texts, the row stays whose own text's component it names; of several the one
    of the smallest text hash, of rows with one text the first by their JSON. Rows of a null doc_id have no name to
    choose by and stay.
    """
    keep, keep_key, key, rank = fresh(docs, "keep_id", "keep_key", "text_key", "keep_rank")
    named = docs.where("doc_id IS NOT NULL")
    ids = named.agg(F.count("doc_id").alias("n"), F.count_distinct("doc_id").alias("d")).first()
    if ids["n"] == ids["d"]:
        heads = near_duplicates(spark, named).where("doc_id = component_id").select(F.col("doc_id").alias(keep)).distinct()
        out = docs.join(heads.hint("merge"), docs.doc_id == heads[keep], "left_semi")
    else:
        named = named.withColumn(key, F.xxhash64("text"))
        heads = near_duplicates(spark, named, key=key).where("doc_id = component_id")
        heads = heads.groupBy(F.col("doc_id").alias(keep)).agg(F.min(key).alias(keep_key))
        out = named.join(heads.hint("merge"), (named.doc_id == heads[keep]) & (named[key] == heads[keep_key]), "left_semi").drop(key)
        first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))))
        out = out.withColumn(rank, first).where(F.col(rank) == 1).drop(rank)
    return out.unionByName(docs.where("doc_id IS NULL"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: fingerprint and component of every document."""
    out = near_duplicates(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
