"""Byte-level BPE (8): encoding by monoid tree reduction, decoding by concatenation up the tree.

A text is the concatenation of its pattern matches, each encoded by itself. A long match is encoded by halves: the
two token lists are joined by encoding a window around the seam anew, and the window grows on each side until the
token just outside it and the first one inside stay two tokens when encoded together. A list whose neighbours all
have this property is the encoding of its bytes, so all tokens outside the window are settled. A run of one sign or of
a short pattern never settles, as its tokens stand by its start: a window that has to cover both sides of a long seam
tells so, and such a match is merged whole, by a queue of its pairs. Encodings of short matches are kept in a bounded
memory; the vocabulary's path is a parameter.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm.common import plain_columns, table

#: Byte strings up to this length are merged directly; longer ones are halved.
LEAF = 32
#: Tokens of either side in the first window.
FIRST_WINDOW = 2
#: A seam whose window covers both sides whole, so many bytes or more, doesn't settle.
HOPELESS = 1024
#: Matches up to REMEMBER bytes are kept, CACHE of them in a worker at most.
REMEMBER, CACHE = 48, 300_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Unsettled(Exception):
    """A seam at which no window short of the whole settles."""


class TreeBPE:
    """The encoding of byte strings under a table of ranks."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF):
        self.ranks, self.leaf = ranks, leaf
        self.text = {v: k for k, v in ranks.items()}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}

    def merge(self, b: bytes) -> list[bytes]:
        """Direct encoding: again and again the pair of lowest rank, the leftmost of equals, becomes one."""
        parts = [b[i : i + 1] for i in range(len(b))]
        rank, none = self.ranks.get, 1 << 60
        low = [rank(b[i : i + 2], none) for i in range(len(b) - 1)]  # of each part with the next one
        while low:
            r = min(low)
            if r == none:
                break
            at = low.index(r)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del low[at]
            if at:
                low[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(low):
                low[at] = rank(parts[at] + parts[at + 1], none)
        return parts

    def merge_queued(self, b: bytes) -> list[bytes]:
        """Direct encoding like `merge`, with the pairs in a queue by rank and place: for strings of any length."""
        n, rank = len(b), self.ranks.get
        end = list(range(1, n + 1))  # of the part that begins at a place
        begin = list(range(n))  # of the part that ends before the next place
        alive = [True] * n
        queue = [(r, i) for i in range(n - 1) if (r := rank(b[i : i + 2])) is not None]
        heapify(queue)

        def offer(i: int, j: int) -> None:
            r = rank(b[i:j])
            if r is not None:
                heappush(queue, (r, i))

        while queue:
            r, i = heappop(queue)
            mid = end[i]
            if not alive[i] or mid >= n or rank(b[i : end[mid]]) != r:
                continue  # one of the two parts has changed since
            stop = end[mid]
            alive[mid], end[i], begin[stop - 1] = False, stop, i
            if i:
                offer(begin[i - 1], stop)
            if stop < n:
                offer(i, end[stop])
        return [b[i : end[i]] for i in range(n) if alive[i]]

    def settled(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens side by side stay two tokens."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 50_000:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return known

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of the concatenation of two encoded strings."""
        if not left or not right:
            return left + right
        if self.settled(left[-1], right[0]):
            return left + right
        i, j = min(FIRST_WINDOW, len(left)), min(FIRST_WINDOW, len(right))
        while True:
            window = b"".join(left[len(left) - i :] + right[:j])
            if i == len(left) and j == len(right) and len(window) >= HOPELESS:
                raise Unsettled
            mid = self.merge(window) if len(window) <= 2 * self.leaf else self.merge_queued(window)
            grow_left = i < len(left) and not self.settled(left[-i - 1], mid[0])
            grow_right = j < len(right) and not self.settled(mid[-1], right[j])
            if not grow_left and not grow_right:
                return left[: len(left) - i] + mid + right[j:]
            i, j = min(len(left), i + i * grow_left), min(len(right), j + j * grow_right)

    def tokens(self, b: bytes) -> list[bytes]:
        if len(b) <= self.leaf:
            return self.merge(b)
        half = len(b) // 2
        return self.join(self.tokens(b[:half]), self.tokens(b[half:]))

    def encode(self, b: bytes) -> list[int]:
        """The ids of one match; a match that is itself in the vocabulary is one token."""
        known = self.ranks.get(b)
        if known is not None:
            return [known]
        try:
            tokens = self.tokens(b)
        except Unsettled:
            tokens = self.merge_queued(b)
        return [self.ranks[t] for t in tokens]

    def decode(self, ids: list[int]) -> bytes:
        """Halves are decoded and concatenated; the leaves are the tokens' bytes."""
        if len(ids) <= 64:
            return b"".join(map(self.text.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class TextCodec:
    """Texts to ids and back, with what short matches became kept as (ids as text, number, decoded bytes)."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        self.bpe = TreeBPE(load_ranks(ranks_path))
        self.split = regex.compile(pattern).findall
        self.seen: dict[str, tuple[str, int, bytes]] = {}

    def piece(self, s: str) -> tuple[str, int, bytes]:
        out = self.seen.get(s)
        if out is None:
            ids = self.bpe.encode(s.encode())
            out = " ".join(map(str, ids)), len(ids), self.bpe.decode(ids)
            if len(s) <= REMEMBER:
                if len(self.seen) >= CACHE:
                    self.seen.clear()
                self.seen[s] = out
        return out

    def encode(self, text: str) -> list[int]:
        return [i for s in self.split(text) for i in self.bpe.encode(s.encode())]

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, ids joined by blanks, decoded bytes as text's hash."""
        get, piece = self.seen.get, self.piece
        parts = [get(s) or piece(s) for s in self.split(text)]
        ids = " ".join([p[0] for p in parts])
        n = sum([p[1] for p in parts])
        return n, ids, hashlib.sha256(b"".join([p[2] for p in parts])).hexdigest()


@lru_cache(maxsize=1)
def codec_of(ranks_path: str, pattern: str) -> TextCodec:
    """The codec of a worker, which keeps what it has learned from one task to the next."""
    return TextCodec(ranks_path, pattern)


def default_vocabulary() -> tuple[str, str]:
    """Path of the ranks and the pattern of the public 50k vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, text: str = "text", vocabulary: tuple[str, str] | None = None, with_ids: bool = True) -> DataFrame:
    """`docs` with n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array<int>).

    The vocabulary is the path of its ranks on every executor, and its pattern. A null text is empty and has no
    tokens. Each row is encoded by itself; repeated rows agree; an empty table stays empty; columns of the added
    names are replaced, others pass through.
    """
    path, pattern = vocabulary or default_vocabulary()
    added = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    keep = [c for c in docs.columns if c not in added]
    own, named = plain_columns(docs.select(*[F.col(f"`{c}`") for c in keep]))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema) + ", n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    texts, columns = f"c{keep.index(text)}", list(own.columns)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = codec_of(path, pattern)
        for batch in batches:
            n, hashes, decoded, all_ids = [], [], [], []
            for t in batch.column(texts):
                count, ids, back = codec.digest(t.as_py() or "")
                n.append(count)
                hashes.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(back)
                if with_ids:
                    all_ids.append([int(x) for x in ids.split()])
            more = [pa.array(n, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())] + [pa.array(all_ids, pa.list_(pa.int32()))] * with_ids
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*columns, *added])

    return named(own.mapInArrow(run, schema))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: number and digest of every document's tokens, and digest of their decoding."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, with_ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
