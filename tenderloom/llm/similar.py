"""Near-duplicates by Jaccard similarity of word shingles: MinHash bands, then exact verification.

A text is the set of its lower-cased (A-Z) five-word shingles. Each of ``BANDS`` bands hashes ``ROWS`` of the minima of
``MINIMA`` hash functions to one key, its own choice of them. A pair of similarity 0.8 misses all keys with a chance of about
0.001, a more similar one with less; one of 0.6, 0.5 or 0.4, as in a family that only shares a passage, meets with about
0.45, 0.1 or 0.02 and is seldom compared. Texts are first reduced to distinct sets, so copies cost nothing.

No bucket is compared pair by pair at once. First every member is verified against one centre of each of its
buckets, the member that meets most others; the components of these links make a large family one component. What is left in a bucket are
members of different components: they are compared in blocks by sketches of their least hashes (whole sets of up to 1,024
shingles), and what looks near is verified as well, so the components are those of all pairs that share a key and pass,
but for a chance of 3e-5 that the sketches of longer texts mislead. The work of this step grows with the square of a bucket
only as far as its members are no near copies of one another; its rows do not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import first_of_components, text_digest
from .components import connected_components

SEED, SHINGLE, SIMILARITY = 42, 5, 0.8
MINIMA, BANDS, ROWS = 160, 64, 9
#: Least hashes of a set that are compared before its text is: sets of no more are compared whole. Of two sketches the
#: share below which a pair is given up, for whole sets and for cut ones (four deviations under 0.8). Members in a unit of work.
SKETCH, WHOLE_SHARE, CUT_SHARE, BLOCK = 1024, 0.795, 0.75, 512


def shingles(text: str | None, shingle: int = SHINGLE):
    """Sorted distinct hashes of the shingles; a text of fewer words is one shingle, one without words has none."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    start = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=start[1:])
    n, digest = max(1, len(words) - shingle + 1), xxhash.xxh64_intdigest
    ends = (start[min(shingle, len(words)):] - 1).tolist()
    return np.unique(np.fromiter((digest(line[a:b], SEED) for a, b in zip(start[:n].tolist(), ends)), np.uint64, n))


@lru_cache(1)
def _functions():
    import numpy as np

    shift, factor = np.random.default_rng(SEED + MINIMA).integers(0, 2**63, (2, MINIMA), dtype=np.uint64)
    return shift[:, None], factor[:, None] * np.uint64(2) + np.uint64(1)


def minima(hashes):
    """The least value of each hash function over a set that is not empty."""
    import numpy as np

    shift, factor = _functions()
    least = np.full(MINIMA, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 256):
        x = (hashes[None, at:at + 256] ^ shift) * factor
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, x.min(axis=1), out=least)
    return least


@lru_cache(1)
def _bands():
    import numpy as np

    random = np.random.default_rng(SEED)
    return random.integers(0, 2**63, BANDS, dtype=np.uint64), np.stack([random.choice(MINIMA, ROWS, replace=False) for _ in range(BANDS)])


def band_keys(hashes):
    """One signed 64-bit key for each band of a set that is not empty."""
    import numpy as np

    mix, chosen = _bands()
    key = mix.copy()
    for row in minima(hashes)[chosen].T:
        key = (key ^ row) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def similarity(a, b) -> float:
    """Jaccard similarity of two sorted sets; 1 for two empty ones."""
    import numpy as np

    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _sketches(docs: DataFrame) -> DataFrame:
    """``content`` (digest of the set), ``n`` (its size) and ``bands`` for every row."""
    @F.pandas_udf("content binary, n int, bands array<long>")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import hashlib

        for texts in batches:
            sets = [shingles(t) for t in texts]
            yield pd.DataFrame({"content": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], "n": [len(s) for s in sets],
                                "bands": [band_keys(s) if len(s) else [] for s in sets]})

    return docs.select("doc_id", text_digest("text").alias("digest"), sketch("text").alias("s")).select("doc_id", "digest", "s.*")


def _texts(wanted: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and ``text`` of the wanted nodes; copies of a row have one text."""
    needed = nodes.join(wanted, "node", "left_semi").select("node", "first.*")
    texts = docs.select("doc_id", text_digest("text").alias("digest"), "text").join(needed, ["doc_id", "digest"])
    return texts.groupBy("node").agg(F.min("text").alias("text"))


def shares(sketch, limit, flat, starts, limits):
    """Similarity of one set to others by their sketches: exact for whole ones, else over hashes that both sketches reach.

    ``flat`` holds the sorted sketches of the others one after the other from ``starts``; a limit is the last hash of a cut
    sketch, the largest number for a whole one.
    """
    import numpy as np

    at = np.minimum(np.searchsorted(sketch, flat), len(sketch) - 1)
    both = np.add.reduceat(sketch[at] == flat, starts, dtype=np.int64)
    theirs = np.add.reduceat(flat <= limit, starts, dtype=np.int64)
    own = np.searchsorted(sketch, limits, side="right")
    return both / np.maximum(1, own + theirs - both)


def _alike(open_: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of different parts that share a bucket and look near by sketches of their least hashes.

    The members of a bucket are dealt into blocks; a unit of work is a pair of blocks, compares those outside
    the main part with all others and returns only what passes, so a large bucket is spread and no pair that fails is a row.
    """
    import numpy as np

    last = np.uint32(2**32 - 1)

    @F.pandas_udf("binary")
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([(shingles(t)[:SKETCH] >> np.uint64(32)).astype(np.uint32).tobytes() for t in texts])

    sketches = stored(_texts(open_.select("node").distinct(), docs, nodes).select("node", sketched("text").alias("sketch")), "sketches")
    blocks = open_.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = open_.join(sketches, "node").join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "node", "n", "part", "main", "sketch", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))

    def compare(unit: pa.Table) -> pa.Table:
        node, n, part, main, block = (unit.column(c).to_numpy() for c in ("node", "n", "part", "main", "block"))
        sets = [np.frombuffer(x, np.uint32) for x in unit.column("sketch").to_pylist()]
        starts = np.cumsum([0, *map(len, sets)])[:-1]
        flat = np.concatenate(sets)
        limits = np.array([s[-1] if m > SKETCH else last for s, m in zip(sets, n)], np.uint32)
        within = unit.column("left")[0] == unit.column("right")[0]
        found: list = []
        for i in np.flatnonzero(part != main):
            small, large = np.minimum(n, n[i]), np.maximum(n, n[i])
            ask = (part != part[i]) & (small >= large * (SIMILARITY - 1e-9)) & ((part == main) | (node > node[i])) & (within | (block != block[i]))
            if ask.any():
                least = np.where((n > SKETCH) | (n[i] > SKETCH), CUT_SHARE, WHOLE_SHARE)
                near = ask & (shares(sets[i], limits[i], flat, starts, limits) >= least)
                found += [(min(node[i], x), max(node[i], x)) for x in node[near]]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return dealt.groupBy("key", "left", "right").applyInArrow(compare, "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the pairs ``a``, ``b`` of nodes whose texts are similar enough.

    Texts meet their pairs in two joins; only the text of ``b`` travels once a pair, so ``a`` is the node with more pairs.
    """
    @F.pandas_udf("boolean")
    def passes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        kept = lru_cache(256)(shingles)
        for a, b in batches:
            yield pd.Series([similarity(kept(x), kept(y)) >= SIMILARITY for x, y in zip(a, b)], dtype=bool)

    pairs = stored(pairs, "pairs")
    texts = stored(_texts(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, nodes), "texts")
    joined = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return stored(joined.filter(passes("text_a", "text_b")).select("a", "b"), "similar")


def components(docs: DataFrame, linked: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``doc_id``, ``digest`` (of the text) and ``root`` for every row; rows of one component share the root.

    Rows are linked when the sets of their texts have a similarity of 0.8 or more; texts without words are copies.
    ``linked`` gives the components of another method (``doc_id``, ``digest``, ``root``); each is one more bucket, verified like the others.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = stored(_sketches(docs), "sketches")
    nodes = sketches.groupBy("content").agg(F.min(F.struct("doc_id", "digest")).alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    keys = nodes.select("node", "n", F.explode("bands").alias("key"))
    if linked:
        buckets = sketches.join(linked(docs), ["doc_id", "digest"]).select("content", F.col("root").alias("key")).distinct()
        keys = keys.union(nodes.join(buckets, "content").select("node", "n", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    # a join sizes an exploded side as if it had the rows from before, so it would send all keys of a node to the driver
    met = stored(keys.join(shared.hint("merge"), "key"), "met")
    # the original of a family shares more buckets than its copies and is most often near all of them; each row has its match,
    # the joins are left ones so that only the sums can be broadcast: their size is measured, that of ``met`` is its file's
    degree = met.groupBy("node").agg(F.sum("members").alias("degree"))
    centres = met.join(degree, "node", "left").groupBy("key").agg(F.max(F.struct("degree", "node", "n")).alias("centre"))
    members = stored(met.join(centres, "key", "left"), "members")

    def near(a: str, b: str):  # sets of too different a size cannot pass
        return F.least(a, b) >= F.greatest(a, b) * (SIMILARITY - 1e-9)

    stars = members.filter((F.col("node") != F.col("centre.node")) & near("n", "centre.n"))
    links = _verified(stars.select(F.col("centre.node").alias("a"), F.col("node").alias("b")).distinct(), docs, nodes)
    parts = connected_components(links)

    rest = members.filter("members > 2").join(parts, "node", "left").select("key", "node", "n", F.col("centre.node").alias("centre"), F.coalesce("component", "node").alias("part"))
    rest = stored(rest, "rest")
    counts = rest.groupBy("key", "part").agg(F.count("*").alias("k")).groupBy("key").agg(
        F.count("*").alias("parts"), F.max(F.struct("k", "part"))["part"].alias("main")).filter("parts > 1")
    rest = stored(rest.join(counts, "key").filter("node <> centre").select("key", "node", "n", "part", "main"), "open")  # the centre met them all
    more = _verified(_alike(rest, docs, nodes), docs, nodes)
    if not more.isEmpty():
        parts = connected_components(links.union(more))
    roots = nodes.join(parts, "node", "left").select("content", F.coalesce("component", "node").alias("root"))
    return sketches.join(roots, "content").select("doc_id", "digest", "root")


def keep_first(docs: DataFrame, linked: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row of every component stays: the first by id, then by the digest of its text, then by the other columns.

    ``linked``: see :func:`components`. Documents without an id cannot be told apart and all stay.
    """
    known = docs.filter(F.col("doc_id").isNotNull())
    return first_of_components(known, components(known, linked)).union(docs.filter(F.col("doc_id").isNull()))
