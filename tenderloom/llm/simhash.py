"""Near-duplicates by SimHash and deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments of 32. Fingerprints at 3 or fewer differing bits have one
segment in which they differ by at most one bit, so it is enough to index every segment 32 times, each time
with another bit wiped out, join on equal variants and verify the whole fingerprints.

Documents are first reduced to distinct fingerprints, so copies cost nothing. A segment value that more than
``crowd`` distinct fingerprints share (a large family of near copies) would make a variant with many pairs.
All fingerprints under such variants take another exact way: every fingerprint is put under itself and its
64 one-bit neighbours. Two differ by at most two bits if and only if they meet under one of these 65 keys,
and a key is met by at most 65 fingerprints, so linking each to the smallest there links the same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import text_digest
from .components import connected_components

SEED = 42
CROWD = 64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the lower-cased (A-Z) word shingles, repeats included; 0 for a text without words.

    Bytes are used because their ``lower`` and ``split`` treat exactly A-Z and the six ASCII white-space
    characters; hashes are counted in slices, so memory stays small for any text.
    """
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    start = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=start[1:])
    n = max(1, len(words) - shingle + 1)
    ends = start[min(shingle, len(words)):] - 1
    digest, seen = xxhash.xxh64_intdigest, np.zeros((8, 8), np.int64)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
    for at in range(0, n, 1 << 16):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(start[at:min(at + (1 << 16), n)].tolist(), ends[at:at + (1 << 16)].tolist())], ">u8")
        columns = hashes.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            seen[k] += np.bincount(columns[:, k], minlength=256) @ bits
    return int.from_bytes(np.packbits((seen.reshape(64) * 2 > n).astype(np.uint8)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fp") -> DataFrame:
    """Adds the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return docs.withColumn(name, prints(F.col(text_col)))


def _segments(prints: DataFrame) -> DataFrame:
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    return prints.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), low.alias("value")),
        F.struct(F.lit(1).alias("seg"), F.shiftrightunsigned("fp", 32).alias("value")))).alias("s")).select("fp", "s.seg", "s.value")


def _variants(segments: DataFrame, *keep: str) -> DataFrame:
    """Every segment with each of its 32 bits wiped out: ``key`` holds segment, bit and what is left."""
    wiped = F.expr("transform(sequence(0, 31), j -> (bigint(seg) << 37) | (bigint(j) << 32) | (value & ~(1L << j)))")
    return segments.select(*keep, F.explode(wiped).alias("key"))


def links(prints: DataFrame, bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """Pairs of distinct fingerprints at most ``bits`` apart whose links join the same components as all pairs.

    ``prints``: distinct ``fp``. Outside crowded segment values every pair is there. ``bits`` is 1 or 2.
    """
    if bits not in (1, 2):
        raise ValueError("bits: 1 or 2")
    segments = _segments(prints)
    crowded = segments.groupBy("seg", "value").agg(F.count("*").alias("n")).filter(F.col("n") > crowd)
    crowded_keys = stored(_variants(crowded).distinct(), "crowded")
    keys = _variants(segments, "fp")
    calm = keys.join(crowded_keys, "key", "left_anti")
    a, b = calm.select("key", F.col("fp").alias("a")), calm.select("key", F.col("fp").alias("b"))
    # equal segments meet under all 32 variants; the pair is taken under the first only
    differ = F.expr("(a ^ b) & if(key >> 37 = 0, 4294967295L, ~4294967295L)")
    # a join sizes an exploded side as if it had the rows from before, so it would send 64 rows a fingerprint to the driver
    pairs = a.join(b.hint("merge"), "key").filter(
        (F.col("a") < F.col("b")) & (F.bit_count(F.expr("a ^ b")) <= bits) & ((differ != 0) | (F.expr("(key >> 32) & 31") == 0)))
    pairs = pairs.select("a", "b")
    if not crowded_keys.isEmpty():
        busy = keys.join(crowded_keys, "key", "left_semi").select("fp").distinct()
        if bits == 2:
            near = F.expr("concat(array(fp), transform(sequence(0, 63), j -> fp ^ (1L << j)))")
            meet = busy.select("fp", F.explode(near).alias("z"))
        else:  # one-bit neighbours share the fingerprint with that bit wiped out
            near = F.expr("transform(sequence(0, 63), j -> named_struct('j', j, 'rest', fp & ~(1L << j)))")
            meet = busy.select("fp", F.explode(near).alias("z"))
        centre = meet.groupBy("z").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).filter(F.size("all") > 1)  # 65 at most
        pairs = pairs.union(centre.select("a", F.explode("all").alias("b")).filter("a <> b"))
    return pairs.distinct()


def _rooted(prints: DataFrame, bits: int, crowd: int) -> DataFrame:
    """``fp``, ``rep`` (its smallest document) and ``root`` (the smallest fingerprint of its component) of every fingerprint."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    # nodes are fingerprints; the smallest document of a component is found afterwards
    parts = connected_components(links(distinct.select("fp"), bits, crowd))
    return stored(distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("root")), "roots")


def near_duplicates(docs: DataFrame, bits: int = 2, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    The component is the smallest id reachable over links of at most ``bits`` differing bits. Null and empty
    texts have fingerprint zero and are linked like any other; equal ids keep their rows; null ids take no
    part in the smallest (a component of null ids only has a null id). An empty table gives no rows.
    """
    prints = stored(with_fingerprint(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", "fp"), "fingerprints")
    joined = _rooted(prints, bits, crowd)
    lowest = joined.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = joined.join(lowest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def components(docs: DataFrame, bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """``doc_id``, ``digest`` of its text and ``root`` of the component for every row, as ``similar.components`` gives them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest("text").alias("digest"), "text")
    prints = stored(with_fingerprint(rows).select("doc_id", "digest", "fp"), "fingerprints")
    return prints.join(_rooted(prints, bits, crowd).select("fp", "root"), "fp").select("doc_id", "digest", "root")


def keep_first(docs: DataFrame, bits: int = 2) -> DataFrame:
    """One document of every component stays: the one with its smallest id. Of rows equal in id one stays.

    Documents without an id cannot be told apart and all stay.
    """
    kept = near_duplicates(docs.filter(F.col("doc_id").isNotNull()), bits).filter("doc_id = component_id").select("doc_id").distinct()
    known = docs.filter(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    return known.dropDuplicates(["doc_id"]).select(*docs.columns).union(docs.filter(F.col("doc_id").isNull()))
