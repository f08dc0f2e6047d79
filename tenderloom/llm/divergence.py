"""How far the sources of a language differ in their use of words.

Counting: one ``bytes.translate`` over the UTF-8 bytes of a text lowers A-Z and blanks every other ASCII byte that
is no letter, ``bytes.split`` cuts the terms, and a ``Counter`` per document gives their frequencies; a worker adds
the Counters of its documents up per (lang, source) before anything leaves it, so a word that every document holds
costs one row per worker batch and source.

Comparison: kept terms are sparse counts of sources. Sources and terms of a language are dealt into bounded
blocks by hash; a unit of work is a pair of source blocks and one term block. It fills a small dense matrix with the
shares of its sources and sums the absolute differences over the terms that any of them uses. Terms that neither block
uses add the same difference each and are counted afterwards, so no unit sees the whole vocabulary and no two
sources are joined.

All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: Documents a kept term occurs in, smoothing count, scale of a share, terms listed per source.
MIN_DOCS, SMOOTHING, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Most (source, term) counts a worker holds before it passes them on; sources and terms of one unit of work.
HELD, SOURCES_PER_BLOCK, TERMS_PER_BLOCK = 400_000, 64, 4096

#: A-Z to a-z, other ASCII bytes but letters to blanks; bytes above 7F stay.
LOWERED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def document_terms(text: bytes | None) -> Counter:
    """Frequencies of the terms of one text."""
    return Counter((text or b"").translate(LOWERED).split())


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences), ``docs`` (documents) over all documents; null is ''."""
    layout = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = defaultdict(dict)  # of a group: term -> [occurrences, documents]

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in sums.items():
                n = len(terms)
                both = list(zip(*terms.values()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n), pa.array([source] * n), pa.array(terms, pa.binary()), pa.array(both[0], pa.int64()),
                     pa.array(both[1], pa.int64())], schema=layout)
            sums.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                terms = sums[lang, source]
                before = len(terms)
                for term, n in document_terms(text).items():
                    have = terms.get(term)
                    if have is None:
                        terms[term] = [n, 1]
                    else:
                        have[0] += n
                        have[1] += 1
                size += len(terms) - before
                if not terms:
                    del sums[lang, source]
                if size >= held:
                    yield from passed_on()
                    size = 0
        yield from passed_on()

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    raw = docs.select(text("lang").alias("lang"), text("source").alias("source"), F.col("text").cast("binary").alias("text"))
    rows = raw.mapInArrow(counted, "lang string, source string, term binary, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).withColumn("term", F.col("term").cast("string"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * terms)), exact for any long."""
    def exact(c: Column) -> Column:
        return c.cast("decimal(20,0)")

    above = F.lit(SCALE).cast("decimal(10,0)") * exact(count + SMOOTHING)
    return F.call_function("div", above, exact(total + SMOOTHING * terms)) + F.lit(1).cast("long")


def _unit_distances(unit: pa.Table) -> pa.Table:
    """Partial distances of the pairs of sources of one unit: ``part`` over the ``used`` terms of the unit."""
    import numpy as np

    lang, first, second = (unit.column(c)[0].as_py() for c in ("lang", "first", "second"))
    is_source = unit.column("term").is_null()
    heads, cells = unit.filter(is_source).sort_by("source"), unit.filter(pc.invert(is_source))
    names = heads.column("source").to_pylist()
    bare, block = (heads.column(c).to_numpy() for c in ("share", "block"))
    terms = pc.unique(cells.column("term"))
    row = pc.index_in(cells.column("source"), heads.column("source").combine_chunks()).to_numpy()
    column = pc.index_in(cells.column("term"), terms).to_numpy()
    shares = np.repeat(bare[:, None], len(terms), axis=1)
    shares[row, column] = cells.column("share").to_numpy()
    found: dict = {"a": [], "b": [], "part": [], "bare": []}
    for i in range(len(names)):
        # inside one block each pair once, over two blocks every source of the one with every one of the other
        others = np.arange(i + 1, len(names)) if first == second else np.flatnonzero(block == second) if block[i] == first else []
        if len(others):
            found["a"] += [names[i]] * len(others)
            found["b"] += [names[j] for j in others]
            found["part"] += np.abs(shares[others] - shares[i]).sum(axis=1).tolist()
            found["bare"] += np.abs(bare[others] - bare[i]).tolist()
    n = len(found["a"])
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "a": pa.array(found["a"], pa.string()), "b": pa.array(found["b"], pa.string()),
                     "part": pa.array(found["part"], pa.int64()), "used": pa.array([len(terms)] * n, pa.int64()), "bare": pa.array(found["bare"], pa.int64())})


def _pairs(groups: DataFrame, cells: DataFrame, sources_per_block: int, terms_per_block: int) -> DataFrame:
    """``lang``, ``source``, ``item`` (another source of the lang), ``value`` for all pairs of sources."""
    size = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.max("terms").alias("vocabulary")).select(
        "lang", F.ceil(F.col("sources") / sources_per_block).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("vocabulary") / terms_per_block)).cast("int").alias("slices"))
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    heads = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("bare").alias("share")).join(size, "lang").select(
        "lang", "source", "term", "share", "blocks", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    parts = cells.select("lang", "source", "term", "share").join(size, "lang").select(
        "lang", "source", "term", "share", "blocks", block.alias("block"), F.pmod(F.xxhash64("term", F.lit(1)), F.col("slices")).cast("int").alias("slice"))
    dealt = heads.union(parts).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", "source", "term", "share", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "slice")
    units = dealt.groupBy("lang", "first", "second", "slice").applyInArrow(
        _unit_distances, "lang string, a string, b string, part long, used long, bare long")
    whole = units.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"), F.sum("used").alias("used"), F.first("bare").alias("bare"))
    vocabulary = groups.select("lang", "terms").distinct()
    value = (F.col("part") + (F.col("terms") - F.col("used")) * F.col("bare")).alias("value")
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x")
    return whole.join(vocabulary, "lang").select("lang", value, both).select("lang", "x.source", "x.item", "value")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, held: int = HELD, sources_per_block: int = SOURCES_PER_BLOCK,
          terms_per_block: int = TERMS_PER_BLOCK) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` of every (lang, source) group.

    Part ``pair``: distance to each other source of the lang over all kept terms, largest first. Part ``term``: the
    ``top`` kept terms the group uses more than its lang does. Ties go to the smaller item in UTF-8. A term is kept in a
    lang when ``min_docs`` of its documents hold it. Null text, lang and source count as ''; repeated rows count as
    documents each; ids and other columns are not read. A lang without kept terms has pairs of value 0; a lang of one
    source has no pairs; an empty table gives no rows.
    """
    counts = stored(term_counts(docs, held), "term-counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= min_docs).drop("docs")
    terms = stored(terms, "kept-terms")
    kept = stored(counts.drop("docs").join(terms, ["lang", "term"]), "kept-counts")

    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    occurring = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    zero = F.lit(0).cast("long")
    groups = occurring.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")))
    bare = F.when(F.col("terms") > 0, share(zero, F.col("total"), F.col("terms"))).otherwise(zero)
    groups = stored(groups.withColumn("bare", bare), "groups")

    cells = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("share"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("lang_share"))
    cells = stored(cells, "shares")
    pairs = _pairs(groups, cells, sources_per_block, terms_per_block).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    over = cells.filter("share > lang_share").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("share") - F.col("lang_share")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top), pairs.withColumn("rank", F.row_number().over(order))]
    return ranked[0].unionByName(ranked[1]).select("lang", "source", "part", "item", "value", "rank")
