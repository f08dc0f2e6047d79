"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Statistics of a document are standardised and mapped to cosines of random directions, whose inner products
approximate a Gaussian kernel. Each partition sums its part of the normal equations, Spark adds the parts, and
the system of a few hundred unknowns is solved. Scores of the training rows, counted in bins, are
made monotone by pooling adjacent violators; between the pools' centres the calibrated score is linear.

The fit uses at most ``max_rows`` labelled documents, those with the smallest hash of their id. Everything
else covers all documents; scoring is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

STATISTICS = 18
SPLIT_OUT = 1  # remainder of the id's crc32 by 3 that is held out


def statistics(text: str | None) -> list[float]:
    """Eighteen numbers about a whole text; zeros for a null or empty one."""
    from math import log1p

    text = text or ""
    n = len(text)
    words = text.split()
    w = len(words)
    if not w:
        return [0.0] * STATISTICS
    lines = [x for x in text.split("\n") if x.strip()]
    distinct = len(set(words))
    repeats = sum(map(str.__eq__, words, words[1:])) if w > 1 else 0
    letters = sum(map(len, re.findall(r"[^\W\d_]+", text)))
    upper = sum(map(len, re.findall(r"[A-ZÀ-ÖØ-Þ]+", text)))
    marks = {c: text.count(c) for c in ".,!?|#*&%$<>{}=\"'():;-"}
    odd = sum(marks[c] for c in "#*&%$<>{}=")
    spaces = n - sum(map(len, words))
    digits = sum(map(len, re.findall(r"[0-9]+", text)))
    ends = sum(1 for x in lines if x.rstrip()[-1:] in ".!?")
    trimmed = {x.strip(".,!?|#*&%$:;()") for x in words}
    return [
        log1p(w), log1p(n / w), letters / n, upper / max(1, letters), digits / n, spaces / n,
        marks["."] / w, marks[","] / w, marks["!"] / w, marks["|"] / w, odd / w, marks["?"] / w,
        repeats / w, distinct / w, len(trimmed) / w, len(set(lines)) / max(1, len(lines)), ends / max(1, len(lines)),
        sum(1 for x in words if len(x) > 18) / w]


@dataclass(frozen=True)
class Model:
    """A fitted scorer; ``beta`` is None where there was nothing to learn from, then every score is ``base``."""

    mean: list[float]
    scale: list[float]
    seed: int
    width: int
    beta: list[float] | None
    at: list[float]
    value: list[float]
    base: float = 0.5

    def raw(self, stats):
        return fourier(stats, self.mean, self.scale, self.seed, self.width) @ _array(self.beta)

    def scores(self, stats):
        import numpy as np

        if self.beta is None:
            return np.full(len(stats), self.base)
        return np.interp(self.raw(stats), self.at, self.value)


def _array(x):
    import numpy as np

    return np.asarray(x, dtype=np.float64)


def fourier(stats, mean, scale, seed: int, width: int):
    """Random Fourier features of standardised statistics, with a constant column."""
    import numpy as np

    x = np.clip((_array(stats).reshape(-1, STATISTICS) - _array(mean)) / _array(scale), -6, 6)
    random = np.random.default_rng(seed)
    directions = random.normal(size=(STATISTICS, width)) / np.sqrt(STATISTICS)
    phase = random.uniform(0, 2 * np.pi, width)
    return np.hstack([np.cos(x @ directions + phase) * np.sqrt(2 / width), np.ones((len(x), 1))])


def stats_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def stats(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t) for t in texts])

    return stats(text)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from the fit; null ids count as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == SPLIT_OUT


def pooled(values: list[float], weights: list[float]) -> list[tuple[int, int, float]]:
    """Pool adjacent violators: (first, last, mean) of the pools of a weighted sequence."""
    pools: list[list[float]] = []
    for i, (v, w) in enumerate(zip(values, weights)):
        pools.append([i, i, v * w, w])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            last = pools.pop()
            pools[-1][1], pools[-1][2], pools[-1][3] = last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]
    return [(int(a), int(b), s / w) for a, b, s, w in pools]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, width: int = 192, ridge: float = 1e-3,
        seed: int = 11, bins: int = 512) -> Model:
    """Fits on labelled rows outside the held-out third.

    ``labels``: doc_id, quality (1 good, 0 bad; other values and nulls are ignored). Of several labels of one
    document the smallest counts. Documents without a label, and labels without a document, take no part.
    """
    import numpy as np

    chosen = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    narrow = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_rows rows of 16 bytes
    table = narrow.select("y", stats_column(F.col("text")).alias("x"))
    table = stored(table, "quality-stats")
    moments = table.agg(
        F.count("*").alias("n"), F.avg("y").alias("y"),
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(STATISTICS)],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(STATISTICS)]).first()
    if not moments["n"] or moments["y"] in (0.0, 1.0):
        return Model([], [], seed, width, None, [], [], 0.5 if not moments["n"] else moments["y"])
    mean = [moments[f"m{i}"] for i in range(STATISTICS)]
    scale = [moments[f"s{i}"] if moments[f"s{i}"] > 1e-9 else 1.0 for i in range(STATISTICS)]
    size = width + 1

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if len(batch):
                z = fourier(np.stack(batch["x"]), mean, scale, seed, width)
                total[:, :size] += z.T @ z
                total[:, size] += z.T @ batch["y"].to_numpy()
        yield pd.DataFrame({"row": np.arange(size), "v": list(total)})

    parts = table.mapInPandas(sums, "row int, v array<double>").select("row", F.posexplode("v").alias("at", "part"))
    total = np.zeros((size, size + 1))
    for r in parts.groupBy("row", "at").agg(F.sum("part").alias("v")).toLocalIterator():  # size * (size + 1) numbers
        total[r["row"], r["at"]] = r["v"]
    beta = np.linalg.solve(total[:, :size] + ridge * moments["n"] / width * np.eye(size), total[:, size])
    model = Model(mean, scale, seed, width, beta.tolist(), [], [])

    @F.pandas_udf("double")
    def raw(x: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.stack(x)))

    # raw scores lie around 0..1; what is outside falls into the first or last bin
    placed = table.select("y", raw("x").alias("s")).withColumn("bin", F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0 - 1e-9), (F.col("s") + 0.5) / 2)) * bins))
    counts = sorted(placed.groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n"), F.sum("s").alias("s")).collect(), key=lambda r: r["bin"])
    pools = pooled([r["y"] / r["n"] for r in counts], [r["n"] for r in counts])
    at, value = [], []
    for first, last, v in pools:
        n = sum(r["n"] for r in counts[first:last + 1])
        at.append(sum(r["s"] for r in counts[first:last + 1]) / n)
        value.append(min(1.0, max(0.0, v)))
    return Model(mean, scale, seed, width, beta.tolist(), at, value)


def score_column(model: Model, text: Column) -> Column:
    """The calibrated score of a text, 0 to 1; null and empty texts are scored as texts without words."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        for texts in batches:
            yield pd.Series(model.scores(np.array([statistics(t) for t in texts]).reshape(-1, STATISTICS)), dtype="float64")

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row; equal rows get equal scores."""
    model = fit(docs, labels, **options)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents with a score of at least 0.5, columns unchanged."""
    model = fit(docs, labels, **options)
    return docs.filter(score_column(model, F.col("text")) >= 0.5)
