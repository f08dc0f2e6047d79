"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Rows, divided by the largest norm, get one more component that makes all of them unit vectors; queries are made
unit vectors as well. Then the largest inner product is the smallest Euclidean distance. A table hashes a
vector to the cells of ``functions`` Gaussian projections, floor((a.x + b) / width). A neighbour whose product
with the query is c projects to a normal distribution around c times the query's projection, so every
perturbed bucket has a probability of holding it. A query visits buckets in falling order of that
probability until ``success`` of it is covered, in each table, and the candidates of all tables are merged and
ranked by their exact inner products.

c is measured: a bounded sample of queries is searched exactly over all rows, and c is the lower quartile of what they
find, so queries outside a dense region are not held to its closeness. A query that found too few candidates in its
buckets goes on to all the others. Equal vectors are one
candidate that carries its smallest ids. Rows are dealt into bounded groups by bucket and by a hash of
their id, queries go to the groups that hold buckets they visit, in bounded groups as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import valid_vectors

SAMPLE = 64
#: Least log probability of a query that visits every bucket.
EVERYWHERE = -1e18


class Tables:
    """The hash functions and the success estimates of all tables; small enough to travel with a task."""

    def __init__(self, dim: int, tables: int, functions: int, width: float, closeness: float, success: float, seed: int):
        import numpy as np

        random = np.random.default_rng(seed)
        self.a = random.normal(size=(tables, dim + 1, functions))
        self.b = random.uniform(0, width, size=(tables, functions))
        self.width, self.closeness, self.success = width, closeness, success

    def cells(self, table: int, vectors):
        import numpy as np

        return np.floor((vectors @ self.a[table] + self.b[table]) / self.width).astype(np.int64)

    def slots(self, table: int, query):
        """First slot and log probabilities of the slots of every function, for one unit query."""
        import numpy as np

        middle = self.closeness * (query @ self.a[table]) + self.b[table]
        spread = math.sqrt(max(1e-6, 1 - self.closeness**2))
        low = np.floor((middle - 4 * spread) / self.width).astype(np.int64)
        n = int(np.ceil(8 * spread / self.width)) + 2
        edges = (low[:, None] + np.arange(n + 1)) * self.width
        below = _normal((edges - middle[:, None]) / spread)
        return low, np.log(np.maximum(np.diff(below, axis=1), 0) + 1e-12)

    def probes(self, table: int, query):
        """The perturbed buckets to visit, most probable first, and the log probability of the last one."""
        import numpy as np

        low, logs = self.slots(table, query)
        cells, score = np.zeros((1, 0), np.int64), np.zeros(1)
        for f in range(len(low)):  # keeps what can still matter: the rest of the functions only lowers a score
            score = (score[:, None] + logs[f]).reshape(-1)
            cells = np.hstack([np.repeat(cells, logs.shape[1], axis=0), np.tile(low[f] + np.arange(logs.shape[1]), len(cells))[:, None]])
            keep = score > -14
            cells, score = cells[keep], score[keep]
        order = np.argsort(-score, kind="stable")
        n = int(np.searchsorted(np.exp(score[order]).cumsum(), self.success)) + 1
        order = order[:n]
        return cells[order], float(score[order[-1]])

    def visits(self, table: int, query, cells, least: float):
        """Log probability of each bucket for a query, -inf where it is not visited."""
        import numpy as np

        low, logs = self.slots(table, query)
        at = cells - low
        inside = ((at >= 0) & (at < logs.shape[1])).all(axis=1)
        at = np.clip(at, 0, logs.shape[1] - 1)
        score = logs[np.arange(len(low)), at].sum(axis=1)
        return np.where(inside & (score >= least - 1e-9), score, -np.inf)


def _normal(x):
    """Normal distribution function to seven digits (Abramowitz and Stegun 26.2.17), enough for an order of visits."""
    import numpy as np

    t = 1 / (1 + 0.2316419 * np.abs(x))
    tail = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(x > 0, 1 - tail, tail)


def _group_of(cells, groups: int):
    """Bucket group of each row of cells, by an integer hash."""
    import numpy as np

    mixed = np.zeros(len(cells), np.uint64)
    for f in range(cells.shape[1]):
        mixed = (mixed ^ cells[:, f].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(groups)).astype(np.int64)


def _best(ids, scores, k: int):
    import numpy as np

    if len(ids) > k:
        least = np.partition(scores, len(ids) - k)[len(ids) - k]
        keep = scores >= least
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, tables: int = 2, functions: int = 6, width: float = 1.5,
            success: float = 0.8, bucket_groups: int = 4, rows_per_group: int = 8192, queries_per_group: int = 2048,
            seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k nearest rows found for each id divisible by ``every``.

    ``success`` is the estimated chance per table of finding a k-th neighbour. Null and zero vectors, vectors with
    a null or non-finite component or of another length than the longest, and rows without an id take no part.
    Repeated rows count once; rows that share an id with a query are not its candidates. A query whose buckets hold
    fewer than k of them visits all buckets, so it returns k, or all candidates if there are fewer. Other columns are ignored; an empty table gives no rows.
    """
    rows = valid_vectors(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")), "v", False)
    rows = rows.filter(F.col("vec_id").isNotNull())
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 1
    rows = rows.filter(F.size("v") == dim).dropDuplicates(["vec_id", "v"])

    # equal vectors: the k + 1 smallest ids answer any query; the group limit is applied before the exchange
    ids = rows.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("nth") <= k + 1)
    classes = stored(ids.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("u", F.col("ids")[0]), "classes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    size = classes.agg(F.count("*").alias("n"), F.max(norm).alias("norm")).first()
    if not size["n"]:
        return classes.select(F.col("u").alias("query_id"), F.lit(1).alias("rank"), F.col("u").alias("vec_id"), F.lit(0.0).alias("score"))
    largest = size["norm"]

    query_ids = rows.filter(F.col("vec_id") % every == 0)
    queries = stored(query_ids.groupBy("v").agg(F.min("vec_id").alias("q")), "queries")
    n_queries = queries.count()
    closeness = _closeness(classes, queries, k, largest)
    model = Tables(dim, tables, functions, width, closeness, success, seed)
    r = max(1, math.ceil(size["n"] / (bucket_groups * rows_per_group)))
    h = max(1, math.ceil(n_queries / queries_per_group))

    def place_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"]) / largest
                x = np.hstack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))[:, None]])
                for t in range(tables):
                    cells = model.cells(t, x)
                    yield pd.DataFrame({"t": t, "g": _group_of(cells, bucket_groups), "id": batch["u"], "v": batch["v"], "cell": list(cells), "least": 0.0})

    def place_everywhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(0, g, q, v, None, EVERYWHERE) for q, v in zip(batch["q"], batch["v"]) for g in range(bucket_groups)]
            yield pd.DataFrame(out, columns=["t", "g", "id", "v", "cell", "least"])

    def place_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            out = []
            for q, v in zip(batch["q"], batch["v"]):
                unit = np.append(v / np.linalg.norm(v), 0.0)
                for t in range(tables):
                    cells, least = model.probes(t, unit)
                    out += [(t, int(g), q, v, None, least) for g in np.unique(_group_of(cells, bucket_groups))]
            yield pd.DataFrame(out, columns=["t", "g", "id", "v", "cell", "least"])

    schema = "t int, g int, id long, v array<double>, cell array<long>, least double"

    def dealt(n: int, salt: int):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")

    data = classes.select("u", "v").mapInPandas(place_rows, schema).withColumn("r", dealt(r, 1)).withColumn(
        "h", F.explode(F.sequence(F.lit(0), F.lit(h - 1)))).withColumn("ask", F.lit(False))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        ask = group["ask"].to_numpy()
        if ask.all() or not ask.any():
            return pd.DataFrame({"q": [], "u": [], "score": []}).astype({"q": "int64", "u": "int64", "score": "float64"})
        table = int(group["t"].iloc[0])
        data, asks = group[~ask], group[ask]
        cells, bucket = np.unique(np.stack(data["cell"]), axis=0, return_inverse=True)
        order = np.argsort(bucket.ravel(), kind="stable")
        starts = np.searchsorted(bucket.ravel()[order], np.arange(len(cells) + 1))
        x, u = np.stack(data["v"])[order], data["id"].to_numpy()[order]
        q_ids, q_scores, q_of = [], [], []
        for q, v, least in zip(asks["id"], asks["v"], asks["least"]):
            unit = np.append(v / np.linalg.norm(v), 0.0)
            chance = model.visits(table, unit, cells, least)
            visited = np.arange(len(cells)) if least == EVERYWHERE else np.flatnonzero(chance > -np.inf)
            if not len(visited):
                continue
            visited = visited[np.argsort(-chance[visited], kind="stable")]
            at = np.concatenate([np.arange(starts[b], starts[b + 1]) for b in visited])
            best, _ = _best(u[at], x[at] @ v, k + 8)
            place = np.flatnonzero(np.isin(u, best))
            found, scores = _best(u[place], np.einsum("ij,j->i", x[place], v), k + 1)
            q_ids.append(found)
            q_scores.append(scores)
            q_of.append(np.full(len(found), q))
        if not q_ids:
            return pd.DataFrame({"q": [], "u": [], "score": []}).astype({"q": "int64", "u": "int64", "score": "float64"})
        return pd.DataFrame({"q": np.concatenate(q_of), "u": np.concatenate(q_ids), "score": np.concatenate(q_scores)})

    columns = ["t", "g", "r", "h", "id", "v", "cell", "least", "ask"]

    def searched(rows: DataFrame, asking: DataFrame, place) -> DataFrame:
        asked = asking.select("q", "v").repartition("q").mapInPandas(place, schema).withColumn("h", dealt(h, 2)).withColumn(
            "r", F.explode(F.sequence(F.lit(0), F.lit(r - 1)))).withColumn("ask", F.lit(True))
        return rows.select(*columns).union(asked.select(*columns)).groupBy("t", "g", "r", "h").applyInPandas(search, "q long, u long, score double")

    found = stored(searched(data, queries, place_queries), "found")
    held = found.select("q", "u").distinct().join(classes.select("u", F.size("ids").alias("n")), "u").groupBy("q").agg(F.sum("n").alias("n"))
    few = stored(queries.join(held.filter(F.col("n") > k), "q", "left_anti"), "few")  # the query itself is one of them
    if not few.isEmpty():
        found = found.union(searched(data.filter("t = 0"), few, place_everywhere))
    by_class = Window.partitionBy("q").orderBy(F.col("score").desc(), "u")
    found = found.groupBy("q", "u").agg(F.max("score").alias("score")).withColumn("nth", F.row_number().over(by_class)).filter(F.col("nth") <= k + 1)
    # from classes to rows: every query of a class, all ids of the classes found but its own
    expanded = found.join(classes.select("u", "ids"), "u").select("q", "score", F.explode("ids").alias("vec_id"))
    first = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    top = expanded.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1)
    lists = top.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("top"))
    members = query_ids.join(queries, "v").select("q", F.col("vec_id").alias("query_id"))
    answers = members.join(lists, "q").select("query_id", F.slice(
        F.filter("top", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("top"))
    return answers.select("query_id", F.posexplode("top").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")


def _closeness(classes: DataFrame, queries: DataFrame, k: int, largest: float) -> float:
    """Lower quartile of the inner product, as unit vectors, of sampled queries with their k-th nearest row; exact over all rows.

    The sample is the :data:`SAMPLE` queries with the smallest hash of their id.
    """
    import numpy as np

    sample = queries.orderBy(F.xxhash64("q"), "q").limit(SAMPLE).collect()
    asked = np.array([r["v"] for r in sample])
    asked /= np.linalg.norm(asked, axis=1)[:, None]

    def nearest_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.full((len(asked), k + 1), -np.inf)
        for batch in batches:
            for at in range(0, len(batch), 4096):
                s = asked @ np.stack(batch["v"].iloc[at:at + 4096]).T / largest
                best = np.sort(np.hstack([best, s]), axis=1)[:, -(k + 1):]
        yield pd.DataFrame({"s": range(len(asked)), "best": list(best)})

    parts = classes.select("v").mapInPandas(nearest_of, "s int, best array<double>").select("s", F.explode("best").alias("b"))
    order = Window.partitionBy("s").orderBy(F.col("b").desc())
    found = parts.withColumn("nth", F.row_number().over(order)).filter((F.col("nth") == k + 1) & (F.col("b") > -1.5)).agg(F.percentile("b", 0.25)).first()[0]
    return min(0.999, max(0.0, found if found is not None else 0.0))
