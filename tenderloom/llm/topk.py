"""Exact top-k search by inner product: columnar branch and bound.

Vectors are stored dimension by dimension. For a query the partial products are accumulated one block of
dimensions after the other, those with most of the query's mass first. What the remaining dimensions can
still add is at most the product of the remaining norms, so after each block a candidate whose upper bound
is below the k-th largest lower bound is out; survivors are compacted before the next block.

Rows and queries are dealt into bounded groups by a hash of their ids; each pair of a row group and a query
group is one unit of work and keeps at most k rows per query.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import valid_vectors

STEP = 8


class VerticalBlock:
    """Integer vectors in vertical layout with the squared norms of every block of dimensions."""

    def __init__(self, ids, vectors, step: int = STEP):
        import numpy as np

        self.ids = np.asarray(ids, np.int64)
        self.columns = np.ascontiguousarray(np.asarray(vectors, np.int64).T)
        self.cuts = [(a, min(a + step, len(self.columns))) for a in range(0, len(self.columns), step)]
        self.squares = np.stack([(self.columns[a:b].astype(np.float64) ** 2).sum(axis=0) for a, b in self.cuts])

    def search(self, own: int, query, k: int):
        """Ids and scores of the k largest products with the query, without rows of id ``own``; ties to smaller ids."""
        import numpy as np

        query = np.asarray(query, np.int64)
        mass = np.array([(query[a:b].astype(np.float64) ** 2).sum() for a, b in self.cuts])
        alive = np.flatnonzero(self.ids != own)
        partial = np.zeros(len(alive), np.int64)
        remaining = self.squares[:, alive].sum(axis=0)
        left = mass.sum()
        for block in np.argsort(-mass, kind="stable"):
            a, b = self.cuts[block]
            for d in range(a, b):
                if query[d]:
                    partial += query[d] * self.columns[d, alive]
            left = max(0.0, left - mass[block])
            remaining = np.maximum(0.0, remaining - self.squares[block, alive])
            if len(alive) > k:
                slack = np.sqrt(left * remaining) * (1 + 1e-9) + 1.0
                least = np.partition(partial - slack, len(alive) - k)[len(alive) - k]
                keep = partial + slack >= least
                if keep.sum() < 0.8 * len(alive):
                    alive, partial, remaining = alive[keep], partial[keep], remaining[keep]
        order = np.lexsort((self.ids[alive], -partial))[:k]
        return self.ids[alive][order], partial[order]


def exact_topk(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, rows_per_group: int = 2048,
               queries_per_group: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k best rows for each row whose id is divisible by ``every``.

    Components become floor(scale * x) with x as double. Null vectors, vectors with a null or non-finite
    component, without components or of another length than the longest, and rows without an id take no part.
    Repeated rows count once; rows that share an id with a query are not its candidates. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = valid_vectors(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")), "v", True)
    rows = rows.filter(F.col("vec_id").isNotNull()).select("vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    rows = stored(rows.dropDuplicates(["vec_id", "v"]), "rows")  # before any group keeps its k best
    is_query = F.col("vec_id") % every == 0
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"), F.max(F.size("v")).alias("dim")).first()
    g, h = max(1, math.ceil(size["n"] / rows_per_group)), max(1, math.ceil(size["q"] / queries_per_group))
    rows = rows.filter(F.size("v") == (size["dim"] or 0))

    def dealt(n: int, salt: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")

    data = rows.withColumn("g", dealt(g, 1)).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(h - 1)))).withColumn("ask", F.lit(False))
    asked = rows.filter(is_query).withColumn("h", dealt(h, 2)).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(g - 1)))).withColumn("ask", F.lit(True))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        ask = group["ask"].to_numpy()
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if ask.all() or not ask.any():
            return empty
        data = group[~ask]
        block = VerticalBlock(data["vec_id"], np.stack(data["v"]))
        out = []
        for own, query in zip(group["vec_id"][ask], group["v"][ask]):
            ids, scores = block.search(own, query, k)
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(out, ignore_index=True).astype("int64")

    columns = ["vec_id", "v", "g", "h", "ask"]
    found = data.select(*columns).union(asked.select(*columns)).groupBy("g", "h").applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
