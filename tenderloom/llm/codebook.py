"""Compressed vector codes: product quantisation whose rounds skip what bounds already decide.

A vector of integers is cut into equal parts; every part position has a codebook of its own, trained by rounds of
assignment and averaging, all in exact integers. For every part of every row two bounds are kept, each with the round it
was taken in: how far its entry was at most, and how far every other entry was at least. The codebooks of all
rounds are retained, so a bound is carried to the present by the net displacement of the entries, the norm of the
sum of all their moves since its round; that is never more than the sum of the norms, which bounds updated
round by round add up. Only where the carried bounds meet is the distance to the own entry computed
anew, and only where that does not decide either are all entries compared, exactly and with ties to lower indexes.

The rows stay dealt as they are: a round reads the states of the last one from the shared folder, writes new ones and
sums each entry's parts per task, so the driver sees one row per entry. A lost executor repeats its tasks of one round.
States of a round that a later one replaced are deleted once that one is complete.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, stored
from .common import valid_vectors

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Largest integer component: squared distances of parts then fit in 64 bits.
LIMIT = 1 << 28
#: Bounds closer than this are left to exact distances; it covers the rounding of roots in double precision.
SLACK = 0.01


def squared_distances(parts, book):
    """Exact squared distances (rows x entries) of parts (rows x width) to the entries of one codebook."""
    import numpy as np

    out = np.empty((len(parts), len(book)), np.int64)
    for j, entry in enumerate(book):
        gap = parts - entry
        out[:, j] = np.einsum("ij,ij->i", gap, gap)
    return out


class History:
    """The codebooks of all rounds so far, as int64 arrays (parts x entries x width)."""

    def __init__(self, books):
        import numpy as np

        self.books = books
        now = books[-1]
        #: net displacement from every round to the present, by (round, part, entry)
        self.net = np.stack([np.sqrt(((now - b).astype(np.float64) ** 2).sum(axis=2)) for b in books])
        #: the largest one among the entries beside the given one
        self.others = np.zeros_like(self.net)
        for j in range(self.net.shape[2]):
            rest = np.delete(self.net, j, axis=2)
            self.others[:, :, j] = rest.max(axis=2) if rest.shape[2] else 0.0

    def first(self, v) -> dict:
        """States of rows (rows x parts x width) that have none yet."""
        import numpy as np

        shape = v.shape[:2]
        state = {"code": np.zeros(shape, np.uint8), "upper": np.zeros(shape), "lower": np.zeros(shape),
                 "upper_round": np.zeros(shape, np.uint8), "lower_round": np.zeros(shape, np.uint8), "rescans": np.zeros(len(v), np.int32)}
        for m in range(shape[1]):
            self._rescan(v, m, np.arange(len(v)), state)
        return state

    def advance(self, v, state: dict) -> None:
        """Assigns every part to the nearest entry of the last codebook."""
        import numpy as np

        now = len(self.books) - 1
        for m in range(v.shape[1]):
            code = state["code"][:, m]
            upper = state["upper"][:, m] + self.net[state["upper_round"][:, m], m, code]
            lower = state["lower"][:, m] - self.others[state["lower_round"][:, m], m, code]
            open_ = np.flatnonzero(upper + SLACK >= lower)
            gap = v[open_, m] - self.books[-1][m][code[open_]]
            own = np.sqrt(np.einsum("ij,ij->i", gap, gap).astype(np.float64))
            state["upper"][open_, m], state["upper_round"][open_, m] = own, now
            self._rescan(v, m, open_[own + SLACK >= lower[open_]], state)

    def _rescan(self, v, m: int, rows, state: dict) -> None:
        import numpy as np

        if not len(rows):
            return
        now = len(self.books) - 1
        squares = squared_distances(v[rows, m], self.books[-1][m])
        code = squares.argmin(axis=1)
        state["code"][rows, m] = code
        state["upper"][rows, m] = np.sqrt(squares[np.arange(len(rows)), code].astype(np.float64))
        squares[np.arange(len(rows)), code] = np.iinfo(np.int64).max
        state["lower"][rows, m] = np.sqrt(squares.min(axis=1).astype(np.float64))
        state["upper_round"][rows, m] = state["lower_round"][rows, m] = now
        state["rescans"][rows] += 1


def _vectors(column: pa.Array, parts: int):
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, -1)


def _read_state(batch: pa.RecordBatch, parts: int) -> dict:
    import numpy as np

    def small(name: str):
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, parts).copy()

    def bound(name: str):
        return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, parts)

    return {"code": small("code"), "upper": bound("upper"), "lower": bound("lower"), "upper_round": small("upper_round"),
            "lower_round": small("lower_round"), "rescans": batch.column("rescans").to_numpy(zero_copy_only=False).copy()}


def _state_batch(batch: pa.RecordBatch, state: dict) -> pa.RecordBatch:
    import numpy as np

    def small(name: str) -> pa.Array:
        return pa.array([row.tobytes() for row in state[name]], pa.binary())

    def bound(name: str, away: float) -> pa.Array:
        values = state[name].astype(np.float32)
        wrong = values < state[name] if away > 0 else values > state[name]  # rounding must not make a bound claim too much
        values[wrong] = np.nextafter(values[wrong], np.float32(away))
        return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), pa.array(values.ravel()))

    columns = {"code": small("code"), "upper": bound("upper", np.inf), "lower": bound("lower", -np.inf), "upper_round": small("upper_round"),
               "lower_round": small("lower_round"), "rescans": pa.array(state["rescans"])}
    kept = ["vec_id", "label", "v"]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns.values()], [*kept, *columns])


def _type(rows: DataFrame) -> str:
    return rows.schema["label"].dataType.simpleString()


def _assigned(rows: DataFrame, books: list, parts: int, begins: bool) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = History(books)
        for batch in batches:
            if batch.num_rows:
                v = _vectors(batch.column("v"), parts)
                if begins:
                    state = history.first(v)
                else:
                    state = _read_state(batch, parts)
                    history.advance(v, state)
                yield _state_batch(batch, state)

    state = "code binary, upper array<float>, lower array<float>, upper_round binary, lower_round binary, rescans int"
    return rows.mapInArrow(assign, f"vec_id long, label {_type(rows)}, v array<int>, {state}")


def _entry_sums(states: DataFrame, parts: int, entries: int) -> dict:
    """(part, entry) to number and component sums of its parts; at most parts x entries rows reach the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        sums = counts = None
        for batch in batches:
            if not batch.num_rows:
                continue
            v, code = _vectors(batch.column("v"), parts), np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            if sums is None:
                sums, counts = np.zeros((parts, entries, v.shape[2]), np.int64), np.zeros((parts, entries), np.int64)
            for m in range(parts):
                np.add.at(sums[m], code[:, m], v[:, m])
                counts[m] += np.bincount(code[:, m], minlength=entries)
        if sums is not None:
            m, j = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(m, pa.int32()), pa.array(j, pa.int32()), pa.array(counts[m, j]), pa.array(sums[m, j].tolist(), pa.list_(pa.int64()))],
                                             ["part", "entry", "n", "sums"])

    per_task = states.select("v", "code").mapInArrow(add, "part int, entry int, n long, sums array<long>")
    whole = per_task.select("part", "entry", "n", F.posexplode("sums").alias("at", "x")).groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    rows = whole.groupBy("part", "entry").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "x"))).alias("sums")).collect()
    return {(r["part"], r["entry"]): (r["n"], [x["x"] for x in r["sums"]]) for r in rows}


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, parts: int) -> tuple[DataFrame, int]:
    """Rows that take part as ``vec_id``, ``label``, ``v`` (padded to whole parts), and the width of a part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    rows = valid_vectors(rows, "v", True)
    size = rows.agg(F.max(F.size("v")).alias("n"), F.max(F.expr("array_max(transform(v, x -> abs(cast(x as double))))")).alias("top")).first()
    if size["n"] is None:
        return rows.select("vec_id", "label", F.col("v").cast("array<int>").alias("v")), 1
    if size["top"] * scale >= LIMIT:
        raise ValueError(f"components must stay below {LIMIT / scale}")
    width = -(-size["n"] // parts)
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    padding = F.array_repeat(F.lit(0), width * parts - size["n"])
    return rows.filter(F.size("v") == size["n"]).select("vec_id", "label", F.concat(whole, padding).alias("v")), width


def train(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list]:
    """States under the last codebooks, and the codebooks of all rounds. ``rows`` must not be empty."""
    import numpy as np

    spark = rows.sparkSession
    start = rows.filter("vec_id is not null").groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").limit(entries).collect()
    start = start or rows.groupBy().agg(F.min("v").alias("v")).collect()  # no row has an id
    books = [np.stack([np.array(r["v"], np.int64).reshape(parts, width) for r in start], axis=1)]
    path = None
    states = rows
    for turn in range(rounds + 1):
        new = scratch_dir(spark, f"codes-{turn}")
        _assigned(states, books, parts, turn == 0).write.parquet(new)
        if path:
            _delete(spark, path)
        path, states = new, spark.read.parquet(new)
        if turn == rounds:
            break
        book = books[-1].copy()
        for (m, j), (n, sums) in _entry_sums(states, parts, book.shape[1]).items():
            book[m, j] = [x // n for x in sums]
        if (book == books[-1]).all():
            break  # the rounds left would change nothing
        books.append(book)
    return states, books


def codebooks_digest(book) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id``, ``label``, ``code``, ``error``, ``label_error``, ``codebooks_sha256``, ``rescans`` for every row that takes part.

    Components become floor(scale * x). Codebooks start as the parts of the rows with the smallest ids; of rows that share
    an id the smallest vector counts, rows without an id do not start an entry (only if none has one, the smallest vector does).
    Fewer ids than ``entries`` give as many entries. Null vectors, vectors with a null or non-finite component, empty ones and
    those of another length than the longest take no part; a length that is no multiple of ``parts`` is filled up with zeros.
    Repeated rows each count and each give a row. A component of 65,536 or more (at the default scale) raises ValueError,
    as exact distances would leave 64 bits. ``rescans`` counts the comparisons with all entries that the bounds left over,
    the first one of each part included. Other columns are ignored; an empty table gives no rows.
    """
    out = f"vec_id long, label {vectors.schema[label_col].dataType.simpleString()}, code string, error long, label_error long, codebooks_sha256 string, rescans int"
    rows, width = _integers(vectors, id_col, vector_col, label_col, scale, parts)
    rows = stored(rows, "integers")
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], out)
    states, books = train(rows, width, parts, entries, rounds)
    book = books[-1]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            if not batch.num_rows:
                continue
            v, code = _vectors(batch.column("v"), parts), np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            error = np.zeros(len(v), np.int64)
            for m in range(parts):
                gap = v[:, m] - book[m][code[:, m]]
                error += np.einsum("ij,ij->i", gap, gap)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in code]), pa.array(error), batch.column("rescans")],
                ["vec_id", "label", "code", "error", "rescans"])

    coded = stored(states.select("vec_id", "label", "v", "code", "rescans").mapInArrow(measured, f"vec_id long, label {_type(rows)}, code string, error long, rescans int"), "codes")
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(labels, coded["label"].eqNullSafe(labels["_label"])).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(codebooks_digest(book)).alias("codebooks_sha256"), "rescans")
