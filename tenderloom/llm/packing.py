"""Packing documents into sequences of fixed length by the sum-of-squares rule.

Documents are placed as they come. What is longer than a sequence is cut into full sequences and a
remainder. A remainder goes to the fill level (an open sequence of that level, or a new one) that makes the
sum over all levels of the squared number of open sequences smallest: placing an item of size s at level h
changes it by 2 (N[h + s] - N[h]) + 2 (for a new sequence by 2 N[s] + 1), so one look over the level array
decides. Full sequences leave at once; only open ones are held, as lists of pieces.

Every input partition packs on its own, so nothing is shuffled. At its end what is still open is laid out again
back to back, cutting freely; the last tokens become sequences of powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import word_tokenizer

LENGTH = 4096


class SumOfSquares:
    """Online packing of (item, size) into sequences of ``length``; ``done`` collects finished ones."""

    def __init__(self, length: int = LENGTH):
        import numpy as np

        self.length = length
        self.count = np.zeros(length + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.done: list[list] = []

    def place(self, piece: tuple, size: int) -> None:
        import numpy as np

        if size >= self.length:
            self.done.append([piece])
            return
        last = self.length - size
        # half the change of the sum of squares by level; filling a sequence up removes one and adds none
        change = self.count[size:] - self.count[:last + 1] + 1.0
        change[last] = 0.5 - self.count[last]
        change[self.count[:last + 1] == 0] = np.inf
        change[0] = self.count[size] + 0.5
        level = int(change.argmin())
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level == last:
            self.done.append(pieces)
        else:
            self.open.setdefault(level + size, []).append(pieces)
            self.count[level + size] += 1

    def leftover(self) -> list:
        """The pieces still open, fullest sequences first; nothing is open afterwards."""
        left = [piece for level in sorted(self.open, reverse=True) for pieces in self.open[level] for piece in pieces]
        self.open.clear()
        self.count[:] = 0
        return left


def lay_out(pieces: list[tuple[int, int, int]], length: int) -> list[list[tuple[int, int, int]]]:
    """Pieces (item, start, size) back to back in full sequences, the rest in sequences of powers of two."""
    total = sum(p[2] for p in pieces)
    sizes = [length] * (total // length) + [1 << b for b in range(length.bit_length(), -1, -1) if total % length >> b & 1]
    out, queue = [], list(reversed(pieces))
    for room in sizes:
        row = []
        while room:
            item, start, size = queue.pop()
            take = min(size, room)
            row.append((item, start, take))
            if take < size:
                queue.append((item, start + take, size - take))
            room -= take
        out.append(row)
    return out


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_id: int = 2, keeps_space: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_to.

    Null texts are empty and hold the end id only; every row is a document of its own, also where ids are equal
    or null. ``sequence_id`` is the number of the input partition and of the sequence in it. Other
    columns are ignored. An empty table gives no rows. Memory: the pieces of open sequences, at most one
    remainder per document of a partition.
    """
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to"]

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        from pyspark import TaskContext

        tokenizer, end = word_tokenizer(vocabulary, keeps_space), end_id.to_bytes(4, "little")
        base, made = TaskContext.get().partitionId() << 40, 0
        packer = SumOfSquares(length)
        held: dict[int, tuple] = {}  # ids of open remainders, for pieces that are cut at the end
        n = 0

        def rows(sequences: list, drop: bool) -> pd.DataFrame:
            nonlocal made
            out = []
            for pieces in sequences:
                at = 0
                total = sum(p[2] for p in pieces)
                for item, start, size in pieces:
                    doc_id, first, ids, tokens = held[item]
                    raw = ids[(start - first) * 4:(start - first + size) * 4]
                    out.append((doc_id, start, size, zlib.crc32(raw), tokens, base + made, at, total))
                    at += size
                    if drop:
                        del held[item]
                made += 1
            return pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

        for batch in batches:
            encoded = tokenizer.encoded(t or "" for t in batch["text"])
            for missing, doc_id, ids in zip(batch["missing"], batch["doc_id"], encoded):
                ids += end
                tokens = len(ids) // 4
                for start in range(0, tokens, length):
                    size = min(length, tokens - start)
                    held[n] = (None if missing else int(doc_id), start, ids[start * 4:(start + size) * 4], tokens)
                    packer.place((n, start, size), size)
                    n += 1
                if len(packer.done) >= 500:
                    yield rows(packer.done, True)
                    packer.done = []
        yield rows(packer.done, True)
        yield rows(lay_out(packer.leftover(), length), False)

    id_ = F.col(id_col).cast("long")
    return docs.select(F.coalesce(id_, F.lit(0)).alias("doc_id"), id_.isNull().alias("missing"), F.col(text_col).alias("text")).mapInPandas(
        packed, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_to long")
