"""Token files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents as blocks of 1,024: the block's minimum is subtracted, what is
left is packed at the width that holds nine tenths of the values, and the values that do not fit are kept
whole in an exception list. An index of block starts and one of documents end the file, so any document can
be read without its predecessors.

Layout (little-endian): magic, blocks, block starts (u64), documents (id i64, null flag u8, last id u64 each),
trailer (blocks, documents, ids, index start as u64; magic). Block: minimum u32, count u16, width u8, pad u8,
exceptions u16, packed bits (most significant first), exception places u16, exception values u32.

Documents are range-partitioned by id, one file per partition, written through the file system that the shared
folder's address names. A task that is repeated writes a file of another name; the list of files, written
by Spark's own committer, holds those of the tasks that counted.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir, stored
from .tokens import word_tokenizer

MAGIC = b"TLPFOR1\0"
BLOCK = 1024
FITS = 0.9
HEAD, TRAILER = struct.Struct("<IHBBH"), struct.Struct("<4Q8s")


def pack_blocks(ids, block: int = BLOCK, fits: float = FITS) -> list[bytes]:
    """The blocks of an array of unsigned 32-bit ids; only the last may be short."""
    import numpy as np

    out = []
    whole = len(ids) // block
    parts = [ids[:whole * block].reshape(whole, block)] if whole else []
    if len(ids) % block:
        parts.append(ids[whole * block:].reshape(1, -1))
    for rows in parts:
        n = rows.shape[1]
        least = rows.min(axis=1)
        delta = rows - least[:, None]
        nth = min(n - 1, max(0, int(np.ceil(fits * n)) - 1))
        pivot = np.partition(delta, nth, axis=1)[:, nth]
        width = np.ceil(np.log2(pivot.astype(np.float64) + 1)).astype(int)
        packed: list[bytes] = [b""] * len(rows)
        for w in np.unique(width):
            if w:
                at = np.flatnonzero(width == w)
                low = (delta[at] & np.uint32((1 << int(w)) - 1)).astype(">u4")
                bits = np.unpackbits(low.view(np.uint8).reshape(len(at), n, 4), axis=2)[:, :, 32 - w:]
                for i, b in zip(at, np.packbits(bits.reshape(len(at), -1), axis=1)):
                    packed[i] = b.tobytes()
        over = delta >= (np.uint64(1) << width.astype(np.uint64))[:, None]
        for i in range(len(rows)):
            places = np.flatnonzero(over[i])
            out.append(HEAD.pack(int(least[i]), n, int(width[i]), 0, len(places)) + packed[i]
                       + places.astype("<u2").tobytes() + delta[i][places].astype("<u4").tobytes())
    return out


def unpack_block(raw: bytes):
    """The ids of one block as unsigned 32-bit numbers."""
    import numpy as np

    least, n, width, _, exceptions = HEAD.unpack_from(raw)
    size = (n * width + 7) // 8
    if width:
        bits = np.zeros((n, 32), np.uint8)
        bits[:, 32 - width:] = np.unpackbits(np.frombuffer(raw, np.uint8, size, HEAD.size), count=n * width).reshape(n, width)
        delta = np.packbits(bits, axis=1).view(">u4").reshape(n).astype(np.uint32)
    else:
        delta = np.zeros(n, np.uint32)
    if exceptions:
        at = HEAD.size + size
        delta[np.frombuffer(raw, "<u2", exceptions, at)] = np.frombuffer(raw, "<u4", exceptions, at + 2 * exceptions)
    return delta + np.uint32(least)


class TokenFileWriter:
    """Writes documents one after the other; at most one unfinished block and the indexes are held."""

    def __init__(self, sink):
        self.sink, self.at, self.ids = sink, len(MAGIC), 0
        self.starts: list[int] = []
        self.docs: list[tuple[int, int, int]] = []
        self.rest: list[bytes] = []
        self.held = 0
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids += len(ids) // 4
        self.docs.append((doc_id or 0, doc_id is None, self.ids))
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= 256 * BLOCK * 4:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        import numpy as np

        ids = np.frombuffer(b"".join(self.rest), "<u4")
        take = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in pack_blocks(ids[:take]) if take else []:
            self.starts.append(self.at)
            self.sink.write(block)
            self.at += len(block)
        self.rest = [ids[take:].tobytes()]
        self.held = len(self.rest[0])

    def close(self) -> None:
        import numpy as np

        self._flush(True)
        index = [np.array(self.starts, "<u8"), np.array([d[0] for d in self.docs], "<i8"),
                 np.array([d[1] for d in self.docs], "u1"), np.array([d[2] for d in self.docs], "<u8")]
        for part in index:
            self.sink.write(part.tobytes())
        self.sink.write(TRAILER.pack(len(self.starts), len(self.docs), self.ids, self.at, MAGIC))


class TokenFileReader:
    """Reads a token file; ``documents`` goes through it in order, ``ids`` reads any range of ids."""

    def __init__(self, source, size: int):
        import numpy as np

        source.seek(size - TRAILER.size)
        blocks, docs, self.n_ids, self.index, magic = TRAILER.unpack(source.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        source.seek(self.index)
        raw = source.read(blocks * 8 + docs * 17)
        self.source = source
        self.starts = np.append(np.frombuffer(raw, "<u8", blocks), np.uint64(self.index)).astype(np.int64)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, blocks * 8)
        self.null = np.frombuffer(raw, "u1", docs, blocks * 8 + docs * 8)
        self.ends = np.frombuffer(raw, "<u8", docs, blocks * 8 + docs * 9).astype(np.int64)

    def blocks(self, first: int, last: int):
        """The ids of the blocks from ``first`` up to, not including, ``last``."""
        import numpy as np

        begin = int(self.starts[first])
        self.source.seek(begin)
        raw = self.source.read(int(self.starts[last]) - begin)
        cuts = (self.starts[first:last + 1] - begin).tolist()
        return np.concatenate([unpack_block(raw[a:b]) for a, b in zip(cuts, cuts[1:])])

    def ids(self, start: int, end: int):
        import numpy as np

        if start >= end:
            return np.zeros(0, np.uint32)
        first = start // BLOCK
        return self.blocks(first, (end - 1) // BLOCK + 1)[start - first * BLOCK:end - first * BLOCK]

    def documents(self, at_once: int = 256) -> Iterator[tuple[int | None, int, int, list]]:
        """Id, first id's place, number of ids and pieces of ids of every document, some blocks at a time."""
        begin = doc = 0
        pieces: list = []
        blocks = len(self.starts) - 1
        ends = self.ends.tolist()
        for first in range(0, blocks, at_once):
            ids = self.blocks(first, min(blocks, first + at_once))
            low, at = first * BLOCK, 0
            while doc < len(ends) and ends[doc] <= low + len(ids):
                pieces.append(ids[at:ends[doc] - low])
                yield (None if self.null[doc] else int(self.doc_ids[doc])), begin, ends[doc] - begin, pieces
                begin, at, pieces, doc = ends[doc], ends[doc] - low, [], doc + 1
            pieces.append(ids[at:])


def arrow_uri(path: str) -> str:
    """The path with Hadoop's names of S3 as pyarrow knows them; other schemes and plain paths stay."""
    scheme, sep, rest = path.partition("://")
    return f"s3://{rest}" if sep and scheme in ("s3a", "s3n") else path


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int = 2, keeps_space: bool = True, id_col: str = "doc_id",
                 text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Writes the documents' ids as token files and returns their list: part, path, size, documents, ids.

    Files are in ascending order of id (null ids first; equal ids in order of a hash of their texts, so reruns agree). Null texts are empty and hold
    the end id only. Other columns are ignored. An empty table gives an empty list.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "tokens")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext

        tokenizer = word_tokenizer(vocabulary, keeps_space)
        end = end_id.to_bytes(4, "little")
        writer = sink = None
        for batch in batches:
            if writer is None and len(batch):
                system, root = fs.FileSystem.from_uri(arrow_uri(folder))
                system.create_dir(root, recursive=True)
                part = TaskContext.get().partitionId()
                name = f"part-{part:06d}-{uuid.uuid4().hex}.pfor"
                sink = system.open_output_stream(f"{root}/{name}")
                writer = TokenFileWriter(sink)
            encoded = tokenizer.encoded(t or "" for t in batch["text"])
            for missing, doc_id, ids in zip(batch["missing"], batch["doc_id"], encoded):
                writer.add(None if missing else int(doc_id), ids + end)
        if writer is not None:
            writer.close()
            sink.close()
            size = system.get_file_info(f"{root}/{name}").size
            yield pd.DataFrame({"part": [part], "path": [f"{folder}/{name}"], "bytes": [size],
                                "n_docs": [len(writer.docs)], "n_ids": [writer.ids]})

    id_ = F.col(id_col).cast("long")
    rows = docs.select(id_.alias("raw"), F.coalesce(id_, F.lit(0)).alias("doc_id"), id_.isNull().alias("missing"), F.col(text_col).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))  # orders equal ids and lets them lie in several ranges
    rows = rows.repartitionByRange("raw", "digest").sortWithinPartitions("raw", "digest").select("doc_id", "missing", "text")
    return stored(rows.mapInPandas(write, "part int, path string, bytes long, n_docs long, n_ids long"), "token-files")


def read_digests(files: DataFrame) -> DataFrame:
    """One row per document of the token files: ``doc_id``, ``start`` over all files, ``n_tokens``, ``ids_crc32``."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        from pyarrow import fs

        for batch in batches:
            for path, size, before in zip(batch["path"], batch["bytes"], batch["before"]):
                system, name = fs.FileSystem.from_uri(arrow_uri(path))
                with system.open_input_file(name) as source:
                    found = []
                    for doc_id, start, n, pieces in TokenFileReader(source, int(size)).documents():
                        crc = 0
                        for piece in pieces:
                            crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                        found.append((doc_id, before + start, n, crc))
                        if len(found) == 20_000:
                            yield _frame(found)
                            found = []
                    yield _frame(found)

    def _frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
        return out.astype({"doc_id": "Int64"})

    n = max(1, files.count())
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("before", F.coalesce(F.sum("n_ids").over(upto), F.lit(0)))  # one row per file
    return placed.select("path", "bytes", "before").repartition(n).mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")
