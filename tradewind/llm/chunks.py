"""Documents in chunks of a few megabytes, so that tasks can exchange facts about texts, not texts.

A chunk is one row with its texts compressed in one value; it is written once and is the same for every
later pass, on any executor. A pass sends what it has found in a chunk, reduced to distinct keys, to
buckets of the key space, and gets an answer per chunk back. So a text that very many documents share
reaches a bucket once per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import stored

CHUNK_BYTES = 2 << 20
NO_ID = np.iinfo(np.int64).max
_SCHEMA = "chunk bigint, n_bytes bigint, ids binary, nulls binary, sizes binary, body binary"
_ARROW = pa.schema([("chunk", pa.int64()), ("n_bytes", pa.int64()), *[(c, pa.binary()) for c in ("ids", "nulls", "sizes", "body")]])


@dataclass
class Chunk:
    chunk: int
    ids: np.ndarray  # null ids count as the largest
    nulls: np.ndarray
    begins: np.ndarray  # of each text, one blank between texts; one more at the end
    data: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.begins[i] : self.begins[i + 1] - 1].tobytes()

    def id_list(self) -> list[int | None]:
        return [None if null else int(i) for i, null in zip(self.ids, self.nulls)]


def packed(values: bytes, level: int = 1) -> bytes:
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", level).compress(values, asbytes=True)


def unpacked(values: bytes) -> bytes:
    return pa.decompress(values[8:], int.from_bytes(values[:8], "little"), codec="zstd", asbytes=True)


def _row(chunk: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
    nulls = np.array([i is None for i in ids], dtype=bool)
    known = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    row = [chunk, int(sizes.sum()), known.tobytes(), nulls.tobytes(), sizes.tobytes(), packed(b" ".join(texts) + b" ")]
    return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents' ids and texts as a stored table of chunks; a long text is a chunk of its own."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                text = text or b""
                if texts and held + len(text) > chunk_bytes:
                    yield _row(number, ids, texts)
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(i)
                texts.append(text)
                held += len(text) + 16
        if texts:
            yield _row(number, ids, texts)

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(gather, _SCHEMA))


def opened(row: dict) -> Chunk:
    sizes = np.frombuffer(row["sizes"], dtype=np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    return Chunk(row["chunk"], np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["nulls"], dtype=bool), begins,
                 np.frombuffer(unpacked(row["body"]), dtype=np.uint8))


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}


def bucket_count(chunks: DataFrame, bytes_per_byte: float, bucket_bytes: int = 8 << 20) -> int:
    """Buckets of about ``bucket_bytes``, if every byte of text sends so many bytes."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(1, int(total * bytes_per_byte / bucket_bytes) + 1)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The slice of the hash space, by the top 32 bits."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def dealt(sent: DataFrame, buckets: int) -> DataFrame:
    """``sent`` by bucket, in as many partitions as there are buckets or the session shuffles to.

    The number is given, as small partitions should not be merged here: what they cost is work, not bytes.
    """
    usual = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sent.repartition(min(buckets, max(usual, 200)), "bucket")


def answered(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """``chunks`` with a column ``answers``: the (bucket, answer) pairs of each, at most one per bucket."""
    gathered = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))
    return chunks.join(gathered, "chunk", "left")


def answers_of(row: dict) -> dict[int, bytes]:
    return {a["bucket"]: a["answer"] for a in row["answers"] or []}
