"""Packing by power-of-two decomposition: documents cut into binary-length pieces, equal lengths bucketed."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release
from .tokens import batches, encoder

PIECES = "id long, start long, length long, bucket int, doc_tokens long, ids binary"


def piece_lengths(n: int, longest: int) -> list[int]:
    """``n`` as a sum of powers of two, none above ``longest`` (itself a power of two), longest first."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def binary_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, longest: int = 4096, memo_bytes: int = 100_000_000) -> DataFrame:
    """The pieces of all documents: id, ``start``, ``length``, ``bucket`` (log2 of the length), ``doc_tokens``, ``ids`` (little-endian
    unsigned 32-bit), ``sequence_id``, ``offset``.

    A document's ids under the tokenizer at ``path`` and one ``end_id`` are cut into pieces whose lengths are powers of two up to
    ``longest``. A piece is a sequence: batches are drawn from one bucket, so nothing is padded and no sequence holds two documents.
    Work is by document in Arrow batches, without a shuffle; memory grows with the longest text only, beside twice ``memo_bytes`` a worker for
    ids already looked up. ``sequence_id`` follows the order of the input partitions. The string of a special token in a text becomes that
    token's id, as in the library.

    Null or empty text: one piece of length 1, the end id. Null or repeated ids are carried as they are, each row packed by itself.
    An empty table gives no rows; other columns are ignored.
    """

    def cut(parts: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encode, end = encoder(path, False, memo_bytes=memo_bytes), np.array([end_id], "<u4").tobytes()
        for part in parts:
            names, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for a, b in batches(texts):
                out: dict[str, list] = {k: [] for k in ("id", "start", "length", "bucket", "doc_tokens", "ids")}
                for name, ids in zip(names[a:b], encode.ids(texts[a:b]), strict=True):
                    ids, start = ids + end, 0
                    n = len(ids) // 4
                    for k in piece_lengths(n, longest):
                        for key, value in zip(out, (name, start, k, k.bit_length() - 1, n, ids[4 * start : 4 * (start + k)]), strict=True):
                            out[key].append(value)
                        start += k
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))
        release()

    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    pieces = rows.mapInArrow(cut, PIECES).withColumnRenamed("id", id_col)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One directory a bucket: training reads batches of equal length from it."""
    pieces.write.partitionBy("bucket").parquet(path)
