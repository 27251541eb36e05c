"""Token ids in word-aligned binary form (Simple-8b), written through Spark in document order and read back."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import release
from .tokens import batches, encoder

#: Fixed values of the format: selector s packs COUNTS[s] ids of WIDTHS[s] bits in the low 60 bits of a word; selector 0 is an escape, a run
#: of one id of any width (run length in 28 bits, id in 32).
COUNTS = (1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (32, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 30)
MAGIC, BLOCK = b"TMS8", 1024
HEAD = struct.Struct("<4sIQQQ")  # magic, block size, documents, ids, words
#: Bits of each id below 65,536; one bit for 0.
BITS = np.maximum(np.frexp(np.arange(1 << 16))[1], 1).astype(np.uint8)


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words, and for each block of ``block`` ids the number of its first word. Blocks share no word, so each decodes alone."""
    n = len(ids)
    blocks = -(-n // block)
    wide = np.full(blocks * block + 60, 255, np.uint8)  # bits of each id; beyond the end nothing fits
    high = ids >> np.uint32(16)
    wide[:n] = np.where(high > 0, BITS[np.minimum(high, len(BITS) - 1)] + 16, BITS[ids & np.uint32(0xFFFF)]) if high.any() else BITS[ids]
    best = np.zeros(blocks * block, np.uint8)  # the selector that packs most ids from here on
    by_count = {COUNTS[s]: s for s in range(14, 0, -1)}
    most, room = wide[:n].copy(), np.tile(np.arange(block, 0, -1, dtype=np.uint16), blocks)[:n]
    for k in range(1, 6):
        if k > 1:
            np.maximum(most, wide[k - 1 : k - 1 + n], out=most)
        fits = (most <= WIDTHS[by_count[k]]) & (room >= k)
        best[:n][fits] = by_count[k]
    # where a selector's ids don't fit, those of one for more and narrower ids don't either: the few places that are left are looked at one by one
    place = np.flatnonzero(fits)
    most = most[place]
    for k in range(6, COUNTS[1] + 1):
        most = np.maximum(most, wide[place + (k - 1)])
        if k in by_count:
            fits = (most <= WIDTHS[by_count[k]]) & (room[place] >= k)
            place, most = place[fits], most[fits]
            best[place] = by_count[k]
    counts = np.array(COUNTS)
    at = np.arange(blocks) * block
    ends = np.minimum(at + block, n)
    starts, owner, live = [], [], np.arange(blocks)
    while len(live):
        here = at[live]
        starts.append(here)
        owner.append(live)
        at[live] = here + counts[best[here]]
        live = live[at[live] < ends[live]]
    if not starts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    start = np.sort(np.concatenate(starts))
    first = np.searchsorted(start, np.arange(blocks) * block).astype(np.uint32)
    selector = best[start]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector):
        mine = selector == s
        if s == 0:
            words[mine] |= (np.uint64(1) << np.uint64(32)) | ids[start[mine]].astype(np.uint64)
            continue
        shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
        words[mine] |= np.bitwise_or.reduce(ids[start[mine][:, None] + np.arange(COUNTS[s])].astype(np.uint64) << shifts, axis=1)
    return words, first


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of consecutive words, decoded selector by selector."""
    selector = (words >> np.uint64(60)).astype(np.uint8)
    counts = np.array(COUNTS)[selector]
    escaped = selector == 0
    counts[escaped] = (words[escaped] >> np.uint64(32)) & np.uint64((1 << 28) - 1)
    at = np.cumsum(counts) - counts
    ids = np.zeros(n, np.uint32)
    for s in np.unique(selector):
        mine = np.flatnonzero(selector == s)
        if s == 0:
            for i in mine:
                ids[at[i] : at[i] + counts[i]] = words[i] & np.uint64(0xFFFFFFFF)
            continue
        shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
        ids[at[mine][:, None] + np.arange(COUNTS[s])] = (words[mine][:, None] >> shifts) & np.uint64((1 << WIDTHS[s]) - 1)
    return ids


def segment(names: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One segment: head, ids of documents (with a null flag each), lengths, block offsets, words."""
    words, first = pack(ids)
    known = np.array([x is not None for x in names], np.uint8)
    named = np.array([x or 0 for x in names], "<i8")
    head = HEAD.pack(MAGIC, BLOCK, len(names), len(ids), len(words))
    return b"".join([head, named.tobytes(), known.tobytes(), np.array(lengths, "<u8").tobytes(), first.astype("<u4").tobytes(), words.astype("<u8").tobytes()])


def parse(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, lengths, block offsets, words) of a segment."""
    magic, block, docs, n, words = HEAD.unpack_from(data)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a segment of token ids")
    at = HEAD.size
    named, at = np.frombuffer(data, "<i8", docs, at), at + 8 * docs
    known, at = np.frombuffer(data, np.uint8, docs, at), at + docs
    lengths, at = np.frombuffer(data, "<u8", docs, at), at + 8 * docs
    first, at = np.frombuffer(data, "<u4", -(-n // BLOCK), at), at + 4 * -(-n // BLOCK)
    return [x if k else None for x, k in zip(named.tolist(), known.tolist(), strict=True)], lengths, first, np.frombuffer(data, "<u8", words, at)


def ids_between(data: bytes, begin: int, end: int) -> np.ndarray:
    """Ids ``begin`` to ``end`` of a segment, decoding only the blocks that hold them."""
    _, lengths, first, words = parse(data)
    end = min(end, int(lengths.sum()))
    if begin >= end:
        return np.zeros(0, np.uint32)
    a, b = begin // BLOCK, -(-end // BLOCK)
    last = int(first[b]) if b < len(first) else len(words)
    got = unpack(words[int(first[a]) : last], min(b * BLOCK, int(lengths.sum())) - a * BLOCK)
    return got[begin - a * BLOCK : end - a * BLOCK]


def write_ids(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, segment_ids: int = 1_000_000) -> None:
    """Writes the ids of all texts, each with ``end_id`` after it, in ascending id order (null first; equal ids by a hash of their texts).

    Rows are dealt by ranges of the id, so file k holds smaller ids than file k + 1, and are sorted in each file. A file is a Parquet
    container, which any store takes that Spark can write to; each of its rows is a segment of about ``segment_ids`` ids (never
    part of a document) in the format above. Null text counts as empty. The string of a special token in a text becomes that token's id, as
    in the library.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), text.alias("__text"))
    rows = rows.repartitionByRange("__id").sortWithinPartitions("__id", F.xxhash64("__text")).withColumn("__file", F.spark_partition_id())

    def encode(parts: Iterator) -> Iterator:
        import pyarrow as pa

        of, end = encoder(tokenizer, True), np.array([end_id], "<u4").tobytes()
        names, lengths, held, total, at, file = [], [], [], 0, 0, 0
        kinds = {"file": pa.int32(), "segment": pa.int32(), "n_docs": pa.int64(), "n_ids": pa.int64(), "data": pa.binary()}

        def made():
            data = segment(names, lengths, np.frombuffer(b"".join(held), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((file, at, len(names), total, data), kinds.values(), strict=True)], list(kinds))

        for part in parts:
            own, texts, file = part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)[0].as_py() if part.num_rows else file
            for a, b in batches(texts):
                for name, ids in zip(own[a:b], of.ids(texts[a:b]), strict=True):
                    names.append(name)
                    lengths.append(len(ids) // 4 + 1)
                    held.append(ids + end)
                    total += lengths[-1]
                    if total >= segment_ids:
                        yield made()
                        names, lengths, held, total, at = [], [], [], 0, at + 1
        if names:
            yield made()
        release()

    rows.mapInArrow(encode, "file int, segment int, n_docs long, n_ids long, data binary").write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids``."""
    files = spark.read.parquet(path)

    def decode(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for part in parts:
            for file, number, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                names, lengths, _, words = parse(data.as_buffer())
                ids = unpack(words, int(lengths.sum())).astype("<u4").tobytes()
                ends = np.cumsum(lengths).tolist()
                starts = [0, *ends[:-1]]
                docs = [ids[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)]
                columns = [pa.array([file] * len(names), pa.int32()), pa.array([number] * len(names), pa.int32()), pa.array(names, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths.astype(np.int64)), pa.array([zlib.crc32(x) for x in docs], pa.int64())]
                labels = ["file", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, labels = [*columns, pa.array(docs, pa.binary())], [*labels, "ids"]
                yield pa.RecordBatch.from_arrays(columns, labels)

    docs = files.select("file", "segment", "data").mapInArrow(decode, "file int, segment int, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    heads = files.select("file", "segment", "n_ids")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    totals = heads.groupBy("file").agg(F.sum("n_ids").alias("__n")).select("file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__file_start"))
    inside = Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = heads.select("file", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("__segment_start")).join(totals, "file")
    start = F.col("__file_start") + F.col("__segment_start") + F.col("inside")
    return docs.join(starts, ["file", "segment"]).select("doc_id", start.cast("long").alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
