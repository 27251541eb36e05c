"""Best-fit packing by exact complements: pieces of documents meet in sequences that their lengths fill, planned on counts of lengths alone."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, numbered, release
from .tokens import batches, encoder

PIECES = "id long, piece int, start long, length int, ids_crc32 long, ids binary"


def cuts(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: one, or if ``n`` is above ``longest`` a first one of what is over and then full ones."""
    first = n % longest or min(n, longest)
    return [(0, first), *((start, longest) for start in range(first, n, longest))]


def _pair(counts: np.ndarray, total: int) -> tuple[int, int] | None:
    """The two lengths of that ``total`` of which most pairs can be had."""
    if total < 2:
        return None
    both = np.minimum(counts[1:total], counts[total - 1 : 0 : -1])
    if total % 2 == 0:
        both[total // 2 - 1] = counts[total // 2] // 2
    best = int(both.argmax())
    return (best + 1, total - best - 1) if both[best] > 0 else None


def complement(counts: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three lengths that fill ``gap`` exactly and can be had together; the fewest, and of triples that with the longest member."""
    if gap > 0 and counts[gap] > 0:
        return (gap,)
    found = _pair(counts, gap)
    if found or gap < 3:
        return found
    left = counts.copy()
    for x in np.flatnonzero(counts[: gap - 1])[::-1].tolist():
        left[x] -= 1
        found = _pair(left, gap - x)
        left[x] += 1
        if found:
            return (x, *found)
    return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """How to pack ``counts`` pieces of each length: (number of sequences, the lengths in each), in order.

    From the longest length down, combinations that fill the gap beside a piece exactly are consumed as often as all of their members can be had;
    then what is left is packed best fit, longest first, into the smallest gap that takes it. Each step uses up a length or a group of open
    sequences, so the plan has a few entries a length, whatever the number of pieces.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[int, tuple[int, ...]]] = []
    for a in range(capacity, 0, -1):
        while left[a] > 0:
            left[a] -= 1
            rest = () if a == capacity else complement(left, capacity - a)
            left[a] += 1
            if rest is None:
                break
            times = Counter((a, *rest))
            n = int(min(left[v] // k for v, k in times.items()))
            for v, k in times.items():
                left[v] -= n * k
            out.append((n, tuple(sorted((a, *rest), reverse=True))))
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for a in range(capacity, 0, -1):
        n = int(left[a])
        for gap in sorted(g for g in open_ if g >= a):
            while n and open_[gap]:
                bins, parts = open_[gap].pop()
                n = _fill(open_, bins, parts, gap, a, n)
        if n:
            _fill(open_, n, (), capacity, a, n)
    return out + [(bins, parts) for gap in sorted(open_) for bins, parts in open_[gap] if parts]


def _fill(open_: dict, bins: int, parts: tuple[int, ...], gap: int, a: int, n: int) -> int:
    """Puts up to ``n`` pieces of length ``a`` into ``bins`` equal sequences, as many as fit into one after the other; returns how many are left."""
    each = gap // a
    full = min(bins, n // each)
    rest = n - full * each if full < bins else 0
    for m, k in ((full, each), (1, rest) if rest else (0, 0), (bins - full - (rest > 0), 0)):
        if m:
            open_.setdefault(gap - k * a, []).append((m, parts + (a,) * k))
    return n - full * each - rest


def _places(entries: list[tuple[int, tuple[int, ...]]], counts: dict[int, int]) -> dict[str, np.ndarray]:
    """The plan by number: pieces numbered by length stand in runs, each run in one entry and of one length; arrays by run, in order of ``first``."""
    first = dict(zip(sorted(counts), np.cumsum([0, *(counts[v] for v in sorted(counts))]).tolist(), strict=False))
    runs, sequence = [], 0
    for bins, parts in entries:
        at = 0
        for v, k in sorted(Counter(parts).items(), reverse=True):
            runs.append((first[v], sequence, k, at))
            first[v] += bins * k
            at += v * k
        sequence += bins
    columns = np.array(sorted(runs), np.int64).reshape(-1, 4).T
    return dict(zip(("first", "sequence", "each", "offset"), columns, strict=True))


def best_fit_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = 1024, with_ids: bool = False, memo_bytes: int = 100_000_000) -> DataFrame:
    """The pieces of all documents and their places: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` and, if asked for, ``ids``
    (little-endian unsigned 32-bit).

    A document is its ids under the tokenizer at ``path`` and one ``end_id``; only those above ``capacity`` are cut, into full pieces after a first
    one of what is over. Encoding goes by document in Arrow batches and is written once. The plan is made on the counts of lengths, which are at
    most ``capacity`` numbers; pieces are numbered by length with one range shuffle (a length that many share is cut into ranges too), and a
    piece's number tells its place in the plan. Sequence ids follow the order of encoding among equal lengths; they may differ between runs.

    Null or empty text: one piece, the end id. Null or repeated ids are carried as they are, each row packed by itself. An empty table gives no
    rows; other columns are ignored.
    """

    def encode(parts: Iterator) -> Iterator:
        import pyarrow as pa

        of, end = encoder(path, True, memo_bytes=memo_bytes), np.array([end_id], "<u4").tobytes()
        kinds = {"id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int32(), "ids_crc32": pa.int64(), "ids": pa.binary()}
        for part in parts:
            names, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for a, b in batches(texts):
                out: dict[str, list] = {k: [] for k in kinds}
                for name, ids in zip(names[a:b], of.ids(texts[a:b]), strict=True):
                    ids += end
                    for k, (start, n) in enumerate(cuts(len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + n)]
                        for key, value in zip(out, (name, k, start, n, zlib.crc32(own), own if with_ids else None), strict=True):
                            out[key].append(value)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds.values(), strict=True)], list(kinds))
        release()

    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    pieces = scratch.keep(rows.mapInArrow(encode, PIECES).withColumn("__row", F.monotonically_increasing_id()))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    by_run = _places(plan(counts, capacity), counts)

    def place(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for part in parts:
            number = part.column("__number").to_numpy()
            run = np.searchsorted(by_run["first"], number, "right") - 1
            inside = number - by_run["first"][run]
            sequence = by_run["sequence"][run] + inside // by_run["each"][run]
            offset = by_run["offset"][run] + inside % by_run["each"][run] * part.column("length").to_numpy()
            kept = [c for c in part.schema.names if c != "__number"]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*kept, "sequence_id", "offset"])

    dealt = numbered(pieces.drop("ids"), ["length", "__row"], "__number")
    out = dealt.mapInArrow(place, "id long, piece int, start long, length int, ids_crc32 long, __row long, sequence_id long, offset long")
    if with_ids:
        out = out.join(pieces.select("__row", "ids"), "__row")
    else:
        scratch.drop(0, 1)  # the numbered rows are checkpointed
    return out.withColumn("length", F.col("length").cast("long")).withColumnRenamed("id", id_col).drop("__row")


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences of ``best_fit_pieces(.., with_ids=True)``: id, number of tokens, their ids; a group is one sequence, at most ``capacity`` tokens."""
    inside = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.aggregate(inside, F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))
