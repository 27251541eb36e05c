"""The trie of conversation prefixes, as intervals of sorted conversations: a Cartesian tree over the lengths of common prefixes of neighbours.

Conversations are sorted by their turns' keys; ``lcp`` of a row is the number of turns it shares with the row before (-1 for the first). A node of
the trie is a run of rows that share its turns. Where its rows part (or some of them end), the smallest lcp inside the run is the node's depth, and
the nearest smaller values on either side bound the run: ``p``, its first row, and ``q``, the first row after it. Rows of equal lcp in one run are one
node; depths above it down to the larger of the two bounding values are nodes of the same run. All that a node needs comes from
running sums over rows: with S the words that a row shares with the row before, a node's subtree saves the sum of S over its run but for the first
row, less what stands before the node once for each of these rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, checkpointed

#: Bytes of a turn's key in a conversation's sort key; rows of a block (a range partition).
KEY, BLOCK_ROWS = 16, 50_000
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()

#: What a block gives. ``node``: a node whose run lies in the block, one row a depth. ``open``: a node whose run crosses the block's left or right border, to be
#: completed. ``stop``: a row where such a run can begin (right side) or end (left side). ``end``: a member of a run of equal rows at a border. ``block``: totals.
#: ``up_block``, ``up_side``, ``up_depth`` name the parent of a node where that is an open one.
FOUND = (
    "kind string, block int, left boolean, right boolean, depth int, conv long, parent long, up_block int, up_side string, up_depth int, members long, children long, "
    "leaves long, saved long, words array<long>, sha string, run binary, place long, length int"
)
FIELDS = {f.split()[0]: f.split()[1] for f in FOUND.split(", ")}


def conversations(turns: DataFrame, conv_col: str = "conv_id", place_col: str = "place", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, ``keys`` (its turns' keys in order of place, binary), ``words`` (words of each turn's text).

    A turn's key is a 128-bit hash of role and text (null counts as empty). A row without a place adds no turn. Memory of a task grows with the
    longest conversation, by some 60 bytes a turn.
    """
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    turn = F.when(F.col(place_col).isNotNull(), F.struct(F.col(place_col).alias("place"), key.alias("key"), words.alias("words")))
    each = turns.select(F.col(conv_col).cast("long").alias("conv"), turn.alias("turn")).filter("conv is not null")
    rows = each.groupBy("conv").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    joined = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), ""))
    return rows.select("conv", joined.alias("keys"), F.col("turns.words").alias("words"))


def shared(a: bytes, b: bytes) -> int:
    """How many whole keys two rows have in common at their beginnings."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // KEY
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))) // KEY


def nearest_smaller(values: list[int]) -> tuple[list[int], list[int]]:
    """For each value the place of the nearest smaller one before it (else -1) and after it (else the number of values)."""
    n = len(values)
    before, after, stack = [-1] * n, [n] * n, []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            after[stack.pop()] = i
        k = stack[-1] if stack else -1
        before[i] = before[k] if k >= 0 and values[k] == v else k
        stack.append(i)
    return before, after


class Least:
    """The least value of any range, from the least of ranges whose lengths are powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (step := 1 << len(self.levels) - 1) * 2 <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, begin: int, end: int) -> int:
        k = (end - begin).bit_length() - 1
        return int(min(self.levels[k][begin], self.levels[k][end - (1 << k)]))


def expanded(depth: int, top: int, conv: int, members: int, children: int, leaves: int, sums: int, words, sha: str | None, run: bytes | None) -> Iterator[dict]:
    """A node and the nodes of the same run above it, ``top`` first; ``words[d]`` are those of the first d turns. Only the deepest has ends and can branch."""
    for d in range(top, depth + 1):
        last = d == depth
        yield {
            "kind": "node", "depth": d, "conv": conv, "parent": conv if d > top else None, "members": members, "children": children if last else 1, "leaves": leaves,
            "saved": sums - (members - 1) * int(words[d - 1] if d else 0), "sha": sha if last else NOTHING, "run": run if last else None,
        }


def _batches(rows: Iterator[dict], size: int = 20_000) -> Iterator:
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    held: list[dict] = []

    def made():
        return pa.RecordBatch.from_arrays([pa.array([r.get(f) for r in held], kinds[t]) for f, t in FIELDS.items()], list(FIELDS))

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held.clear()
    if held:
        yield made()


def _in_block(edges: dict[int, tuple[int, int, int]]):
    """Finds what ``FOUND`` names in a block; ``edges``: by block the lcp of its first row, that of the next block's first row, and the rows before it."""

    def of_rows(block: int, lcp: list[int], convs: list[int], totals: list[np.ndarray], equal: list[tuple[int, int, bytes]]) -> Iterator[dict]:
        n, (_, following, start) = len(lcp), edges[block]
        nexts = [*lcp[1:], following]
        lengths = [len(t) - 1 for t in totals]
        leaves = np.concatenate([[0], np.cumsum(np.array(nexts) < np.array(lengths))]).astype(np.int64)
        sums = np.concatenate([[0], np.cumsum([int(t[max(v, 0)]) for t, v in zip(totals, lcp, strict=True)])]).astype(np.int64)
        least = Least(np.array(convs, np.int64))
        ends: dict[int, tuple[str | None, bytes | None]] = {}
        for a, b, keys in equal:
            if (a == 0 and lcp[0] == lengths[0]) or (b == n and following >= lengths[-1]):
                name = hashlib.md5(keys).digest()
                yield from ({"kind": "end", "conv": c, "run": name} for c in convs[a:b])
                ends[a] = (None, name)
            else:
                ends[a] = (hashlib.sha256(",".join(map(str, convs[a:b])).encode()).hexdigest(), None)
        before, after = nearest_smaller(lcp)
        at: dict[tuple[int, int], list[int]] = {}  # nodes: first row before their first lcp (-1: in an earlier block), depth -> rows of that lcp
        for j, (p, v) in enumerate(zip(before, lcp, strict=True)):
            if v >= 0:
                at.setdefault((p, v), []).append(j)
        whole = {key: least(key[0], after[own[0]]) for key, own in at.items() if key[0] >= 0 and after[own[0]] < n}

        def parent(j: int) -> dict:
            """What tells the parent of a node that is bounded by the lcp of row ``j``."""
            v = following if j == n else lcp[j]
            if v < 0:
                return {}
            if j == n:
                return {"up_block": block, "up_side": "next", "up_depth": v}
            key = (before[j], v)
            return {"parent": whole[key]} if key in whole else {"up_block": block, "up_side": "L" if key[0] < 0 else "R", "up_depth": v}

        for i in range(n):  # rows alone, below what they share with their neighbours
            top = max(lcp[i], nexts[i]) + 1
            if top <= lengths[i]:
                up = parent(i if lcp[i] >= nexts[i] else i + 1)
                for row in expanded(lengths[i], top, convs[i], 1, 0, 1, 0, totals[i], *ends[i]):
                    yield row | up if row["depth"] == top else row
        for (p, v), own in at.items():
            q = after[own[0]]
            branches = sum(lengths[j] > v for j in own)
            if (p, v) not in whole:
                yield {"kind": "open", "block": block, "left": p < 0, "right": q == n, "depth": v, "children": branches, "words": totals[own[0]][: v + 1]}
                continue
            top = max(lcp[p], lcp[q]) + 1
            up = parent(p if lcp[p] >= lcp[q] else q)
            sha, run = ends[p] if lengths[p] == v else (NOTHING, None)
            for row in expanded(v, top, whole[p, v], q - p, branches + (lengths[p] > v), int(leaves[q] - leaves[p]), int(sums[q] - sums[p + 1]), totals[p], sha, run):
                yield row | up if row["depth"] == top else row
        smallest = lcp[-1] + 1
        for i in reversed(range(n)):  # where runs to the right of this block can begin
            if lcp[i] < smallest:
                smallest = lcp[i]
                sha, run = ends.get(i, (None, None))
                yield {"kind": "stop", "block": block, "left": False, "depth": lcp[i], "place": start + i, "conv": least(i, n), "length": lengths[i], "leaves": int(leaves[i]), "saved": int(sums[i + 1]), "sha": sha, "run": run}
        smallest = lcp[0] + 1
        for i in range(n):  # where runs from the left of this block can end
            if lcp[i] < smallest:
                smallest = lcp[i]
                yield {"kind": "stop", "block": block, "left": True, "depth": lcp[i], "place": start + i, "conv": least(0, i) if i else None, "leaves": int(leaves[i]), "saved": int(sums[i])}
        yield {"kind": "block", "block": block, "depth": min(lcp), "conv": least(0, n), "leaves": int(leaves[n]), "saved": int(sums[n]), "place": start}

    def find(parts: Iterator) -> Iterator:
        block, lcp, convs, totals, equal, last, begun = None, [], [], [], [], None, 0
        for part in parts:
            for keys, conv, words, block in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):  # noqa: B007
                if last is not None and keys != last:
                    equal.append((begun, len(lcp), last))
                    begun = len(lcp)
                lcp.append(edges[block][0] if last is None else shared(last, keys))
                convs.append(conv)
                totals.append(np.concatenate([[0], np.cumsum(words)]).astype(np.int64))
                last = keys
        if last is not None:
            equal.append((begun, len(lcp), last))
            yield from _batches(of_rows(block, lcp, convs, totals, equal))

    return find


def _ends(parts: Iterator) -> Iterator:
    """SHA-256 of each run's ids, which come in order; a run of any length passes through in batches."""
    import pyarrow as pa

    name, digest, done = None, None, []
    for part in parts:
        for run, conv in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            if run != name:
                if name is not None:
                    done.append((name, digest.hexdigest()))
                name, digest = run, hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if len(done) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*done, strict=True)], ["run", "ends"])
            done = []
    if name is not None:
        done.append((name, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*done, strict=True)], ["run", "ends"])


def _borders(parts: Iterator) -> Iterator:
    import pyarrow as pa

    for part in parts:
        blocks, firsts, lasts = (part.column(k).to_pylist() for k in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([shared(a, b) for a, b in zip(firsts, lasts, strict=True)], pa.int32())], ["block", "lcp"])


def prefix_trie(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The nodes of the trie of ``conversations(..)``, one row each: ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Rows are sorted by one range shuffle (rows that many conversations equal are cut by id) and checkpointed, so blocks stay what they are. Each
    block is searched by one task, which holds ``block_rows`` conversations. What goes to the driver is a few numbers a block. Runs that cross
    borders, at most as many a block as its longest shared prefix has turns, are bounded by joins with the blocks that their nearest smaller values
    lie in, which the least lcp of each block tells. The ids of a run of equal conversations across a border pass through one task in order, as
    their hash asks for, but are not held.

    Conversations without turns are members of the root alone. An empty table gives no rows.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    kept = scratch.keep(rows.select("keys", "conv", "words"))
    total = kept.count()
    if not total:
        scratch.drop(0, 1)
        return spark.createDataFrame([], "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    parts = max(-(-total // block_rows), min(total, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = checkpointed(kept.repartitionByRange(parts, "keys", "conv").sortWithinPartitions("keys", "conv").withColumn("block", F.spark_partition_id()))
    blocks = scratch.keep(dealt.groupBy("block").agg(F.count("*").alias("n"), F.min("keys").alias("first"), F.max("keys").alias("last")))
    sizes = sorted((r["block"], r["n"]) for r in blocks.select("block", "n").collect())  # a few numbers a block, here and below
    order = [b for b, _ in sizes]
    borders = spark.createDataFrame(list(zip(order[1:], order[:-1], strict=True)), "block int, earlier int")
    touching = borders.join(blocks.select("block", "first"), "block").join(blocks.select(F.col("block").alias("earlier"), "last"), "earlier").select("block", "first", "last")
    lcp = {r["block"]: r["lcp"] for r in touching.mapInArrow(_borders, "block int, lcp int").collect()}
    starts = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    edges = {b: (lcp.get(b, -1), lcp.get(order[k + 1], -1) if k + 1 < len(order) else -1, starts[k]) for k, b in enumerate(order)}
    found = scratch.keep(dealt.select("keys", "conv", "words", "block").mapInArrow(_in_block(edges), FOUND))
    whole = found.filter("kind = 'node'")
    next_of = spark.createDataFrame([*zip(order, order[1:], strict=False)], "up_block int, __next int")
    whole = whole.join(F.broadcast(next_of), "up_block", "left")  # one row a block
    whole = whole.withColumn("up_block", F.when(F.col("up_side") == "next", F.col("__next")).otherwise(F.col("up_block"))).withColumn("up_side", F.when(F.col("up_side") == "next", "L").otherwise(F.col("up_side")))
    crossing, names = _crossing(found, total, scratch)
    node = ["depth", "conv", "parent", "up_block", "up_side", "up_depth", "members", "children", "leaves", "saved", "sha", "run"]
    every = whole.select(*node).unionByName(crossing.select(*node))
    runs = found.filter("kind = 'end'").select("run", "conv").repartition("run").sortWithinPartitions("run", "conv").mapInArrow(_ends, "run binary, ends string")
    return (
        every.join(names, ["up_block", "up_side", "up_depth"], "left").join(runs, "run", "left")
        .select(F.col("conv").alias("conv_id"), "depth", F.coalesce("parent", "up_conv").alias("parent_conv_id"), F.col("members").alias("n_convs"), F.col("children").alias("n_children"),
                F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", "ends").alias("ends_sha256"))
    )


def _crossing(found: DataFrame, total: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The nodes whose runs cross borders, one row a depth, and the smallest member of each by block, side and depth, as ``found`` names parents."""
    blocks = sorted(found.filter("kind = 'block'").select("block", "depth", "conv", "leaves", "saved").collect())
    numbers = np.array([b[0] for b in blocks])
    smallest = np.array([b[1] for b in blocks])
    least = np.array([b[2] for b in blocks], np.int64)
    leaves, sums = (np.concatenate([[0], np.cumsum([b[k] for b in blocks])]).astype(np.int64) for k in (3, 4))
    end = int(numbers[-1]) + 1  # stands for the block after the last

    def targets(parts: Iterator) -> Iterator:
        """By open node the blocks in which its run begins and ends: the nearest whose least lcp is smaller."""
        import pyarrow as pa

        for part in parts:
            begins, stops = [], []
            for block, left, right, depth in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                k = int(np.searchsorted(numbers, block))
                begins.append(int(numbers[np.flatnonzero(smallest[:k] < depth)[-1]]) if left else block)
                after = np.flatnonzero(smallest[k + 1 :] < depth) if right else [-1]
                stops.append(int(numbers[k + 1 + after[0]]) if len(after) else end)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(begins, pa.int32()), pa.array(stops, pa.int32())], [*part.schema.names, "begin", "stop"])

    opened = found.filter("kind = 'open'").select("block", "left", "right", "depth", "children", "words")
    opened = opened.mapInArrow(targets, "block int, left boolean, right boolean, depth int, children long, words array<long>, begin int, stop int")
    stops = found.filter("kind = 'stop'")
    p = stops.filter("not left").select(F.col("block").alias("begin"), F.struct("place", F.col("depth").alias("lcp"), "conv", "length", "leaves", "saved", "sha", "run").alias("p"))
    q_fields = ("place", F.col("depth").alias("lcp"), "conv", "leaves", "saved")
    last = found.sparkSession.createDataFrame([(end, total, -1, None, 0, 0)], "stop int, place long, depth int, conv long, leaves long, saved long").select("stop", F.struct(*q_fields).alias("q"))
    q = stops.filter("left").select(F.col("block").alias("stop"), F.struct(*q_fields).alias("q")).unionByName(last)
    key = ["block", "left", "right", "depth", "children", "words", "begin", "stop"]
    met = opened.join(p, "begin").filter("p.lcp < depth").groupBy(*[k for k in key if k != "words"]).agg(F.any_value("words").alias("words"), F.max("p").alias("p"))
    met = met.join(q, "stop").filter("q.lcp < depth").groupBy(*[k for k in key if k != "words"]).agg(F.any_value("words").alias("words"), F.any_value("p").alias("p"), F.min("q").alias("q"))
    met = scratch.keep(met)
    nodes = met.groupBy(F.col("p.place").alias("place"), "depth").agg(F.sum("children").alias("children"), F.any_value("words").alias("words"), F.any_value("p").alias("p"), F.any_value("q").alias("q"), F.any_value("begin").alias("begin"), F.any_value("stop").alias("stop"))

    def complete(parts: Iterator) -> Iterator:
        def rows() -> Iterator[dict]:
            for part in parts:
                for r in part.to_pylist():
                    p, q, depth = r["p"], r["q"], r["depth"]
                    a, b = (int(np.searchsorted(numbers, x)) for x in (r["begin"], r["stop"]))
                    members = q["place"] - p["place"]
                    conv = min([p["conv"], *least[a + 1 : b].tolist(), *([q["conv"]] if q["conv"] is not None else [])])
                    sha, run = (p["sha"], p["run"]) if p["length"] == depth else (NOTHING, None)
                    top = max(p["lcp"], q["lcp"]) + 1
                    up = {"up_block": r["begin"], "up_side": "R", "up_depth": p["lcp"]} if p["lcp"] >= q["lcp"] else {"up_block": r["stop"], "up_side": "L", "up_depth": q["lcp"]}
                    every = expanded(depth, top, conv, members, r["children"] + (p["length"] > depth), int(leaves[b] + q["leaves"] - leaves[a] - p["leaves"]), int(sums[b] + q["saved"] - sums[a] - p["saved"]), r["words"], sha, run)
                    for row in every:
                        row["place"] = p["place"]
                        row["length"] = depth  # of the run's deepest node
                        yield row | up if row["depth"] == top > 0 else row

        yield from _batches(rows())

    crossing = scratch.keep(nodes.select("place", "depth", "children", "words", "p", "q", "begin", "stop").mapInArrow(complete, FOUND))
    own = crossing.filter("depth = length").select("place", "depth", F.col("conv").alias("up_conv"))
    named = met.select("block", "left", "right", "depth", F.col("p.place").alias("place")).join(own, ["place", "depth"])
    side = F.explode(F.filter(F.array(F.when(F.col("left"), "L"), F.when(F.col("right"), "R")), lambda s: s.isNotNull())).alias("up_side")
    return crossing, named.select(F.col("block").alias("up_block"), side, F.col("depth").alias("up_depth"), "up_conv")
