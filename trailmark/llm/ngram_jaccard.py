"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix, pruned by size bounds.

1. Each text becomes its set of hashed n-grams. Sets are dealt by hash into column blocks of the incidence matrix (arrays, not a row for
   each entry). A block knows in how many documents each of its n-grams occurs and answers with those that occur twice or more.
2. Only such n-grams can be shared. A document whose shared ones are fewer than the similarity asks of its own size links with nothing
   and leaves here; the others order their shared n-grams from rare to common.
3. Equal sets become one class. Two classes that link share one of the first few n-grams of both (prefix bound); sizes and places in
   the order bound the overlap from above, and pairs below what their sizes ask are discarded.
4. Of the pairs left, overlaps are accumulated from the incidence rows. First each column is multiplied with one row only (its hub), so that
   groups of copies join at linear cost. Then the columns that still hold several components are taken as families of rows that
   they connect; rows of a family meet block by block in a sparse product that counts all overlaps, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, clear_shuffles, joined_groups, release
from .components import connected_components

MIX = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


class WordHashes(dict):
    """Hashes of words, remembered; emptied when it holds 250,000."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 250_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def ngram_set(text: str, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word n-grams of a text, A-Z lowered; one for the whole of a shorter text, none without words."""
    split = text.encode("utf-8", "replace").lower().split()
    n = len(split)
    if not n:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, split), np.uint64, n)
    size = min(n, words)
    grams = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        grams = (grams ^ (grams >> np.uint64(31))) * MIX[i % 5] + own[i : n - size + 1 + i]
    return np.unique(grams ^ (grams >> np.uint64(29)))


def _bytes(grams: np.ndarray) -> bytes:
    return np.ascontiguousarray(grams, "<u8").tobytes()


def _deltas(owner: np.ndarray) -> bytes:
    """Rising numbers (a document for each n-gram) as one byte a step; a step of 255 or more takes a mark and four bytes of its own at the end."""
    step = np.diff(owner, prepend=0)
    wide = step >= 255
    return np.where(wide, 255, step).astype(np.uint8).tobytes() + step[wide].astype("<u4").tobytes()


def _owners(data: bytes, n: int) -> np.ndarray:
    step = np.frombuffer(data, np.uint8, n).astype(np.int64)
    wide = step == 255
    step[wide] = np.frombuffer(data, "<u4", int(wide.sum()), n)
    return np.cumsum(step)


def _incidence(words: int, blocks: int, chunk_tokens: int):
    """Rows of text in, column blocks of the incidence matrix out; one more row per chunk names its documents."""

    def cut(parts: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        hashes, at, base = WordHashes(), 0, TaskContext.get().partitionId() << 32
        kinds = {"block": pa.int32(), "chunk": pa.int64(), "names": pa.binary(), "owners": pa.binary(), "grams": pa.binary()}
        names, sets, held = [], [], 0

        def made():
            sizes = np.array([len(s) for s in sets], "<u4")
            grams = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
            block = ((grams >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(block, kind="stable")  # stays in order of documents inside a block
            grams, owner, block = grams[order], owner[order], block[order]
            ends = np.searchsorted(block, np.arange(blocks + 1))
            marks = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)
            known = np.array([x is not None for x in names], np.uint8).tobytes()
            spread = xxhash.xxh3_64_intdigest(f"{base}:{at}".encode()) % blocks  # where the names pass through
            out = [(spread, base + at, b"".join([np.uint32(len(names)).tobytes(), np.array([x or 0 for x in names], "<i8").tobytes(), known, sizes.tobytes(), marks]), None, None)]
            for b in range(blocks):
                i, j = ends[b], ends[b + 1]
                if i < j:
                    out.append((b, base + at, None, _deltas(owner[i:j]), _bytes(grams[i:j])))
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds.values(), strict=True)], list(kinds))

        for part in parts:
            for name, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                names.append(name)
                sets.append(ngram_set(text.as_py() or "", words, hashes))
                held += len(sets[-1])
                if held >= chunk_tokens or len(names) >= 50_000:
                    yield made()
                    names, sets, held, at = [], [], 0, at + 1
        if names:
            yield made()
        hashes.clear()
        release()

    return cut


def _shared(table):
    """One column block: for each chunk its n-grams that occur in two documents or more, with a weight that grows with their number."""
    import pyarrow as pa

    block = table.column("block")[0].as_py()
    columns = [table.column(k) for k in ("chunk", "names", "owners", "grams")]
    grams = [np.frombuffer(g.as_buffer() or b"", "<u8") if g.is_valid else np.zeros(0, "<u8") for g in columns[3]]
    _, inverse, times = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    weights = np.minimum(np.ceil(8 * np.log2(times)), 255).astype(np.uint8)[inverse]
    del inverse, times
    out, at = [], 0
    for chunk, name, owner, part in zip(*columns[:3], grams, strict=True):
        if name.is_valid:
            out.append((block, chunk.as_py(), name.as_py(), None, None, None))
            continue
        weight = weights[at : at + len(part)]
        at += len(part)
        keep = weight > 0
        if keep.any():
            out.append((block, chunk.as_py(), None, _deltas(_owners(owner.as_py(), len(part))[keep]), _bytes(part[keep]), weight[keep].tobytes()))
    kinds = {"block": pa.int32(), "chunk": pa.int64(), "names": pa.binary(), "owners": pa.binary(), "grams": pa.binary(), "weights": pa.binary()}
    columns = list(zip(*out, strict=True)) or [()] * 6
    made = pa.table({k: pa.array(list(v), t) for (k, t), v in zip(kinds.items(), columns, strict=True)})
    del weights, grams, out, columns
    release()
    return made


def _documents(num: int, den: int):
    """A chunk's answers put together: one row per document, with its shared n-grams from rare to common if they can reach the bound."""

    def gather(table):
        import pyarrow as pa

        head = next(x for x in table.column("names").to_pylist() if x is not None)
        n = int(np.frombuffer(head, "<u4", 1)[0])
        names, known = np.frombuffer(head, "<i8", n, 4), np.frombuffer(head, np.uint8, n, 4 + 8 * n)
        sizes, marks = np.frombuffer(head, "<u4", n, 4 + 9 * n), head[4 + 13 * n :]
        owners, grams, weights = [], [], []
        for own, gram, weight in zip(*(table.column(k) for k in ("owners", "grams", "weights")), strict=True):
            if gram.is_valid:
                grams.append(np.frombuffer(gram.as_buffer(), "<u8"))
                owners.append(_owners(own.as_py(), len(grams[-1])))
                weights.append(np.frombuffer(weight.as_buffer(), np.uint8))
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        shared = np.bincount(owner, minlength=n)
        stays = (sizes > 0) & (den * shared >= num * sizes.astype(np.int64))
        rows: list = [None] * n
        if len(owner):
            keep = stays[owner]
            owner, gram, weight = owner[keep], np.concatenate(grams)[keep], np.concatenate(weights)[keep]
            order = np.lexsort((gram, weight, owner))
            gram, ends = gram[order], np.cumsum(np.where(stays, shared, 0))
            for i in np.flatnonzero(stays):
                rows[i] = gram[ends[i] - shared[i] : ends[i]].tobytes()
        ids = [int(x) if k else None for x, k in zip(names, known, strict=True)]
        mark = [marks[16 * i : 16 * i + 16] if stays[i] else None for i in range(n)]
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n": pa.array(sizes.astype(np.int64)), "mark": pa.array(mark, pa.binary()), "grams": pa.array(rows, pa.binary())})

    return gather


def _prefixes(num: int, den: int):
    """Of each class the n-grams one of which any partner must share, with how many come after each."""

    def cut(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for part in parts:
            out = [[], [], [], []]
            for mark, n, grams in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                gram = np.frombuffer(grams, np.int64)
                length = len(gram) - -(-num * n // den) + 1
                out[0].extend(gram[:length].tolist())
                out[1].extend([mark] * length)
                out[2].extend([n] * length)
                out[3].extend(range(len(gram), len(gram) - length, -1))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], ["gram", "mark", "n", "rest"])

    return cut


def _overlaps(parts: Iterator) -> Iterator:
    """Pairs with both incidence rows in, overlap counts out: equal n-grams of a pair become neighbours when a block is sorted."""
    import pyarrow as pa

    for part in parts:
        counts = []
        for left, right in zip(part.column(2), part.column(3), strict=True):
            both = np.concatenate([np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)])
            both.sort()
            counts.append(int(np.count_nonzero(both[1:] == both[:-1])))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(4), part.column(5), pa.array(counts, pa.int64())], ["a", "b", "na", "nb", "overlap"])


def _block_product(num: int, den: int, dense_from: int = 32, columns: int = 4096):
    """Rows of two blocks in, links between different labels out (a spanning forest of them): the product of the incidence rows.

    Columns with few entries add up pairs of entries, those with many are multiplied as dense slices. Only pairs between the
    blocks (or all, within one) that their sizes allow are compared with the bound.
    """

    def product(table):
        import pyarrow as pa

        marks, labels, sizes, grams, side = (table.column(k).to_pylist() for k in ("mark", "label", "n", "grams", "side"))
        m = len(marks)
        parts = [np.frombuffer(g, np.uint64) for g in grams]
        gram, owner = np.concatenate(parts), np.repeat(np.arange(m), [len(p) for p in parts])
        order = np.argsort(gram, kind="stable")
        gram, owner = gram[order], owner[order]
        begins = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        times = np.diff(np.r_[begins, len(gram)])
        column = np.repeat(np.arange(len(begins)), times)
        few = (times > 1) & (times < dense_from)
        overlap = np.zeros(m * m, np.int64)
        rare = few[column]
        c, o = column[rare], owner[rare]
        for k in range(1, dense_from):
            same = c[k:] == c[:-k]
            if not same.any():
                break
            overlap += np.bincount(o[:-k][same] * m + o[k:][same], minlength=m * m)
        overlap = overlap.reshape(m, m)
        overlap = overlap + overlap.T
        many = np.flatnonzero(times >= dense_from)
        place = np.full(len(begins), -1)
        place[many] = np.arange(len(many))
        spot = place[column]
        for at in range(0, len(many), columns):
            mine = (spot >= at) & (spot < at + columns)
            dense = np.zeros((m, min(columns, len(many) - at)), np.float32)
            dense[owner[mine], spot[mine] - at] = 1
            overlap += (dense @ dense.T).astype(np.int64)  # counts below 2**24 are exact
        n, side = np.array(sizes, np.int64), np.array(side)
        linked = (num + den) * overlap >= num * (n[:, None] + n[None, :])
        _, label = np.unique(np.array(labels, object), return_inverse=True)
        linked &= (label[:, None] != label[None, :]) & ((side[:, None] != side[None, :]) | (side.max() == side.min()))
        left, right = np.nonzero(np.triu(linked, 1))
        root = list(range(m))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out: tuple[list, list] = ([], [])
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            x, y = find(int(label[i])), find(int(label[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out[0].append(marks[i])
                out[1].append(marks[j])
        return pa.table({"a": pa.array(out[0], pa.binary()), "b": pa.array(out[1], pa.binary())})

    return product


def _could_link(num: int, den: int) -> Column:
    """Size bounds on a pair (l, r) that meets in one n-gram: what comes after it in both bounds the overlap if it is their first."""
    need = F.ceil(F.lit(num) * (F.col("l.n") + F.col("r.n")) / F.lit(num + den))
    return (
        (F.col("l.mark") != F.col("r.mark"))
        & (den * F.col("l.n") >= num * F.col("r.n"))
        & (den * F.col("r.n") >= num * F.col("l.n"))
        & (F.least("l.rest", "r.rest") >= need)
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100, block_bytes: int = 6_000_000, chunk_tokens: int = 1_000_000, hub_rounds: int = 1, family_rows: int = 1024) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (smallest id reachable by links, its own included).

    Two rows link when ``den * intersection >= num * union`` of their sets of distinct ``words``-word n-grams (A-Z lowered, words are runs of anything but
    ASCII white space). A text shorter than that is one n-gram; without words or text the set is empty and links with nothing.
    Equal sets always link. ``block_bytes`` of text make one column block, so blocks grow in number, not in size. An n-gram is a 64-bit hash of its
    words' hashes, kept whole everywhere: two different ones of a pair with a and b n-grams coincide with a chance of a * b / 2**64.

    What grows: each occurrence of an n-gram costs 9 bytes in the first shuffle, so that one which stands in every document puts 9 bytes a
    document into its block; a family of m classes that frequent n-grams hold together costs (m / ``family_rows``) ** 2 / 2 block products, since
    all its pairs are counted. A chunk sends a row to each block it has n-grams for: beyond about 1 TB of text these rows become short, and larger
    ``block_bytes`` and ``chunk_tokens`` keep their number down.

    Null ids are carried and count as no id: a component of null ids only has a null ``component_id``. Rows that repeat an id are
    nodes of their own with that id. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"))
    total = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))

    def documents() -> DataFrame:
        incidence = rows.mapInArrow(_incidence(words, blocks, chunk_tokens), "block int, chunk long, names binary, owners binary, grams binary")
        shared = incidence.groupBy("block").applyInArrow(_shared, "block int, chunk long, names binary, owners binary, grams binary, weights binary")
        return checkpointed(shared.groupBy("chunk").applyInArrow(_documents(num, den), "doc_id long, n long, mark binary, grams binary"))

    found = documents()
    clear_shuffles(docs.sparkSession)  # the incidence matrix is no longer needed
    alive = found.filter("mark is not null")
    classes = checkpointed(alive.groupBy("mark").agg(F.min("doc_id").alias("smallest"), F.count("*").alias("rows"), F.any_value("n").alias("n"), F.any_value("grams").alias("grams")))
    entries = classes.select("mark", "n", "grams").mapInArrow(_prefixes(num, den), "gram long, mark binary, n long, rest long")
    met = entries.groupBy("gram").agg(F.count("*").alias("classes")).filter("classes > 1").select("gram")  # a class has a gram once
    prefixes = checkpointed(entries.join(met, "gram", "left_semi"))

    def verified(pairs: DataFrame) -> DataFrame:
        left = classes.select(F.col("mark").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
        right = classes.select(F.col("mark").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ga", "gb", "na", "nb")
        counted = joined.mapInArrow(_overlaps, "a binary, b binary, na long, nb long, overlap long")
        return checkpointed(counted.select("a", "b", (den * F.col("overlap") >= num * (F.col("na") + F.col("nb") - F.col("overlap"))).alias("linked")))

    def columns_of(labels: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
        """The prefix entries with labels, and the columns that hold more than one label, each with its hub."""
        own = prefixes.join(labels, "mark")  # only grams that stand in the prefixes of several classes
        hub = F.min(F.struct(F.xxhash64("mark", F.lit(seed)).alias("h"), "mark", "n", "rest", "label"))
        several = own.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), hub.alias("hub")).filter("lo <> hi")
        return own, several.select("gram", "hub.mark", "hub.n", "hub.rest", "hub.label")

    def relabelled(links: DataFrame) -> DataFrame:
        joined = connected_components(links.select("a", "b"))
        return checkpointed(classes.select("mark").join(joined, F.col("mark") == F.col("v"), "left").select("mark", F.coalesce("label", "mark").alias("label")))

    links, labels = None, classes.select("mark", F.col("mark").alias("label"))
    for seed in range(hub_rounds):
        own, hubs = columns_of(labels, seed)
        met = own.alias("l").join(hubs.alias("r"), F.col("l.gram") == F.col("r.gram")).filter(_could_link(num, den) & (F.col("l.label") != F.col("r.label")))
        now = verified(met.select(F.least("l.mark", "r.mark").alias("a"), F.greatest("l.mark", "r.mark").alias("b")).distinct()).filter("linked")
        links = now if links is None else links.unionByName(now)
        labels = relabelled(links)
    own, hubs = columns_of(labels, hub_rounds)
    spokes = own.select("gram", "mark").join(hubs.select("gram", F.col("mark").alias("hub")), "gram").select(F.col("mark").alias("a"), F.col("hub").alias("b")).distinct()
    families = connected_components(spokes).withColumnsRenamed({"v": "mark", "label": "family"})
    sizes = families.groupBy("family").agg(F.count("*").alias("m"))
    small = sizes.filter(F.col("m") <= family_rows // 2).agg(F.sum("m")).first()[0] or 0
    bins = max(1, -(-int(small) // (family_rows // 2)))
    # small families share a block; a large one is cut into blocks by a hash, and each pair of its blocks is one product
    cut = families.join(sizes, "family").withColumn("blocks", F.when(F.col("m") <= family_rows // 2, 1).otherwise(F.ceil(F.col("m") / family_rows)).cast("int"))
    cut = cut.withColumn("key", F.when(F.col("m") <= family_rows // 2, F.pmod(F.xxhash64("family"), F.lit(bins)).cast("string")).otherwise(F.hex("family")))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("mark", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"))
    rows_of = cut.join(labels, "mark").join(classes.select("mark", "n", "grams"), "mark")
    found_links = checkpointed(rows_of.groupBy("key", "i", "j").applyInArrow(_block_product(num, den), "a binary, b binary"))
    if not found_links.isEmpty():
        labels = relabelled(links.select("a", "b").unionByName(found_links))
    smallest = classes.select("mark", "smallest", "rows").join(labels, "mark")
    least = checkpointed(smallest.groupBy("label").agg(F.min("smallest").alias("component_id"), F.count("*").alias("classes")))
    of_class = checkpointed(joined_groups(smallest.select("mark", "label", "rows"), least, "label", "classes").select("mark", "component_id", "rows"))
    linked = joined_groups(alive.select("doc_id", "n", "mark"), of_class, "mark", "rows").select("doc_id", "n", "component_id")
    alone = found.filter("mark is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
