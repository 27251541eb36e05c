"""Ranked lexical search: the best documents for each query by a term score, found shard by shard with MaxScore."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, release, running_start

#: Most distinct terms, counted for each query by itself, of the queries that are searched for in one round; these are broadcast.
ROUND_TERMS = 1_000_000
#: A shard is closed at so many documents or postings.
SHARD_DOCS, SHARD_POSTINGS = 8192, 2_000_000

#: By byte: A-Z in lower case, other letters, digits and all bytes of characters beyond ASCII as they are, any other byte a blank.
TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SHARD = "docs binary, null_docs binary, lengths binary, terms binary, ends binary, places binary, counts binary"


def terms(text: bytes) -> list[bytes]:
    """The terms of a text, in order and with repeats."""
    return text.translate(TO_TERMS).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one of a query's terms adds for each unit of its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_norms(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Each document's m, from its number of terms; in whole numbers of any size, since the product may pass 64 bits."""
    kinds, at = np.unique(lengths, return_inverse=True)
    return np.array([10 + 90 * n * documents // total for n in kinds.tolist()], np.int64)[at]


class Shard:
    """Postings of some documents, read from a row of the written index: by term (number in the round's vocabulary) places and counts in place order."""

    def __init__(self, row: dict):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.docs, self.nulls, self.lengths = read("docs", "<i8"), read("null_docs", np.bool_), read("lengths", "<i8")
        self.terms, ends = read("terms", "<i4"), read("ends", "<i8")
        self.starts, self.ends = np.concatenate([[0], ends[:-1]]).astype(np.int64), ends
        self.places, self.counts = read("places", "<i4"), read("counts", "<i4").astype(np.int64)


class Searcher:
    """The best ``k`` of all shards seen so far for each query; what the earlier ones gave is the threshold for the next."""

    def __init__(self, queries: list[tuple[int, np.ndarray]], weights: np.ndarray, documents: int, total: int, k: int):
        self.queries, self.weights, self.documents, self.total, self.k = queries, weights, documents, total, k
        self.best: list[list[tuple]] = [[] for _ in queries]

    def visit(self, shard: Shard) -> None:
        norms = length_norms(shard.lengths, self.documents, self.total)
        scores = impact(shard.counts, norms[shard.places]) * np.repeat(self.weights[shard.terms], shard.ends - shard.starts)
        bounds = np.maximum.reduceat(scores, shard.starts) if len(scores) else scores  # the most that a term can add here
        at = np.full(len(self.weights) + 1, -1, np.int64)
        at[shard.terms] = np.arange(len(shard.terms))
        for q, (_, own) in enumerate(self.queries):
            lists = at[own]
            lists = lists[lists >= 0]
            lists = lists[bounds[lists] > 0]
            if len(lists):
                self.search(q, shard, scores, lists[np.argsort(-bounds[lists], kind="stable")], bounds)

    def search(self, q: int, shard: Shard, scores: np.ndarray, lists: np.ndarray, bounds: np.ndarray) -> None:
        """MaxScore over the lists in falling order of their bounds. While documents in none of the lists read so far could still enter, a list is
        essential and read whole; the rest are probed at the places that can still qualify, and places that no longer can go."""
        best, k = self.best[q], self.k
        floor = best[0][0] if len(best) == k else 0  # a document needs this score at least (at equal scores the id decides)
        rest = np.concatenate([np.cumsum(bounds[lists][::-1])[::-1][1:], [0]])
        sums, i = np.zeros(len(shard.lengths), np.int64), 0
        while i < len(lists):
            if i and rest[i - 1] < max(floor, 1):
                break
            a, b = shard.starts[lists[i]], shard.ends[lists[i]]
            sums[shard.places[a:b]] += scores[a:b]
            if rest[i] and len(sums) > k:
                floor = max(floor, int(np.partition(sums, -k)[-k]))
            i += 1
        found = np.flatnonzero(sums > 0)
        sums = sums[found]
        for j in range(i, len(lists)):
            stays = sums + rest[j - 1] >= floor
            found, sums = found[stays], sums[stays]
            a, b = shard.starts[lists[j]], shard.ends[lists[j]]
            places = shard.places[a:b]
            where = np.minimum(np.searchsorted(places, found), len(places) - 1)
            hit = places[where] == found
            sums[hit] += scores[a:b][where[hit]]
            if rest[j] and len(sums) > k:
                floor = max(floor, int(np.partition(sums, -k)[-k]))
        stays = sums >= max(floor, 1)
        found, sums = found[stays], sums[stays]
        if len(found) > k:  # the k best, by id among equals (null last)
            order = np.lexsort((shard.docs[found], shard.nulls[found], -sums))[:k]
            found, sums = found[order], sums[order]
        for place, score in zip(found.tolist(), sums.tolist(), strict=True):
            own = (score, not shard.nulls[place], -int(shard.docs[place]))
            if len(best) < k:
                heapq.heappush(best, own)
            elif own > best[0]:
                heapq.heapreplace(best, own)

    def rows(self) -> Iterator[tuple]:
        for (number, _), best in zip(self.queries, self.best, strict=True):
            for score, known, negative in best:
                yield number, -negative if known else None, score


def _index(vocabulary):
    """Makes shards of the documents of a task; each posting is of a term of the vocabulary (broadcast: term to number)."""

    def index(parts: Iterator) -> Iterator:
        import pyarrow as pa

        numbers = vocabulary.value
        unknown = len(numbers)
        get = numbers.get
        names, lengths, pairs, counted = [], [], [], 0

        def made():
            placed = np.concatenate([p for p, _ in pairs]) if pairs else np.zeros(0, np.int64)
            times = np.concatenate([c for _, c in pairs]) if pairs else np.zeros(0, np.int64)
            order = np.lexsort((placed >> 32, placed & 0xFFFFFFFF))  # by term, then by place
            term, place = (placed & 0xFFFFFFFF)[order], (placed >> 32)[order]
            kinds, first = np.unique(term, return_index=True)
            ends = np.append(first[1:], len(term))[: len(kinds)]
            columns = {
                "docs": np.array([x or 0 for x in names], "<i8"), "null_docs": np.array([x is None for x in names], np.bool_), "lengths": np.array(lengths, "<i8"),
                "terms": kinds.astype("<i4"), "ends": ends.astype("<i8"), "places": place.astype("<i4"), "counts": times[order].astype("<i4"),
            }
            return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in columns.values()], list(columns))

        for part in parts:
            for name, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                words = terms(text.as_buffer().to_pybytes()) if text.is_valid else []
                coded = np.fromiter((get(w, unknown) for w in words), np.int64, len(words))
                kinds, times = np.unique(coded[coded < unknown], return_counts=True)
                pairs.append(((len(names) << 32) | kinds, times))
                names.append(name)
                lengths.append(len(words))
                counted += len(kinds)
                if len(names) >= SHARD_DOCS or counted >= SHARD_POSTINGS:
                    yield made()
                    names, lengths, pairs, counted = [], [], [], 0
        if names:
            yield made()
        release()

    return index


def _counts(parts: Iterator) -> Iterator:
    """For each shard how many documents hold each term; under -1 the documents with terms, under -2 all their terms."""
    import pyarrow as pa

    for part in parts:
        for row in part.to_pylist():
            shard = Shard(row)
            number = np.concatenate([shard.terms, [-1, -2]]).astype(np.int64)
            n = np.concatenate([shard.ends - shard.starts, [np.count_nonzero(shard.lengths), shard.lengths.sum()]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(n)], ["term", "n"])


def _search(held, k: int):
    """Searches the shards of a task for all queries of a round (broadcast)."""

    def search(parts: Iterator) -> Iterator:
        import pyarrow as pa

        searcher = Searcher(*held.value, k)
        for part in parts:
            for row in part.to_pylist():
                searcher.visit(Shard(row))
        rows = list(searcher.rows())
        columns = [pa.array(v, pa.int64()) for v in (zip(*rows, strict=True) if rows else ([], [], []))]
        yield pa.RecordBatch.from_arrays(columns, ["query", "doc", "score"])
        release()

    return search


def ranked(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_col: str = "item_id", query_text_col: str = "text", round_terms: int = ROUND_TERMS) -> DataFrame:
    """For each query its ``k`` documents of the highest score above 0: query id, ``rank`` (from 1), document id, ``score``.

    A round takes queries of up to ``round_terms`` terms, which bounds what is broadcast; one such round is enough for some 20,000 passages. In
    a round, one pass over all whole texts makes shards (postings of the queries' terms, places and counts in place order) and writes them to the
    shared folder; counts of documents for each term are summed from the shards; a second pass over the shards searches each by MaxScore and keeps
    ``k`` documents a query and task, whose threshold one shard hands to the next. No document's text or postings are shuffled, and a task holds
    one shard. Work grows with queries times shards, as each query is a ranking of all documents.

    Equal scores stand by ascending id, null ids last; rows that repeat an id are documents of their own. Null and empty texts have no terms, so
    they match nothing and are not counted. A query that repeats a term asks once; null or empty queries find nothing; queries that repeat an id are
    ranked each for themselves. Empty tables give no rows; other columns are ignored.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    text = F.col(query_text_col).cast("string")
    blank = F.translate(F.regexp_replace(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked = F.filter(F.array_distinct(F.split(blank, " ")), lambda t: t != "")
    wanted = queries.select(F.col(query_col).cast("long").alias("__id"), F.monotonically_increasing_id().alias("__query"), asked.alias("__terms"))
    wanted = scratch.keep(wanted.filter(F.size("__terms") > 0).withColumn("__n", F.size("__terms")))
    dealt = scratch.keep(running_start(wanted, ["__query"], "__n", "__first").withColumn("__round", F.floor(F.col("__first") / round_terms)))
    last = dealt.agg(F.max("__round")).first()[0]
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary"))
    found = []
    for number in range(-1 if last is None else last + 1):
        own = dealt.filter(F.col("__round") == number).select("__query", "__terms").collect()  # terms of one round
        vocabulary = {t.encode(): i for i, t in enumerate(dict.fromkeys(t for r in own for t in r["__terms"]))}
        sent = spark.sparkContext.broadcast(vocabulary)
        shards = scratch.keep(texts.mapInArrow(_index(sent), SHARD))
        counts = {r["term"]: r["n"] for r in shards.mapInArrow(_counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}  # terms of one round
        documents, total = counts.get(-1, 0), counts.get(-2, 0)
        weights = np.array([weight(documents, counts.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        coded = [(r["__query"], np.array([vocabulary[t.encode()] for t in r["__terms"]], np.int64)) for r in own]
        held = spark.sparkContext.broadcast((coded, weights, documents, max(total, 1)))
        found.append(scratch.keep(shards.mapInArrow(_search(held, k), "query long, doc long, score long")))
        scratch.drop(len(scratch.paths) - 2, len(scratch.paths) - 1)  # the round's shards
    if not found:
        found = [spark.createDataFrame([], "query long, doc long, score long")]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    top = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.join(dealt.select("__query", "__id"), top["query"] == dealt["__query"]).select(F.col("__id").alias(query_col), "rank", F.col("doc").alias(id_col), "score")
