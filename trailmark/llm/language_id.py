"""Language ID: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release

FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def gram_buckets(text: str, bits: int) -> np.ndarray:
    """The hash bucket of each of a text's character 1- to 3-grams; letters in lower case, other runs are one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    points = np.where(_letters(points), points, np.uint32(32))
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    points = points[keep]
    out = []
    key = np.zeros(len(points), np.uint32)
    for size in range(1, min(3, len(points)) + 1):
        key = key[: len(points) - size + 1] * FACTORS[0] + points[size - 1 :] * FACTORS[size - 1] + np.uint32(size)
        mixed = (key ^ (key >> np.uint32(15))) * FACTORS[1]
        out.append((mixed >> np.uint32(32 - bits)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def gram_counts(text: str, bits: int) -> np.ndarray:
    """Counts of a text's grams by bucket."""
    return np.bincount(gram_buckets(text, bits), minlength=1 << bits)


def sparse_counts(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The counts matrix of a batch of texts by buckets as its entries other than zero: (row, bucket, count), by row."""
    grams = [gram_buckets(t, bits) for t in texts]
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), [len(g) for g in grams])
    cells = np.bincount((owner << bits) | np.concatenate(grams), minlength=len(texts) << bits)
    some = np.flatnonzero(cells)
    return some >> bits, some & ((1 << bits) - 1), cells[some]


_TABLE = np.zeros(0, bool)


def _letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters, from a table of all of them built once a worker."""
    global _TABLE
    if not len(_TABLE):
        _TABLE = np.array([chr(i).isalpha() if not 0xD800 <= i < 0xE000 else False for i in range(0x110000)])
    return _TABLE[points]


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = 14, rows_per_language: int = 20_000, smoothing: float = 0.1, most_languages: int = 1000) -> tuple[list[str], np.ndarray]:
    """(languages, log-probability matrix of languages by buckets, its last column the log prior).

    About ``rows_per_language`` distinct texts a language at most, chosen by a hash of the text, are read: a documented bound on what a
    model needs, whatever the table's size. A text counts as often as it stands in the table, but its copies are read once; the text of a
    language's least hash is always among them, so no language with a text is left without. Partitions add up their counts; one row per language and partition is summed by Spark,
    and the matrix of ``2 ** bits`` columns reaches the driver. It has ``most_languages`` rows at most (1,000 rows of 2 ** 14 doubles are 131 MB): a
    table with more distinct languages is refused with an error, as its column cannot hold languages. Rows with a null language or text are left out.
    """
    known = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")
    known = known.withColumn("hash", F.xxhash64("text"))
    distinct = known.groupBy("lang", "hash").agg(F.count("*").alias("n"))
    share = distinct.groupBy("lang").agg(F.sum("n").alias("n"), (F.lit(1.0) * rows_per_language / F.count("*")).alias("share"), F.min("hash").alias("least"))
    languages = [(r.lang, r.share, r.n, r.least) for r in share.orderBy("lang").limit(most_languages + 1).collect()]
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not languages:
        return [], np.zeros((0, (1 << bits) + 1))
    names = [x[0] for x in languages]
    cuts = labelled.sparkSession.createDataFrame([(x[0], x[1], x[3]) for x in languages], "lang string, share double, least long")
    chosen = known.join(F.broadcast(cuts), "lang").filter((F.pmod("hash", F.lit(1 << 20)) < F.col("share") * (1 << 20)) | (F.col("hash") == F.col("least")))  # most_languages rows
    chosen = chosen.groupBy("lang", "hash").agg(F.any_value("text").alias("text"), F.count("*").alias("n")).select("lang", "text", "n")
    place = {name: i for i, name in enumerate(names)}

    def count(parts: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for lang, text, n in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist(), strict=True):
                sums[place[lang]] = sums.get(place[lang], 0) + n * gram_counts(text.as_py(), bits)
        for lang, counts in sums.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.int32()), pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())], ["lang", "bucket", "n"])
        release()

    matrix = np.full((len(names), 1 << bits), smoothing)
    summed = chosen.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages times buckets
    matrix[summed["lang"].to_numpy(), summed["bucket"].to_numpy()] += summed["n"].to_numpy()
    logs = np.log(matrix / matrix.sum(axis=1, keepdims=True))
    prior = np.log(np.array([x[2] for x in languages]) / sum(x[2] for x in languages))
    return names, np.hstack([logs, prior[:, None]])


def predict(docs: DataFrame, names: list[str], logs: np.ndarray, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, label: str = "lang_pred", score: str = "score", rows_per_product: int = 64) -> DataFrame:
    """``docs``' columns ``keep`` (the id alone by default) plus ``label`` and ``score``, the posterior of that language.

    The matrix is broadcast (``train`` bounds it). Texts are scored ``rows_per_product`` at a time: their sparse counts matrix times the
    transposed log-probabilities. ``und`` with score 0 if the text is null or has no letter, or if nothing was learned; of equal posteriors
    the first language in order wins. Null and repeated ids are carried as they are. Other columns of ``docs`` have no part in it; those that are
    kept and named like ``label`` or ``score`` need other names for these. An empty table gives no rows.
    """
    keep = keep or [id_col]
    model = docs.sparkSession.sparkContext.broadcast((names, np.ascontiguousarray(logs[:, :-1]), logs[:, -1] if len(names) else np.zeros(0)))
    bits = max(logs.shape[1] - 1, 1).bit_length() - 1

    def scored(parts: Iterator) -> Iterator:
        import pyarrow as pa

        langs, weights, prior = model.value
        for part in parts:
            best, scores = [], []
            for at in range(0, part.num_rows, rows_per_product):
                texts = [t.as_py() or "" for t in part.column(place).slice(at, rows_per_product)]
                if not langs:
                    best += ["und"] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                row, bucket, count = sparse_counts(texts, bits)
                total = np.stack([np.bincount(row, count * own[bucket], len(texts)) for own in weights], axis=1) + prior
                top = total.argmax(axis=1)
                posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                lettered = [any(map(str.isalpha, t)) for t in texts]
                best += [langs[i] if ok else "und" for i, ok in zip(top, lettered, strict=True)]
                scores += [float(p) if ok else 0.0 for p, ok in zip(posterior, lettered, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(best, pa.string()), pa.array(scores, pa.float64())], [*out_names])
        release()

    held = text_col in keep
    place = keep.index(text_col) if held else len(keep)
    rows = docs.select(*keep, *[F.col(text_col).cast("string").alias("__text")] * (not held))
    out_names = [*keep, label, score]
    schema = docs.select(*keep).schema.add(label, "string").add(score, "double")
    return rows.mapInArrow(scored, schema)
