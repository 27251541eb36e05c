"""From raw documents to packed training sequences, in five stages; each is written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trailmark.llm import exact_dedup, language_id, mixing, ngram_jaccard, packing
from trailmark.llm.common import remove, shared_dir, table, written
from trailmark.llm.tokens import tokenizer_path

LEAST_SCORE = 0.5
#: Rows of an Arrow batch in the stages that run Python (batches of Spark's 10,000 rows of long texts fill workers), and bytes for known token ids:
#: the executors' memory also holds what earlier stages left in their JVM.
BATCH_ROWS, MEMO_BYTES = 1000, 24_000_000
BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _in_small_batches(spark: SparkSession) -> None:
    """For this and the later stages' plans; ``run`` sets the session back."""
    spark.conf.set(BATCHES, BATCH_ROWS)


def _free(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called that."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, and that column's name.

    The number is the row's place in its file under the number of the file, so it belongs to the row: however a later pass or a new attempt deals
    files over tasks, a row has the same one. Rows that do not come from files are written first. The files' names (which the driver lists in any case)
    are numbered there and broadcast.
    """
    row = _free(docs, "__row")
    if not docs.inputFiles():
        docs = written(docs)
    path, index = _free(docs, "__path"), _free(docs, "__index")
    place = docs.metadataColumn("_metadata")
    placed = docs.withColumns({path: place["file_path"], index: place["row_index"]})
    names = sorted(r[path] for r in placed.select(path).distinct().collect())
    numbers = docs.sparkSession.createDataFrame([(name, k << 40) for k, name in enumerate(names)], f"`{path}` string, `{row}` long")
    keyed = placed.join(F.broadcast(numbers), path).withColumn(row, F.col(row) + F.col(index))  # one row a file
    return keyed.select(*docs.columns, row), row


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows; documents without an identifiable language go (``und``, or a posterior below ``LEAST_SCORE``).

    Null and repeated ids are carried; null and empty texts are ``und`` and go. Columns named like the verdict's stay what they are. An empty table, or
    one without labels, gives no rows.
    """
    _in_small_batches(spark)
    names, logs = language_id.train(docs)
    label, score = _free(docs, "__lang"), _free(docs, "__posterior")
    judged = language_id.predict(docs, names, logs, keep=docs.columns, label=label, score=score)
    return judged.filter((F.col(label) != "und") & (F.col(score) >= LEAST_SCORE)).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts exactly one stays: one of the largest id (any of those that repeat it), one of a null id only if all ids are null.

    Null and empty texts are equal. An empty table gives no rows.
    """
    keyed, row = _keyed(docs)
    key = F.struct(F.col("doc_id").isNotNull(), "doc_id", row)
    verdicts = exact_dedup.exact_duplicates(keyed.select(key.alias("key"), "text"), id_col="key", keep="largest")
    return keyed.join(verdicts.filter("kept").select(F.col("key")[row].alias(row)), row, "left_semi").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies exactly one row stays: of the smallest id, null ids last, and any one of rows that repeat it.

    Rows without words link with nothing and stay. An empty table gives no rows.
    """
    _in_small_batches(spark)
    keyed, row = _keyed(docs)
    groups = ngram_jaccard.near_duplicates(keyed, id_col=row).select(row, "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))
    kept = keyed.select("doc_id", row).join(groups, row).groupBy("component_id").agg(first.alias("first")).select(F.col("first")[row].alias(row))
    return keyed.join(kept, row, "left_semi").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; none of it is left where that is zero.

    Rows that repeat id, source and size are matched with their verdicts by their places in order (of texts and of copies). Null sources are one
    source; rows without words go. An empty table gives no rows.
    """
    mixed = mixing.balanced_copies(docs).select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "copies")
    mixed = mixed.withColumn("__place", F.row_number().over(Window.partitionBy("__id", "__source", "__size").orderBy("copies")))
    own = {"size": _free(docs, "__own"), "place": _free(docs, "__at"), "copy": _free(docs, "__copy")}
    sized = docs.withColumn(own["size"], mixing.word_count(F.col("text")))
    sized = sized.withColumn(own["place"], F.row_number().over(Window.partitionBy("doc_id", F.col("source").cast("string"), own["size"]).orderBy(F.xxhash64("text"))))
    docs_, verdicts = sized.alias("d"), mixed.alias("m")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.__id")) & F.col("d.source").cast("string").eqNullSafe(F.col("m.__source")) & (F.col(f"d.{own['size']}") == F.col("m.__size")) & (F.col(f"d.{own['place']}") == F.col("m.__place"))
    taken = docs_.join(verdicts, same).filter("m.copies > 0")
    return taken.select("d.*", F.explode(F.sequence(F.lit(1), F.col("m.copies").cast("int"))).alias(own["copy"])).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of binary lengths with their ids, none holding two documents. Null or empty text: one piece, the end id. An empty table gives no rows."""
    _in_small_batches(spark)
    return packing.binary_pieces(docs, tokenizer_path("word_bpe_49k.json"), memo_bytes=MEMO_BYTES)


STAGES = [("language_id", identify_language), ("exact_dedup", drop_copies), ("ngram_jaccard", drop_near_copies), ("entropy_mix", mix_sources), ("binary_packing", pack)]

#: Hashed naive Bayes, Newton steps and a tokenizer cannot be said in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages. Each stage is written under the shared folder; a stage's table goes once the next stands."""
    docs, base = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before, rows = None, spark.conf.get(BATCHES)
    try:
        for name, stage in STAGES:
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
            docs = spark.read.parquet(f"{base}/{name}")
            if before:
                remove(spark, before)
            before = f"{base}/{name}"
    finally:
        spark.conf.set(BATCHES, rows)
    return docs
