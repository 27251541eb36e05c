"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import ann_graph, best_fit, exact_dedup, hilbert, language_id, license_scan, max_score, mixing, ngram_jaccard, packing, prefix_trie, secret_scan, simple8b
from .common import shared_dir, table
from .tokens import token_pattern, tokenizer_path


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    names, logs = language_id.train(docs.filter(F.coalesce(~held_out, F.lit(True))))
    return language_id.predict(docs.select("doc_id", "text"), names, logs).withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def op2_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ann_graph.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.col("source").alias("__source"), F.col("lang").alias("__lang")
    )
    dims = {"source": F.col("__source"), "lang": F.col("__lang"), "size": F.col("size")}
    out = hilbert.hilbert_shards(docs, dims, 8, ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


#: CRC-32 of the UTF-8 bytes of t, a byte at a time by the table ``tab``; the polynomial is a fixed value of the checksum.
CRC32_TABLE_SQL = "ct AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, " + "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM (SELECT i, " * 7 + "CASE WHEN i & 1 = 1 THEN xor(i >> 1, 3988292384) ELSE i >> 1 END AS c FROM range(256) r(i)" + ")" * 8 + ")"
CRC32_SQL = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT)), "
    "lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"
)


def _hilbert_sql(bits: int, names: list[str]) -> list[str]:
    """Named expressions that turn quantised coordinates x0, x1, .. of ``q`` into ``curve``, one for each step of the transform."""
    n, out, last = len(names), [], "q"
    for b in range(bits - 1, 0, -1):
        for i in range(n):
            mask, own = (1 << b) - 1, f"(x{i} & {1 << b}) > 0"
            swapped = f"(xor(x0, x{i}) & {mask})"
            new = [f"CASE WHEN {own} THEN xor(x0, {mask}) ELSE " + ("x0" if i == 0 else f"xor(x0, {swapped})") + " END AS x0"]
            new += [(f"CASE WHEN {own} THEN x{j} ELSE xor(x{j}, {swapped}) END AS x{j}" if j == i else f"x{j}") for j in range(1, n)]
            step = f"h{b}_{i}"
            out.append(f"{step} AS (SELECT * EXCLUDE ({', '.join(f'x{j}' for j in range(n))}), {', '.join(new)} FROM {last})")
            last = step
    gray = ", ".join("x0 AS g0" if j == 0 else f"{' '.join([])}" + "xor(" * j + "x0" + "".join(f", x{k})" for k in range(1, j + 1)) + f" AS g{j}" for j in range(n))
    out.append(f"gray AS (SELECT *, {gray} FROM {last})")
    flip = "0"
    for b in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN (g{n - 1} & {1 << b}) > 0 THEN {(1 << b) - 1} ELSE 0 END)"
    out.append(f"flip AS (SELECT *, {flip} AS f FROM gray)")
    places = [f"((xor(g{j}, f) >> {b}) & 1)::BIGINT * {1 << (n * b + n - 1 - j)}" for b in range(bits - 1, -1, -1) for j in range(n)]
    out.append(f"curved AS (SELECT *, {' + '.join(places)} AS curve FROM flip)")
    return out


def op4_sql(shards: int = 8, bits: int = 5) -> str:
    dims, parts = ["source", "lang", "size"], 1 << bits
    steps = ["base AS (SELECT doc_id, source, lang, strlen(coalesce(text, '')) + 1 AS size, coalesce(text, '') AS t FROM documents)"]
    for j, d in enumerate(dims):
        steps.append(f"v{j} AS (SELECT v, least(((sum(n) OVER (ORDER BY v)) - n) * {parts} // (sum(n) OVER ()), {parts - 1})::INTEGER AS share FROM (SELECT {d} AS v, count(*) AS n FROM base WHERE {d} IS NOT NULL GROUP BY ALL))")
        steps.append(f"c{j} AS (SELECT v, share AS x FROM v{j})")
    steps.append("q AS (SELECT doc_id, size, t, " + ", ".join(f"coalesce(c{j}.x, 0)::INTEGER AS x{j}" for j in range(3)) + " FROM base " + " ".join(f"LEFT JOIN c{j} ON base.{d} = c{j}.v" for j, d in enumerate(dims)) + ")")
    steps += [*_hilbert_sql(bits, dims), CRC32_TABLE_SQL]
    steps.append(f"crc AS (SELECT * EXCLUDE (tab), {CRC32_SQL} AS text_crc32 FROM curved, ct)")
    steps.append("placed AS (SELECT *, row_number() OVER (ORDER BY curve, doc_id NULLS FIRST, text_crc32, size) - 1 AS place, count(*) OVER () AS total FROM crc)")
    steps.append(f"sh AS (SELECT *, (place * {shards} // total)::INTEGER AS shard FROM placed)")
    return f"WITH {', '.join(steps)} SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard, place - (shard * total + {shards - 1}) // {shards} AS slot, NULL::INTEGER AS grown_shard, curve FROM sh"


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


OP5_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""


def op6_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.binary_pieces(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    base, both = F.array_distinct("base.label"), F.array_distinct(F.concat("base.label", "matches.label"))
    best = F.coalesce(F.array_max("matches.score"), F.lit(0.0))
    return out.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(best).alias("score"),
        "matches",
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan_secrets(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), token_pattern())
    base = F.filter("spans", lambda x: x["kind"] != "random")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    return out.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op8_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    simple8b.write_ids(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return simple8b.read_ids(spark, path)


def op10_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.balanced_copies(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op11_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_score.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Terms as they are written for both sides; what stands between terms is of ASCII.
OP11_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {OP11_TERMS} AS t FROM documents WHERE text IS NOT NULL),
n AS (SELECT r, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM n),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term),
q AS (SELECT item_id, row_number() OVER () AS i, unnest(list_distinct({OP11_TERMS})) AS term FROM benchmark),
s AS (SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n USING (r), total GROUP BY i, r),
k AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""


def rebuilt(turns: DataFrame, family: int = 20) -> DataFrame:
    """Conversations that begin like the first of their family of ids: each takes its first turns (up to three, by its own id) in place of as many of its own.

    Turns of one number are ordered by role and text. Each conversation also has a row without a place, so that one without turns stays. Rows
    without an id belong to none.
    """
    own = turns.filter("conv_id is not null").select("conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "turn")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = own.select("conv_id", F.row_number().over(order).alias("place"), "role", "text")
    head = lambda c: F.crc32(F.col(c).cast("string")) % 4
    ids = own.select("conv_id").distinct().withColumns({"first": F.col("conv_id") - F.col("conv_id") % family, "h": head("conv_id")})
    heads = placed.filter((F.col("conv_id") % family == 0) & (F.col("place") <= 3)).withColumnRenamed("conv_id", "first")
    taken = ids.join(heads, "first").filter("place <= h").select("conv_id", "place", "role", "text")
    nothing = ids.select("conv_id", F.lit(None).cast("int").alias("place"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    return taken.unionByName(placed.filter(F.col("place") > head("conv_id"))).unionByName(nothing)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prefix_trie.prefix_trie(prefix_trie.conversations(rebuilt(table(spark, sf_dir, "conversations"))))
    return out.select(*[F.col(c).cast("long").alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")], "ends_sha256")


OP12_SQL = f"""
WITH {CRC32_TABLE_SQL},
own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % 20 AS base, {CRC32_SQL} % 4 AS h FROM (SELECT DISTINCT c, c::VARCHAR AS t FROM own), ct),
turns AS (SELECT i.c, place, role, text FROM ids i JOIN own o ON o.c = i.base AND place <= h UNION ALL SELECT i.c, place, role, text FROM ids i JOIN own o ON o.c = i.c AND place > h),
ranked AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY place) AS d, len(role) || ':' || role || text AS step, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM turns),
paths AS (SELECT c, d, words, list(md5(step)) OVER (PARTITION BY c ORDER BY d) AS path FROM ranked UNION ALL SELECT c, 0, 0, [] FROM ids),
ended AS (SELECT c, max(d) AS n FROM paths GROUP BY c),
nodes AS (SELECT path, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
          sha256(coalesce(string_agg(CASE WHEN d = n THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256 FROM paths JOIN ended USING (c) GROUP BY path),
kids AS (SELECT path[:-2] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_ AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (path)),
ups AS (SELECT path[:k] AS path, n_children = 0 AS leaf, (n_convs - 1) * words AS saved FROM (SELECT *, unnest(range(depth + 1)) AS k FROM full_)),
sums AS (SELECT path, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM ups GROUP BY path)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM full_ f JOIN sums USING (path) LEFT JOIN nodes p ON f.depth > 0 AND p.path = f.path[:-2]
"""


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.best_fit_pieces(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_graph_neighbours": op2_graph_neighbours,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_hilbert_shards": op4_hilbert_shards,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_binary_packing": op6_binary_packing,
    "op7_license_scan": op7_license_scan,
    "op8_simple8b_ids": op8_simple8b_ids,
    "op9_secret_scan": op9_secret_scan,
    "op10_entropy_mix": op10_entropy_mix,
    "op11_max_score": op11_max_score,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_best_fit": op13_best_fit,
}
ORACLES = {"op4_hilbert_shards": op4_sql(), "op5_exact_dedup": OP5_SQL, "op11_max_score": OP11_SQL, "op12_prefix_trie": OP12_SQL}
