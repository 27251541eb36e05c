"""Each stage of the pipeline against a brute-force version of its own input, and the whole run."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_operators import brute_near, brute_targets, check_pieces, odd, empty  # noqa: F401 (fixtures)

import corpus_pipeline
from trailmark.llm import language_id

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage of the run over the small documents got and gave."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        made = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs.collect(), made.collect(), docs.columns, made.columns)
        docs = made
    return out


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_order_and_columns(stages):
    assert list(stages) == ["language_id", "exact_dedup", "ngram_jaccard", "entropy_mix", "binary_packing"]
    for name, (_, _, before, after) in stages.items():
        assert name == "binary_packing" or before == after


def test_language_stage(stages):
    before, after, *_ = stages["language_id"]
    counts = {r.doc_id: language_id.gram_counts(r.text or "", 14) for r in before}
    labelled = [r for r in before if r.text is not None and r.lang is not None]
    names = sorted({r.lang for r in labelled})
    sums = np.array([sum((counts[r.doc_id] for r in labelled if r.lang == n), np.zeros(1 << 14)) + 0.1 for n in names])
    logs, share = np.log(sums / sums.sum(axis=1, keepdims=True)), Counter(r.lang for r in labelled)
    prior = np.log([share[n] / len(labelled) for n in names])
    expected = []
    for r in before:
        total = logs @ counts[r.doc_id] + prior
        posterior = 1 / np.exp(total - total.max()).sum()
        if counts[r.doc_id].any() and any(map(str.isalpha, r.text or "")) and posterior >= corpus_pipeline.LEAST_SCORE:
            expected.append(r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(expected)


def test_exact_stage(stages):
    before, after, *_ = stages["exact_dedup"]
    best = {}
    for r in before:
        best[lowered(r.text)] = max(best.get(lowered(r.text), r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(best.values())


def test_near_stage(stages):
    before, after, *_ = stages["ngram_jaccard"]
    found = brute_near([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(name for name, _, component in found if name == component)


def test_near_stage_repeated_and_null_ids(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(60)) for k in "abcd")
    rows = [(1, a), (2, f"{a} x"), (2, b), (None, f"{a} y"), (3, c), (3, c), (3, f"{c} x"), (None, d), (None, f"{d} x"), (4, ""), (4, None)]
    made = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    got = Counter((r.doc_id, (r.text or "-")[0]) for r in made)
    assert got == Counter([(1, "a"), (2, "b"), (3, "c"), (None, "d"), (4, "-"), (4, "-")])


def test_stages_keep_columns_named_like_verdicts(spark):
    """Columns called like the operators' own, repeated rows and repeated ids: verdicts are by row."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a, "en", "s"), (1, a, "en", "s"), (2, a, "en", "s"), (5, b, "en", "s"), (5, f"{b} c", "en", None), (None, b, None, "s"), (None, None, None, None), (None, "", None, None)]
    docs = spark.createDataFrame([(*r, 1.5, "x", 7, "k") for r in rows], "doc_id long, text string, lang string, source string, score double, lang_pred string, __row int, key string")
    judged = corpus_pipeline.identify_language(spark, docs, SF)
    assert judged.columns == docs.columns and judged.count() == 6
    single = corpus_pipeline.drop_copies(spark, docs, SF)
    assert single.columns == docs.columns
    assert Counter((r.doc_id, (r.text or "-")[:1], len(r.text or "")) for r in single.collect()) == Counter([(2, "a", len(a)), (5, "b", len(b)), (5, "b", len(b) + 2), (None, "-", 0)])
    near = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert near.columns == docs.columns and Counter(r.doc_id for r in near.collect()) == Counter([1, 5, None, None])
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns and {r.score for r in mixed.collect()} == {1.5}


def test_mix_of_repeated_ids_meets_its_target(spark):
    docs = spark.createDataFrame([(i % 3, " ".join(["w"] * 10) + f" {i}", "abc"[i % 2]) for i in range(60)], "doc_id long, text string, source string")
    taken = Counter()
    for r in corpus_pipeline.mix_sources(spark, docs, SF).collect():
        taken[r.source] += len(r.text.split())
    target = brute_targets({"a": 330, "b": 330})
    assert all(abs(taken[s] - target[s]) <= 11 / 2 for s in target)


def test_mix_stage(stages):
    before, after, *_ = stages["entropy_mix"]
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in before}
    source, copies = {r.doc_id: r.source for r in before}, Counter(r.doc_id for r in after)
    assert set(copies) <= set(words) and max(copies.values()) <= 3
    sizes, taken = Counter(), Counter()
    for name, n in words.items():
        sizes[source[name]] += n
        taken[source[name]] += n * copies[name]
    target = brute_targets(sizes)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(max(n for name, n in words.items() if source[name] == s) / 2, 1)


def test_packing_stage(stages):
    before, after, *_ = stages["binary_packing"]
    text, copies, own = {r.doc_id: r.text for r in before}, Counter(r.doc_id for r in before), defaultdict(list)
    for r in after:
        own[r.doc_id, r.start].append(r)
    assert all(len(rows) == copies[name] for (name, _), rows in own.items()) and {name for name, _ in own} == set(text)
    check_pieces([rows[0] for rows in own.values()], text)
    assert len({r.sequence_id for r in after}) == len(after)


def test_stages_take_odd_and_empty_rows(spark, odd, empty):  # noqa: F811
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SF)
            assert name == "binary_packing" or made.columns == docs.columns
            assert name == "binary_packing" or made.count() <= 3 * docs.count()


def test_run(spark, stages):
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, SF).collect())
    assert got == Counter(r.doc_id for r in stages["binary_packing"][1])


@pytest.mark.parametrize("stage", [corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies])
def test_no_group_is_lost_when_files_are_dealt_anew(spark, tmp_path, stage):
    """Verdicts are computed in one pass and applied in another, over tasks that hold other files in another order."""
    texts = [" ".join(f"w{i}x{k}" for k in range(12)) for i in range(300)]
    rows = [(2 * i + c, texts[i], "_metadata") for c in range(2) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, _metadata string").repartition(20).write.parquet(f"{tmp_path}/docs")
    try:
        kept = stage(spark, spark.read.parquet(f"{tmp_path}/docs"), SF)
        spark.conf.set("spark.sql.files.minPartitionNum", "37")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert sorted(r.text for r in kept.collect()) == sorted(texts)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
