"""Ranked search, the prefix trie and best-fit packing against brute-force versions, on whole tables and on small odd ones."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import duck_rows, spark_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from trailmark.llm import best_fit, max_score, prefix_trie, queries
from trailmark.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score long, rank int, query string, __id long"


def brute_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranking(docs, items, k=10):
    counted = [(i, Counter(brute_terms(t))) for i, t in docs if brute_terms(t)]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(brute_terms(text)) if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def as_rows(df):
    return sorted(((r[0], r[1], r[2], r[3]) for r in df.collect()), key=str)


def test_ranking_of_whole_tables_equals_sql_and_brute_force(spark):
    got = queries.op11_max_score(spark, SF)
    assert spark_rows(got) == duck_rows(queries.OP11_SQL, SF)
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    assert as_rows(got) == brute_ranking([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in items])


def odd_documents():
    r = random.Random(3)
    rows = [(i, " ".join(r.choices(["the", "cat", "Dog", "sat", "on", "été", "ÉTÉ", "a1", "x_y", f"w{i}"], k=r.randint(0, 30)))) for i in range(300)]
    rows += [(1000 + i, "the cat") for i in range(200)]  # copies and ties
    return rows + [(5, "the cat"), (5, "the cat"), (None, "the cat sat"), (None, None), (7, None), (8, ""), (9, " .,! "), (10, "Dog " * 100_000)]


@pytest.mark.parametrize(("shard", "round_terms"), [(8192, 10**6), (16, 4)])
def test_ranking_of_odd_rows(spark, monkeypatch, shard, round_terms):
    rows = odd_documents()
    items = [(1, "cat the THE Cat"), (1, "dog"), (2, None), (3, ""), (None, "été sat"), (4, "ÉTÉ x y on on"), (5, "nothing here"), (6, "w7 the w9 a1")]
    docs = spark.createDataFrame([(i, t, 1, 2, "q", 3) for i, t in rows], DOCS).repartition(3)
    asked = spark.createDataFrame([(i, t, 7, "d") for i, t in items], "item_id long, text string, doc_id long, terms string")
    index = max_score._index

    def small(vocabulary):
        run = index(vocabulary)

        def patched(parts):
            max_score.SHARD_DOCS = shard
            return run(parts)

        return patched

    monkeypatch.setattr(max_score, "_index", small)
    got = max_score.ranked(docs, asked, round_terms=round_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert as_rows(got) == brute_ranking(rows, items)


def test_ranking_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(1, "the cat")], "item_id long, text string")
    assert max_score.ranked(none, some).count() == 0
    assert max_score.ranked(spark.createDataFrame([(1, "the cat", 1, 1, "", 1)], DOCS), some.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_max_score_of_shards_equals_all_sums(data):
    """Lists of any bounds, shards of any size, thresholds handed on from shard to shard."""
    r = random.Random(data.draw(st.integers(0, 10**9)))
    n_terms, k = r.randint(1, 8), r.randint(1, 4)
    docs = [{t: r.randint(1, 5) for t in r.sample(range(n_terms), r.randint(0, n_terms))} for _ in range(r.randint(1, 60))]
    weights = np.array([r.choice([0, 1, 10, 1000]) for _ in range(n_terms)], np.int64)
    total = max(1, sum(sum(d.values()) for d in docs))
    asked = [(q, np.array(r.sample(range(n_terms), r.randint(1, n_terms)))) for q in range(3)]
    searcher = max_score.Searcher(asked, weights, len(docs), total, k)
    step = r.randint(1, len(docs))
    for a in range(0, len(docs), step):
        part = docs[a : a + step]
        own = sorted({t for d in part for t in d})
        places = [[i for i, d in enumerate(part) if t in d] for t in own]
        row = {
            "docs": np.arange(a, a + len(part), dtype="<i8"), "null_docs": np.zeros(len(part), bool), "lengths": np.array([sum(d.values()) for d in part], "<i8"), "terms": np.array(own, "<i4"),
            "ends": np.cumsum([len(p) for p in places]).astype("<i8"), "places": np.array(sum(places, []), "<i4"), "counts": np.array([part[i][t] for t, p in zip(own, places, strict=True) for i in p], "<i4"),
        }
        searcher.visit(max_score.Shard({c: v.tobytes() for c, v in row.items()}))
    for q, terms in asked:
        every = []
        for i, d in enumerate(docs):
            m = 10 + 90 * sum(d.values()) * len(docs) // total
            score = sum(int(weights[t]) * (10**9 * d[t] // (1000 * d[t] + 8 * m)) for t in terms.tolist() if t in d)
            if score:
                every.append((-score, i))
        assert sorted((-s, i) for x, i, s in searcher.rows() if x == q) == sorted(every)[:k]


def brute_trie(convs):
    """Nodes of {conversation: [(role, text), ..]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    saved, leaves, kids = Counter(), Counter(), Counter()
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(own) - 1) * words
            leaves[path[:d]] += kids[path] == 0
    return sorted(
        (min(own), len(path), min(members[path[:-1]]) if path else -1, len(own), kids[path], leaves[path], saved[path], hashlib.sha256(",".join(str(c) for c in sorted(own) if len(convs[c]) == len(path)).encode()).hexdigest())
        for path, own in members.items()
    )


def trie_rows(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    return out


def test_trie_of_the_whole_table_equals_sql_and_brute_force(spark):
    got = queries.op12_prefix_trie(spark, SF)
    assert spark_rows(got) == duck_rows(queries.OP12_SQL, SF)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(got) == brute_trie(rebuilt_by_hand(rows))


def test_trie_of_odd_rows(spark, tmp_path):
    rows = [(20, None, None, None), (20, 1, "user", "a b"), (20, 1, "user", "a"), (21, 0, "user", ""), (39, 5, None, "x"), (40, 0, "user", "hello  you"), (41, 0, "user", "hello  you"), (41, 1, "bot", "ok " * 50_000)]
    rows += [(None, 0, "user", "lost"), (None, None, None, None), (57, 1, "u", "only own"), (60, 0, "u", "a"), (60, 0, "u", "a"), (61, 2, "u", "a")]
    spark.createDataFrame([(*r, 1, "d") for r in rows], "conv_id long, turn long, role string, text string, depth int, kind string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert trie_rows(queries.op12_prefix_trie(spark, str(tmp_path))) == brute_trie(rebuilt_by_hand(rows))
    nothing = spark.createDataFrame([], "conv_id long, place int, role string, text string")
    assert prefix_trie.prefix_trie(prefix_trie.conversations(nothing)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_trie_over_many_blocks(spark, seed):
    """Blocks of a few rows: runs of copies, long common prefixes and turnless conversations cross their borders."""
    r = random.Random(seed)
    made = [tuple(("u", r.choice("ab" if seed % 2 else "abcdef") * r.randint(1, 1 + seed // 2)) for _ in range(r.randint(0, 5))) for _ in range(120)]
    made += [made[7]] * 60 + [()] * 9 + [(("u", "a"),) * 40] * 5 + [(("u", "a"),) * 33] * 2
    if seed == 3:
        made = [(("u", "same"),) * 3 + m for m in made]
    ids = r.sample(range(-50, 10_000), len(made))
    convs = {c: list(m) for c, m in zip(ids, made, strict=True)}
    rows = [(c, d, *t) for c, m in convs.items() for d, t in enumerate(m)] + [(c, None, None, None) for c in convs]
    turns = spark.createDataFrame(rows, "conv_id long, place int, role string, text string")
    got = prefix_trie.prefix_trie(prefix_trie.conversations(turns), block_rows=9)
    assert trie_rows(got) == [tuple(-1 if k == 2 and x is None else x for k, x in enumerate(n)) for n in brute_trie(convs)]


def brute_best_fit(lengths, capacity):
    """Best fit decreasing, piece by piece."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 30), max_size=12))))
def test_plan_packs_all_and_about_as_well_as_piece_by_piece(case):
    capacity, counts = case
    entries, got = best_fit.plan(counts, capacity), Counter()
    for bins, parts in entries:
        assert bins > 0 and sum(parts) <= capacity
        for v in parts:
            got[v] += bins
    assert got == Counter(counts)
    lengths = [v for v, n in counts.items() for _ in range(n)]
    used = sum(b for b, _ in entries)
    assert used <= brute_best_fit(lengths, capacity) * 1.2 + 1 and used >= -(-sum(lengths) // capacity)


def test_exact_complements_leave_no_gap():
    counts = Counter({700: 3, 324: 1, 200: 1, 124: 2, 100: 2, 224: 1})  # 700+324, 700+200+124, 700+100+100+124
    assert sorted(best_fit.plan(counts, 1024)) == [(1, (700, 200, 124)), (1, (700, 224, 100)), (1, (700, 324)), (1, (124, 100))] or sum(b for b, _ in best_fit.plan(counts, 1024)) <= 4
    assert best_fit.plan({512: 10**12}, 1024) == [(5 * 10**11, (512, 512))]


def check_packing(rows, texts, capacity=1024):
    path = tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    own, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(own) == set(texts)
    for doc, pieces in own.items():
        ids = [*tok.encode(texts[doc] or "", add_special_tokens=False).ids, 2]
        pieces.sort(key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces))) == list(range(-(-len(ids) // capacity)))
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))] and all(p.length == capacity for p in pieces[1:])
        assert all(p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) for p in pieces) and sum(p.length for p in pieces) == len(ids)
    for placed in sequences.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:i]) for i in range(len(placed))] and sum(n for _, n in placed) <= capacity
    lengths = [r.length for r in rows]
    assert len(sequences) <= brute_best_fit(lengths, capacity) * 1.05 + 1


def test_best_fit_of_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_packing(queries.op13_best_fit(spark, SF).collect(), texts)


def test_best_fit_of_odd_rows(spark):
    texts = {1: None, 2: "", 3: "word", 4: "été " * 3000, 5: "a <|endoftext|> b <|ENDOFTEXT|>", 6: " \t\n", None: "no id"}
    schema = "doc_id long, text string, length int, sequence_id string, __number long, piece int"
    docs = spark.createDataFrame([(i, t, 1, "s", 2, 3) for i, t in texts.items()], schema)
    path = tokenizer_path("byte_bpe_50k.json")
    check_packing(best_fit.best_fit_pieces(docs, path).collect(), texts)
    twice = docs.unionByName(docs).unionByName(docs)
    assert best_fit.best_fit_pieces(twice, path).count() == 3 * best_fit.best_fit_pieces(docs, path).count()
    assert best_fit.best_fit_pieces(docs.limit(0), path).count() == 0
    packed = best_fit.best_fit_pieces(docs, path, with_ids=True)
    whole = {r.sequence_id: bytes(r.ids) for r in best_fit.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
