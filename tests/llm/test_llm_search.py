"""Nearest neighbours and benchmark decontamination against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.llm import contamination, nearest
from conftest import TESTDATA


def exact(rows, asked, k=10):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in asked:
        if q in good:
            others = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            out[q] = others[:k]
    return out


def answers(frame, query, k=10):
    out = {}
    for r in nearest.nearest(frame, query, k).orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return out


def test_small_tables_are_answered_exactly(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)]  # ties, more than an answer holds
    rows += [(100, [1.0, 2.0, 3.0, 4.0]), (200, None), (300, [0.0] * 4), (400, [1.0, None, 1.0, 1.0]), (500, [float("nan")] * 4),
             (600, [float("inf"), 1.0, 1.0, 1.0]), (700, [1.0, 2.0]), (800, [2.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (900, [])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, shard int")
    rows = [(i, v and [np.float32(x) if x is not None else None for x in v]) for i, v in rows]
    got = answers(frame, F.col("vec_id") % 100 == 0)
    expected = exact(rows, [i for i, _ in rows if i is not None and i % 100 == 0])
    assert got.keys() == {q for q, found in expected.items() if found}
    for q, found in got.items():
        assert [i for _, i in found] == [i for _, i in expected[q]] and np.allclose([s for s, _ in found], [s for s, _ in expected[q]], rtol=0, atol=1e-12)
    assert nearest.nearest(frame.limit(0), F.lit(True)).count() == 0


def test_recall_on_the_test_table(spark):
    table = spark.read.parquet(f"{TESTDATA}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    asked = [i for i, _ in rows if i % 5 == 0]
    got, expected = answers(table, F.col("vec_id") % 5 == 0), exact(rows, asked)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in expected[q]}) for q in asked)
    assert hits >= 0.97 * 10 * len(asked)


def test_graph_recall_on_clustered_points():
    rng = np.random.default_rng(2)
    points = (rng.normal(size=(40, 32))[rng.integers(0, 40, 3000)] * 3 + rng.normal(size=(3000, 32))).astype(np.float32)
    graph, entries = nearest.build_graph(points)
    assert (graph >= 0).any(axis=1).all() and not (graph == np.arange(3000)[:, None]).any()
    queries = points[::50]
    found, far = nearest.beam_search(points, graph, entries, queries, nearest.SEARCH_BEAM)
    assert (np.diff(far, axis=1) >= 0).all()
    true = ((queries[:, None] - points[None]) ** 2).sum(axis=2).argsort(axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b[:10])) / 10 for a, b in zip(true, found)]) >= 0.9


def hard_points(kind):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(900, 24))
    if kind == "outlier":
        points[5] = 1e20
    elif kind == "component":
        points[7, 3] = 1e9
    elif kind == "apart":
        points[::2] += 1e4
    elif kind == "groups":
        points += 1e6 * rng.integers(0, 150, size=(900, 1))
    elif kind == "shifted":
        points += 1e7
    return points * {"tiny": 1e-25, "vanishing": 1e-200, "huge": 1e200}.get(kind, 1)


@pytest.mark.parametrize("kind", ["outlier", "component", "apart", "groups", "shifted", "tiny", "vanishing", "huge"])
def test_graph_recall_whatever_the_distances(kind):
    points = hard_points(kind)
    graph, entries = nearest.build_graph(points)
    assert nearest.entries_to(graph, list(entries), np.arange(len(points))) == list(entries)
    asked = np.append(np.arange(0, 900, 30), [5, 7])
    found, far = nearest.beam_search(points, graph, entries, points[asked], nearest.SEARCH_BEAM)
    true = nearest.apart(points, points[asked])
    assert np.array_equal(far[:, :20], np.take_along_axis(true, found[:, :20], 1))
    least = np.sort(true, axis=1)[:, 10:11]
    assert ((far[:, :11] <= least).mean()) >= 0.95


def test_outliers_cost_no_answers(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(hard_points("outlier"))]
    rows[9] = (9, [1e9, *rows[9][1][1:]])
    rows += [(2000 + i, [1e300 * (i + 1)] * 24) for i in range(3)] + [(3000, [-1.7e308] * 24)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, expected = answers(frame, F.col("vec_id") % 20 == 0), exact(rows, [i for i, _ in rows if i % 20 == 0])
    assert got.keys() == expected.keys() and all(len(found) == 10 for found in got.values())
    ordinary = [q for q in expected if q < 1000]
    assert sum(len({i for _, i in got[q]} & {i for _, i in expected[q]}) for q in ordinary) >= 0.95 * 10 * len(ordinary)


def test_shards_and_blocks_answer_together(spark, monkeypatch):
    monkeypatch.setattr(nearest, "QUERIES", 7)
    monkeypatch.setattr(nearest, "BLOCKS", 2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(hard_points("plain")[:300])] + [(500 + i, [float(i), 1.0]) for i in range(9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard_rows in (40, 1000):
        got = {}
        for r in nearest.nearest(frame, F.col("vec_id") % 5 == 0, 10, shard_rows).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        expected = exact(rows, [i for i, _ in rows if i % 5 == 0])
        assert got.keys() == expected.keys()
        assert sum(len(set(got[q]) & {i for _, i in expected[q]}) / len(expected[q]) for q in expected) >= 0.97 * len(expected)


def test_pruning_keeps_near_and_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [-3, 0]], np.float32)
    kept = nearest.robust_prune(points, np.array([0]), np.array([[4, 2, 1, 3, 0, 2, -1]]), 1.2)[0]
    assert list(kept[kept >= 0]) == [1, 3, 4]


WORDS = [f"term{i}" for i in range(300)]


def items_of(rng, n):
    return [(i, " ".join(rng.choices(WORDS, k=rng.randrange(8, 40))) + ". " + " ".join(rng.choices(WORDS, k=4)) + ".") for i in range(n)]


def dense(index, terms):
    """BM25 of every item for a set of terms, without an index."""
    scores = np.zeros(len(index.items))
    for t in terms:
        for at in range(index.begins[t], index.begins[t + 1]):
            scores[index.posted[at]] += index.impacts[at]
    return scores


def test_wand_retrieves_all_above_the_threshold():
    rng = random.Random(3)
    index = contamination.build_index([contamination.parse_item(i, t) for i, t in items_of(rng, 150)])
    own = np.bincount(index.posted, weights=index.impacts)
    assert np.allclose(own, 1)
    for _ in range(60):
        terms = np.unique(rng.sample(range(len(index.terms)), rng.randrange(1, 120)))
        for least in (0.1, 0.3, 0.6):
            scores = dense(index, terms)
            got = contamination.wand(index, terms, range(len(index.tops)), least)
            assert sorted(i for i, _ in got) == [i for i in range(150) if scores[i] >= least]
            assert all(abs(s - scores[i]) < 1e-9 for i, s in got)


def test_bounds_lose_no_passage(spark):
    """What the operator reports is what scoring every passage against every item reports."""
    rng = random.Random(4)
    items = items_of(rng, 60)
    rows = []
    for d in range(120):
        words = rng.choices(WORDS, k=rng.randrange(0, 300))
        if d % 2:
            part = rng.choice(items)[1].split()
            at = rng.randrange(len(words) + 1)
            words[at:at] = part[: rng.randrange(1, len(part) + 1)]
        rows.append((d, " ".join(words)))
    index = contamination.build_index([contamination.parse_item(i, t) for i, t in items])
    expected = set()
    for d, text in rows:
        hashes, offsets = contamination._words([text])
        for _, first, end in zip(*contamination._passages(offsets, index.longest)):
            terms = np.flatnonzero(np.isin(index.terms, hashes[first:end]))
            for number in np.flatnonzero(dense(index, terms) >= 0.5):
                q, a = contamination.overlap(index.items[number], hashes[first:end])
                if q >= 0.75 and a >= 0.5:
                    expected.add((d, index.items[number].item_id))
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    assert {(r.doc_id, r.item_id) for r in contamination.contaminated(docs, bench).collect()} == expected and len(expected) >= 10
    sharded = contamination.contaminated(docs, bench, shard_items=7)
    assert {(r.doc_id, r.item_id) for r in sharded.collect()} == expected
    clean = contamination.drop_contaminated(docs, bench, shard_items=7)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in expected}


def test_decontamination_cases(spark):
    item = "What does the long river carry to the sea? It carries sand, salt and old stones."
    near = item.upper().replace(",", " ;").replace("STONES", "ROCKS")
    half = "What does the long river carry"
    rows = [(1, f"intro {item} outro"), (2, near), (3, half), (4, None), (5, ""), (6, "word " * 30_000 + item + " word" * 30_000), (1, f"intro {item} outro"),
            (None, item), (7, "It carries sand, salt and old stones.")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    bench = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, item), (14, "...")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in contamination.contaminated(docs, bench).collect()), key=repr)
    assert got == sorted([(d, i) for d in (1, 1, 2, 6, None) for i in (10, 13)], key=repr)
    clean = contamination.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id or 0 for r in clean.collect()) == [3, 4, 5, 7]
    assert contamination.contaminated(docs.limit(0), bench).count() == 0 and contamination.contaminated(docs, bench.limit(0)).count() == 0
    assert contamination.drop_contaminated(docs, bench.limit(0)).count() == len(rows)


def test_one_changed_word_or_a_cut_end_loses_no_item(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(2000)]
    body = rng.sample(vocabulary, 40)
    items = {1: " ".join(body[:39]) + ". Er.", 2: " ".join(body[:36]) + ". " + " ".join(body[36:]) + ".",
             3: " ".join(body[:38]) + " 3.14", 4: " ".join(body[:20]), 5: body[0] + "? " + " ".join(body[1:30])}
    rows, expected = [], set()
    for i, text in items.items():
        words = text.split()
        for at in range(len(words)):
            copies = [words[:at] + ["changed"] + words[at + 1:], words[:at] + words[at + 1:], words[:at] + ["put", *words[at:]]]
            for copy in copies:
                filler = rng.choices(vocabulary[1000:], k=60)
                rows.append((len(rows), " ".join(filler[:30] + copy + filler[30:])))
                expected.add((rows[-1][0], i))
    parts = {i: len(rows) + i for i in (1, 2, 3, 4)}  # two thirds of an item are not the item
    rows += [(d, " ".join(items[i].split()[: 2 * len(items[i].split()) // 3])) for i, d in parts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for i, text in items.items():
        bench = spark.createDataFrame([(i, text)], "item_id long, text string")
        got = {(r.doc_id, r.item_id) for r in contamination.contaminated(docs, bench).collect()}
        assert got >= {e for e in expected if e[1] == i} and (parts.get(i), i) not in got, i
