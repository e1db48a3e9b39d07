import collections
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oddspend.llm import ngram_join, permutation_index, shingles
from oddspend.llm.components import components


def grams(text, n=5):
    w = shingles_words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def shingles_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def test_shingles_tell_n_grams_apart():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", "é", "🙂", " ", "\n", "\t", " ", "\x00"]) for _ in range(rng.randint(0, 80)))
        assert len(shingles.shingles(text)) == len(grams(text))
    a, b = "a b c d e f g", "a b c d e f h"
    assert len(np.intersect1d(shingles.shingles(a), shingles.shingles(b))) == len(grams(a) & grams(b)) == 2
    assert shingles.choose_bands(0.8, 0.999, 256) == (30, 7)


def near_table(documents):
    rng = random.Random(2)
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    words = [f"w{k}" for k in range(4000)]
    base = [rng.choice(words) for _ in range(300)]
    for k in range(400):  # one large group of near copies, of which some are exact copies
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(300)] = rng.choice(words)
        rows.append((10_000 + k, " ".join(w)))
    return rows + [(20_000, None), (20_001, ""), (20_002, " \n"), (20_003, "two words"), (20_004, "two  words"), (20_003, "two words"), (None, "no id at all here now"), (None, "no id at all here now")]


def brute_links(rows, threshold=0.8):
    sets = [grams(t) for _, t in rows]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and small >= threshold * large:
                m = len(sets[a] & sets[b])
                if m / (small + large - m) >= threshold:
                    n[a], n[b] = n[a] + 1, n[b] + 1
                    parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    return n, groups


@pytest.mark.parametrize("block", [32, 256])
def test_every_link_of_the_banding_is_counted_once(spark, documents, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_table(documents)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n, groups = brute_links(rows)
    got = collections.defaultdict(list)
    for r in ngram_join.links(df).collect():
        got[r["id"]].append((r["n_links"], r["head"]["id"]))
    want, ident = collections.defaultdict(list), [ngram_join.NO_ID if i is None else i for i, _ in rows]
    for members in groups.values():
        for k in members:
            want[ident[k]].append((n[k], min(ident[m] for m in members)))
    different = [i for i in want if sorted(want[i]) != sorted(got[i])]
    assert sum(x[0] for v in got.values() for x in v) >= 0.999 * sum(n)
    assert len(different) <= 0.01 * len(rows) and all(len(got[i]) == len(want[i]) for i in want)
    kept = [r["doc_id"] for r in ngram_join.drop_near_copies(df).collect()]
    assert len(kept) == len(groups) and kept.count(20_003) == 1 and kept.count(None) == 1


def test_join_of_odd_rows(odd):
    out = ngram_join.drop_near_copies(odd)
    assert out.columns == odd.columns and out.count() == odd.count() - 1
    assert ngram_join.links(odd.limit(0)).count() == 0 and ngram_join.drop_near_copies(odd.limit(0)).count() == 0


def test_overlaps_of_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 20_000, n).astype(np.uint64)) for n in (1, 50, 9000, 300, 9000)]
    found = ngram_join.overlaps(sets[:3], sets[2:])
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:3]]


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (201, 200), (201, 201)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[100 + k] == 100 for k in range(30)) and got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_nearest(ids, x, q, k=5):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    at = int(np.flatnonzero(ids == q)[0])
    score = (x * x[at]).sum(axis=1)
    rows = np.array([i for i in range(len(ids)) if ids[i] != q])
    return rows[np.lexsort((ids[rows], -score[rows]))[:k]], score


def test_recall_and_scores(spark):
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    out = permutation_index.search(t, F.col("id") % 50 == 0).toPandas()
    table = t.toPandas()
    ids, x = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), dtype=float)
    hits, queries = 0, ids[ids % 50 == 0]
    assert set(out["query_id"]) == set(queries)
    for q, g in out.groupby("query_id"):
        near, score = brute_nearest(ids, x, q)
        g = g.sort_values("rank")
        assert g["rank"].tolist() == [1, 2, 3, 4, 5] and q not in set(g["vec_id"])
        places = [int(np.flatnonzero(ids == v)[0]) for v in g["vec_id"]]
        assert np.allclose(g["score"], score[places], atol=1e-12, rtol=0)
        assert all((a > b) or (a == b and v < w) for a, b, v, w in zip(g["score"], g["score"][1:], g["vec_id"], g["vec_id"][1:]))
        hits += len(set(near) & set(places))
    assert hits >= 0.9 * 5 * len(queries)


def test_hot_vector_in_blocks_gives_what_one_block_gives(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 16))
    x[300:700] = x[0]  # one vector that almost half of all rows have
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(permutation_index, "BLOCK", 50)
    monkeypatch.setattr(permutation_index, "QUERIES", 3)
    out = permutation_index.search(df, F.col("id") % 50 == 0, share=1.0).toPandas()
    for q in (0, 300, 450):
        assert out[out["query_id"] == q].sort_values("rank")["vec_id"].tolist() == [v for v in (0, *range(300, 310)) if v != q][:5]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (150, [nan, 1.0]), (200, [inf, 1.0]), (250, [None, 1.0]), (300, [1.0]), (None, [1.0, 1.0]), (350, []), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, id string, rank int")
    out = [tuple(r) for r in permutation_index.search(df.filter("vec_id is null or vec_id != 300"), F.col("id") % 50 == 0).collect()]
    assert sorted(out) == [(0, 1, 1, 1.0), (0, 2, 2, 0.0)]
    assert permutation_index.search(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert permutation_index.search(df, F.col("id") % 50 == 0).filter("vec_id > 2").count() == 0


def test_components_of_every_size_and_a_stray_dimension(spark):
    rows = [(0, [2.0**660, 2.0**660]), (1, [1.0, 1.0]), (2, [1e-200, 0.0]), (50, [2.0**-660, 2.0**-660]), (100, [5e-324, 0.0]), (150, [1.7e308, -1.7e308]), (3, [-1e-310, 2e-310])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {q: [(v, s) for _, v, s in sorted((r["rank"], r["vec_id"], r["score"]) for r in g)] for q, g in by_query(permutation_index.search(df, F.col("id") % 50 == 0)).items()}
    half = 2**-0.5
    assert [v for v, _ in out[0]] == [1, 50, 2, 100, 3] and np.allclose([s for _, s in out[0]], [1, 1, half, half, 10**-0.5], atol=1e-12)
    assert [v for v, _ in out[50]] == [0, 1, 2, 100, 3] and out[100][0] == (2, 1.0)
    assert [v for v, _ in out[150]] == [2, 100, 0, 1, 50] and np.allclose([s for _, s in out[150]], [half, half, 0, 0, 0], atol=1e-12)
    # one row of another dimension, whatever its id, does not shut out the rest
    for k in range(20):
        stray = spark.createDataFrame([(1000 + k, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>")
        few = permutation_index.choose_pivots(permutation_index.valid(df.union(stray), "vec_id", "embedding"))
        assert few.shape[1] == 2


def by_query(found):
    out = collections.defaultdict(list)
    for r in found.collect():
        out[r["query_id"]].append(r)
    return out
