"""Range join of vectors: against all pairs, with cells, blocks and copies of any size, and odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import metric_join

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.95):
    """(vec_id, n_links, component_id, kept) of all rows, from all pairs."""
    def direction(v):
        if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float64) / max(abs(x) for x in v)
        return x / np.linalg.norm(x)

    unit = [direction(v) for _, v in rows]
    n, links = len(rows), [[] for _ in rows]
    for i in range(n):
        for j in range(n):
            if i != j and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i].append(j)
    told = []
    for i in range(n):
        seen, open_ = {i}, [i]
        while open_:
            for j in links[open_.pop()]:
                if j not in seen:
                    seen.add(j)
                    open_.append(j)
        least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        told.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(told, key=str)


def got(spark, rows, schema=SCHEMA, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], schema).withColumns({c: F.lit("x") for c in ("vector", "class", "n", "first", "component", "copies")})
    return sorted((tuple(r) for r in metric_join.vector_links(df, **options).collect()), key=str)


def cloud(rng, n, dim=8, hot=0.34):
    """Directions at random, a dense group with a share of the rows, looser groups, and copies."""
    x = rng.normal(size=(n, dim))
    centre = rng.normal(size=dim)
    k = int(n * hot)
    x[:k] = centre + rng.normal(size=(k, dim)) * rng.choice([0.02, 0.2, 0.35], size=(k, 1)) * np.linalg.norm(centre) / np.sqrt(dim)
    x[k : k + n // 10] = x[rng.integers(0, n, n // 10)] * rng.choice([1, 1, 2.5], size=(n // 10, 1))
    return [(int(i), [float(np.float32(c)) for c in v]) for i, v in zip(rng.permutation(n), x)]


@pytest.mark.parametrize(("cell", "visitors", "dim"), [(4096, 16_384, 8), (16, 32, 8), (8, 8, 3)])
def test_all_links_are_found(spark, monkeypatch, cell, visitors, dim):
    """Also where cells are dealt into many blocks, and blocks are copied for their visitors."""
    monkeypatch.setattr(metric_join, "CELL", cell)
    monkeypatch.setattr(metric_join, "VISITORS", visitors)
    monkeypatch.setattr(metric_join, "SAMPLE", 64)
    rows = cloud(np.random.default_rng(cell + dim), 300, dim)
    assert got(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [1.0, 0.001]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]),
        (9, [1.0, -0.0]), (None, [0.0, 1.0]), (None, [1e30, 1e28]), (10, [0.0, 1.0]), (11, [1.0]), (12, [3.0]), (13, [1.0, 0.0, 0.0]), (14, [1e-38, 0.0]), (None, [-1.0, 0.0]),
    ]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == [] and got(spark, [(3, [0.0])]) == [(3, 0, 3, True)]


def test_vectors_of_doubles(spark):
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1.0, 0.5]), (4, [1e308, -1e308])]
    assert got(spark, rows, "vec_id long, embedding array<double>, label int") == brute(rows)


def test_chains_of_links(spark):
    """Neighbours alone are linked; what is reached is one component."""
    turns = [(k, [float(np.cos(0.3 * k)), float(np.sin(0.3 * k))]) for k in range(12)]
    assert got(spark, turns) == brute(turns) and {r[2] for r in got(spark, turns)} == {0}
    assert {r[1] for r in got(spark, turns, cosine=0.99)} == {0}


def test_a_hot_group_is_counted_without_comparing_it(spark, monkeypatch):
    """A third of the rows within half the reach of one pivot: no two of them are compared, and no task holds many rows."""
    rng = np.random.default_rng(3)
    hot = rng.normal(size=16) + rng.normal(size=(1000, 16)) * 0.01
    x = np.concatenate([hot, rng.normal(size=(2000, 16))])
    rows = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    sizes = []
    monkeypatch.setattr(metric_join, "CELL", 100)
    deal = metric_join.deal

    def dealt(places, cells):
        met = deal(places, cells).cache()
        sizes.extend(met.groupBy("task").agg(F.count("*").alias("n"), F.sum((~F.col("visitor") & F.col("inside")).cast("int")).alias("compared")).collect())
        sizes.append(met.where("not visitor").join(places.where("ring = 0").select("class"), "class").agg(F.count("*").alias("n"), F.sum(F.col("inside").cast("int")).alias("compared")).first())
        return met

    monkeypatch.setattr(metric_join, "deal", dealt)
    told = {r.vec_id: r for r in metric_join.vector_links(rows).collect()}
    assert all(told[k].n_links == 999 and told[k].component_id == 0 for k in range(1000))
    assert sizes[-1]["n"] >= 1000 and sizes[-1]["compared"] == 0
    assert max(s["n"] for s in sizes[:-1]) <= 200 + 2000  # a block and its visitors


def test_the_forest_connects_what_links_connect():
    rng = np.random.default_rng(5)
    for share in (0.001, 0.02, 0.5):
        links = rng.random((60, 80)) < share
        forest = metric_join.Forest(140)
        forest.add(links, np.arange(60), np.arange(60, 140))
        assert all(links[a, b - 60] for a, b in forest.edges) and len(forest.edges) == 140 - len({forest._top(k) for k in range(140)})
        assert all(forest._top(i) == forest._top(60 + j) for i, j in zip(*np.nonzero(links)))
