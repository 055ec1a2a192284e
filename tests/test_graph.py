"""Graph scores on small graphs against brute force."""

import itertools
import random

from pyspark.sql import functions as F

from commlens.operators import edges, graph


def small(spark, seed=1, n=9, p=0.35):
    rng = random.Random(seed)
    rows = [(f"n{i}", f"n{j}", rng.randrange(1, 5)) for i in range(n) for j in range(n) if rng.random() < p]
    return rows, spark.createDataFrame(rows, "src string, dst string, volume long")


def undirected(rows):
    adj = {}
    for a, b, _ in rows:
        adj.setdefault(a, set())
        adj.setdefault(b, set())
        if a != b:
            adj[a].add(b)
            adj[b].add(a)
    return adj


def test_cliques_and_clustering(spark):
    for seed in (1, 2):
        rows, e = small(spark, seed)
        rows.append(("lone", "lone", 1))
        e = e.union(spark.createDataFrame([("lone", "lone", 1)], e.schema))
        adj = undirected(rows)
        whole = [set(c) for k in range(1, len(adj) + 1) for c in itertools.combinations(sorted(adj), k) if all(b in adj[a] for a, b in itertools.combinations(c, 2))]
        want = sorted(sorted(c) for c in whole if not any(c < d for d in whole))
        assert sorted(r.members for r in graph.cliques(e).collect()) == want
        got = {r.node: r.clustering for r in graph.clustering(e).collect()}
        for v, near in adj.items():
            t = sum(b in adj[a] for a, b in itertools.combinations(sorted(near), 2))
            assert abs(got[v] - (2 * t / (len(near) * (len(near) - 1)) if len(near) > 1 else 0)) < 1e-9
        score = {r.node: r.raw_clique_score for r in graph.clique_scores(e).collect()}
        assert score == {v: sum(2.0 ** (len(c) - 1) for c in want if v in c) for v in adj}


def test_paths(spark):
    rows, e = small(spark, 3)
    out = {}
    for a, b, _ in rows:
        out.setdefault(a, set()).add(b)
    nodes = sorted({x for r in rows for x in r[:2]})
    want, paths = {}, {}
    for s in nodes:
        level, front = {s: 0}, [s]
        count = {s: 1}
        while front:
            nxt = []
            for v in front:
                for w in sorted(out.get(v, set()) - {v}):
                    if w not in level:
                        level[w] = level[v] + 1
                        nxt.append(w)
                    if level[w] == level[v] + 1:
                        count[w] = count.get(w, 0) + count[v]
            front = nxt
        want[s], paths[s] = level, count
    got = {}
    for r in graph.distances(e).collect():
        got.setdefault(r.node, {})[r.other] = r.steps
    assert got == want
    n = len(nodes)
    for r in graph.betweenness(e).collect():
        v = r.node
        b = sum(paths[s][v] * paths[v][t] / paths[s][t] for s in nodes for t in want[s] if len({s, v, t}) == 3 and v in want[s] and t in want[v] and want[s][v] + want[v][t] == want[s][t])
        assert abs(r.betweenness - b / ((n - 1) * (n - 2))) < 1e-9


def test_responses(spark):
    rows = [("a", "b", "2024-01-05 10:00:00"), ("b", "a", "2024-01-09 09:00:00"), ("b", "a", "2024-01-10 10:00:00"), ("a", "a", "2024-01-05 10:00:00"), ("c", "a", "2024-01-05 10:00:00")]
    m = spark.createDataFrame(rows, "src string, dst string, t string").withColumn("t", F.col("t").cast("timestamp"))
    score = {r.node: r.response_score for r in graph.response_score(m).collect()}
    # Friday plus three business days is Wednesday 10:00, exclusive: one reply, one other pair.
    assert abs(score["b"] - 1 / 3) < 1e-9 and score["c"] == 0 and score["a"] == 0
    at = {r.node: r.average_time for r in graph.average_time(m).collect()}
    assert at["b"] == 4 * 86400 - 3600 and at["a"] == 432_000
    r = graph.responses(m).where("node = 'b'").agg(F.sum(F.col("in_time").cast("int")).alias("hit"), F.count("*").alias("n")).first()
    assert (r.hit, r.n) == (1, 2)


def test_scores(spark):
    rows, e = small(spark, 4)
    h = graph.hits(e, 30).collect()
    assert abs(sum(r.hub for r in h) - 1) < 1e-9 and abs(sum(r.authority for r in h) - 1) < 1e-9
    assert abs(sum(r.rank for r in graph.pagerank(e, 10).collect()) - 1) < 1e-9
    c = graph.normalised(spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0)], "node string, x double, average_time double"), ["x", "average_time"])
    assert [(r.x, r.average_time) for r in c.orderBy("node").collect()] == [(0.0, 0.0), (100.0, 0.0)]
    assert [r.hierarchy for r in graph.hierarchy(c, {"x": 1.0, "average_time": 1.0}).orderBy("node").collect()] == [0, 50]
    two = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("c", "a", 1), ("x", "y", 1), ("y", "z", 1), ("z", "x", 1)], "src string, dst string, volume long")
    by = {r.node: r.community for r in graph.communities(two).collect()}
    assert len({by[k] for k in "abc"}) == 1 and len({by[k] for k in "xyz"}) == 1 and by["a"] != by["x"]
    assert edges.undirected(two).count() == 6


def test_communities_by_modularity(spark):
    """Cliques joined by single edges are found; modularity equals its definition; no merge of two communities would raise it."""
    rows = [(f"{c}{i}", f"{c}{j}", 1) for c in "abcd" for i in range(5) for j in range(i)] + [("a0", "b0", 1), ("b1", "c0", 1), ("c1", "d0", 1), ("d1", "a1", 1), ("a0", "a0", 3), ("lone", "lone", 1)]
    e = spark.createDataFrame(rows, "src string, dst string, volume long")
    parts = graph.communities(e)
    by = {r.node: r.community for r in parts.collect()}
    assert by == {f"{c}{i}": f"{c}0" for c in "abcd" for i in range(5)} | {"lone": "lone"}
    adj = undirected(rows)
    m = sum(map(len, adj.values())) / 2

    def q(label):
        return sum((1 if b in adj[a] else 0) - len(adj[a]) * len(adj[b]) / (2 * m) for a in adj for b in adj if label[a] == label[b]) / (2 * m)

    assert abs(graph.modularity(e, parts) - q(by)) < 1e-12
    for seed in (5, 6):
        rows, e = small(spark, seed, 12, 0.15)
        adj, by = undirected(rows), {r.node: r.community for r in graph.communities(e).collect()}
        m = sum(map(len, adj.values())) / 2
        assert set(by) == set(adj) and all(by[by[k]] == by[k] for k in by)
        for x, y in itertools.combinations(sorted(set(by.values())), 2):
            assert q({k: x if v == y else v for k, v in by.items()}) <= q(by) + 1e-9


def test_closeness_and_eigenvector(spark):
    import numpy as np

    rows, e = small(spark, 3)
    names = sorted({x for a, b, _ in rows for x in (a, b)})
    adj = undirected(rows)
    a = np.array([[float(y in adj[x]) for y in names] for x in names])
    values, vectors = np.linalg.eigh(a)
    got = {r.node: r.eigenvector for r in graph.eigenvector_centrality(e, 60).collect()}
    assert np.allclose([got[n] for n in names], np.abs(vectors[:, -1]), atol=1e-3) or abs(values[-1] - values[-2]) < 0.1
    step = {}
    for x, y, _ in rows:
        step.setdefault(x, set()).add(y)
    for r in graph.closeness(e).collect():
        dist, front, k = {r.node: 0}, {r.node}, 0
        while front:
            k += 1
            front = {y for x in front for y in step.get(x, ())} - set(dist)
            dist |= dict.fromkeys(front, k)
        s, n = sum(dist.values()), len(dist) - 1
        assert r.eccentricity == max(dist.values()) and abs(r.closeness - (n * n / s / (len(names) - 1) if n else 0)) < 1e-9 and abs(r.farness - (s / n if n else 0)) < 1e-9
