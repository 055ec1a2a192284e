"""Queries: network scores on the message edges (large) and on the nations' trade edges (iterative scores)."""

from __future__ import annotations

from pyspark.sql import functions as F

from commlens.operators import edges, graph
from commlens.plans.mails import MESSAGES_SQL, TRADE_SQL, messages, table, trade
from commlens.plans.registry import query
from commlens.tables import written


def _messages(spark, sf_dir):
    return messages(spark, sf_dir).select("src", "dst", "t", "mail_id")


@query("g2_number_of_emails", f"WITH {MESSAGES_SQL}, n AS (SELECT src AS node FROM msg UNION SELECT dst FROM msg), c AS (SELECT src, count(*) AS k FROM msg GROUP BY 1) SELECT node, coalesce(k, 0) AS number_of_emails FROM n LEFT JOIN c ON src = node")
def g2(spark, sf_dir):
    return graph.number_of_emails(edges.weights(_messages(spark, sf_dir)))


#: Three business days later; ISO weekdays, Monday is 1.
_LATER = "t1 + CASE WHEN isodow(t1) <= 2 THEN INTERVAL 3 DAY WHEN isodow(t1) <= 5 THEN INTERVAL 5 DAY WHEN isodow(t1) = 6 THEN INTERVAL 4 DAY ELSE INTERVAL 3 DAY END"
_RESPONSES = f"""
WITH {MESSAGES_SQL}, p AS (SELECT a.dst AS node, a.t AS t1, b.t AS t2 FROM msg a JOIN msg b ON a.src = b.dst AND a.dst = b.src WHERE a.src <> a.dst),
r AS (SELECT node, t1, t2, t2 > t1 AND t2 < {_LATER} AS hit FROM p), n AS (SELECT src AS node FROM msg UNION SELECT dst FROM msg),
c AS (SELECT node, count(*) FILTER (hit) AS replies, count(*) FILTER (NOT hit) AS others, avg(epoch_us(t2) / 1e6 - epoch_us(t1) / 1e6) FILTER (hit) AS mean FROM r GROUP BY 1)"""


@query("g3_response_score", f"{_RESPONSES} SELECT n.node, round(coalesce(replies / (replies + others + 1.0), 0), 6)::DOUBLE AS response_score FROM n LEFT JOIN c ON c.node = n.node")
def g3(spark, sf_dir):
    return graph.response_score(_messages(spark, sf_dir)).select("node", F.round("response_score", 6).alias("response_score"))


@query("g4_average_time", f"{_RESPONSES} SELECT n.node, round(coalesce(mean, 432000), 3)::DOUBLE AS average_time FROM n LEFT JOIN c ON c.node = n.node")
def g4(spark, sf_dir):
    return graph.average_time(_messages(spark, sf_dir)).select("node", F.round("average_time", 3).alias("average_time"))


@query("j3_responses", """
WITH v AS (SELECT user_id, ts FROM events WHERE event_type = 'view'), p AS (SELECT user_id, ts FROM events WHERE event_type = 'purchase'),
x AS (SELECT v.user_id, v.ts AS t1, p.ts AS t2 FROM v JOIN p ON v.user_id = p.user_id)
SELECT user_id, t1, t2 FROM x WHERE t2 > t1 AND t2 < """ + _LATER)
def j3(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    day = lambda c: F.unix_date(F.col(c).cast("date"))
    v = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("t1")).withColumn("day", F.explode(F.sequence(day("t1"), day("t1") + 5)))
    p = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("t2")).withColumn("day", day("t2"))
    return v.join(p, ["user_id", "day"]).where((F.col("t2") > F.col("t1")) & (F.col("t2") < graph.business_days_later(F.col("t1")))).select("user_id", "t1", "t2")


@query("g5_degree", f"WITH {MESSAGES_SQL}, e AS (SELECT DISTINCT src, dst FROM msg), ends AS (SELECT src AS node FROM e UNION ALL SELECT dst FROM e), n AS (SELECT count(DISTINCT node) AS n FROM ends) SELECT node, round(count(*) / (n - 1.0), 6)::DOUBLE AS degree_centrality FROM ends, n GROUP BY node, n")
def g5(spark, sf_dir):
    return graph.degree_centrality(edges.weights(_messages(spark, sf_dir))).select("node", F.round("degree_centrality", 6).alias("degree_centrality"))


def _hits_sql(rounds: int) -> str:
    ctes = ["h0 AS (SELECT node, 1.0::DOUBLE AS hub FROM nodes)"]
    for i in range(1, rounds + 1):
        ctes.append(f"a{i} AS MATERIALIZED (SELECT dst AS node, sum(volume * hub) AS authority FROM e JOIN h{i - 1} ON src = node GROUP BY 1)")
        ctes.append(f"r{i} AS MATERIALIZED (SELECT src AS node, sum(volume * authority) AS hub FROM e JOIN a{i} ON dst = node GROUP BY 1)")
        ctes.append(f"h{i} AS MATERIALIZED (SELECT node, hub / (SELECT sum(hub) FROM r{i}) AS hub FROM r{i})")
    ctes.append(f"z AS MATERIALIZED (SELECT dst AS node, sum(volume * hub) AS authority FROM e JOIN h{rounds} ON src = node GROUP BY 1)")
    return f"""WITH {TRADE_SQL}, {', '.join(ctes)}
SELECT n.node, round(coalesce(hub, 0), 6)::DOUBLE AS hub, round(coalesce(authority / (SELECT sum(authority) FROM z), 0), 6)::DOUBLE AS authority FROM nodes n LEFT JOIN h{rounds} h ON h.node = n.node LEFT JOIN z ON z.node = n.node"""


@query("g6_hits", _hits_sql(10))
def g6(spark, sf_dir):
    return graph.hits(trade(spark, sf_dir), 10).select("node", F.round("hub", 6).alias("hub"), F.round("authority", 6).alias("authority"))


def _pagerank_sql(rounds: int) -> str:
    ctes = ["o AS (SELECT src, sum(volume) AS o FROM e GROUP BY 1)", "k AS (SELECT count(*) AS n FROM nodes)", "r0 AS MATERIALIZED (SELECT node, 1.0::DOUBLE / (SELECT n FROM k) AS rank FROM nodes)"]
    for i in range(1, rounds + 1):
        ctes.append(f"x{i} AS (SELECT coalesce(sum(rank), 0) AS loose FROM r{i - 1} WHERE node NOT IN (SELECT src FROM o)), y{i} AS (SELECT e.dst AS node, sum(volume::DOUBLE / o * rank) AS got FROM e JOIN o ON o.src = e.src JOIN r{i - 1} ON node = e.src GROUP BY 1)")
        ctes.append(f"r{i} AS MATERIALIZED (SELECT nodes.node, (0.15 + 0.85 * loose) / n + 0.85 * coalesce(got, 0) AS rank FROM nodes LEFT JOIN y{i} ON y{i}.node = nodes.node, x{i}, k)")
    return f"WITH {TRADE_SQL}, {', '.join(ctes)} SELECT node, round(rank, 6)::DOUBLE AS rank FROM r{rounds}"


@query("g1_pagerank", _pagerank_sql(20))
def g1(spark, sf_dir):
    return graph.pagerank(trade(spark, sf_dir), 20).select("node", F.round("rank", 6).alias("rank"))


_TRI = f"""WITH {TRADE_SQL}, tri AS (SELECT x.a AS p, x.b AS q, y.b AS r FROM und x JOIN und y ON x.b = y.a JOIN und z ON z.a = x.a AND z.b = y.b),
t AS (SELECT node, count(*) AS t FROM (SELECT p AS node FROM tri UNION ALL SELECT q FROM tri UNION ALL SELECT r FROM tri) GROUP BY 1), d AS (SELECT a AS node, count(*) AS d FROM adj GROUP BY 1)"""


@query("g7_clustering", f"{_TRI} SELECT n.node, round(CASE WHEN d > 1 THEN 2.0 * coalesce(t, 0) / (d * (d - 1)) ELSE 0 END, 6)::DOUBLE AS clustering FROM nodes n LEFT JOIN d ON d.node = n.node LEFT JOIN t ON t.node = n.node")
def g7(spark, sf_dir):
    return graph.clustering(trade(spark, sf_dir)).select("node", F.round("clustering", 6).alias("clustering"))


@query("g8_cliques")
def g8(spark, sf_dir):
    c = graph.cliques(written(trade(spark, sf_dir), "trade"))
    return c.select(F.array_join("members", ",").alias("members"), "size")


@query("g9_g10_clique_scores")
def g9(spark, sf_dir):
    e = written(trade(spark, sf_dir), "trade")
    w = e.groupBy(F.col("src").alias("node")).agg(F.sum("volume").cast("double").alias("weight"))
    return graph.clique_scores(e, w)


_DIST = f"""WITH RECURSIVE {TRADE_SQL}, step AS (SELECT DISTINCT src, dst FROM e WHERE src <> dst),
walk AS (SELECT node, node AS other, 0 AS steps FROM nodes UNION SELECT node, dst, steps + 1 FROM walk JOIN step ON other = src WHERE steps < 25),
d AS (SELECT node, other, min(steps) AS steps FROM walk GROUP BY 1, 2)"""


@query("g11_distances", f"{_DIST} SELECT * FROM d")
def g11(spark, sf_dir):
    return graph.distances(trade(spark, sf_dir))


@query("g11_mean_shortest_paths", f"{_DIST}, m AS (SELECT node, avg(steps) AS m FROM d GROUP BY 1) SELECT node, round(CASE WHEN m = 0 THEN (SELECT max(m) FROM m) ELSE m END, 6)::DOUBLE AS mean_shortest_paths FROM m")
def g11m(spark, sf_dir):
    return graph.mean_shortest_paths(trade(spark, sf_dir)).select("node", F.round("mean_shortest_paths", 6).alias("mean_shortest_paths"))


@query("g12_betweenness", f"""{_DIST},
p AS (SELECT node, node AS other, 0 AS steps FROM nodes UNION ALL SELECT p.node, dst, p.steps + 1 FROM p JOIN step ON p.other = src JOIN d ON d.node = p.node AND d.other = dst AND d.steps = p.steps + 1),
c AS (SELECT node, other, steps, count(*)::DOUBLE AS c FROM p GROUP BY ALL),
b AS (SELECT x.other AS node, sum(x.c * y.c / z.c) AS b FROM c x JOIN c y ON y.node = x.other JOIN c z ON z.node = x.node AND z.other = y.other AND z.steps = x.steps + y.steps WHERE x.steps > 0 AND y.steps > 0 GROUP BY 1)
SELECT nodes.node, round(coalesce(b, 0) / ((SELECT count(*) FROM nodes) - 1) / ((SELECT count(*) FROM nodes) - 2), 6)::DOUBLE AS betweenness FROM nodes LEFT JOIN b ON b.node = nodes.node""")
def g12(spark, sf_dir):
    return graph.betweenness(written(trade(spark, sf_dir), "trade")).select("node", F.round("betweenness", 6).alias("betweenness"))


@query("g16_closeness", f"""{_DIST}, m AS (SELECT node, count(*) AS r, sum(steps) AS s, max(steps) AS x FROM d WHERE node <> other GROUP BY 1)
SELECT nodes.node, round(coalesce(r::DOUBLE / s * r / ((SELECT count(*) FROM nodes) - 1), 0), 6)::DOUBLE AS closeness, round(coalesce(s::DOUBLE / r, 0), 6)::DOUBLE AS farness, coalesce(x, 0)::INT AS eccentricity FROM nodes LEFT JOIN m ON m.node = nodes.node""")
def g16(spark, sf_dir):
    c = graph.closeness(written(trade(spark, sf_dir), "trade"))
    return c.select("node", F.round("closeness", 6).alias("closeness"), F.round("farness", 6).alias("farness"), "eccentricity")


def _eigenvector_sql(rounds: int) -> str:
    ctes = ["v0 AS MATERIALIZED (SELECT node, 1.0::DOUBLE AS x FROM nodes)"]
    for i in range(1, rounds + 1):
        ctes.append(f"s{i} AS MATERIALIZED (SELECT v.node, any_value(v.x) + coalesce(sum(u.x), 0) AS x FROM v{i - 1} v LEFT JOIN adj ON a = v.node LEFT JOIN v{i - 1} u ON u.node = b GROUP BY 1)")
        ctes.append(f"v{i} AS MATERIALIZED (SELECT node, x / sqrt((SELECT sum(x * x) FROM s{i})) AS x FROM s{i})")
    return f"WITH {TRADE_SQL}, {', '.join(ctes)} SELECT node, round(x, 6)::DOUBLE AS eigenvector FROM v{rounds}"


@query("g16_eigenvector", _eigenvector_sql(30))
def g16e(spark, sf_dir):
    return graph.eigenvector_centrality(trade(spark, sf_dir), 30).select("node", F.round("eigenvector", 6).alias("eigenvector"))


def _metrics(spark, sf_dir):
    m = written(messages(spark, sf_dir).select("src", "dst", "t"), "messages")
    return written(graph.mail_scores(m), "scores")  # read for its ends and for its rows


_METRICS = f"""{_RESPONSES}, ne AS (SELECT src, count(*) AS k FROM msg GROUP BY 1), ed AS (SELECT DISTINCT src, dst FROM msg), ends AS (SELECT src AS node FROM ed UNION ALL SELECT dst FROM ed),
dg AS (SELECT node, count(*) / ((SELECT count(*) FROM n) - 1.0) AS dc FROM ends GROUP BY 1),
m AS (SELECT n.node, coalesce(k, 0) AS number_of_emails, coalesce(replies / (replies + others + 1.0), 0)::DOUBLE AS response_score, coalesce(mean, 432000)::DOUBLE AS average_time, dc::DOUBLE AS degree_centrality
 FROM n LEFT JOIN c ON c.node = n.node LEFT JOIN ne ON src = n.node LEFT JOIN dg ON dg.node = n.node),
b AS (SELECT min(number_of_emails) a1, max(number_of_emails) b1, min(response_score) a2, max(response_score) b2, min(average_time) a3, max(average_time) b3, min(degree_centrality) a4, max(degree_centrality) b4 FROM m),
s AS (SELECT node, CASE WHEN a1 = b1 THEN 0 ELSE (number_of_emails - a1) * 100.0 / (b1 - a1) END AS number_of_emails, CASE WHEN a2 = b2 THEN 0 ELSE (response_score - a2) / (b2 - a2) * 100 END AS response_score,
 CASE WHEN a3 = b3 THEN 0 ELSE 100 - (average_time - a3) / (b3 - a3) * 100 END AS average_time, CASE WHEN a4 = b4 THEN 0 ELSE (degree_centrality - a4) / (b4 - a4) * 100 END AS degree_centrality FROM m, b)"""
_NAMES = ["number_of_emails", "response_score", "average_time", "degree_centrality"]
_WEIGHTS = {"number_of_emails": 1.0, "response_score": 0.7, "average_time": 1.0, "degree_centrality": 1.3}


@query("a15_normalised", f"{_METRICS} SELECT node, {', '.join(f'round({c}, 4)::DOUBLE AS {c}' for c in _NAMES)} FROM s")
def a15(spark, sf_dir):
    return graph.normalised(_metrics(spark, sf_dir), _NAMES).select("node", *[F.round(c, 4).alias(c) for c in _NAMES])


@query("g13_hierarchy", f"{_METRICS} SELECT node, round_even(({' + '.join(f'{w} * {m}' for m, w in _WEIGHTS.items())}) / {len(_WEIGHTS)}, 0)::BIGINT AS hierarchy FROM s")
def g13(spark, sf_dir):
    return graph.hierarchy(graph.normalised(_metrics(spark, sf_dir), _NAMES), _WEIGHTS).select("node", "hierarchy")


@query("k5_y12_hierarchy_report", f"{_METRICS}, h AS (SELECT node, round_even(({' + '.join(f'{w} * {m}' for m, w in _WEIGHTS.items())}) / {len(_WEIGHTS)}, 0)::BIGINT AS hierarchy FROM s) SELECT (hierarchy // 20)::BIGINT AS bin, count(*) AS n FROM h GROUP BY 1")
def k5(spark, sf_dir):
    h = g13(spark, sf_dir)
    return h.groupBy(F.floor(F.col("hierarchy") / 20).alias("bin")).agg(F.count("*").alias("n"))


@query("g14_communities")
def g14(spark, sf_dir):
    return graph.communities(trade(spark, sf_dir))


@query("g15_roles")
def g15(spark, sf_dir):
    e = written(trade(spark, sf_dir), "trade")
    m = graph.degree_centrality(e).join(graph.clustering(e), "node").join(graph.number_of_emails(e), "node")
    return graph.roles(m, ["degree_centrality", "clustering", "number_of_emails"], k=3)


@query("s18_j6_scores_joined", f"{_TRI}, ne AS (SELECT src, sum(volume)::BIGINT AS k FROM e GROUP BY 1) SELECT n_name AS name, round(CASE WHEN d > 1 THEN 2.0 * coalesce(t, 0) / (d * (d - 1)) WHEN nodes.node IS NOT NULL THEN 0 END, 6)::DOUBLE AS clustering, CASE WHEN nodes.node IS NOT NULL THEN coalesce(k, 0) END AS number_of_emails FROM nation LEFT JOIN nodes ON n_name = nodes.node LEFT JOIN d ON d.node = n_name LEFT JOIN t ON t.node = n_name LEFT JOIN ne ON src = n_name")
def s18(spark, sf_dir):
    e = written(trade(spark, sf_dir), "trade")
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    return graph.with_network_scores(n, "name", graph.clustering(e), graph.number_of_emails(e)).select("name", F.round("clustering", 6).alias("clustering"), "number_of_emails")
