"""Network scores on edge tables (src, dst, volume); every score is a DataFrame (node, value).

Iterations write their state after each round, so the plan stays short and a lost executor costs a round's tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commlens.operators.edges import both_ways, nodes_of, undirected, without_loops
from commlens.tables import written


def filled(nodes: DataFrame, scores: DataFrame, name: str, default) -> DataFrame:
    return nodes.join(scores, "node", "left").select("node", F.coalesce(name, F.lit(default)).alias(name))


def number_of_emails(e: DataFrame) -> DataFrame:
    return filled(nodes_of(e), e.groupBy(F.col("src").alias("node")).agg(F.sum("volume").alias("number_of_emails")), "number_of_emails", 0)


def business_days_later(t: Column, days: int = 3) -> Column:
    """The time of day ``days`` business days on (Saturdays and Sundays do not count); built for three."""
    if days != 3:
        raise ValueError("three business days")
    day = F.weekday(t)
    return t + F.make_dt_interval(F.when(day <= 1, 3).when(day <= 4, 5).when(day == 5, 4).otherwise(3))


def responses(mails: DataFrame) -> DataFrame:
    """Of mails (src, dst, t timestamp) the pairs (a wrote to b at t1, b to a at t2): node b, t1, t2, in_time.

    A reply is in time strictly after t1 and strictly before three business days later.  All pairs of opposite mails
    count for the score, so the join is on the pair alone; its size is the product of a pair's two mail counts.
    """
    m = mails.where("src <> dst").select("src", "dst", F.col("t").cast("timestamp").alias("t"))
    a = m.select(F.col("src").alias("x"), F.col("dst").alias("node"), F.col("t").alias("t1"))
    b = m.select(F.col("dst").alias("x"), F.col("src").alias("node"), F.col("t").alias("t2"))
    return a.join(b, ["x", "node"]).withColumn("in_time", (F.col("t2") > F.col("t1")) & (F.col("t2") < business_days_later(F.col("t1"))))


#: Replies are counted within spans of time, so that no pair of people meets in one task; a mail belongs to one span or to two.
SPAN = 64 * 86_400_000_000


def pair_counts(mails: DataFrame) -> DataFrame:
    """Unordered pairs (a, b): mails from a to b (``there``) and from b to a (``back``); mails to oneself are all ``there``."""
    first = F.coalesce(F.col("src") <= F.col("dst"), F.lit(True))
    m = mails.select(F.when(first, F.col("src")).otherwise(F.col("dst")).alias("a"), F.when(first, F.col("dst")).otherwise(F.col("src")).alias("b"), first.alias("first"))
    return m.groupBy("a", "b").agg(F.count_if("first").alias("there"), F.count_if(~F.col("first")).alias("back"))


def node_counts(pairs: DataFrame) -> DataFrame:
    """Per node of ``pair_counts``: mails sent, edges in and out, pairs of opposite mails."""
    edges = ((F.col("there") > 0).cast("long") + (F.col("back") > 0).cast("long")).alias("edges")
    both = (F.col("there") * F.col("back")).alias("pairs")
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("there").alias("sent"), edges, both), F.struct(F.col("b").alias("node"), F.col("back").alias("sent"), edges, both))
    return pairs.select(F.inline(ends)).groupBy("node").agg(F.sum("sent").alias("sent"), F.sum("edges").alias("edges"), F.sum("pairs").alias("pairs"))


def replies_in_time(mails: DataFrame) -> DataFrame:
    """(node, replies, seconds): the pairs of ``responses`` that are in time, counted without listing them.

    Replies to a mail are those up to its limit less those up to the mail itself, and running counts and sums over a
    pair's mails in order of time give both.  One exchange by pair and span; a mail whose limit lies in the next span
    goes there too, and counts from that span's beginning.
    """
    first = F.col("src") < F.col("dst")
    t = F.col("t").cast("timestamp")
    m = mails.where("src <> dst AND t IS NOT NULL").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), first.alias("first"), F.unix_micros(t).alias("t"), F.unix_micros(business_days_later(t)).alias("until"))
    span = lambda c: F.floor(F.col(c) / SPAN)
    m = m.withColumn("own", span("t")).withColumn("span", F.explode(F.sequence("own", span("until")))).withColumn("own", F.col("own") == F.col("span"))
    w = Window.partitionBy("a", "b", "span")
    some = lambda c: F.max(c).over(w)
    # Replies by a to mails of b, and by b to mails of a: are there both in the span?
    m = m.withColumn("by_a", some(F.col("own") & F.col("first")) & some(~F.col("first"))).withColumn("by_b", some(F.col("own") & ~F.col("first")) & some("first")).where("by_a OR by_b")
    row = lambda by_a, at, kind, n, sign: F.struct(by_a.alias("by_a"), at.alias("at"), F.lit(kind).alias("kind"), F.lit(n).cast("long").alias("n"), F.lit(sign).alias("sign"))
    # At equal times a limit comes before replies, and a mail after them: both ends are strict.
    reply = F.when(F.col("own") & F.when(F.col("first"), F.col("by_a")).otherwise(F.col("by_b")), row(F.col("first"), F.col("t"), 1, 1, 0))
    mail = F.when(F.when(F.col("first"), F.col("by_b")).otherwise(F.col("by_a")), F.array(row(~F.col("first"), F.col("until"), 0, 0, 1), F.when(F.col("own"), row(~F.col("first"), F.col("t"), 2, 0, -1))))
    rows = F.array_compact(F.concat(F.array(reply), F.coalesce(mail, F.array().cast(f"array<{_ROW}>"))))
    e = m.select("a", "b", "span", "t", F.explode(rows).alias("e")).select("a", "b", "span", (F.col("t") - F.col("span") * SPAN).alias("t"), "e.by_a", (F.col("e.at") - F.col("span") * SPAN).alias("at"), "e.kind", "e.n", "e.sign")
    w = Window.partitionBy("a", "b", "span", "by_a").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumn("k", F.sum("n").over(w)).withColumn("sum", F.sum(F.col("n") * F.col("at")).over(w)).where("sign <> 0 AND k > 0")
    micros = F.col("sign") * (F.col("sum") - F.col("k") * F.col("t")).cast("double")
    hits = e.groupBy(F.when(F.col("by_a"), F.col("a")).otherwise(F.col("b")).alias("node")).agg(F.sum(F.col("sign") * F.col("k")).alias("replies"), F.sum(micros).alias("micros"))
    return hits.where("replies > 0").select("node", "replies", (F.col("micros") / F.lit(1e6)).alias("seconds"))


_ROW = "struct<by_a: boolean, at: bigint, kind: int, n: bigint, sign: int>"


def response_counts(mails: DataFrame) -> DataFrame:
    """Per node: replies in time, other pairs, seconds of the replies.

    The same numbers as from ``responses`` without its pairs: the pairs of two people are the product of two counts.
    """
    total = node_counts(pair_counts(mails.where("src <> dst"))).where("pairs > 0")
    return total.join(replies_in_time(mails), "node", "left").select("node", F.coalesce("replies", F.lit(0)).alias("replies"), (F.col("pairs") - F.coalesce("replies", F.lit(0))).alias("others"), "seconds")


def mail_scores(mails: DataFrame, default: float = 432_000.0) -> DataFrame:
    """(node, number_of_emails, response_score, average_time, degree_centrality), by one count of pairs and one of replies."""
    n = written(node_counts(pair_counts(mails)), "nodes")
    size = n.agg(F.count("*").alias("size"))
    s = n.where("node IS NOT NULL").join(replies_in_time(mails), "node", "left").join(F.broadcast(size))  # one row
    return s.select(
        "node", F.col("sent").alias("number_of_emails"), (F.coalesce("replies", F.lit(0)) / (F.col("pairs") + 1)).alias("response_score"),
        F.coalesce(F.col("seconds") / F.col("replies"), F.lit(default)).alias("average_time"), F.when(F.col("size") > 1, F.col("edges") / (F.col("size") - 1)).otherwise(F.lit(1.0)).alias("degree_centrality"),
    )


def response_score(mails: DataFrame) -> DataFrame:
    """R / (R + U + 1); nodes without any opposite mails have 0."""
    c = response_counts(mails).select("node", (F.col("replies") / (F.col("replies") + F.col("others") + 1)).alias("response_score"))
    return filled(nodes_of(mails), c, "response_score", 0.0)


def average_time(mails: DataFrame, default: float = 432_000.0) -> DataFrame:
    """Mean seconds until a reply; ``default`` where there is none."""
    c = replies_in_time(mails).select("node", (F.col("seconds") / F.col("replies")).alias("average_time"))
    return filled(nodes_of(mails), c, "average_time", default)


def degree_centrality(e: DataFrame) -> DataFrame:
    """In- and out-edges over n - 1."""
    n = nodes_of(e)
    ends = e.select(F.col("src").alias("node")).unionAll(e.select(F.col("dst").alias("node"))).groupBy("node").agg(F.count("*").alias("d"))
    size = n.agg(F.count("*").alias("n"))
    return ends.join(F.broadcast(size)).select("node", F.when(F.col("n") > 1, F.col("d") / (F.col("n") - 1)).otherwise(F.lit(1.0)).alias("degree_centrality"))  # one row


def hits(e: DataFrame, rounds: int = 20) -> DataFrame:
    """(node, hub, authority), each summing to 1, after a fixed number of rounds."""
    e = written(e.select("src", "dst", F.col("volume").cast("double").alias("w")), "edges")
    nodes = written(nodes_of(e), "nodes")
    hub = nodes.select("node", F.lit(1.0).alias("hub"))
    auth = None
    for _ in range(rounds):
        auth = e.join(hub, e.src == hub.node).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("w") * F.col("hub")).alias("authority"))
        raw = written(e.join(auth, e.dst == auth.node).groupBy(F.col("src").alias("node")).agg(F.sum(F.col("w") * F.col("authority")).alias("hub")), "hubs")
        total = raw.agg(F.sum("hub")).first()[0]
        hub = raw.select("node", (F.col("hub") / F.lit(total or 1.0)).alias("hub"))
    auth = written(e.join(hub, e.src == hub.node).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("w") * F.col("hub")).alias("authority")), "authorities")
    total = auth.agg(F.sum("authority")).first()[0]
    auth = auth.select("node", (F.col("authority") / F.lit(total or 1.0)).alias("authority"))
    return nodes.join(hub, "node", "left").join(auth, "node", "left").select("node", F.coalesce("hub", F.lit(0.0)).alias("hub"), F.coalesce("authority", F.lit(0.0)).alias("authority"))


def pagerank(e: DataFrame, rounds: int = 20, damping: float = 0.85) -> DataFrame:
    """(node, rank) over row-normalised weights; what nodes without out-edges hold is dealt to all."""
    e = e.select("src", "dst", F.col("volume").cast("double").alias("w"))
    out = e.groupBy("src").agg(F.sum("w").alias("o"))
    e = written(e.join(out, "src").select("src", "dst", (F.col("w") / F.col("o")).alias("p")), "edges")
    nodes = written(nodes_of(e).join(out.select(F.col("src").alias("node"), F.lit(1).alias("sends")), "node", "left"), "nodes")
    n = nodes.count()
    rank = nodes.select("node", F.lit(1.0 / max(n, 1)).alias("rank"), "sends")
    for _ in range(rounds):
        loose = rank.where("sends IS NULL").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
        got = e.join(rank, e.src == rank.node).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("p") * F.col("rank")).alias("got"))
        rank = written(nodes.join(got, "node", "left").select("node", (F.lit((1 - damping) / n + damping * loose / n) + damping * F.coalesce("got", F.lit(0.0))).alias("rank"), "sends"), "ranks")
    return rank.select("node", "rank")


def oriented(e: DataFrame) -> DataFrame:
    """Undirected pairs (a, b) from the end with fewer neighbours to the one with more (ties by name): out-degrees stay under the root of twice the edges."""
    both = written(both_ways(e), "pairs")
    deg = both.groupBy("a").agg(F.count("*").alias("d"))
    d = both.where("a < b").join(deg.withColumnRenamed("d", "da"), "a").join(deg.select(F.col("a").alias("b"), F.col("d").alias("db")), "b")
    first = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    return written(d.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("b")), "oriented")


def triangles(e: DataFrame) -> DataFrame:
    """(a, b, c): each triangle once."""
    o = oriented(e)
    two = o.join(o.select("a", F.col("b").alias("c")), "a").where("b < c")
    close = undirected(e).select(F.col("a").alias("b"), F.col("b").alias("c"))
    return two.join(close, ["b", "c"]).select("a", "b", "c")


def clustering(e: DataFrame) -> DataFrame:
    """Triangles over possible triangles of a node in the undirected graph; 0 below two neighbours."""
    t = triangles(e).select(F.explode(F.array("a", "b", "c")).alias("node")).groupBy("node").agg(F.count("*").alias("t"))
    d = both_ways(e).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("d"))
    c = d.join(t, "node", "left").select("node", F.when(F.col("d") > 1, 2 * F.coalesce("t", F.lit(0)) / (F.col("d") * (F.col("d") - 1))).otherwise(F.lit(0.0)).alias("clustering"))
    return filled(nodes_of(e), c, "clustering", 0.0)


def _maximal(adjacent: dict[str, set[str]]) -> Iterator[list[str]]:
    """Maximal cliques of a small graph, branching on the vertices outside a pivot's neighbourhood."""
    todo: list[tuple[list[str], set[str], set[str]]] = [([], set(adjacent), set())]
    while todo:
        r, p, x = todo.pop()
        if not p and not x:
            yield sorted(r)
            continue
        if not p:
            continue
        pivot = max(sorted(p | x), key=lambda u: len(p & adjacent[u]))
        for v in sorted(p - adjacent[pivot]):
            todo.append(([*r, v], p & adjacent[v], x & adjacent[v]))
            p = p - {v}
            x = x | {v}


def cliques(e: DataFrame) -> DataFrame:
    """(clique_id, members, size): the maximal cliques of the undirected graph, single nodes without neighbours included.

    Each task sees one vertex with those of its neighbours that follow it in the order of ``oriented`` and the edges among
    them; a clique found there is maximal unless a vertex before it is adjacent to all members, which a join decides.
    """
    o = oriented(e)
    tri = triangles(e)
    ends = o.select(F.col("a").alias("v"), "b", F.lit(None).cast("string").alias("c"))
    # The triangle's vertex that both others follow.
    own = tri.select("a", "b", "c").select(F.col("a").alias("v"), "b", "c")

    def local(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        adjacent: dict[str, set[str]] = {b: set() for b in table["b"]}
        for b, c in zip(table["b"], table["c"]):
            if c is not None:
                adjacent[b].add(c)
                adjacent[c].add(b)
        return pd.DataFrame({"members": [sorted([key[0], *c]) for c in _maximal(adjacent)]})

    found = ends.unionAll(own).groupBy("v").applyInPandas(local, "members array<string>")
    found = written(found.select(F.md5(F.array_join("members", "\x1f")).alias("clique_id"), "members", F.size("members").alias("size")), "cliques")
    both = both_ways(e)
    near = found.select("clique_id", "size", F.explode("members").alias("a")).join(both, "a").groupBy("clique_id", "size", "b").agg(F.count("*").alias("n")).where("n = size")
    whole = found.join(near.select("clique_id").distinct(), "clique_id", "left_anti")
    lone = nodes_of(e).join(both.select(F.col("a").alias("node")).distinct(), "node", "left_anti")
    return whole.unionAll(lone.select(F.md5("node").alias("clique_id"), F.array("node").alias("members"), F.lit(1).alias("size")))


def clique_scores(e: DataFrame, weight: DataFrame | None = None) -> DataFrame:
    """(node, cliques, raw_clique_score, weighted_clique_score).

    raw: the sum of 2^(size - 1) over a node's cliques; weighted: each clique times the sum of its members' ``weight``
    (node, weight), which by the model is mails times average time, so slower members weigh more.
    """
    c = written(cliques(e), "whole-cliques")
    rows = c.select("clique_id", "size", F.explode("members").alias("node"))
    if weight is not None:
        w = rows.join(weight, "node").groupBy("clique_id").agg(F.sum("weight").alias("w"))
        rows = rows.join(w, "clique_id", "left")
    else:
        rows = rows.withColumn("w", F.lit(1.0))
    score = F.pow(F.lit(2.0), F.col("size") - 1)
    s = rows.groupBy("node").agg(F.count("*").alias("cliques"), F.sum(score).alias("raw_clique_score"), F.sum(score * F.coalesce("w", F.lit(0.0))).alias("weighted_clique_score"))
    return s


def distances(e: DataFrame) -> DataFrame:
    """(node, other, steps) along directed edges for every pair that is connected, the node itself with 0.

    A frontier goes one step a round, until it is empty.  The result has a row for each connected pair, as the score needs it.
    """
    step = written(without_loops(e).select("src", "dst").distinct(), "steps")
    seen = written(nodes_of(e).select("node", F.col("node").alias("other"), F.lit(0).alias("steps")), "reached")
    front = seen
    for k in count(1):
        nxt = front.join(step, front.other == step.src).select("node", F.col("dst").alias("other")).distinct()
        front = written(nxt.join(seen.select("node", "other"), ["node", "other"], "left_anti").select("node", "other", F.lit(k).alias("steps")), "front")
        if not front.limit(1).count():
            return seen
        seen = seen.unionAll(front)
        if k % 16 == 0:
            seen = written(seen, "reached")  # a plan of few tables, however long the paths are
    raise AssertionError


def mean_shortest_paths(e: DataFrame) -> DataFrame:
    """Mean steps to all nodes that are reached, the node itself (0) included; nodes that reach none get the largest mean."""
    m = distances(e).groupBy("node").agg(F.avg("steps").alias("m"))
    top = m.agg(F.max("m").alias("top"))
    return m.join(F.broadcast(top)).select("node", F.when(F.col("m") == 0, F.col("top")).otherwise(F.col("m")).alias("mean_shortest_paths"))  # one row


def betweenness(e: DataFrame) -> DataFrame:
    """Shares of shortest directed paths through a node, over (n - 1)(n - 2); paths are counted level by level from every node at once."""
    step = written(without_loops(e).select("src", "dst").distinct(), "steps")
    dist = written(distances(e), "distances")
    levels = [r[0] for r in dist.select("steps").distinct().orderBy("steps").collect()]  # at most the longest path
    before = dist.join(step, dist.other == step.src).select("node", F.col("other").alias("via"), F.col("dst").alias("to"), "steps")
    to = dist.select("node", F.col("other").alias("to"), F.col("steps").alias("k"))
    links = written(before.join(to, ["node", "to"]).where("k = steps + 1").select("node", "via", "to", "k"), "links")
    paths = written(dist.where("steps = 0").select("node", "other", F.lit(1.0).alias("paths")), "paths")
    for k in levels[1:]:
        new = links.where(F.col("k") == k).join(paths.withColumnRenamed("other", "via"), ["node", "via"]).groupBy("node", F.col("to").alias("other")).agg(F.sum("paths").alias("paths"))
        paths = written(paths.unionAll(new), "paths")
    credit = None
    for k in reversed(levels[1:]):
        own = links.where(F.col("k") == k).join(paths.select("node", F.col("other").alias("to"), F.col("paths").alias("p_to")), ["node", "to"]).join(paths.select("node", F.col("other").alias("via"), F.col("paths").alias("p_via")), ["node", "via"])
        if credit is not None:
            own = own.join(credit.select("node", F.col("other").alias("to"), "c"), ["node", "to"], "left")
        else:
            own = own.withColumn("c", F.lit(0.0))
        new = own.groupBy("node", F.col("via").alias("other")).agg(F.sum(F.col("p_via") / F.col("p_to") * (1 + F.coalesce("c", F.lit(0.0)))).alias("c"))
        credit = written(new if credit is None else credit.unionAll(new), "credit")
    n = nodes_of(e).count()
    if credit is None:
        return nodes_of(e).select("node", F.lit(0.0).alias("betweenness"))
    total = credit.where("node <> other").groupBy(F.col("other").alias("node")).agg((F.sum("c") / max(1, (n - 1) * (n - 2))).alias("betweenness"))
    return filled(nodes_of(e), total, "betweenness", 0.0)


def normalised(df: DataFrame, metrics: list[str], inverted: tuple[str, ...] = ("average_time", "mean_shortest_paths")) -> DataFrame:
    """Every metric scaled to 0..100 over all rows (inverted ones from 100 down); a metric with one value everywhere is 0."""
    ends = df.agg(*[F.min(m).alias(f"lo_{m}") for m in metrics], *[F.max(m).alias(f"hi_{m}") for m in metrics])
    out = df.join(F.broadcast(ends))  # one row
    for m in metrics:
        x = (F.col(m) - F.col(f"lo_{m}")) / (F.col(f"hi_{m}") - F.col(f"lo_{m}")) * 100
        x = 100 - x if m in inverted else x
        out = out.withColumn(m, F.when(F.col(f"hi_{m}") == F.col(f"lo_{m}"), F.lit(0.0)).otherwise(x))
    return out.drop(*ends.columns)


def hierarchy(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Adds ``hierarchy``: the weighted sum of the metrics over their number, rounded half to even."""
    total = sum((F.col(m) * w for m, w in weights.items()), F.lit(0.0))
    return df.withColumn("hierarchy", F.bround(total / len(weights)).cast("long"))


def labels_propagated(e: DataFrame, rounds: int = 20) -> DataFrame:
    """(node, community) by label propagation: each round every node takes the most frequent label around it and its own (ties: the smallest).

    May go back and forth without end, hence ``rounds``.
    """
    both = written(both_ways(e), "pairs")
    label = written(nodes_of(e).select("node", F.col("node").alias("label")), "labels")
    for _ in range(rounds):
        seen = both.join(label, both.b == label.node).select(F.col("a").alias("node"), "label").unionAll(label.select("node", "label"))
        n = seen.groupBy("node", "label").agg(F.count("*").alias("n"))
        new = written(n.groupBy("node").agg(F.min_by("label", F.struct(-F.col("n"), "label")).alias("label")), "labels")
        changed = new.join(label.withColumnRenamed("label", "old"), "node").where("label <> old").limit(1).count()
        label = new
        if not changed:
            break
    return label.select("node", F.col("label").alias("community"))


def communities(e: DataFrame) -> DataFrame:
    """(node, community): greedy agglomeration by modularity, from single nodes until no merge raises it.

    Merging a and b raises modularity by w(a, b) / m - d(a) d(b) / 2m^2 (m edges, w of them between a and b, d sums of
    degrees).  Each round every community names the neighbour with the greatest gain (ties: the smaller pair of names),
    and all pairs that name each other merge at once, the greatest gain of all among them; so a round merges many
    pairs where one by one would take as many rounds as nodes.  A community is called by its smallest node.
    """
    pairs = written(both_ways(e), "pairs")
    m = pairs.count() / 2
    label = written(nodes_of(e).select("node", F.col("node").alias("label")), "labels")
    between = written(pairs.select("a", "b", F.lit(1).cast("long").alias("w")), "between")
    degree = written(pairs.groupBy("a").agg(F.count("*").alias("d")), "degrees")
    while m:
        own, other = degree.select("a", F.col("d").alias("da")), degree.select(F.col("a").alias("b"), F.col("d").alias("db"))
        gain = F.col("w") / m - F.col("da") * F.col("db") / (2 * m * m)
        best = between.join(own, "a").join(other, "b").withColumn("gain", gain).where("gain > 1e-12")
        best = best.groupBy("a").agg(F.min_by("b", F.struct(-F.col("gain"), F.least("a", "b"), F.greatest("a", "b"))).alias("b"))
        best = written(best, "best")
        merged = best.join(best.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_semi").where("a < b")
        merged = written(merged.select(F.col("b").alias("old"), F.col("a").alias("new")), "merged")
        if not merged.limit(1).count():
            break

        def renamed(df: DataFrame, column: str, merged: DataFrame = merged) -> DataFrame:
            return df.join(merged, df[column] == merged.old, "left").withColumn(column, F.coalesce("new", column)).drop("old", "new")

        label = written(renamed(label, "label"), "labels")
        between = written(renamed(renamed(between, "a"), "b").where("a <> b").groupBy("a", "b").agg(F.sum("w").alias("w")), "between")
        degree = written(renamed(degree, "a").groupBy("a").agg(F.sum("d").alias("d")), "degrees")
    return label.select("node", F.col("label").alias("community"))


def modularity(e: DataFrame, parts: DataFrame) -> float:
    """Modularity of a division (node, community) of the undirected graph; 0 without edges."""
    pairs = both_ways(e).join(parts.select(F.col("node").alias("a"), F.col("community").alias("ca")), "a").join(parts.select(F.col("node").alias("b"), F.col("community").alias("cb")), "b")
    per = pairs.groupBy("ca").agg(F.count("*").alias("d"), F.sum((F.col("ca") == F.col("cb")).cast("long")).alias("inside"))
    r = per.agg(F.sum("d").alias("m2"), F.sum("inside").alias("i"), F.sum(F.col("d").cast("double") * F.col("d")).alias("dd")).first()
    return r["i"] / r["m2"] - r["dd"] / r["m2"] ** 2 if r["m2"] else 0.0


def closeness(e: DataFrame) -> DataFrame:
    """(node, closeness, farness, eccentricity) over the nodes that a node reaches along directed edges.

    closeness: (r - 1) / sum of steps, times (r - 1) / (n - 1), for r reached nodes of n; farness: mean steps to the
    others; eccentricity: most steps.  A node that reaches none has 0 in all.
    """
    n = nodes_of(e).count()
    d = distances(e).where("node <> other").groupBy("node").agg(F.count("*").alias("r"), F.sum("steps").alias("s"), F.max("steps").alias("eccentricity"))
    d = d.select("node", (F.col("r") / F.col("s") * F.col("r") / max(1, n - 1)).alias("closeness"), (F.col("s") / F.col("r")).alias("farness"), "eccentricity")
    return nodes_of(e).join(d, "node", "left").select("node", *[F.coalesce(c, F.lit(0.0) if c != "eccentricity" else F.lit(0)).alias(c) for c in ("closeness", "farness", "eccentricity")])


def eigenvector_centrality(e: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, eigenvector): the undirected graph's leading eigenvector, of length 1, by ``rounds`` power iterations with a shift by one."""
    pairs = written(both_ways(e), "pairs")
    x = written(nodes_of(e).select("node", F.lit(1.0).alias("x")), "vector")
    for _ in range(rounds):
        got = pairs.join(x, pairs.b == x.node).groupBy(F.col("a").alias("node")).agg(F.sum("x").alias("got"))
        raw = written(x.join(got, "node", "left").select("node", (F.col("x") + F.coalesce("got", F.lit(0.0))).alias("x")), "vector")
        length = raw.agg(F.sum(F.col("x") * F.col("x"))).first()[0]
        x = raw.select("node", (F.col("x") / F.lit((length or 1.0) ** 0.5)).alias("x"))
    return x.select("node", F.col("x").alias("eigenvector"))


def roles(metrics: DataFrame, columns: list[str], k: int = 4, seed: int = 1) -> DataFrame:
    """(node, role): k-means over scaled structural metrics."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    metrics = written(metrics, "metrics")
    steps = [VectorAssembler(inputCols=columns, outputCol="v"), StandardScaler(inputCol="v", outputCol="x", withMean=True), KMeans(k=k, seed=seed, featuresCol="x", predictionCol="role")]
    return Pipeline(stages=steps).fit(metrics).transform(metrics).select("node", "role")


def with_network_scores(persons: DataFrame, name: str, *scores: DataFrame) -> DataFrame:
    """Persons with every score table (node, ...) joined by their name; those without scores keep nulls."""
    for s in scores:
        persons = persons.join(s.withColumnRenamed("node", name), name, "left")
    return persons
