"""The network of terms that meet in titles: nodes, edges, communities; clusters of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def network(pairs: DataFrame, stopwords: list[str], threshold: int = 5, nodes: int = 50, edges: int = 500) -> DataFrame:
    """(termino_a, termino_b, peso): the edges among the ``nodes`` terms that stand in most rows of ``pairs``, with at
    least ``threshold`` meetings; at most ``edges`` of them, heaviest first, ties by terms."""
    own = pairs.where(~F.col("termino_a").isin(stopwords) & ~F.col("termino_b").isin(stopwords))
    ends = own.select(F.explode(F.array("termino_a", "termino_b")).alias("t")).groupBy("t").agg(F.count("*").alias("f"))
    best = F.broadcast(ends.orderBy(F.desc("f"), "t").limit(nodes).select("t"))  # at most `nodes` rows
    edge = own.join(best.withColumnRenamed("t", "termino_a"), "termino_a", "left_semi").join(best.withColumnRenamed("t", "termino_b"), "termino_b", "left_semi")
    edge = edge.groupBy("termino_a", "termino_b").agg(F.sum("n").alias("peso")).where(F.col("peso") >= threshold)
    return edge.orderBy(F.desc("peso"), "termino_a", "termino_b").limit(edges)


def louvain(edges: list[tuple[str, str]]) -> dict[str, int]:
    """Communities of an undirected graph by modularity, unweighted, numbered from 1 by their first node.

    For the bounded graph of ``network``.  Nodes are visited in order, so the result is the same each time.
    """
    names = sorted({x for e in edges for x in e})
    member = {v: v for v in names}
    weights: dict[tuple[str, str], float] = {}
    for a, b in edges:
        key = (a, b) if a <= b else (b, a)
        weights[key] = weights.get(key, 0) + 1
    level_nodes, level = names, weights
    while True:
        near: dict[str, dict[str, float]] = {v: {} for v in level_nodes}
        degree = dict.fromkeys(level_nodes, 0.0)
        for (a, b), w in level.items():
            degree[a] += w
            degree[b] += w
            if a != b:
                near[a][b] = near[a].get(b, 0) + w
                near[b][a] = near[b].get(a, 0) + w
        total = sum(degree.values()) or 1.0
        group = {v: v for v in level_nodes}
        mass = dict(degree)
        moved_any, moved = False, True
        while moved:
            moved = False
            for v in level_nodes:
                to: dict[str, float] = {}
                for u, w in near[v].items():
                    to[group[u]] = to.get(group[u], 0) + w
                old = group[v]
                mass[old] -= degree[v]
                gain = lambda c: to.get(c, 0) - mass[c] * degree[v] / total  # noqa: B023, E731
                best = max([old, *sorted(to)], key=lambda c: (round(gain(c), 12), c == old))
                mass[best] += degree[v]
                if best != old:
                    group[v], moved, moved_any = best, True, True
        member = {v: group[c] for v, c in member.items()}
        if not moved_any:
            break
        merged: dict[tuple[str, str], float] = {}
        for (a, b), w in level.items():
            x, y = sorted((group[a], group[b]))
            merged[x, y] = merged.get((x, y), 0) + w
        level_nodes, level = sorted(set(group.values())), merged
    number: dict[str, int] = {}
    return {v: number.setdefault(member[v], len(number) + 1) for v in names}


def modularity_of(edges: list[tuple[str, str]], member: dict[str, int]) -> float:
    """The modularity of a bounded graph."""
    mass: dict[int, int] = {}
    for e in edges:
        for v in e:
            mass[member[v]] = mass.get(member[v], 0) + 1
    m = len(edges)
    return sum(member[a] == member[b] for a, b in edges) / m - sum(x * x for x in mass.values()) / (4 * m * m) if m else 0.0


def communities(edges: DataFrame) -> DataFrame:
    """(termino, comunidad, grado) of the nodes of a ``network`` (at most its ``edges``, which one task holds)."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        pairs = sorted(zip(f["termino_a"], f["termino_b"], strict=True))
        member = louvain(pairs)
        degree = pd.Series([x for p in pairs for x in p]).value_counts()
        return pd.DataFrame([(v, c, int(degree[v])) for v, c in member.items()], columns=["termino", "comunidad", "grado"])

    return edges.groupBy().applyInPandas(run, "termino string, comunidad int, grado int")


def modularity(edges: DataFrame, members: DataFrame) -> DataFrame:
    """(nodos, aristas, comunidades, modularidad) of communities (termino, comunidad) of an unweighted graph."""
    degree = edges.select(F.explode(F.array("termino_a", "termino_b")).alias("termino")).groupBy("termino").agg(F.count("*").alias("g"))
    own = members.select("termino", "comunidad")
    by = own.join(degree, "termino").groupBy("comunidad").agg(F.sum("g").alias("g"))
    ends = edges.join(own.withColumnsRenamed({"termino": "termino_a", "comunidad": "ca"}), "termino_a").join(own.withColumnsRenamed({"termino": "termino_b", "comunidad": "cb"}), "termino_b")
    inside = ends.agg(F.count("*").alias("aristas"), F.sum(F.when(F.col("ca") == F.col("cb"), 1).otherwise(0)).alias("dentro"))
    total = by.agg(F.count("*").alias("comunidades"), F.sum(F.col("g").cast("double") * F.col("g")).alias("s"))
    rest = inside.crossJoin(F.broadcast(total)).crossJoin(F.broadcast(own.agg(F.countDistinct("termino").alias("nodos"))))  # one row each
    q = F.col("dentro") / F.col("aristas") - F.col("s") / (4.0 * F.col("aristas") * F.col("aristas"))
    return rest.select("nodos", "aristas", "comunidades", F.round(q, 6).alias("modularidad"))


def complete_linkage(distance: np.ndarray, height: float) -> list[int]:
    """Clusters of complete linkage cut at ``height``: numbered from 1 by first member.  For some dozen items."""
    groups = [[i] for i in range(len(distance))]
    while len(groups) > 1:
        gap, i, j = min((max(distance[a, b] for a in groups[i] for b in groups[j]), i, j) for i in range(len(groups)) for j in range(i + 1, len(groups)))
        if gap > height:
            break
        groups[i] += groups.pop(j)
    label = {v: k for k, g in enumerate(sorted(groups, key=min), 1) for v in g}
    return [label[i] for i in range(len(distance))]


def with_profiles(top: DataFrame, pairs: DataFrame) -> DataFrame:
    """(termino, total, otros, pesos) of a top-N (termino, total): how often each term meets each of the others in
    ``pairs``, and itself ``total`` times."""
    ends = F.array(F.struct(F.col("termino_a").alias("x"), F.col("termino_b").alias("y")), F.struct(F.col("termino_b").alias("x"), F.col("termino_a").alias("y")))
    own = F.broadcast(top.select("termino"))  # the N terms
    met = pairs.join(own.withColumnRenamed("termino", "termino_a"), "termino_a", "left_semi").join(own.withColumnRenamed("termino", "termino_b"), "termino_b", "left_semi")
    met = met.groupBy("termino_a", "termino_b").agg(F.sum("n").alias("n")).withColumn("e", F.explode(ends)).select(F.col("e.x").alias("termino"), F.col("e.y").alias("otro"), "n")
    met = met.unionByName(top.select("termino", F.col("termino").alias("otro"), F.col("total").alias("n")))
    return top.join(met.groupBy("termino").agg(F.collect_list("otro").alias("otros"), F.collect_list("n").alias("pesos")), "termino")


def profile_similarity(edges: DataFrame) -> DataFrame:
    """(termino_a, termino_b, similitud), a < b: the cosine of the weights with which two nodes of a ``network`` meet the
    others.  Bounded by the network's edges."""
    ends = F.array(F.struct(F.col("termino_a").alias("x"), F.col("termino_b").alias("y")), F.struct(F.col("termino_b").alias("x"), F.col("termino_a").alias("y")))
    rows = edges.withColumn("e", F.explode(ends)).select(F.col("e.x").alias("t"), F.col("e.y").alias("otro"), F.col("peso").cast("double").alias("w"))
    norm = rows.groupBy("t").agg(F.sum(F.col("w") * F.col("w")).alias("s"))
    a, b = rows.select(F.col("t").alias("termino_a"), "otro", F.col("w").alias("wa")), rows.select(F.col("t").alias("termino_b"), "otro", F.col("w").alias("wb"))
    dot = a.join(b, "otro").where("termino_a < termino_b").groupBy("termino_a", "termino_b").agg(F.sum(F.col("wa") * F.col("wb")).alias("d"))
    dot = dot.join(norm.select(F.col("t").alias("termino_a"), F.col("s").alias("sa")), "termino_a").join(norm.select(F.col("t").alias("termino_b"), F.col("s").alias("sb")), "termino_b")
    return dot.select("termino_a", "termino_b", F.round(F.col("d") / F.sqrt(F.col("sa") * F.col("sb")), 6).alias("similitud"))


def semantic_edges(similar_terms: DataFrame, edges: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Pairs of similar terms (termino_a < termino_b) that have no edge yet."""
    there = edges.select(F.least("termino_a", "termino_b").alias("termino_a"), F.greatest("termino_a", "termino_b").alias("termino_b")).distinct()
    return similar_terms.where(F.col("similitud") >= threshold).join(there, ["termino_a", "termino_b"], "left_anti")


def clustered_top(top: DataFrame, height: float = 0.4) -> DataFrame:
    """(termino, total, terminos) from (termino, total, otros, pesos) of a top-N: terms with near profiles (numbers by
    name) merged under the most frequent."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["total", "termino"], ascending=[False, True], ignore_index=True)
        at = {x: i for i, x in enumerate(sorted({x for xs in f["otros"] for x in xs}))}
        m = np.zeros((len(f), max(1, len(at))))
        for i, (xs, ws) in enumerate(zip(f["otros"], f["pesos"], strict=True)):
            m[i, [at[x] for x in xs]] = ws
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        f["c"] = complete_linkage(1 - m @ m.T, height)
        out = [(g["termino"].iloc[0], int(g["total"].sum()), ", ".join(g["termino"])) for _, g in f.groupby("c")]
        return pd.DataFrame(sorted(out, key=lambda r: (r[1], r[0])), columns=["termino", "total", "terminos"])

    return top.groupBy().applyInPandas(run, "termino string, total bigint, terminos string")


def similar(queries: DataFrame, rows: DataFrame, threshold: float, block: int = 4096) -> DataFrame:
    """(a, b, similitud): each stated query (vec_id, embedding) with each other row of cosine similarity at least
    ``threshold``.  Queries are broadcast in blocks of ``block``; the rows are scanned once, and each Arrow batch meets one
    block after another.  Zero vectors match nothing."""
    spark = rows.sparkSession
    blocks = max(1, -(-queries.count() // block))
    held = []
    for i in range(blocks):
        own = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i)
        found = own.where("vec_id is not null and embedding is not null").select("vec_id", "embedding").collect()
        if found:
            held.append(spark.sparkContext.broadcast((np.array([r.vec_id for r in found], np.int64), _unit([r.embedding for r in found]))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.dropna()
            if not len(f):
                continue
            own, v = f["vec_id"].to_numpy(np.int64), _unit(f["embedding"].tolist()).T
            for shared in held:
                ids, q = shared.value
                s = q @ v
                x, y = np.nonzero((s >= threshold) & (ids[:, None] != own[None, :]))
                if len(x):
                    yield pd.DataFrame({"a": ids[x], "b": own[y], "similitud": s[x, y]})
                if len(held) > 1:
                    shared.__dict__.pop("_value", None)  # one block at a time; it is read again from the worker's disk

    return rows.select("vec_id", "embedding").mapInPandas(run, "a bigint, b bigint, similitud double")


def _unit(vectors: list) -> np.ndarray:
    if not vectors:
        return np.zeros((0, 0))
    m = np.array([np.asarray(v, float) for v in vectors], float).reshape(len(vectors), -1)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.where(n > 0, m / np.where(n > 0, n, 1), np.nan)
