"""Operator 3: approximate nearest neighbours over balanced posting lists.

Inner product becomes distance by one more coordinate (all vectors padded to the largest
norm).  Centroids come from a bounded sample, split in two again and again at the median,
so lists are balanced.  Every vector is posted to its nearest list and, near a border, to
further ones whose distance is within ``CLOSURE`` of the nearest.  Centroids are searched
through a neighbour graph in memory.  A query takes the lists whose distance is within a
ratio of the nearest one's; the ratio is the smallest that reaches ``TARGET`` of the true
neighbours of some sampled queries inside the sample, where neighbours are sparser, and so
farther, than among all vectors.  Lists and queries meet at a shuffle, where the original
vectors are compared in double precision.  The nearest ``FIRST_LISTS`` lists come first:
the last score they give a query is a bound below which no other list needs to answer.

Equal vectors are folded into one with their smallest ids, and long lists are cut into
pieces, so no list that one vector dominates grows in a single task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelforge.llm.common import read, written

TOP = 20
# The sample that centroids are fitted on; the least mean length of a list; rows of a list in
# one task.  There are at most as many lists as the root of the number of vectors.
SAMPLE, LIST_VECTORS, PIECE_ROWS = 20_000, 250, 20_000
CLOSURE, REPLICAS, TARGET, TRIALS, FIRST_LISTS = 1.3, 4, 0.97, 300, 2
GRAPH_DEGREE, SEED = 16, 11


def usable(vectors: DataFrame) -> DataFrame:
    """One row (vec_id, embedding) per vec_id that takes part: no null id, and a vector of
    the commonest length without null or non-finite components that isn't zero.  Of
    several vectors under one id the smallest counts."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          e.alias("embedding")) \
        .where(F.col("vec_id").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda x: x != 0))
    size = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (size["n"] if size else 0)) \
        .groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def balanced_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Means of ``lists`` parts, got by halving the largest part at the median between two
    centres until there are enough."""
    rng = np.random.default_rng(SEED)
    parts = [np.arange(len(sample))]
    while len(parts) < lists:
        parts.sort(key=len)
        own = parts.pop()
        if len(own) < 2:
            parts.append(own)
            break
        x = sample[own]
        centres = x[rng.choice(len(own), 2, replace=False)]
        for _ in range(8):
            side = ((x - centres[0]) ** 2).sum(axis=1) - ((x - centres[1]) ** 2).sum(axis=1)
            order = np.argsort(side, kind="stable")
            half = len(own) // 2
            centres = np.stack([x[order[:half]].mean(axis=0), x[order[half:]].mean(axis=0)])
        parts += [own[order[:half]], own[order[half:]]]
    return np.stack([sample[p].mean(axis=0) for p in parts])


def neighbour_graph(centroids: np.ndarray, degree: int = GRAPH_DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours of each centroid, places where a search starts)."""
    n = len(centroids)
    degree = min(degree, n - 1)
    near = np.empty((n, degree), np.int64)
    norms = (centroids ** 2).sum(axis=1)
    for a in range(0, n, 1024):
        d = norms[None, :] - 2 * centroids[a:a + 1024] @ centroids.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        near[a:a + 1024] = np.argpartition(d, degree - 1, axis=1)[:, :degree] if degree else near[a:a + 1024]
    starts = np.random.default_rng(SEED).choice(n, max(1, int(np.sqrt(n))), replace=False)
    return near, starts


def search_graph(x: np.ndarray, centroids: np.ndarray, graph: np.ndarray, starts: np.ndarray,
                 beam: int, steps: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search for all rows of ``x`` at once: (centroids, squared distances), nearest
    first; -1 and infinity fill up.  Each step opens the nearest unopened centroid."""
    n, width = len(x), min(beam, len(centroids))
    norms = (centroids ** 2).sum(axis=1)
    own = (x ** 2).sum(axis=1)
    seen = np.zeros((n, len(centroids)), bool)
    ids = np.full((n, width), -1)
    dist = np.full((n, width), np.inf)
    opened = np.zeros((n, width), bool)

    def put(new: np.ndarray, d: np.ndarray):
        nonlocal ids, dist, opened
        all_ids = np.concatenate([ids, new], axis=1)
        all_d = np.concatenate([dist, d], axis=1)
        all_open = np.concatenate([opened, np.zeros(new.shape, bool)], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        ids, dist, opened = (np.take_along_axis(v, order, 1) for v in (all_ids, all_d, all_open))

    first = np.broadcast_to(starts, (n, len(starts)))
    seen[:, starts] = True
    put(first, own[:, None] + norms[starts][None, :] - 2 * x @ centroids[starts].T)
    rows = np.arange(n)
    for _ in range(steps or width):
        nearest = np.argmin(np.where(opened | (ids < 0), np.inf, dist), axis=1)
        free = ~opened[rows, nearest] & (ids[rows, nearest] >= 0)
        if not free.any() or not graph.shape[1]:
            break
        opened[rows, nearest] = True
        new = graph[np.maximum(ids[rows, nearest], 0)]
        fresh = ~np.take_along_axis(seen, new, 1) & free[:, None]
        np.put_along_axis(seen, new, True, 1)
        d = own[:, None] + norms[new] - 2 * np.einsum("ij,ikj->ik", x, centroids[new])
        put(np.where(fresh, new, -1), np.where(fresh, d, np.inf))
    return ids, np.maximum(dist, 0)


def _padded(x: np.ndarray, largest: float, query: bool) -> np.ndarray:
    norms = np.sqrt((x ** 2).sum(axis=1))
    if query:
        return np.column_stack([x * (largest / norms)[:, None], np.zeros(len(x))])
    return np.column_stack([x, np.sqrt(np.maximum(largest ** 2 - norms ** 2, 0))])


def _matrix(column) -> np.ndarray:
    flat = pa.chunked_array([column]) if isinstance(column, pa.Array) else column
    flat = flat.combine_chunks()
    if not len(flat):
        return np.zeros((0, 0))
    return flat.flatten().to_numpy().astype(np.float64).reshape(len(flat), -1)


def fit(distinct: DataFrame, n: int) -> dict:
    """Centroids and their graph, from at most ``SAMPLE`` vectors (smallest hashes)."""
    rows = distinct.orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE).select("embedding").toArrow()
    x = _matrix(rows.column("embedding"))
    largest = distinct.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))).alias("n")) \
        .first()["n"] ** 0.5
    lists = max(1, min(int(n ** 0.5), n // LIST_VECTORS, len(x) // 8))
    padded = _padded(x, largest, False)
    centroids = balanced_centroids(padded, lists)
    graph, starts = neighbour_graph(centroids)
    model = {"centroids": centroids, "graph": graph, "starts": starts, "largest": largest}
    return model | _probe_ratio(x, padded, model)


def _lists_of(padded: np.ndarray, m: dict) -> tuple[np.ndarray, np.ndarray]:
    """(lists, which of them each vector is posted to)."""
    ids, d = search_graph(padded, m["centroids"], m["graph"], m["starts"], 3 * REPLICAS)
    ids, d = ids[:, :REPLICAS], d[:, :REPLICAS]
    chosen = (ids >= 0) & (d <= CLOSURE ** 2 * d[:, :1])
    chosen[:, 0] = True
    return ids, chosen


def _probe_ratio(x: np.ndarray, padded: np.ndarray, m: dict) -> dict:
    """The squared distance ratio up to which lists are probed, and the width of the search."""
    centroids, some = m["centroids"], min(TRIALS, len(x))
    top = min(TOP, len(x) - 1)
    if top < 1 or len(centroids) == 1:
        return {"ratio": 1.0, "beam": 8}
    score = x[:some] @ x.T
    score[np.arange(some), np.arange(some)] = -np.inf
    near = np.argpartition(-score, top - 1, axis=1)[:, :top]
    q = _padded(x[:some], m["largest"], True)
    d = np.maximum((q ** 2).sum(axis=1)[:, None] + (centroids ** 2).sum(axis=1) - 2 * q @ centroids.T, 0)
    members, place = np.unique(near, return_inverse=True)
    ids, chosen = _lists_of(padded[members], m)
    place = place.reshape(near.shape)
    reach = np.where(chosen[place], d[np.arange(some)[:, None, None], ids[place]], np.inf).min(axis=2)
    low = d.min(axis=1)
    ratio = float(np.quantile(reach / np.maximum(low, 1e-12)[:, None], TARGET))
    wide = int((d <= ratio * low[:, None]).sum(axis=1).max())
    return {"ratio": ratio, "beam": min(len(centroids), max(16, wide + wide // 4))}


def _posting(model):
    def post(it):
        for batch in it:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                ids, chosen = _lists_of(_padded(_matrix(part.column("embedding")), model.value["largest"], False),
                                        model.value)
                row, col = np.nonzero(chosen)
                out = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row, col].astype(np.int32)), out.column("vid"), out.column("embedding")],
                    names=["list", "vid", "embedding"])
    return post


def _probing(model):
    def probe(it):
        m = model.value
        for batch in it:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                x = _padded(_matrix(part.column("embedding")), m["largest"], True)
                ids, d = search_graph(x, m["centroids"], m["graph"], m["starts"], m["beam"])
                near = (ids >= 0) & (d <= m["ratio"] * d[:, :1] + 1e-9)
                lists = pa.array([i[n].tolist() for i, n in zip(ids, near)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("vid"), part.column("embedding"), lists],
                                                 names=["qvid", "query", "lists"])
    return probe


def _compare(top: int):
    """The best ``top`` vectors of one piece of a list for each query that probes it, as far as
    their score reaches the query's ``least``."""
    def compare(left, right):
        out = {"qvid": [], "vid": [], "score": []}
        if left.num_rows and right.num_rows:
            x, ids = _matrix(left.column("embedding")), left.column("vid").to_numpy()
            qids, least = right.column("qvid").to_numpy(), right.column("least").to_numpy()
            q = _matrix(right.column("query"))
            for a in range(0, len(q), 256):
                rough = q[a:a + 256] @ x.T
                # rounding differs between the products, so the border is taken with a margin
                slack = 1e-9 * (1 + np.abs(least[a:a + 256]))
                for k, reach in enumerate(rough >= (least[a:a + 256] - slack)[:, None]):
                    own = np.flatnonzero(reach)
                    if len(own) > top + 8:
                        border = np.partition(rough[k][own], len(own) - top - 8)[len(own) - top - 8]
                        own = own[rough[k][own] >= border]
                    score = (x[own] * q[a + k]).sum(axis=1)
                    order = np.lexsort((ids[own], -score))[:top]
                    out["qvid"].append(np.full(len(order), qids[a + k]))
                    out["vid"].append(ids[own][order])
                    out["score"].append(score[order])
        kinds = {"qvid": np.int64, "vid": np.int64, "score": np.float64}
        return pa.table({n: np.concatenate([np.zeros(0, kinds[n]), *v]) for n, v in out.items()})
    return compare


def nearest(vectors: DataFrame, is_query, top: int = TOP) -> DataFrame:
    """The ``top`` nearest rows found for every row of ``vectors(vec_id, embedding)`` that
    satisfies ``is_query`` (a condition on vec_id): query_id, rank, vec_id, score.

    Nearness is the largest inner product; ties go to the smaller vec_id; a row is not its
    own neighbour.  See ``usable`` for the rows that take part.  All of them are indexed,
    and all queries searched; no usable vector: an empty result."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = written(usable(vectors), "vectors")
    by_vector = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.withColumn("_r", F.row_number().over(by_vector)).where(F.col("_r") <= top + 1)
    distinct = written(few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                       .select(F.col("ids")[0].alias("vid"), "embedding", "ids"), "distinct")
    n = distinct.count()
    if not n:
        return spark.createDataFrame([], schema)
    model = spark.sparkContext.broadcast(fit(distinct, n))
    kind = distinct.schema["embedding"].dataType.simpleString()
    postings = written(distinct.select("vid", "embedding")
                       .mapInArrow(_posting(model), f"list int, vid long, embedding {kind}"), "postings")
    # the vectors that queries stand for
    repeated = distinct.where(F.size("ids") > 1).select("vid", "embedding")
    salts = 8
    repeated = repeated.select("vid", F.col("embedding").alias("_e"),
                               F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s"))
    asked = rows.where(is_query).withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int"))
    asked = written(asked.join(repeated, (asked["embedding"] == repeated["_e"]) & (asked["_salt"] == repeated["_s"]),
                               "left").select(F.col("vec_id").alias("query_id"),
                                              F.coalesce("vid", "vec_id").alias("qvid")), "asked")
    questions = distinct.join(asked.select(F.col("qvid").alias("vid")).distinct(), "vid", "left_semi")
    probes = written(questions.select("vid", "embedding").mapInArrow(
        _probing(model), f"qvid long, query {kind}, lists array<int>"), "probes")
    pieces = F.broadcast(postings.groupBy("list").agg(  # one row per centroid
        F.ceil(F.count(F.lit(1)) / PIECE_ROWS).cast("int").alias("pieces")))
    cut = postings.join(pieces, "list").withColumn("piece", F.pmod(F.xxhash64("vid"), "pieces").cast("int")) \
        .drop("pieces")

    def answers(asking: DataFrame) -> DataFrame:
        sent = asking.select("qvid", "query", "least", F.explode("lists").alias("list")).join(pieces, "list") \
            .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
        return cut.groupBy("list", "piece").cogroup(sent.groupBy("list", "piece")) \
            .applyInArrow(_compare(top + 1), "qvid long, vid long, score double")

    first = written(answers(probes.withColumn("least", F.lit(float("-inf")))
                            .withColumn("lists", F.slice("lists", 1, FIRST_LISTS))), "answers")
    ranked = Window.partitionBy("qvid").orderBy(F.desc("score"))
    least = first.groupBy("qvid", "vid").agg(F.max("score").alias("score")) \
        .withColumn("_r", F.row_number().over(ranked)).where(F.col("_r") == top + 1) \
        .select("qvid", F.col("score").alias("least"))
    others = probes.join(least, "qvid", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf")))) \
        .withColumn("lists", F.slice("lists", FIRST_LISTS + 1, 1 << 30))
    found = first.union(answers(others))
    order = Window.partitionBy("qvid").orderBy(F.desc("score"), "vid")
    best = found.groupBy("qvid", "vid").agg(F.max("score").alias("score")) \
        .withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top + 1)
    # every folded vector again with its ids; a query needs one neighbour more than asked for
    members = best.join(distinct.select("vid", "ids"), "vid") \
        .select("qvid", F.explode(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("i"))))
                .alias("c")).groupBy("qvid").agg(F.array_sort(F.collect_list("c")).alias("c")) \
        .select("qvid", F.slice("c", 1, top + 1).alias("c"))
    own = F.slice(F.filter("c", lambda x: x["i"] != F.col("query_id")), 1, top)
    return asked.join(members, "qvid").select("query_id", F.posexplode(own).alias("p", "x")) \
        .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"),
                (-F.col("x.s")).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: the 20 nearest rows of every row whose vec_id is divisible by 20."""
    return nearest(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)
