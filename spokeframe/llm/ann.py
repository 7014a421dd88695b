"""Approximate nearest neighbours by balanced posting lists.

* Vectors are scaled to length one; equal vectors (bit by bit) form a class that keeps its least ids,
  as many as any answer can hold, so a vector that stands a million times is searched once.
* Centroids come from a bounded sample, halved along the line between two far points until the parts
  are small, which makes lists of even size. Every class of the table goes to the list of its nearest
  centroid, and also to those of others about as near (``REPLICATE``): vectors on a boundary are in
  several lists.
* A query finds its nearest centroids by best-first search in a graph of centroids held in memory, and
  selects all lists whose distance is within a ratio (``PRUNE``) of the nearest one's. Where those the
  search kept end within the ratio, all centroids are measured, so the ratio alone decides.
* The ``FIRST`` nearest lists are read first. The worst of a query's nearest so far then bounds what
  the others can add: a selected list is read only if a vector could lie as near, its radius (the
  distance of its farthest member from the centroid) taken into account, and it gives only vectors
  that do. So what a query gathers does not grow with the number of its lists.
* Queries and lists meet by a join on the list. A list too large for a task is cut into blocks, all of
  which the queries visit. The candidates' cosines are computed in double precision from the vectors
  as given.

The number of lists follows the number of classes up to ``MAX_LISTS``, so centroids and graph are
bounded (16 MB at 256 dimensions); beyond that the lists are longer and are cut into more blocks.

Defined results: a vector that is null, zero, or has a null or non-finite component, or whose length
is not that of most vectors, takes no part. Rows equal in id and vector count once; an id with
several vectors is answered for each of them. Ties go to the smaller id. Without vectors that take
part, as in an empty table, there are no answers. Other columns of the table are not read.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from spokeframe.llm.columns import only
from spokeframe.session import through_table

NEAREST = 5

# Classes per list aimed at, the most lists there can be, and sampled classes per list.
PER_LIST, MAX_LISTS, SAMPLE_PER_LIST = 128, 1 << 14, 16

# Distance ratios: lists a vector is written to (at most REPLICAS), and lists a query reads.
REPLICATE, REPLICAS = 1.08, 4
PRUNE, FIRST = 1.3, 4

# Cosines nearer to each other than this many decimals are ties until the last ranking.
DECIMALS = 12

# Neighbours of a centroid in the graph, and candidates kept in a search.
DEGREE, BEAM = 24, 64

# Classes and queries that meet in one task at once.
BLOCK = 4096


def unit(vectors):
    """Rows scaled to length one, in single precision for distances."""
    vectors = np.asarray(vectors, dtype=np.float64)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def balanced_centroids(sample, lists, seed=0):
    """Halve the sample until there are ``lists`` parts; the parts' mean directions, duplicates out."""
    random = np.random.default_rng(seed)
    parts = [np.arange(len(sample))]
    while len(parts) < lists:
        parts.sort(key=len)
        part = parts.pop()
        if len(part) < 2:
            parts.append(part)
            break
        own = sample[part]
        one = own[random.integers(len(own))]
        one = own[(own @ one).argmin()]
        other = own[(own @ one).argmin()]
        for _ in range(4):
            order = (own @ (one - other)).argsort(kind="stable")
            low, high = order[:len(order) // 2], order[len(order) // 2:]
            one, other = own[high].mean(axis=0), own[low].mean(axis=0)
        parts += [part[low], part[high]]
    means = np.array([sample[p].mean(axis=0) for p in parts])
    return np.unique(means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12), axis=0)


def neighbour_graph(centroids, degree=DEGREE):
    """For every centroid its nearest others, those hidden behind a nearer neighbour left out."""
    graph = []
    for at in range(0, len(centroids), 512):
        near = centroids[at:at + 512] @ centroids.T
        wide = min(4 * degree + 1, len(centroids))
        for i, row in enumerate(near, at):
            order = np.argpartition(-row, wide - 1)[:wide]
            order = order[np.argsort(-row[order], kind="stable")]
            chosen = []
            for j in order[order != i]:
                if len(chosen) == degree:
                    break
                if not chosen or (centroids[chosen] @ centroids[j]).max() < row[j]:
                    chosen.append(int(j))
            # Room that is left goes to the nearest, which keeps the graph well connected.
            for j in order[order != i]:
                if len(chosen) >= degree // 2:
                    break
                if int(j) not in chosen:
                    chosen.append(int(j))
            graph.append(np.array(chosen, dtype=np.int64))
    return graph


class Lists:
    """Centroids with their graph."""

    def __init__(self, centroids):
        self.centroids = centroids.astype(np.float32)
        self.graph = neighbour_graph(self.centroids)
        self.entries = np.linspace(0, len(centroids) - 1, min(8, len(centroids))).astype(np.int64)

    def search(self, vector, beam):
        """Centroids near ``vector`` with their cosines, nearest first, by best-first search."""
        seen = set(self.entries.tolist())
        cosines = self.centroids[self.entries] @ vector
        open_ = [(-c, int(i)) for c, i in zip(cosines, self.entries)]
        heapq.heapify(open_)
        best = [(c, i) for c, i in ((-c, i) for c, i in open_)]
        heapq.heapify(best)
        while open_:
            negative, node = heapq.heappop(open_)
            if len(best) >= beam and -negative < best[0][0]:
                break
            new = [j for j in self.graph[node].tolist() if j not in seen]
            if not new:
                continue
            seen.update(new)
            for c, j in zip((self.centroids[new] @ vector).tolist(), new):
                if len(best) < beam or c > best[0][0]:
                    heapq.heappush(open_, (-c, j))
                    heapq.heappush(best, (c, j))
                    if len(best) > beam:
                        heapq.heappop(best)
        found = sorted(best, reverse=True)
        return np.array([i for _, i in found]), np.array([c for c, _ in found])

    def all(self, vector):
        """All centroids with their cosines, nearest first."""
        cosines = self.centroids @ vector
        order = np.argsort(-cosines, kind="stable")
        return order, cosines[order]

    def near(self, vector, ratio, most=None):
        """The lists within ``ratio`` of the nearest one's distance, at most ``most`` if given, and
        their distances."""
        def distances(cosines):
            return np.sqrt(np.maximum(2 - 2 * cosines, 0))

        def within(cosines):
            distance = distances(cosines)
            return int((distance <= distance[0] * ratio + 1e-6).sum())

        nodes, cosines = self.search(vector, max(most or 0, BEAM))
        wanted = within(cosines)
        if wanted == len(nodes) < len(self.centroids) and most is None:
            nodes, cosines = self.all(vector)
            wanted = within(cosines)
        n = min(wanted, most or wanted)
        return nodes[:n], distances(cosines[:n])


def _array(column):
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def usable(vectors, vec_id="vec_id", embedding="embedding"):
    """``vec_id, v``: vectors of double precision that take part."""
    plain = only(vectors, vec_id=vec_id, v=embedding).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    sound = plain.where("v IS NOT NULL AND vec_id IS NOT NULL").where(finite).where(
        F.exists("v", lambda x: x != 0))
    lengths = sound.groupBy(F.size("v").alias("length")).count().orderBy(
        F.desc("count"), "length").first()
    return sound.where(F.size("v") == (lengths["length"] if lengths else 0))


def vector_key(vector):
    """A hash of the components; zero of either sign is the same."""
    return F.xxhash64(F.transform(vector, lambda x: x + F.lit(0.0)))


def classes_of(vectors, keep):
    """``key, v, ids, least_id``: one row per distinct vector with its ``keep`` least ids.

    The rank's limit is applied in the tasks before the shuffle as well.
    """
    keyed = vectors.withColumn("key", vector_key("v"))
    ranked = keyed.withColumn("nth", F.row_number().over(
        Window.partitionBy("key").orderBy("vec_id"))).where(F.col("nth") <= keep)
    return ranked.groupBy("key").agg(
        F.min_by("v", "nth").alias("v"), F.array_sort(F.collect_set("vec_id")).alias("ids"),
        F.min("vec_id").alias("least_id"))


def fit(classes, n, per_list=PER_LIST, max_lists=MAX_LISTS):
    """Centroids of a bounded sample of the classes, made in one task."""
    lists = max(1, min(n // per_list, max_lists))
    rows = lists * SAMPLE_PER_LIST

    def run(frames):
        frames = [f for f in frames if len(f)]
        if frames:
            sample = unit(_array(pd.concat(frames).sort_values("key")["v"]))
            for centroid in balanced_centroids(sample, lists):
                yield pd.DataFrame({"c": [centroid.tolist()]})

    sample = classes.select("key", "v").orderBy(F.xxhash64("key"), "key").limit(rows)
    found = sample.coalesce(1).mapInPandas(run, "c array<double>").toPandas()
    return _array(found["c"]) if len(found) else np.zeros((0, 1))


def _assigned(shared, ratio, most=None):
    """``key, list, nth, far``: the lists of each vector, nearest first, with their distance."""
    def run(frames):
        lists = shared.value
        for frame in frames:
            if not len(frame):
                continue
            chosen = [lists.near(v, ratio, most) for v in unit(_array(frame["v"]))]
            many = np.array([len(c) for c, _ in chosen])
            yield pd.DataFrame({
                "key": np.repeat(frame["key"].to_numpy(), many),
                "list": np.concatenate([c for c, _ in chosen]),
                "nth": np.concatenate([np.arange(n) for n in many]),
                "far": np.concatenate([f for _, f in chosen]).astype(np.float64)})

    return run


_LISTED = "key bigint, list bigint, nth bigint, far double"


def _meet(keep):
    """Of a block of queries and one of classes, each query's ``keep`` nearest classes, those below
    its ``floor`` left out."""
    def run(queries, classes):
        q, x = _array(queries["v"]), _array(classes["v"])
        cosines = (q @ x.T) / np.linalg.norm(q, axis=1)[:, None] / np.linalg.norm(x, axis=1)[None, :]
        cosines = np.round(cosines, DECIMALS)
        least = classes["least_id"].to_numpy()
        by_id = np.argsort(least, kind="stable")
        best = by_id[np.argsort(-cosines[:, by_id], axis=1, kind="stable")[:, :keep]]
        score = np.take_along_axis(cosines, best, axis=1)
        row, column = np.nonzero(score >= queries["floor"].to_numpy()[:, None])
        return pd.DataFrame({
            "query": queries["key"].to_numpy()[row],
            "key": classes["key"].to_numpy()[best[row, column]],
            "near": score[row, column], "least_id": least[best[row, column]],
        })

    return run


def _nearest(met, keep):
    """Of ``query, key, near, least_id`` the ``keep`` nearest of each query, each class once."""
    once = met.groupBy("query", "key").agg(F.max("near").alias("near"),
                                           F.min("least_id").alias("least_id"))
    order = Window.partitionBy("query").orderBy(F.desc("near"), "least_id")
    return once.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep)


def search(vectors, is_query, nearest=NEAREST, prune=PRUNE, first=FIRST, per_list=PER_LIST,
           max_lists=MAX_LISTS, replicate=REPLICATE, replicas=REPLICAS, vec_id="vec_id",
           embedding="embedding"):
    """``query_id, rank, vec_id, score``: the nearest found of every row that ``is_query`` holds for.

    ``is_query`` is a condition on ``vec_id``. ``replicas`` bounds the lists that one vector is written
    to, ``prune`` the lists that are read for a query.
    """
    spark = vectors.sparkSession
    rows = through_table(usable(vectors, vec_id, embedding))
    keep = nearest + 1
    classes = through_table(classes_of(rows, keep))
    n = classes.count()
    centroids = fit(classes, n, per_list, max_lists)
    asked = rows.where(is_query).select(
        F.col("vec_id").alias("query_id"),
        vector_key("v").alias("query")).distinct()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    shared = spark.sparkContext.broadcast(Lists(centroids))
    postings = through_table(classes.select("key", "v").mapInPandas(
        _assigned(shared, replicate, replicas), _LISTED))
    queries = classes.join(asked.select(F.col("query").alias("key")).distinct(), "key", "left_semi")
    visits = through_table(queries.select("key", "v").mapInPandas(_assigned(shared, prune), _LISTED))
    radius = through_table(postings.groupBy("list").agg(
        F.max("far").alias("radius"), F.count("*").alias("members")))

    def read(visits):
        """What the lists give to the queries that visit them (``key, list, floor``)."""
        # Each side is dealt to blocks of its own and copied to all blocks of the other.
        visitors = visits.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("other"))
        cuts = through_table(radius.join(visitors, "list").select(
            "list", F.ceil(F.col("members") / BLOCK).cast("int").alias("own"), "other"))

        def dealt(table, mine, theirs, columns, more=()):
            placed = table.join(cuts, "list").join(classes.select("key", *columns), "key")
            return placed.select(
                "list", F.pmod(F.xxhash64("key"), F.col(mine)).cast("int").alias(mine + "_block"),
                F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)).alias(theirs + "_block"),
                # Columns of the side's own, as both sides come from one table.
                *(F.col(c).alias(c) for c in ["key", *columns, *more]))

        left = dealt(visits, "other", "own", ["v"], ["floor"])
        right = dealt(postings, "own", "other", ["v", "least_id"])
        by = ["list", "own_block", "other_block"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(
            _meet(keep), "query bigint, key bigint, near double, least_id bigint")

    none = F.lit(-2.0)
    at_first = through_table(_nearest(
        read(visits.where(F.col("nth") < first).withColumn("floor", none)), keep).drop("nth"))
    # Fewer than ``keep`` found leave the floor open.
    floors = at_first.groupBy("query").agg(F.min("near").alias("least"), F.count("*").alias("n"))
    floors = floors.select(F.col("query").alias("key"), F.when(
        F.col("n") >= keep, F.col("least")).otherwise(none).alias("floor"))
    reach = F.sqrt(F.greatest(F.lit(2.0) - 2 * F.col("floor"), F.lit(0.0)))
    later = visits.where(F.col("nth") >= first).join(floors, "key", "left").withColumn(
        "floor", F.coalesce("floor", none)).join(radius, "list").where(
        F.col("far") <= reach + F.col("radius") + 1e-5)
    met = _nearest(at_first.unionByName(read(through_table(later.select("key", "list", "floor")))),
                   keep).select("query", "key")
    x, y = F.col("v"), F.col("w")

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    of_query = classes.select(F.col("key").alias("query"), F.col("v").alias("w"))
    scored = met.join(classes, "key").join(of_query, "query").select(
        "query", "ids", (dot(x, y) / (F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))).alias("score"),
        "least_id")
    top = Window.partitionBy("query").orderBy(F.desc("score"), "least_id")
    best = scored.withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= keep)
    each = best.select("query", "score", F.explode("ids").alias("vec_id")).groupBy("query").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))),
                1, keep).alias("found"))
    answered = asked.join(each, "query").select("query_id", F.slice(F.filter(
        "found", lambda f: f["vec_id"] != F.col("query_id")), 1, nearest).alias("found"))
    return answered.select("query_id", F.posexplode("found").alias("at", "f")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"),
        (-F.col("f.far")).alias("score"))
