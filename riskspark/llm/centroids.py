"""Clusters around centroids, searched through a vantage-point tree that each round broadcasts anew."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, written
from .integer_vectors import BLOCK, Sums, group_means, integer_vectors, matrix, squared

#: Centroids of a leaf.
LEAF = 4
#: Vantage points that are tried for a node.
TRIED = 16
#: Relative error that bounds allow for; far above that of a square root and a difference in doubles.
SLACK = 1e-12
#: Bounds (a vector's, a node's) held at once.
CELLS = 4_000_000


class CentroidTree:
    """A vantage-point tree: an inner node has a centroid and two children, a leaf some centroids.

    A child knows the smallest and largest distance of its centroids from its
    parent's vantage point, so by the triangle inequality a point at distance d
    from that has none of them nearer than ``max(d - largest, smallest - d)``.
    """

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = centroids
        self.members: list[np.ndarray] = []
        self.children: list[list[tuple[int, float, float]]] = []
        self.visits = 0
        if len(centroids):
            self._grow(np.arange(len(centroids)), leaf)

    def _grow(self, numbers: np.ndarray, leaf: int) -> int:
        at = len(self.members)
        self.members.append(numbers)
        self.children.append([])
        if len(numbers) <= max(leaf, 1):
            return at
        tried = numbers[np.linspace(0, len(numbers) - 1, min(TRIED, len(numbers))).astype(int)]
        away = np.sqrt(squared(self.centroids[tried], self.centroids[numbers]).astype(np.float64))
        best = int(away.std(1).argmax())
        keep = numbers != tried[best]
        rest, away = numbers[keep], away[best][keep]
        self.members[at] = tried[best : best + 1]
        order = np.argsort(away, kind="stable")
        for half in np.array_split(order, 2):
            if len(half):
                low, high = float(away[half].min()), float(away[half].max())
                self.children[at].append((self._grow(np.sort(rest[half]), leaf), low, high))
        return at

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each point's nearest centroid; of equally near ones the smallest number."""
        step = max(1, CELLS // max(1, len(self.members)))
        both = [self._search(points[i : i + step]) for i in range(0, len(points), step)]
        return np.concatenate([b[0] for b in both]), np.concatenate([b[1] for b in both])

    def _search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each point visits its open nodes in order of their bounds, until its least bound exceeds its best distance.

        A bound equal to the best distance is still visited: it may hide a tie of smaller number.
        """
        n = len(points)
        number, best = np.full(n, len(self.centroids)), np.full(n, np.iinfo(np.int64).max)
        bounds = np.full((n, len(self.members)), np.inf)
        bounds[:, 0] = 0
        live = np.arange(n)
        while live.size:
            node = bounds[live].argmin(1)
            low = bounds[live, node]
            near = low <= np.sqrt(best[live].astype(np.float64)) * (1 + SLACK)
            live, node, low = live[near], node[near], low[near]
            bounds[live, node] = np.inf
            self.visits += live.size
            for v in np.unique(node):
                here = node == v
                rows = live[here]
                members = self.members[v]
                distance = squared(points[rows], self.centroids[members])
                at = distance.argmin(1)
                least, whose = distance[np.arange(len(rows)), at], members[at]
                better = (least < best[rows]) | ((least == best[rows]) & (whose < number[rows]))
                best[rows[better]], number[rows[better]] = least[better], whose[better]
                if self.children[v]:
                    d = np.sqrt(distance[:, 0].astype(np.float64))
                    for child, small, large in self.children[v]:
                        bounds[rows, child] = np.maximum(low[here], np.maximum(d - large, small - d) - SLACK * (d + large))
        return number, best


def start_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors whose hash of ``<seed>:<vec_id>`` is smallest, in its order; a null id comes last, of equal ids the smaller vector first."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(F.asc_nulls_last(key), "ints").select("ints").limit(k).collect()
    return np.array([r["ints"] for r in rows], np.int64)


def cluster_vectors(embeddings: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2, leaf: int = LEAF, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    Components become floor(scale * x); each round assigns every vector to its
    nearest centroid and moves each non-empty centroid to the floor of its vectors'
    mean. Vectors that are null, of another length than ``dims``, or that hold a
    null, NaN or infinite component are left out. Repeated rows stay and count.
    Fewer rows than ``k`` give fewer clusters; an empty table gives no row. Only the
    two named columns are read, so others may have any name. Components whose
    squared distances don't fit a long raise an error.

    Nothing is shuffled but a row for each task and cluster; ``k`` centroids bound
    what is broadcast and what reaches the driver.
    """
    vectors = integer_vectors(embeddings, scale, dims, {"vec_id": id_col}, vector)
    spark = vectors.sparkSession
    centroids = start_centroids(vectors, k, seed).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        shared = spark.sparkContext.broadcast(CentroidTree(centroids, leaf))

        def fill(sums: Sums, block: np.ndarray, shared=shared) -> None:
            sums.add(shared.value.nearest(block)[0], block)

        for number, mean in group_means(vectors, dims, dims, k, fill).items():
            centroids[number] = mean
        shared.unpersist()
    shared = spark.sparkContext.broadcast(CentroidTree(centroids, leaf))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = matrix(batch.column(1), dims)
            for i in range(0, len(whole), BLOCK):
                number, distance = shared.value.nearest(whole[i : i + BLOCK])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, BLOCK), pa.array(number, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    kind = dict(vectors.dtypes)["vec_id"]
    found = written(vectors.select("vec_id", "ints").mapInArrow(lean(nearest), f"vec_id {kind}, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    own = spark.createDataFrame([(i, sums[i], digests[i]) for i in sums], "cluster int, cluster_inertia long, centroid_sha256 string")
    joined = found.join(F.broadcast(own), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(sums.values())).cast("long").alias("inertia"), "centroid_sha256")


def _oracle(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> str:
    """DuckDB SQL of the same result, by comparing every vector with every centroid."""
    ctes = [
        f"""kept AS (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS x,
 row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE))) AS r
 FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "p AS MATERIALIZED (SELECT * FROM kept)",
        f"b0 AS MATERIALIZED (SELECT r - 1 AS e, x AS c FROM p WHERE r <= {k})",
    ]
    for i in range(rounds + 1):
        d = "list_inner_product(x, x) + list_inner_product(c, c) - 2 * list_inner_product(x, c)"
        ctes.append(f"a{i} AS MATERIALIZED (SELECT r, min(struct_pack(d := ({d})::BIGINT, e := e)) AS n FROM p, b{i} GROUP BY r)")
        if i < rounds:
            ctes.append(f"u{i} AS (SELECT n.e AS e, j, floor(sum(x[j]::BIGINT)::DOUBLE / count(*)) AS m FROM a{i} JOIN p USING (r), range(1, {dims + 1}) AS t(j) GROUP BY n.e, j)")
            ctes.append(f"m{i} AS (SELECT e, list(m ORDER BY j) AS m FROM u{i} GROUP BY e)")
            ctes.append(f"b{i + 1} AS MATERIALIZED (SELECT b.e, coalesce(m, c) AS c FROM b{i} AS b LEFT JOIN m{i} USING (e))")
    digest = "sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ','))"
    return (
        "WITH "
        + ",\n".join(ctes)
        + f"""\nSELECT vec_id, n.e::INTEGER AS cluster, n.d AS distance, (sum(n.d) OVER (PARTITION BY n.e))::BIGINT AS cluster_inertia, (sum(n.d) OVER ())::BIGINT AS inertia, {digest} AS centroid_sha256
 FROM p JOIN a{rounds} USING (r) JOIN b{rounds} AS b ON b.e = n.e"""
    )


ORACLE = _oracle()
