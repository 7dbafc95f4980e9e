"""Product codes of vectors: each part's nearest codebook entry, found through memoised grid cells."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import join_hot
from .common import lean, written
from .integer_vectors import BLOCK, Sums, exact_in, group_means, integer_vectors, matrix

#: Width of a grid cell in integer units of a component.
CELL = 32
#: Cells in each of the two generations of a memo; about 200 bytes each.
MEMO_CELLS = 100_000


class CellMemo:
    """Nearest entries of one part's codebook, by the grid cell of a point.

    For a cell the memo keeps, as bits, the entries that can be nearest to some
    point of the cell's box: those whose smallest distance to the box isn't above
    the least of all entries' largest distances to it. An entry at exactly that
    distance stays, as it may tie. Only kept entries are compared exactly.
    """

    def __init__(self, entries: np.ndarray, cell: int = CELL, most: int = MEMO_CELLS):
        self.entries, self.cell, self.most = entries, cell, most
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.asked = self.made = self.compared = 0

    def bits(self, cells: np.ndarray) -> np.ndarray:
        """Packed bits of the entries that may be nearest in each of these cells.

        A coordinate's share of both distances depends on that coordinate of the
        cell alone, so it is computed once for each distinct one.
        """
        exact_in(cells * self.cell, self.entries)
        nearest, farthest = (np.zeros((len(cells), len(self.entries)), np.int64) for _ in range(2))
        for j in range(cells.shape[1]):
            spots, at = np.unique(cells[:, j], return_inverse=True)
            low = (spots * self.cell)[:, None]
            high, e = low + self.cell - 1, self.entries[:, j][None, :]
            gap, far = np.maximum(np.maximum(low - e, e - high), 0), np.maximum(np.abs(e - low), np.abs(e - high))
            nearest += (gap * gap)[at]
            farthest += (far * far)[at]
        return np.packbits(nearest <= farthest.min(1)[:, None], axis=1)

    def candidates(self, points: np.ndarray) -> np.ndarray:
        """Whether each entry may be nearest to each point."""
        cells = points // self.cell
        keys = np.ascontiguousarray(cells).view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel()
        _, first, at = np.unique(keys, return_index=True, return_inverse=True)
        names = [keys[i].tobytes() for i in first]
        found = [self.known.get(k) or self.old.get(k) for k in names]
        new = [i for i, x in enumerate(found) if x is None]
        self.asked, self.made = self.asked + len(points), self.made + len(new)
        if new:
            for i, row in zip(new, self.bits(cells[first[new]]), strict=True):
                found[i] = row.tobytes()
        if len(self.known) + len(names) > self.most:
            self.known, self.old = {}, self.known
        self.known.update(zip(names, found, strict=True))
        width = (len(self.entries) + 7) // 8
        masks = np.unpackbits(np.frombuffer(b"".join(found), np.uint8).reshape(-1, width), axis=1, count=len(self.entries))
        return masks[at].astype(bool)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each point's nearest entry; of equally near ones the lowest index."""
        exact_in(points, self.entries)
        rows, entries = np.nonzero(self.candidates(points))
        self.compared += len(rows)
        away = points[rows] - self.entries[entries]
        away *= away
        distance = away.sum(1)
        starts = np.searchsorted(rows, np.arange(len(points)))
        least = np.minimum.reduceat(distance, starts)
        first = np.flatnonzero(distance == least[rows])
        _, lowest = np.unique(rows[first], return_index=True)
        return entries[first[lowest]], least


def memos(codebooks: np.ndarray, cell: int) -> list[CellMemo]:
    return [CellMemo(c, cell) for c in codebooks]


def assigned(own: list[CellMemo], block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, squared distances) of a block's vectors, a column a part."""
    cut = np.split(block, len(own), axis=1)
    both = [m.nearest(np.ascontiguousarray(x)) for m, x in zip(own, cut, strict=True)]
    return np.stack([b[0] for b in both], axis=1), np.stack([b[1] for b in both], axis=1)


def train_codebooks(vectors: DataFrame, dims: int, parts: int, entries: int, rounds: int, cell: int = CELL) -> np.ndarray:
    """Codebooks (part, entry, component) after some rounds over all vectors (vec_id, ints); no entries without vectors.

    They start as the parts of the vectors of smallest id; a null id comes last,
    and of equal ids the smaller vector first.
    """
    spark, width = vectors.sparkSession, dims // parts
    start = vectors.orderBy(F.asc_nulls_last("vec_id"), "ints").select("ints").limit(entries).collect()
    books = np.array([r["ints"] for r in start], np.int64).reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(start) else 0):
        shared = spark.sparkContext.broadcast(books)
        # A task's memos; a worker process runs one task at a time and the codebooks change each round.
        held: dict[str, list[CellMemo]] = {}

        def fill(sums: Sums, block: np.ndarray, shared=shared, held=held) -> None:
            if "own" not in held:
                held["own"] = memos(shared.value, cell)
            index, _ = assigned(held["own"], block)
            for p, x in enumerate(np.split(block, parts, axis=1)):
                sums.add(index[:, p] + p * entries, x)

        for group, mean in group_means(vectors, dims, width, parts * entries, fill).items():
            books[group // entries, group % entries] = mean
        shared.unpersist()
    return books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, books: np.ndarray, dims: int, cell: int = CELL) -> DataFrame:
    """(vec_id, label, code, error): the code has two hex digits a part; ``error`` is the sum of squared distances."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = memos(shared.value, cell)
        for batch in batches:
            whole = matrix(batch.column(2), dims)
            for i in range(0, len(whole), BLOCK):
                index, distance = assigned(own, whole[i : i + BLOCK])
                part = batch.slice(i, BLOCK)
                codes = pa.array([x.tobytes().hex() for x in index.astype(np.uint8)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), codes, pa.array(distance.sum(1))], names=["vec_id", "label", "code", "error"])

    kinds = dict(vectors.dtypes)
    return vectors.select("vec_id", "label", "ints").mapInArrow(lean(coded), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def _label_key(label: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), label.cast("string")), F.lit(""))


def compress_vectors(embeddings: DataFrame, dims: int = 64, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, cell: int = CELL, id_col: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector.

    Components become floor(scale * x); vectors are cut into equal parts, each
    with a codebook of at most 256 entries, trained over all rows and read back by
    every task. Vectors that are null, of another length, or that hold a null, NaN
    or infinite component are left out. Repeated rows stay and count. Fewer rows
    than entries give smaller codebooks; an empty table gives no row. Of equally
    near entries the lowest index counts; a null id or label is one like any other.
    Only the three named columns are read, so others may have any name. Components
    whose squared distances don't fit a long raise an error.

    Nothing is shuffled but a row for each task and entry, and label sums; a hot
    label's rows stay where they are.
    """
    if dims % parts or not 0 < entries <= 256:
        raise ValueError("parts must be equal and have at most 256 entries")
    vectors = integer_vectors(embeddings, scale, dims, {"vec_id": id_col, "label": label}, vector)
    books = train_codebooks(vectors, dims, parts, entries, rounds, cell)
    coded = written(encode_vectors(vectors, books, dims, cell).withColumn("of", _label_key(F.col("label"))), "codes")
    sums = written(coded.groupBy("of").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows")), "label_sums")
    total = sums.agg(F.sum("rows")).first()[0] or 0
    joined = join_hot(coded, sums, "of", "rows", total)
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def _oracle(dims: int = 64, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """DuckDB SQL of the same result, by comparing every part with every entry."""
    width = dims // parts
    ctes = [
        f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v, row_number() OVER (ORDER BY vec_id NULLS LAST, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE))) AS r
 FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"p AS MATERIALIZED (SELECT r, part, v[part * {width} + 1 : part * {width} + {width}] AS x FROM kept, range({parts}) AS t(part))",
        f"b0 AS MATERIALIZED (SELECT part, r - 1 AS e, x AS c FROM p WHERE r <= {entries})",
    ]
    for i in range(rounds + 1):
        d = "list_inner_product(x, x) + list_inner_product(c, c) - 2 * list_inner_product(x, c)"
        ctes.append(f"a{i} AS MATERIALIZED (SELECT r, p.part, min(struct_pack(d := ({d})::BIGINT, e := e)) AS n FROM p JOIN b{i} AS b ON p.part = b.part GROUP BY r, p.part)")
        if i < rounds:
            ctes.append(f"u{i} AS (SELECT p.part, n.e AS e, j, floor(sum(x[j]::BIGINT)::DOUBLE / count(*)) AS m FROM a{i} JOIN p USING (r, part), range(1, {width + 1}) AS t(j) GROUP BY p.part, n.e, j)")
            ctes.append(f"m{i} AS (SELECT part, e, list(m ORDER BY j) AS m FROM u{i} GROUP BY part, e)")
            ctes.append(f"b{i + 1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(m, c) AS c FROM b{i} AS b LEFT JOIN m{i} USING (part, e))")
    ctes.append(f"coded AS (SELECT r, string_agg(lower(printf('%02x', n.e)), '' ORDER BY part) AS code, sum(n.d)::BIGINT AS error FROM a{rounds} GROUP BY r)")
    ctes.append(f"digest AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY part, e)) AS s FROM b{rounds})")
    return "WITH " + ",\n".join(ctes) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256 FROM kept JOIN coded USING (r), digest"


ORACLE = _oracle()
