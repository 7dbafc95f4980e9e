"""Near-duplicates by a chosen-path set similarity join.

A document's set is its distinct word shingles; two documents are linked when
the Jaccard similarity of their sets reaches the threshold. The join:

1. Each set becomes ``TOKENS`` minwise tokens; two sets agree in a token with a
   probability equal to their similarity. Equal sets are joined at once, by a
   digest, and one of each stays.
2. Chosen paths: in each of ``trees`` independent trees documents branch by the
   values of two selected tokens; one alone is shared by chance too often.
3. A first look pairs each document with one leader, the smallest id of the nodes
   it is in most often, a number of pairs linear in the nodes; on full sets. It
   makes most nodes one component, and those end there.
4. Nodes with several components branch by one more token while they are larger
   than ``leaf``. Where they end they are compared exhaustively, on full sets: a
   node, or two blocks of a large one, is a group of a task, and what leaves the
   task are the links that join components, fewer than the group has documents.
   So a group of thousands of near copies never becomes all its pairs.
5. Branching ends at the deepest level that keeps the miss bound. Nodes still
   large there are compared in blocks, whatever their number.

After k levels, k + 1 tokens, a pair at similarity s is missed by all trees with
probability (1 - s^(k + 1))^trees: 5e-6 at the threshold of 0.8 after the first
level, 2e-4 after the second, which is the deepest by default. Trees share no
token down to there, so they are independent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import join_hot
from ..operators.graph import connected_components
from .common import lean, text_of, written
from .tokens import blocks

#: Minwise tokens of a set.
TOKENS = 64
#: Probability up to which a pair at the threshold may be missed.
MISS = 2e-4
#: Documents and shingles of a block in the exhaustive comparison, about; a longer document has a block of its own size.
BLOCK = 512
BLOCK_SHINGLES = 250_000
#: Characters of texts that are turned into sets together, about.
BLOCK_CHARS = 300_000
#: Bits of the filter of candidates' ids; more candidates than about a tenth of it only let more texts pass.
FILTER_BITS = 1 << 26

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLY = _RANDOM.integers(1, 1 << 63, TOKENS, dtype=np.uint64) | np.uint64(1)
_ADD = _RANDOM.integers(0, 1 << 63, TOKENS, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_LENGTH = np.arange(64, dtype=np.uint64) * _STEP
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_SPACE = np.array([b in b" \t\n\x0b\x0c\r" for b in range(256)])
_BYTE[_IS_SPACE] = 0


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], size: int = 4) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's word shingles.

    A-Z are lowered; words are what ASCII white space separates. A text of fewer
    words than ``size``, but not none, has its whole sequence as one shingle.
    """
    raws = [t.encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]
    data = np.frombuffer(b" ".join([b"", *raws, b""]), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raws])
    space = _IS_SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(texts)
    inside = np.arange(len(data) - starts[0]) - np.repeat(starts - starts[0], np.diff(np.append(starts, len(data))))
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(inside.max()), _STEP)]), dtype=np.uint64)
    words = _mixed(np.add.reduceat(_BYTE[data[starts[0] :]] * power[inside], starts - starts[0]))
    first = np.searchsorted(starts, np.concatenate([[0], ends[:-1]]), "right")
    last = np.searchsorted(starts, ends, "right")
    n = len(words) - size + 1
    runs = _mixed(sum((words[k : n + k] * _PLACE[k] for k in range(size)), np.zeros(max(n, 0), np.uint64))) if n > 0 else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            out.append(_mixed((words[a:b] * _PLACE[: b - a]).sum(keepdims=True) + _LENGTH[b - a]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minwise_tokens(values: np.ndarray) -> np.ndarray:
    """The smallest value of a set under each of ``TOKENS`` hash functions, 32 bits."""
    best = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(values), 4096):
        np.minimum(best, (values[k : k + 4096, None] * _MULTIPLY + _ADD).min(0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def _sketches(documents: DataFrame, id_col: str, size: int) -> DataFrame:
    """(doc_id, n_shingles, digest, tokens) of every document row."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in blocks(texts, BLOCK_CHARS):
                sets = shingle_sets(texts[a:b], size)
                tokens = np.array([minwise_tokens(x) for x in sets], np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([_digest(x) for x in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, TOKENS * (b - a + 1), TOKENS), pa.int32()), pa.array(tokens.ravel())),
                    ],
                    names=["doc_id", "n_shingles", "digest", "tokens"],
                )

    read = text_of(documents, F.col(id_col).cast("long").alias("doc_id"))
    return read.mapInArrow(lean(sketched), "doc_id long, n_shingles long, digest binary, tokens array<int>")


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _mark(digest: bytes) -> int:
    """Four bytes of a digest, which tell apart the texts of an id that stands more than once."""
    return int.from_bytes(digest[:4], "big")


def deepest_level(percent: int, trees: int, levels: int, miss: float = MISS) -> int:
    """The last level, 1 at least and ``levels`` at most, at which a pair at the threshold is missed with at most ``miss``.

    Trees must also have tokens of their own down to it.
    """
    holds = [k for k in range(1, levels + 1) if (1 - (percent / 100) ** (k + 1)) ** trees <= miss and trees * (k + 1) <= TOKENS]
    return max(holds, default=1)


def _paths(tree: int, trees: int, levels: int) -> list[int]:
    """The tokens that this tree selects: two for the root, one for each level more; no other tree has them while there are enough."""
    return [(tree + k * trees) % TOKENS for k in range(levels + 1)]


def _key_of(tree: int, level: int, trees: int, levels: int) -> Column:
    tokens = [F.get(F.col("tokens"), F.lit(c)) for c in _paths(tree, trees, levels)[: level + 1]]
    return F.xxhash64(F.lit(tree), F.lit(level), *tokens)


def _shared_nodes(sets: DataFrame, trees: int, levels: int) -> DataFrame:
    """(key, id, mark, tree, leader) of the first level's nodes of two texts or more; the leader is the smallest id and its mark."""
    keys = F.array(*[F.struct(F.lit(t).cast("byte").alias("tree"), _key_of(t, 1, trees, levels).alias("key")) for t in range(trees)])
    rows = sets.select("id", "mark", F.explode(keys).alias("x")).select("id", "mark", "x.tree", "x.key")
    nodes = rows.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("id", "mark")).alias("leader")).filter("size > 1")
    return written(join_hot(rows, written(nodes, "shared"), "key", "size", trees * sets.count()), "nodes")


def _leaders(nodes: DataFrame) -> DataFrame:
    """(a, ma, b, mb): each text with the leader of most of its nodes, of equally frequent ones the smallest."""
    led = nodes.filter("leader.id < id").groupBy("id", "mark", "leader").agg(F.count("*").alias("k"))
    best = led.groupBy("id", "mark").agg(F.min(F.struct((-F.col("k")).alias("k"), "leader")).alias("x"))
    return best.select(F.col("x.leader.id").alias("a"), F.col("x.leader.mark").alias("ma"), F.col("id").alias("b"), F.col("mark").alias("mb"))


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with ``c``, the component of ``id`` so far."""
    joined = rows.join(found.withColumnRenamed("component", "c"), "id", "left")
    return joined.withColumn("c", F.coalesce("c", "id"))


def _open_nodes(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` (key, n, c, ...) of nodes that hold several components, with the node's ``size`` and ``weight``, the sum of n.

    Nodes whose documents are one component already have nothing to add and end.
    """
    rows = written(rows, "rows", most)
    nodes = rows.groupBy("key").agg(F.count("*").alias("size"), F.count("*").alias("held"), F.sum("n").alias("weight"), F.min("c").alias("low"), F.max("c").alias("high"))
    mixed = written(nodes.filter("low <> high").drop("low", "high"), "mixed", most)
    return written(join_hot(rows, mixed, "key", "held", most), "open", most)


def _ended_nodes(nodes: DataFrame, sets: DataFrame, found: DataFrame, trees: int, levels: int, leaf: int, most: int) -> DataFrame:
    """Open nodes (key, id, mark, c, size, weight) where branching ends: small ones, and all of the last level."""
    ended: list[DataFrame] = []
    rows = _named(nodes.select("id", "mark", "tree", "key"), found)
    for level in range(1, levels + 1):
        own = ["id", "mark", "n"] if level == 1 else ["id", "mark", "n", "tokens"]
        known = rows.join(sets.select(*own), ["id", "mark"])
        if level > 1:
            keys = F.array(*[_key_of(t, level, trees, levels) for t in range(trees)])
            known = known.withColumn("key", F.get(keys, F.col("tree").cast("int")))
        opened = _open_nodes(known.select("id", "mark", "tree", "key", "n", "c"), most)
        large = opened.filter(F.col("size") > leaf)
        if level == levels or large.isEmpty():
            ended.append(opened)
            break
        ended.append(opened.filter(F.col("size") <= leaf))
        rows = large.select("id", "mark", "tree", "c")
    return reduce(DataFrame.unionByName, ended).select("key", "id", "mark", "c", "size", "weight")


def joining_links(ids: np.ndarray, components: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Pairs (left, right) of ids at the threshold, as many as it takes to join the components that such pairs join.

    Sets are sorted distinct values; ``left`` and ``right`` are places in them, the
    same ones or none in common. Each set of the left is counted against all of
    the right at once.
    """
    n = np.array([len(x) for x in sets], np.int64)
    values, spots = np.unique(np.concatenate([sets[j] for j in right]), return_inverse=True)
    starts = np.cumsum(n[right]) - n[right]
    group = np.unique(components, return_inverse=True)[1]
    mark = np.zeros(len(values) + 1, np.int32)
    out: list[tuple[int, int]] = []
    for i in left:
        near = (group[right] != group[i]) & (100 * np.minimum(n[i], n[right]) >= percent * np.maximum(n[i], n[right]))
        if not near.any():
            continue
        at = np.searchsorted(values, sets[i])
        at = np.where(values[np.minimum(at, len(values) - 1)] == sets[i], at, len(values))
        mark[at] = 1
        shared = np.add.reduceat(mark[spots], starts)
        mark[at] = 0
        for j in right[near & (100 * shared >= percent * (n[i] + n[right] - shared))]:
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                out.append((ids[i], ids[j]))
    return np.array(out, np.int64).reshape(-1, 2)


def _compared(rows: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(src, dst): links that join the components within each node of ``rows``, on full sets.

    A node of more than about ``BLOCK`` documents or ``BLOCK_SHINGLES`` shingles is
    dealt into blocks, and every two of them meet in one group, so a group is
    bounded and a large node is spread over many tasks.
    """
    parts = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("weight") / BLOCK_SHINGLES)).cast("int")
    dealt = rows.withColumn("parts", parts).withColumn("block", F.pmod(F.xxhash64("id", "mark", F.lit(7)), F.col("parts")).cast("int"))
    dealt = dealt.join(full.drop("n"), ["id", "mark"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "c", "values")

    def compared(group: pa.Table) -> pa.Table:
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        ids, components, block = (group.column(x).to_numpy() for x in ("id", "c", "block"))
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("values")]
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        found = joining_links(ids, components, sets, left, right, percent) if len(left) and len(right) else np.zeros((0, 2), np.int64)
        return pa.table({"src": pa.array(found[:, 0], pa.int64()), "dst": pa.array(found[:, 1], pa.int64())})

    return dealt.groupBy("key", "low", "high").applyInArrow(compared, "src long, dst long")


def _full_sets(documents: DataFrame, id_col: str, size: int, ids: DataFrame) -> DataFrame:
    """(id, mark, n, values) of the documents in ``ids``, and of few others; one row of each text, with its ``n`` shingles.

    A bitmap of hashed ids, of ``FILTER_BITS`` bits whatever the table, is built
    by Spark and shipped; texts are filtered and turned into sets where they are
    read, so no text is shuffled. What passes by chance finds no partner later.
    """
    spot = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)) + 1
    marks = ids.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    held = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, bits in marks.toLocalIterator():
        held[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bits, np.uint8)
    shipped = documents.sparkSession.sparkContext.broadcast(held)

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("spot").to_numpy() - 1
            some = batch.filter(pa.array(shipped.value[at >> 3] >> (at & 7) & 1 > 0))
            texts = some.column("text").to_pylist()
            for a, b in blocks(texts, BLOCK_CHARS):
                sets = shingle_sets(texts[a:b], size)
                columns = [some.column("id").slice(a, b - a), pa.array([_mark(_digest(x)) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "mark", "n", "values"])

    texts = text_of(documents, F.col(id_col).cast("long").alias("id")).filter("id is not null")
    return written(texts.select("id", spot.alias("spot"), "text").mapInArrow(lean(valued), "id long, mark long, n long, values binary"), "full-sets")


def _salted(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """``pairs`` with ``salt``, which deals those of one leader into parts of about ``BLOCK`` texts or ``BLOCK_SHINGLES`` shingles; null where one part takes them."""
    sizes = full.select(F.col("id").alias("b"), F.col("mark").alias("mb"), "n")
    keyed = pairs.withColumn("key", F.concat_ws(":", "a", "ma"))
    led = keyed.join(sizes, ["b", "mb"]).groupBy("key").agg(F.count("*").alias("k"), F.sum("n").alias("weight"))
    parts = F.ceil(F.greatest(F.col("k") / BLOCK, F.col("weight") / BLOCK_SHINGLES)).cast("int")
    large = written(led.select("key", "k", parts.alias("parts")).filter("parts > 1"), "leaders")
    if large.isEmpty():
        return pairs.withColumn("salt", F.lit(None).cast("int"))
    return join_hot(keyed, large, "key", "k", pairs.count(), "left").select("a", "ma", "b", "mb", F.pmod(F.xxhash64("b", "mb"), F.col("parts")).cast("int").alias("salt"))


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(src, dst) of the pairs (a, ma, b, mb) whose full sets reach the threshold.

    The pairs of a leader of many texts are dealt into parts, and its set goes to
    each part; the set of another goes to its few pairs.
    """
    salted = written(_salted(pairs, full), "salted")
    one, two = (full.select(F.col("id").alias(x), F.col("mark").alias(f"m{x}"), F.col("values").alias(f"v{x}")) for x in "ab")
    joined = salted.filter("salt is null").join(one, ["a", "ma"]).join(two, ["b", "mb"]).select("a", "b", "va", "vb")
    many = salted.filter("salt is not null")
    if not many.isEmpty():
        sent = many.select("a", "ma", "salt").distinct().join(one, ["a", "ma"])
        joined = joined.unionByName(many.join(two, ["b", "mb"]).join(sent, ["a", "ma", "salt"]).select("a", "b", "va", "vb"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("va"), batch.column("vb"), strict=True):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) else 0
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["src", "dst"])

    return joined.mapInArrow(lean(compared), "src long, dst long")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", size: int = 4, percent: int = 80, trees: int = 12, levels: int = 8, leaf: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document row.

    Linked documents have 100 * intersection >= ``percent`` * union of their
    ``size``-word shingle sets. ``component_id`` is the smallest id reachable over
    links, its own included, and ``kept`` marks that document.

    Null and empty texts and texts without words have an empty set and no links.
    Equal sets are linked whatever their number. Rows that repeat an id are one
    vertex, linked with what any of their texts is linked with; those without
    words stay alone. A row without an id takes no part: its component is null and
    it is kept. Only the id and the
    text are read; an empty table gives no rows.

    Shuffled are sketches (about 300 bytes a document), node rows (40 bytes a
    document and tree) and the full sets of candidates; texts are not. Links are
    confirmed on the 64-bit hashes of all shingles, of which two texts of a
    million shingles have a false match with a probability below 1e-7. Of pairs at
    the threshold at most ``MISS`` are missed: nodes larger than ``leaf`` branch
    down to ``deepest_level``, ``levels`` at most, and all are compared
    exhaustively where they end.
    """
    levels = deepest_level(percent, trees, levels)
    sketches = written(_sketches(documents, id_col, size), "sketches")
    known = sketches.filter("n_shingles > 0 and doc_id is not null")
    first = known.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "tokens")).alias("x"), F.count("*").alias("copies"))
    mark = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    sets = written(first.select("digest", "copies", F.col("x.doc_id").alias("id"), mark.alias("mark"), F.col("x.n_shingles").alias("n"), "x.tokens"), "sets")
    nodes = _shared_nodes(sets, trees, levels)
    full = _full_sets(documents, id_col, size, nodes.select("id"))

    # The texts of an id that stands more than once are one vertex.
    groups = sets.select("digest", "copies", "id")
    several = known.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"), F.count("*").alias("rows")).filter("low <> high").select("doc_id", "rows")
    several = join_hot(known.select("doc_id", "digest"), written(several, "repeated"), "doc_id", "rows", sketches.count()).distinct().join(groups, "digest").select(F.col("doc_id").alias("src"), F.col("id").alias("dst"))

    # Rows of shared nodes: what follows has no more of them, so that their tables are few files where there are few.
    most = nodes.count()
    links = written(_confirmed(_leaders(nodes), full, percent), "links").unionByName(written(several, "several"))
    found = written(connected_components(links, most=links.count()), "components", most)
    more = written(_compared(_ended_nodes(nodes, sets, found, trees, levels, leaf, most), full, percent), "links")
    if not more.isEmpty():
        links = found.toDF("src", "dst").unionByName(more)
        found = written(connected_components(links, most=links.count()), "components", most)

    named = written(groups.join(found, "id", "left").select("digest", "copies", F.coalesce("component", "id").alias("component")), "named")
    placed = join_hot(known.select("doc_id", "n_shingles", "digest"), named, "digest", "copies", sketches.count())
    alone = sketches.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    rows = placed.select("doc_id", "n_shingles", "component").unionByName(alone)
    return rows.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))
