"""Entity graphs: vertices, edges, rank, degrees, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import written
from ..functions.ranges import running_sums
from ..functions.skew import join_hot
from .joins import pagerank_degree_community


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", most: int | None = None) -> DataFrame:
    """(id, component) of every vertex with an edge; component is its smallest reachable id.

    Alternates large-star and small-star rounds until every vertex points at its
    root, a number of rounds that grows with the logarithm of the longest chain.
    Each round is written to the shared folder. A vertex of very many neighbours
    is joined by a broadcast, so its neighbours don't meet in one task. Nulls and
    self-loops are no edges. ``most`` is a bound of the edges, if one is known.
    """
    a, b = F.col(src), F.col(dst)
    links = edges.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = written(links, "links", most)
    while not _is_star_forest(links):
        n = links.count()
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("degree"))
        # Large star: every larger neighbour is linked to the smallest one.
        large = join_hot(both, low, "u", "degree", 2 * n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # Small star: so are the smaller neighbours and the vertex itself.
        # A row of each star for each of the n links and, at most, for each of their ends.
        large = written(large, "large-star", 2 * n)
        small = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")), "small-star", 2 * n)
        moved = join_hot(large, small, "u", "degree", 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(moved.unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links", 4 * n)
    roots = links.select(F.col("v").alias("id")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))


def _is_star_forest(links: DataFrame) -> bool:
    """Whether every ``u`` has one ``v``, and no ``v`` is a ``u``: then each v is the root of its tree."""
    ends = links.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select("v", F.lit(0), F.lit(1)).toDF("id", "up", "down"))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def build_entity_graph(txn: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices id, type; edges src, dst, relationship) of customers, cards and devices.

    Ids carry their type, so equal ids of two types stay apart. Null and
    ``unknown`` devices are left out.
    """

    def named(kind: str, c: str):
        return F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))

    device = F.col("device_id").isNotNull() & (F.col("device_id").cast("string") != "unknown")
    parts = [("customer", "customer_id", F.col("customer_id").isNotNull()), ("card", "card_id", F.col("card_id").isNotNull()), ("device", "device_id", device)]
    vertices = None
    for kind, c, there in parts:
        own = txn.filter(there).select(named(kind, c).alias("id"), F.lit(kind).alias("type")).distinct()
        vertices = own if vertices is None else vertices.unionByName(own)
    owns = txn.filter(F.col("customer_id").isNotNull() & F.col("card_id").isNotNull()).select(named("customer", "customer_id").alias("src"), named("card", "card_id").alias("dst"), F.lit("OWNS_CARD").alias("relationship"))
    used = txn.filter(F.col("customer_id").isNotNull() & device).select(named("customer", "customer_id").alias("src"), named("device", "device_id").alias("dst"), F.lit("USED_DEVICE").alias("relationship"))
    return vertices, owns.distinct().unionByName(used.distinct())


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree): edges in and out."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))


def pagerank(vertices: DataFrame, edges: DataFrame, reset: float = 0.15, rounds: int = 5) -> DataFrame:
    """(id, rank) after a fixed number of rounds, rescaled to sum to the number of vertices."""
    out = edges.groupBy("src").agg(F.count("*").alias("out"))
    total = edges.count()
    out = written(out.withColumn("rows", F.col("out")), "out")
    moves = written(join_hot(edges, out, "src", "rows", total).select("src", "dst", "out"), "moves")
    ranks = vertices.select("id", F.lit(1.0).alias("rank"))
    for _ in range(rounds):
        # A hub's edges stay where they are: its rank goes to them.
        held = ranks.join(out.select(F.col("src").alias("id"), "rows"), "id").withColumnRenamed("id", "src")
        given = join_hot(moves, held, "src", "rows", total).groupBy("dst").agg(F.sum(F.col("rank") / F.col("out")).alias("given"))
        ranks = written(vertices.select("id").join(given, F.col("id") == F.col("dst"), "left").select("id", (reset + (1 - reset) * F.coalesce("given", F.lit(0.0))).alias("rank")), "ranks")
    sums = ranks.agg(F.sum("rank").alias("total"), F.count("*").alias("n"))
    return ranks.crossJoin(F.broadcast(sums)).select("id", (F.col("rank") * F.col("n") / F.col("total")).alias("rank"))


def entity_metrics(vertices: DataFrame, edges: DataFrame, snapshot_date, rounds: int = 5) -> DataFrame:
    """Rank, degree and component of every vertex, as of a date."""
    found = connected_components(edges).select("id", "component")
    return (
        pagerank_degree_community(pagerank(vertices, edges, rounds=rounds), degrees(edges), found)
        .select("id", "rank", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("component", "id").alias("component"), F.lit(snapshot_date).cast("date").alias("snapshot_date"))
    )


def sharing_count(txn: DataFrame, entity: str, member: str, hours: int = 24, ts: str = "event_time_ts", tie: str = "transaction_id") -> DataFrame:
    """Distinct members that used the entity in the ``hours`` up to and with each event.

    A member counts from an event on until so long after its last one. Those spells
    are found within (entity, member); the count at an event is the spells begun by
    then less those over before it, a running sum that is dealt by ranges of time,
    so the events of one busy entity don't meet in one task. Rows without the
    entity are left out, and a null member counts for none.
    """
    length = hours * 3600
    known = txn.filter(F.col(entity).isNotNull()).select(tie, entity, ts, F.col(member).alias("__member"), F.unix_timestamp(F.col(ts).cast("timestamp")).alias("__s"))
    own = Window.partitionBy(entity, "__member").orderBy("__s")
    moments = known.filter("__member is not null").select(entity, "__member", "__s").distinct()
    near = moments.withColumns({"__before": F.lag("__s").over(own), "__after": F.lead("__s").over(own)})
    begins = near.filter(f"__before is null or __s - __before > {length}").select(entity, (2 * F.col("__s")).alias("__at"), F.lit(1).alias("__step"))
    # Over before the next whole second: half a step after the last one that still counts.
    ends = near.filter(f"__after is null or __after - __s > {length}").select(entity, (2 * (F.col("__s") + length) + 1).alias("__at"), F.lit(-1).alias("__step"))
    asked = known.select(entity, (2 * F.col("__s")).alias("__at"), F.lit(0).alias("__step"))
    steps = begins.unionByName(ends).unionByName(asked).groupBy(entity, "__at").agg(F.sum("__step").alias("__step"))
    counts = running_sums(steps, entity, "__at", {"__step": "sharing_count"}).select(entity, "__at", F.col("sharing_count").cast("long"))
    return known.withColumn("__at", 2 * F.col("__s")).join(counts, [entity, "__at"]).select(tie, entity, ts, "sharing_count")
