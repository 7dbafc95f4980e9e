from collections import Counter, defaultdict

from riskspark.plans import catalogue


def test_graph_of_all_transactions(spark, tmp_path):
    """Brute force over a small table; customers, cards and devices as the sample table gives them."""
    events = [(i, user, None if i % 11 == 0 else k) for i, (user, k) in enumerate([(1, 1), (51, 2), (2, 2), (3, 7), (103, 7), (4, 9), (5, 9), (6, 12), (60, 13)] * 3, 1)]
    rows = ", ".join(f"({i}L, TIMESTAMP_NTZ '2024-01-02 00:00:00', {u}L, 'purchase', 1.0D, '{{\"k\": {0 if k is None else k}}}')" for i, u, k in events)
    spark.sql(f"SELECT * FROM VALUES {rows} AS t(event_id, ts, user_id, event_type, value, props)").write.parquet(f"{tmp_path}/events.parquet")
    run = lambda name: catalogue.QUERIES[name](spark, str(tmp_path))

    edges = set()
    for _, user, k in events:
        edges |= {(f"customer:{user % 50}", f"card:{user}", "OWNS_CARD"), (f"customer:{user % 50}", f"device:{(k or 0) % 20}", "USED_DEVICE")}
    near = defaultdict(set)
    for a, b, _ in edges:
        near[a].add(b)
        near[b].add(a)
    component = {}
    for v in sorted(near):
        todo = [] if v in component else [v]
        while todo:
            x = todo.pop()
            if x not in component:
                component[x] = v
                todo += near[x]
    degree = Counter(x for a, b, _ in edges for x in (a, b))
    rank, out = dict.fromkeys(near, 1.0), Counter(a for a, *_ in edges)
    for _ in range(5):
        rank = {v: 0.15 + 0.85 * sum(rank[a] / out[a] for a, b, _ in edges if b == v) for v in near}
    scale = len(rank) / sum(rank.values())

    assert len(set(component.values())) > 1
    assert {tuple(r) for r in run("r1_entity_edges_whole").select("src", "dst", "relationship").collect()} == edges
    assert {tuple(r) for r in run("r1_entity_vertices_whole").select("id", "type").collect()} == {(v, v.split(":")[0]) for v in near}
    assert {r.id: r.degree for r in run("r3_degrees_whole").collect()} == degree
    assert {r.id: r.component for r in run("r4_connected_components_whole").collect()} == component
    assert {r.id: (r.degree, r.component) for r in run("r5_entity_metrics_whole").collect()} == {v: (degree[v], component[v]) for v in near}
    assert {r.customer_id: r.component for r in run("j11_graph_features_whole").collect()} == {v[9:]: c for v, c in component.items() if v.startswith("customer:")}
    assert all(abs(r["rank"] - rank[r.id] * scale) < 1e-5 for r in run("r2_pagerank_whole").collect())
