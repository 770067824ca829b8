import numpy as np
import duckdb

from colophon.llm import topk as K

SF = "/root/testdata/sf0.01"


def brute(ids, x, k):
    s = np.round(x @ x.T, K.DIGITS)
    return {(ids[i], r + 1, ids[j], float(s[i, j])) for i in range(len(ids)) for r, j in enumerate(sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-s[i, j], ids[j]))[:k])}


def rows(df):
    return {(r.vec_id, r["rank"], r.neighbor_id, r.score) for r in df.collect()}


def test_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.sql(K.sql())
    got = K.top_k(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert got.columns == want.columns
    assert rows(got) == set(map(tuple, want.fetchall()))


def test_threshold_stops_early_and_is_exact():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3)) * [5, 1, 0.1]
    shard = K.Shard(np.arange(500), x, np.eye(3))
    got = {(int(r), int(i)) for r, s, i in (t for f in shard.search(np.arange(500), x, np.full(500, -np.inf), 4) for t in zip(*f))}
    s = np.round(x @ x.T, K.DIGITS)
    np.fill_diagonal(s, -np.inf)
    assert got == {(i, j) for i in range(500) for j in sorted(range(500), key=lambda j: (-s[i, j], j))[:4]}
    seen = []
    for rows_, _, high in shard.steps:  # a query along the first axis needs only the head of that list
        seen += list(rows_)
        if np.sort(x[seen, 0])[-4] >= high[0]:
            break
    assert len(seen) < 500


def test_ties_clusters_and_edge_cases(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 4)) * 8
    x = np.repeat(centre, 40, axis=0) + np.round(rng.normal(size=(240, 4)), 1)
    x[5:20] = x[5]
    table = [(i, [float(v) for v in x[i]], "a", 1) for i in range(240)]
    schema = "vec_id long, embedding array<double>, score string, shard int"
    odd = [(None, [1.0] * 4, "a", 1), (900, None, "a", 1), (901, [], "a", 1), (902, [1.0], "a", 1), (7, table[7][1], "a", 1)]
    assert rows(K.top_k(spark.createDataFrame(table + odd, schema), 5, every=1)) == brute(list(range(240)), x, 5)
    few = spark.createDataFrame([(1, [1.0, None], "a", 1), (2, [float("nan"), 3.0], "a", 1)], schema)
    assert rows(K.top_k(few, 5, every=1)) == {(1, 1, 2, 0.0), (2, 1, 1, 0.0)}
    assert K.top_k(spark.createDataFrame([], schema)).collect() == []
    assert {r.vec_id for r in K.top_k(spark.createDataFrame(table + odd, schema), 5).collect()} == set(range(0, 240, 20))


def test_axes_and_rests_stop_the_search_where_vectors_have_structure():
    """64 dimensions of which four carry nearly all: by the lists of principal axes and of rests, queries stop early. Without structure (the driver's embeddings) none do."""
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    x = (rng.normal(size=(4000, 64)) * np.r_[8, 4, 2, 1, np.full(60, 0.01)]) @ turn
    shard = K.Shard(np.arange(4000), x, K.principal(x))
    scored = [0]
    q = np.arange(0, 4000, 20)
    found = {}
    for i in q:
        before, best = 0, []
        for rows_, low, high in shard.steps:
            before += len(rows_)
            best = sorted([*best, *(np.round(x[rows_[rows_ != i]] @ x[i], K.DIGITS))])[-5:]
            if K.bounds(K.turned(x[i : i + 1], shard.axes), low, high)[0] + K.SLACK < best[0]:
                break
        scored.append(before / 4000)
        found[i] = best
    got = {}
    for r, s, _ in shard.search(q, x[q], np.full(len(q), -np.inf), 5):
        for a, b in zip(r, s):
            got.setdefault(q[a], []).append(b)
    for i in q:
        s = np.round(x @ x[i], K.DIGITS)
        s[i] = -np.inf
        assert sorted(got[i]) == sorted(s)[-5:] == found[i]
    assert np.mean(scored[1:]) < 0.5
