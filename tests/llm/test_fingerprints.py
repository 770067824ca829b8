import hashlib

import duckdb
import pytest

from colophon.llm import fingerprints as P

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, h string, sketch int, item_id int"


def value(words):
    return sum(int(hashlib.md5(x.encode()).hexdigest()[:15], 16) * f for x, f in zip(words, P.factors(5))) % 2**64 >> 4


def plain(text, n=5, fraction=1 / 16):
    w = (text or "").split()
    s = {value(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()
    return {h for h in s if h < fraction * 2**60}


def test_against_sql(spark):
    got = P.fingerprints(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark")))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(P.sql())
    assert got.columns == want.columns
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want.fetchall()))


def test_merge_and_containment(spark):
    a, b = " ".join(f"a{i}" for i in range(3000)), " ".join(f"b{i}" for i in range(100))
    docs = spark.createDataFrame([(1, f"{a} {b}", "x", 1, 1), (2, b, "x", 1, 1), (3, a, "x", 1, 1)], SCHEMA)
    s = P.sketches(docs, fraction=0.5)
    sets = {r.doc_id: set(r.sketch) for r in s.collect()}
    assert sets[2] == plain(b, fraction=0.5)
    pairs = {(r.doc_id, r.other): (r.a_in_b, r.b_in_a) for r in P.containment(s, s.withColumnRenamed("doc_id", "other"), "doc_id", "other").collect()}
    assert pairs[2, 1] == (1.0, len(sets[2]) / len(sets[1])) and (2, 3) not in pairs
    union = P.merged(s.withColumn("g", s.doc_id % 2), "g")
    assert {r.g: set(r.sketch) for r in union.collect()} == {1: sets[1] | sets[3], 0: sets[2]}


def test_edge_cases(spark):
    rows = [(1, None, "x", 1, 1), (2, " \n", "x", 1, 1), (3, "two words", "x", 1, 1), (4, "w " * 30000, "x", 1, 1), (4, "w " * 30000, "x", 1, 1), (None, "a", "x", 1, 1)]
    docs, items = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1, None), (None, "x"), (2, "w w w w w")], "item_id long, text string")
    got = [(r.doc_id, r.n_shingles, r.sketch, r.item_id, r.item_containment) for r in P.fingerprints(docs, items, fraction=1.0).collect()]
    h = str(value("wwwww"))
    assert sorted(got, key=str) == sorted([(1, 0, "", None, None), (2, 0, "", None, None), (3, 1, str(value(["two", "words"])), None, None), (4, 29996, h, 2, 1.0), (4, 29996, h, 2, 1.0)], key=str)
    assert P.fingerprints(spark.createDataFrame([], SCHEMA), items).collect() == []
    with pytest.raises(ValueError):
        P.sketches(docs, fraction=0)


def test_short_benchmark_passages_are_found(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = P.passages(docs, items)
    want = con.sql(P.passages_sql())
    assert got.columns == want.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))

    # every item verbatim in a document of its own, two in one, and a document of one item's words twice: recall is whole
    rows = [(r.item_id, r.text) for r in items.collect()]
    assert any(not plain(t) for _, t in rows)  # items that the fraction leaves without a hash
    held = [(i, f"before it {t} after it", "x", 1, 1) for i, t in rows] + [(-1, f"{rows[0][1]} and {rows[1][1]}", "x", 1, 1), (-2, None, "x", 1, 1)]
    found = {(r.doc_id, r.item_id) for r in P.passages(spark.createDataFrame(held, SCHEMA), items).collect() if r.item_containment == 1}
    assert found >= {(i, i) for i, _ in rows} | {(-1, rows[0][0]), (-1, rows[1][0])}
    assert P.passages(spark.createDataFrame([], SCHEMA), items).collect() == []
