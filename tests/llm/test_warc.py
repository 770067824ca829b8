import duckdb

from colophon.llm import warc as W

SF = "/root/testdata/sf0.01"


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_against_sql_with_repeats(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    more = pages.selectExpr("page_id + 10000", "concat(url, '#again')", "html").where("page_id % 3 = 0")
    odd = spark.createDataFrame([(1, None, None), (1, "x\r\ny", ""), (1, "x\r\ny", ""), (None, "n", "n"), (5, "é", "é\r\n\r\nWARC/1.1")], "page_id long, url string, html string")
    pages.union(more).union(odd).withColumn("digest", pages.page_id).write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.sql(f"create view pages as select page_id, url, html from read_parquet('{tmp_path}/pages/*.parquet')")
    got = W.deduplicated(spark.read.parquet(str(tmp_path / "pages")))
    want = con.sql(W.sql())
    assert got.columns == want.columns
    found = rows(got)
    assert found == sorted(map(str, want.fetchall()))
    assert sum("'revisit'" in x for x in found) >= more.count()


def test_round_trip_and_resolution(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "same"), (2, "b", "same"), (3, "c", "other \r\n\r\n text é"), (4, "d", "same"), (5, "e", None)], "page_id long, url string, html string")
    made = W.deduplicated(pages)
    assert sum(r.n_records for r in W.write_archive(made, str(tmp_path / "w")).collect()) == 5
    back = W.read_archive(spark, str(tmp_path / "w"))
    got = {r.uri: r for r in back.where("warc_type <> 'warcinfo'").collect()}
    assert {u: r.warc_type for u, r in got.items()} == {"a": "response", "b": "revisit", "c": "response", "d": "revisit", "e": "response"}
    assert bytes(got["c"].block).decode().split("\r\n\r\n", 1)[1] == "other \r\n\r\n text é"
    found = {r.uri: (r.original_uri, r.original_id) for r in W.resolved(back).collect()}
    assert found == {"b": ("a", got["a"].record_id), "d": ("a", got["a"].record_id)} and got["b"].refers_to == got["a"].record_id
    lone = spark.createDataFrame([("r", "revisit", "u", "d", "x", None, None), ("s", "revisit", "u", "d", None, None, None)], W.ARCHIVE)
    assert {r.original_id for r in W.resolved(lone).collect()} == {None}
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.deduplicated(empty).collect() == [] and W.resolved(spark.createDataFrame([], W.ARCHIVE)).collect() == []


def test_round_trip_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{SF}/pages.parquet'")
    want = con.sql(W.round_trip_sql())
    got = W.round_trip(spark.read.parquet(f"{SF}/pages.parquet"))
    assert got.columns == want.columns
    found = rows(got)
    assert found == sorted(map(str, want.fetchall())) and len(found) >= 250 and "None" not in found[0]


def test_reading_is_linear_and_streams(tmp_path):
    import gzip
    import time

    record = lambda i: f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: {i}\r\nContent-Length: 500\r\n\r\n{'x' * 500}\r\n\r\n".encode()
    times = []
    for n in (4000, 32000):
        content = b"".join(gzip.compress(record(i), 1, mtime=0) for i in range(n))
        began = time.time()
        found = list(W.records_of(content[i : i + 65536] for i in range(0, len(content), 65536)))
        times.append(time.time() - began)
        assert [r[0] for r in found] == [str(i) for i in range(n)] and all(len(r[-1]) == 500 for r in found)
    assert times[1] < 30 * times[0]
    plain = b"".join(map(record, range(50)))
    assert len(list(W.records_of(plain[i : i + 7] for i in range(0, len(plain), 7)))) == 50 and list(W.records_of(iter([plain[:400]]))) == []
    long = b"WARC/1.1\r\nContent-Length: 20000000\r\n\r\n" + b"y" * 20_000_000
    assert len(next(W.records_of(long[i : i + 65536] for i in range(0, len(long), 65536)))[-1]) == 20_000_000
