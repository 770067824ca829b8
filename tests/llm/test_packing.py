import numpy as np
import pytest

from colophon.llm import packing as P
from colophon.llm import textops as T

SCHEMA = "doc_id long, text string, key string, part int, x0 double"


@pytest.mark.parametrize(("dims", "depth"), [(2, 3), (3, 2), (3, 3)])
def test_hilbert_visits_every_cell_in_steps_of_one(dims, depth):
    cells = np.stack(np.meshgrid(*[np.arange(1 << depth)] * dims), axis=-1).reshape(-1, dims)
    key = P.hilbert(cells, depth)
    assert sorted(key.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def brute(rows, capacity):
    """Packs of (doc_id, text) rows, from one list."""
    raw = [t.encode() for _, t in rows]
    w = T.words_of(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])])
    x, n = P.projected(w), np.diff(w.first)
    x, n, ids = x[n > 0], n[n > 0], [r[0] for r, k in zip(rows, n) if k]
    low, width = x.min(axis=0), np.maximum(x.max(axis=0) - x.min(axis=0), 1e-12)
    key = P.hilbert(np.clip((x - low) / width * 1024, 0, 1023).astype(int), 10)
    out, at = [], 0
    for k, i, m in sorted(zip(key.tolist(), ids, n.tolist())):
        first = 0
        while first < m:
            take = min(m - first, capacity - at % capacity)
            out.append((at // capacity, at % capacity, i, k, first, take))
            first, at = first + take, at + take
    return sorted(out)


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for capacity in (64, 4096):
        got = P.packs(docs, capacity).collect()
        assert sorted(tuple(r)[:6] for r in got) == brute(rows, capacity)
        texts = {}
        for r in sorted(got, key=lambda r: r.first_word):
            texts[r.doc_id] = texts.get(r.doc_id, "") + r.text
            x = r.text.encode()
            assert len(T.words_of(np.frombuffer(x, np.uint8), np.array([0, len(x)])).hash) == r.n_words
        assert texts == {i: t for i, t in rows if i in texts} and len(texts) > 190


def test_neighbours_are_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    order = [r.doc_id for r in P.packs(docs).orderBy("pack_id", "position").collect()]
    same = np.mean([lang[a] == lang[b] for a, b in zip(order, order[1:])])
    chance = sum(np.mean([v == x for v in lang.values()]) ** 2 for x in set(lang.values()))
    assert same > chance + 0.2


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "c", 1, 0.0), (2, "", "c", 1, 0.0), (None, "a b", "c", 1, 0.0), (3, "w " * 30000, "c", 1, 0.0), (4, "one two", "c", 1, 0.0), (4, "one two", "c", 1, 0.0)], SCHEMA)
    got = P.packs(docs).collect()
    assert sum(r.n_words for r in got) == 30004 and {r.doc_id for r in got} == {3, 4}
    by = {}
    for r in got:
        by[r.pack_id] = by.get(r.pack_id, 0) + r.n_words
    assert all(v == P.CAPACITY for k, v in by.items() if k < max(by))
    assert P.packs(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        P.packs(docs, 0)


def test_keys_take_one_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "one two", "c", 1, 0.0), (2, "", "c", 1, 0.0), (3, "three", "c", 1, 0.0), (None, "four", "c", 1, 0.0)], SCHEMA)
    keys = P.curve_keys(docs)
    assert keys._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.text, r.n_words) for r in keys.collect()) == [(1, "one two", 2), (3, "three", 1)]


def test_texts_are_exchanged_once(spark, tmp_path):
    """However soon the files of an exchange are deleted: bytes written by all exchanges, against those of one of the texts."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"{x:x}" for x in rng.integers(0, 1 << 60, 500)), "c", 1, 0.0) for i in range(400)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    context = spark.sparkContext._jsc.sc()

    def written():
        context.listenerBus().waitUntilEmpty(30_000)
        executors = context.statusStore().executorList(True)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    def exchanged(df):
        before = written()
        df().write.format("noop").mode("overwrite").save()
        return written() - before

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large for it
    try:
        once = exchanged(lambda: docs.repartitionByRange("doc_id"))
        assert once > 10**6
        assert exchanged(lambda: P.packs(docs)) < 1.3 * once
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sums_go_on_from_batch_to_batch(spark):
    """Parts of the sort with many Arrow batches."""
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', int(id % 7) + 1) as text")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = P.packs(docs, 50).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(tuple(r)[:6] for r in got) == brute([(i, "w " * (i % 7 + 1)) for i in range(3000)], 50)
