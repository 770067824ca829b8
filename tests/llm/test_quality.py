import numpy as np

from colophon.llm import quality as Q
from colophon.llm import textops as T

SCHEMA = "doc_id long, text string, y string, held int, x double"


def test_isotonic_equals_the_minimax_formula():
    rng = np.random.default_rng(0)
    s, y = np.round(rng.normal(size=60), 1), rng.integers(0, 2, 60).astype(float)
    level, value = Q.isotonic(s, y)
    order = np.unique(s)
    total, count = np.array([y[s == v].sum() for v in order]), np.array([(s == v).sum() for v in order])
    mean = lambda a, b: total[a : b + 1].sum() / count[a : b + 1].sum()
    want = np.array([max(min(mean(a, b) for b in range(k, len(order))) for a in range(k + 1)) for k in range(len(order))])
    assert (np.diff(value) > 0).all() and (np.diff(level) > 0).all()
    assert np.allclose(np.unique(want.round(9)), value)


def test_statistics_against_plain_python():
    text = "The cat. The CAT, the dog\n12 ré###"
    raw = np.frombuffer(text.encode(), np.uint8)
    x = dict(zip(Q.STATISTICS, Q.statistics_of(T.words_of(raw, np.array([0, len(raw)])))[0]))
    words = ["the", "cat", "the", "cat", "the", "dog", "12", "ré"]
    assert np.isclose(x["log_words"], np.log1p(8)) and np.isclose(x["distinct"], len(set(words)) / 8) and np.isclose(x["commonest"], 3 / 8)
    assert np.isclose(x["marks"], 5 / len(raw)) and np.isclose(x["upper"], 5 / len(raw)) and np.isclose(x["digits"], 2 / len(raw)) and np.isclose(x["lines"], 1 / len(raw))
    assert x["echo"] == 0 and np.isclose(x["word_mean"], np.mean([len(w.encode()) for w in words]))


def test_held_out_accuracy_and_normal_equations(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = Q.fit(docs, labels, sample=250)
    used = {r.id for r in labels.selectExpr("cast(doc_id as long) id").selectExpr("*", "xxhash64(id) h").orderBy("h", "id").limit(250).collect()}
    got = {r.doc_id: r for r in Q.scores(docs, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect() if r.doc_id not in used}
    assert np.mean([got[d].keep == bool(q) for d, q in truth.items()]) > 0.93
    assert np.mean([got[d].keep for d, q in truth.items() if q]) > 0.95
    assert set(got) == {r.doc_id for r in docs.collect()}
    kept = {r.doc_id for r in Q.accepted(docs, model).collect()}
    assert kept == {d for d, r in got.items() if r.keep}

    def plain(x, y):  # the same from one matrix
        z = model.features(x)
        return np.linalg.solve(z.T @ z + Q.RIDGE * np.eye(z.shape[1]), z.T @ y)

    larger = [spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels")]
    keep = {r.doc_id: r.keep for r in Q.scores(larger[0], Q.fit(larger[0], larger[1].where("doc_id % 2 = 0"))).collect()}
    held = [(keep[r.doc_id], bool(r.quality)) for r in larger[1].where("doc_id % 2 = 1").collect()]
    assert np.mean([k == q for k, q in held]) > 0.99 and np.mean([k for k, q in held if q]) > 0.99

    ids = labels.selectExpr("cast(doc_id as long) id", "cast(quality as double) y").selectExpr("*", "pmod(xxhash64(id, 'held'), 5) = 0 held", "xxhash64(id) h").orderBy("h", "id").limit(250).toPandas()
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = [(Q.statistics_of(T.words_of(np.frombuffer(texts[i].encode(), np.uint8), np.array([0, len(texts[i].encode())])))[0], y) for i, y, h in zip(ids.id, ids.y, ids.held) if not h]
    assert np.allclose(plain(np.array([r[0] for r in rows]), np.array([r[1] for r in rows])), model.beta, atol=1e-6)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "c", 1, 0.5), (2, "", "c", 1, 0.5), (None, "some words", "c", 1, 0.5), (3, "x " * 50000, "c", 1, 0.5), (3, "x " * 50000, "c", 1, 0.5)], SCHEMA)
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert Q.fit(docs, none) is None
    assert [r.keep for r in Q.scores(docs, None).collect()] == [True] * 5
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (3, 1), (None, 1)], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    assert len(Q.scores(docs, model).collect()) == 5 and Q.accepted(docs, model).columns == docs.columns
    empty = spark.createDataFrame([], SCHEMA)
    assert Q.fit(empty, labels) is None and Q.scores(empty, model).collect() == [] and Q.accepted(empty, model).collect() == []
