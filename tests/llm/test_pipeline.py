import corpus_pipeline as C
from colophon.llm import quality, simhash, suffix_dedup, toxicity
from colophon.llm.common import DOCUMENT_COLUMNS

SF = "/root/testdata/sf0.01"


def test_each_stage_does_what_its_operator_says(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r for r in labels.collect()}
    out, before = {}, docs
    for name, f in C.STAGES:
        after = f(spark, before, SF).cache()
        out[name] = (before, after)
        if name != "packing":
            assert after.columns == DOCUMENT_COLUMNS
        before = after
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    a, b = out["quality"]
    good = {d for d, r in truth.items() if r.quality}
    assert len(ids(b) & good) > 0.97 * len(good) and len(ids(b) & (set(truth) - good)) < 0.1 * len(set(truth) - good)
    a, b = out["toxicity"]
    assert ids(b) == ids(a) - ids(toxicity.toxic_documents(a, toxicity.learned_insults(a, labels)))
    a, b = out["near_duplicates"]
    assert ids(b) == ids(a) - ids(simhash.near_duplicates(a).where("duplicate_of is not null")) and simhash.near_duplicates(b).count() < 0.1 * simhash.near_duplicates(a).count() + 1
    a, b = out["repeated_passages"]
    had = {(r.doc_id): len(r.text.split()) for r in a.collect()}
    cut = {}
    for r in suffix_dedup.repeats(a).collect():
        cut.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.copied_words))
    want = {d: n - len(cut.get(d, ())) for d, n in had.items()}
    got = {r.doc_id: len(r.text.split()) for r in b.collect()}
    assert got == {d: n for d, n in want.items() if n or not had[d]}
    a, b = out["packing"]
    assert ids(b) == {r.doc_id for r in a.collect() if any(c.isalnum() for c in r.text)}


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in C.STAGES:
        docs = f(spark, docs, SF)
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_no_rows(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert C.run(spark, str(tmp_path)).collect() == []


def test_nulls_long_and_empty_texts_repeated_rows_and_other_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*DOCUMENT_COLUMNS)
    some = docs.where("doc_id < 60")
    good = docs.where("n_chars > 2000").orderBy("doc_id").first()
    odd = [(None, good.text, "en", "x", 5), (10**6, None, None, None, None), (10**6 + 1, "", "en", "x", 0), (10**6 + 2, good.text * 30, "en", "x", 1), (10**6 + 3, good.text, "en", "x", 1), (10**6 + 3, good.text, "en", "x", 1), (10**6 + 3, good.text[::-1], "en", "x", 1), (10**6 + 4, "w " * 30000, "en", "x", 1)]
    both = some.union(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "1 as th", "2 as row", "3 as text_hash", "4 as pack_id")
    both.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, f in C.STAGES:
        before, d = d, f(spark, d, str(tmp_path)).cache()
        if name == "near_duplicates":
            assert d.where("doc_id is null").count() == before.where("doc_id is null").count()
            assert d.groupBy("doc_id", "text").count().where("count > 1 and doc_id is not null").count() == 0
        if name != "packing":
            assert d.columns == DOCUMENT_COLUMNS
    assert {"doc_id", "text"} <= set(d.columns) and d.where("doc_id is null").count() == 0
