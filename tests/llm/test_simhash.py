import tracemalloc

import numpy as np
import pytest

from colophon.llm import simhash as S
from colophon.llm import textops as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, s0 string, a string"


def rows(texts):
    return [(i, t, "en", "x", len(t or ""), 1, "clash", "clash") for i, t in texts]


def words(rng, n):
    return ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]


def test_trie_pairs_equal_brute_force():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 16, 40, dtype=np.uint64)
    key = np.sort(np.concatenate([base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 16, 12)] + [base, base]))
    want = {(i, j) for i in range(len(key)) for j in range(i + 1, len(key)) if key[i] >> np.uint64(12) == key[j] >> np.uint64(12) and (key[i] ^ key[j]).item().bit_count() <= 3}
    for most in (7, 1 << 19):
        got = [(a, b) for i, j in S.trie_pairs(key, 4, 16, 3, most) for a, b in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got)) and set(got) == want


def test_forest():
    assert S.forest(6, np.array([1, 4, 2]), np.array([2, 5, 0])).tolist() == [0, 0, 0, 3, 4, 4]


def test_groups_and_edge_cases(spark):
    rng = np.random.default_rng(2)
    long = words(rng, 300)
    near = long[:100] + ["changed"] + long[101:]
    other = words(rng, 300)
    texts = [(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(other)), (4, " ".join(other)), (4, " ".join(other)), (5, None), (6, ""), (7, "?!"), (None, " ".join(long)), (8, " ".join(words(rng, 20000)))]
    texts += [(4, " ".join(words(rng, 200))), (9, " ".join(near))]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    got = S.near_duplicates(docs)
    assert got.columns == ["doc_id", "class_id", "duplicate_of", "n_copies", "n_links"]
    assert {tuple(r) for r in got.collect()} == {(1, 1, None, 0, 1), (2, 1, 1, 1, 1), (9, 1, 1, 1, 1), (3, 3, None, 1, 0), (4, 3, 3, 1, 0)}
    kept = S.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, len(r.text or "") > 10) for r in kept.collect()) == [(0, True), (1, True), (3, True), (4, True), (5, False), (6, False), (7, False), (8, True)]
    none = spark.createDataFrame([], SCHEMA)
    assert S.near_duplicates(none).collect() == [] and S.without_near_duplicates(none).collect() == []
    with pytest.raises(ValueError):
        S.near_duplicates(spark.createDataFrame([], SCHEMA), bits=35)


def test_each_route_puts_its_block_first_and_every_pair_has_one():
    rng = np.random.default_rng(6)
    key = rng.integers(0, 1 << 36, 20_000, dtype=np.uint64)
    other = key.copy()
    for _ in range(3):
        other ^= np.uint64(1) << rng.integers(0, 36, len(key)).astype(np.uint64)
    keys = np.stack([np.r_[key, other]] * 1, axis=1)
    i, j, found = np.arange(len(key)), np.arange(len(key)) + len(key), np.zeros(len(key), int)
    for k in range(4):
        a, b = S._rotated(key, k, 36, 3), S._rotated(other, k, 36, 3)
        assert (np.bitwise_count(a ^ b) == np.bitwise_count(key ^ other)).all()
        found += (a >> np.uint64(27) == b >> np.uint64(27)) & S.first_route(keys, i, j, 0, k, 36, 3)
    assert (found == 1).all()


def brute(docs):
    """ids, signatures, distances, and which pairs are links by all tables."""
    sig = S.signatures(docs).where("n_words > 0").toPandas().sort_values(["doc_id", "th"])
    x = sig[["s0", "s1", "s2", "s3"]].to_numpy().view(np.uint64)
    keys = S.table_keys(x)
    pairs = [(i, i + 1 + int(j)) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]).sum(axis=1) <= S.TOTAL)]
    i, j = np.array(pairs).T
    return sig.doc_id.to_numpy(), x, i, j, (np.bitwise_count(keys[i] ^ keys[j]) <= S.BUDGET).any(axis=1)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_classes_and_links_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    ids, x, i, j, link = brute(docs)
    label = S.forest(len(ids), i[link], j[link])
    size = np.bincount(label, minlength=len(ids))
    same = (x[i] == x[j]).all(axis=1)
    classes = np.unique(x, axis=0, return_inverse=True)[1]
    linked = [set() for _ in range(classes.max() + 1)]
    for a, b in zip(classes[i[link & ~same]].tolist(), classes[j[link & ~same]].tolist()):
        linked[a].add(b)
        linked[b].add(a)
    copies = np.bincount(classes)
    want = {(int(d), int(ids[label[k]]), None if label[k] == k else int(ids[label[k]]), int(copies[c]) - 1, len(linked[c])) for k, (d, c) in enumerate(zip(ids, classes)) if size[label[k]] > 1}
    assert {tuple(r) for r in S.near_duplicates(docs).collect()} == want and len(want) > 20
    assert link.mean() > 0.98  # of all pairs up to TOTAL


def test_signature_matches_a_plain_one():
    text = "The tree stands by the tall river"
    w = T.words_of(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    sig, n = S.signatures_of(w)
    total = np.zeros(256)
    for x in dict.fromkeys(text.lower().split()):
        h = T.hash_words([x])
        four = np.concatenate([T.mix(h + np.uint64(0xA0761D6478BD642F * (j + 1) % (1 << 64))) for j in range(4)])
        total += (2.0 * np.unpackbits(four.view(np.uint8), bitorder="little") - 1) * min(max(len(x) - 1, 0.25), 9)
    assert n[0] == 6 and (np.unpackbits(sig[0].view(np.uint8), bitorder="little") == (total > 0)).all()


def test_signatures_of_many_and_of_long_documents_take_bounded_memory():
    rng = np.random.default_rng(9)
    texts = [" ".join(f"{x:x}" for x in rng.integers(1, 1 << 40, n)) for n in [5000] * 60 + [S.PORTION - 1, S.PORTION, S.PORTION + 1, 3 * S.PORTION, 1]]
    raw = [t.encode() for t in texts]
    w = T.words_of(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])])
    tracemalloc.start()
    sig, n = S.signatures_of(w)
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert most < 100 and n[-2] > 12_000  # 440 MB when the bits of 64 documents were held at a time
    for k in range(len(texts) - 5, len(texts)):
        each = list(dict.fromkeys(texts[k].split()))
        h = T.hash_words(each)
        bits = np.unpackbits(np.stack([T.mix(h + np.uint64(0xA0761D6478BD642F * (j + 1) % (1 << 64))) for j in range(4)], axis=1).view(np.uint8), axis=1, bitorder="little")
        weight = np.clip([len(x) - 1 for x in each], 0.25, 9)
        assert n[k] == len(each) and (np.unpackbits(sig[k].view(np.uint8), bitorder="little") == (weight @ bits * 2 > weight.sum())).all()
