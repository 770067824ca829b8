from collections import defaultdict

import numpy as np
import pytest

from colophon.llm import suffix_dedup as R

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, anchor string, at int"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "en", "x", len(t or ""), "clash", 3) for i, t in docs], SCHEMA)


def brute(docs, length):
    """{words of a maximal repeat: its occurrences}, from all pairs of suffixes."""
    words = {d: t.split() for d, t in docs}
    at = defaultdict(list)
    for d, w in words.items():
        for p in range(len(w) - length + 1):
            at[tuple(w[p : p + length])].append((d, p))
    found = set()
    for places in at.values():
        for x in range(len(places)):
            for y in range(x):
                (d, p), (e, q) = places[x], places[y]
                a, b = words[d], words[e]
                if p and q and a[p - 1] == b[q - 1]:
                    continue
                n = 0
                while p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n]:
                    n += 1
                found.add(tuple(a[p : p + n]))
    return {s: {(d, p) for d, w in words.items() for p in range(len(w) - len(s) + 1) if tuple(w[p : p + len(s)]) == s} for s in found}


def groups(rows, docs):
    words = {d: t.split() for d, t in docs}
    children, own, size, text = defaultdict(set), defaultdict(set), {}, {}
    for r in rows:
        own[r.group_id].add((r.doc_id, r.start_word))
        size[r.group_id] = r.n_occurrences
        text[r.group_id] = tuple(words[r.doc_id][r.start_word : r.start_word + r.n_words])
        if r.parent_id is not None:
            children[r.parent_id].add(r.group_id)

    def all_of(g):
        return own[g].union(*(all_of(c) for c in children[g]))

    got = {text[g]: all_of(g) for g in own}
    assert all(len(got[text[g]]) == size[g] for g in own)
    return got


def corpus(seed, n=14, vocabulary=4000):
    rng = np.random.default_rng(seed)
    def new(k):
        return [f"w{x}" for x in rng.integers(0, vocabulary, k)]
    docs, pool = [], [new(int(k)) for k in rng.integers(8, 60, 6)]
    for i in range(n):
        parts = []
        for _ in range(int(rng.integers(1, 5))):
            p = list(pool[int(rng.integers(len(pool)))])
            a = int(rng.integers(0, max(1, len(p) - 6)))
            parts += p[a:] + new(int(rng.integers(0, 6)))
        docs.append((i, " ".join(parts)))
    docs += [(n, docs[0][1]), (n + 1, docs[1][1] + " tail"), (n + 2, docs[1][1])]
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    docs = corpus(seed)
    rows = R.repeats(frame(spark, docs), length=8, gram=4, barrier=1 << 62).collect()
    assert groups(rows, docs) == brute(docs, 8)


def covered(docs, length):
    """(doc, word) covered by a run of `length` words that also stands earlier."""
    first, out = {}, set()
    for d, t in sorted(docs):
        w = t.split()
        for p in range(len(w) - length + 1):
            g = tuple(w[p : p + length])
            if g in first:
                out |= {(d, p + k) for k in range(length)}
            first.setdefault(g, (d, p))
    return out


@pytest.mark.parametrize("barrier", [2, 16, 1 << 62])
def test_copied_words_cover_what_stands_earlier(spark, barrier):
    docs = corpus(5, 20)
    rows = R.repeats(frame(spark, docs), length=8, gram=4, barrier=barrier).collect()
    assert {(r.doc_id, r.start_word + k) for r in rows for k in range(r.copied_words)} == covered(docs, 8)


def test_edge_cases(spark):
    rng = np.random.default_rng(9)
    p = " ".join(f"p{x}" for x in rng.integers(0, 10**6, 60))
    fill = lambda n: " ".join(f"f{x}" for x in rng.integers(0, 10**9, n))
    docs = [(1, f"{fill(30)}\n{p} {fill(20)}"), (2, f"{fill(5)} {p}\t{fill(3)}"), (3, fill(200)), (4, None), (5, ""), (6, "junk " * 3000), (7, fill(20000) + " " + p), (None, p), (8, p), (8, p)]
    got = sorted((r.doc_id, r.start_word, r.n_words, r.copied_words) for r in R.repeats(frame(spark, docs)).collect() if r.doc_id != 6)
    assert got == [(1, 30, 60, 0), (2, 5, 60, 60), (7, 20000, 60, 60), (8, 0, 60, 60)]
    kept = {r.doc_id: r for r in R.without_repeats(frame(spark, docs)).collect()}
    assert set(kept) == {1, 2, 3, 4, 5, 6, 7, None}
    assert kept[1].text == docs[0][1] and p not in kept[2].text and kept[2].n_chars == len(kept[2].text) and kept[2].anchor == "clash"
    assert len(kept[7].text.split()) == 20000 and kept[None].text == p
    assert R.repeats(frame(spark, [])).collect() == [] and R.without_repeats(frame(spark, [])).collect() == []


def test_rows_that_repeat_an_id_are_cut_by_their_own_text(spark):
    rng = np.random.default_rng(3)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**8, n)]
    p = new(60)
    texts = [(1, p + new(20)), (2, ["short", "text", "of", "four"]), (2, new(30) + p), (2, new(200)), (3, new(5) + p), (3, new(5) + p), (4, new(70)), (4, p)]
    texts.append(texts[4])  # equal to another row
    frame_ = spark.createDataFrame([(i, " ".join(w), "clash", 5) for i, w in texts], "doc_id long, text string, _id string, cuts int")
    got = R.without_repeats(frame_)
    assert got.columns == frame_.columns
    kept = sorted((r.doc_id, r.text) for r in got.collect())
    want = [(i, " ".join(w if i == 1 else [x for x in w if x not in p])) for i, w in texts]
    assert kept == sorted(x for x in want if x[1])
    found = R.repeats(frame_).collect()
    assert len({(r.doc_id, r.text_hash) for r in found}) == 5 and {r.n_occurrences for r in found} == {5}


@pytest.mark.parametrize("period", [1, 2, 7, 10, 25, 26])
def test_periodic_stretches_are_covered_whole(spark, period):
    rng = np.random.default_rng(period)
    line = [f"p{k}" for k in range(period)]
    fill = lambda n: [f"f{x}" for x in rng.integers(0, 10**9, n)]
    cut = lambda a, n: (line * (n // period + 2))[a % period :][:n]
    head, tail = fill(30), fill(30)
    docs = [cut(0, 400), cut(0, 600), cut(0, 10000), fill(9) + cut(3, 70) + fill(9), head + cut(5, 300) + tail, head + cut(5, 120) + fill(3), fill(8) + cut(2, 90) + tail, cut(1, 55), head + cut(5, 90) + tail, head[5:] + cut(5, 27) + fill(3)]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    rows = R.repeats(frame(spark, docs)).collect()
    assert {(r.doc_id, r.start_word + k) for r in rows for k in range(r.copied_words)} == covered(docs, R.LENGTH)


def test_coverage_of_the_small_table_is_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r.doc_id, r.start_word + k) for r in R.repeats(docs).collect() for k in range(r.copied_words)}
    want = covered([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], R.LENGTH)
    assert got == want


def test_groups_of_long_repeats_are_maximal_with_production_parameters(spark):
    rng = np.random.default_rng(4)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    long, other = new(5000), new(1200)
    docs = [long, new(20) + long, long[700:3100] + new(40) + other, other + new(9) + long[2000:], new(300) + other[100:900] + new(5), other]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    assert groups(R.repeats(frame(spark, docs)).collect(), docs) == brute(docs, R.LENGTH)
