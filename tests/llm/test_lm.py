import math
import re
from collections import Counter

import numpy as np

from colophon.llm import lm as L

SCHEMA = "doc_id long, text string, piece string, held int"


def words_of(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def exact_em(rows, words, rounds=300):
    """Weights from unrounded estimates, by plain loops over events."""
    by = {}
    for b, p in rows:
        by.setdefault(b, []).append([*p, 1 / (words + 1)])
    out = {}
    for b, p in by.items():
        p, w = np.array(p), np.full(4, 0.25)
        for _ in range(rounds):
            s = w * p
            w = ((s / s.sum(axis=1, keepdims=True)).sum(axis=0) + L.PRIOR) / (len(p) + 4 * L.PRIOR)
        out[b] = w
    return out


def brute(rows, weights=None):
    """The same by dictionaries of words, each document scored with its own counts deleted; weights: to be used instead of exact ones."""
    docs = [(i, words_of(t)) for i, t in rows if i is not None]
    held = [bool(L.held_out(np.array([i]))[0]) for i, _ in docs]
    events = [list(zip(["<>", "<>", *w], ["<>", *w], [*w, "<>"])) if w else [] for _, w in docs]

    def tables(some):
        one, two, three, c1, c2 = Counter(), Counter(), Counter(), Counter(), Counter()
        for e in some:
            for k, (u, v, w) in enumerate(e):
                one[w] += 1
                two[v, w] += 1
                three[k == 0, u, v, w] += 1
                c1[v] += 1
                c2[k == 0, u, v] += 1
        return one, two, three, c1, c2

    def parts(t, own, k, u, v, w):
        one, two, three, c1, c2 = (lambda key, a=a, b=b: a[key] - b[key] for a, b in zip(t, own))
        n = sum(t[0].values()) - sum(own[0].values())
        x, y = c2((k == 0, u, v)), c1(v)
        bucket = min(int(math.log2(x + 1)), L.BUCKETS2) * (L.BUCKETS1 + 1) + min(int(math.log2(y + 1)), L.BUCKETS1)
        return bucket, (three((k == 0, u, v, w)) / x if x else 0.0, two((v, w)) / y if y else 0.0, one(w) / n if n else 0.0)

    every, train = tables(events), tables([e for e, h in zip(events, held) if not h])
    words, none = len(every[0]), tables([])
    used = [parts(train, none, k, *x) for e, h in zip(events, held) if h for k, x in enumerate(e)]
    weights = weights or exact_em(used, words)
    out = []
    for (i, w), e in zip(docs, events):
        own = tables([e])
        logs = [math.log(weights.get(b, np.full(4, 0.25)) @ np.array([*p, 1 / (words + 1)])) for b, p in (parts(every, own, k, *x) for k, x in enumerate(e))]
        out.append((i, len(w), sum(logs) if e else None, math.exp(-sum(logs) / len(e)) if e else None))
    return sorted(out, key=str), weights, words, used


def result(df):
    return sorted(((r.doc_id, r.n_words, r.log_probability, r.perplexity) for r in df.collect()), key=str)


def close(a, b, by):
    return len(a) == len(b) and all(x[:2] == y[:2] and (x[2] is None) == (y[2] is None) and (x[2] is None or abs(x[2] - y[2]) <= by * (x[1] + 1)) for x, y in zip(a, b))


def corpus(seed=4, n=300):
    rng = np.random.default_rng(seed)
    rows = [(i, " ".join(f"W{min(int(x), 200)}" for x in rng.zipf(1.3, rng.integers(1, 60)))) for i in range(n)]
    return rows + [(300, None), (301, ""), (302, " .,"), (303, "the " * 20000), (None, "lost"), (5, "twice ÉTÉ"), (5, "twice ÉTÉ")]


def test_against_brute_force_and_edge_cases(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    want, weights, words, used = brute(rows)
    for options in ({"shard": 300, "piece": 2000}, {}):
        assert close(result(L.scores(docs, **options)), want, 0.05)  # all but the rounding of the histogram
    # the weights of the histogram, as it is made of the same events, and with them the scores to the last digit
    step = lambda p: round(math.log(p) * L.STEP) / L.STEP if p > 0 else L.ZERO
    histogram = [(*k, n) for k, n in sorted(Counter((b, *map(step, p)) for b, p in used).items())]
    rounded = L.learned(histogram, words)
    assert max(np.abs(rounded[b] - w).max() for b, w in weights.items()) < 0.1
    assert close(result(L.scores(docs, shard=300)), brute(rows, {b: rounded[b] for b in weights})[0], 2e-5)
    assert np.allclose(rounded.sum(axis=1), 1) and L.scores(spark.createDataFrame([], SCHEMA)).collect() == []
    one = [(1, "a b a b")]
    assert close(result(L.scores(spark.createDataFrame([(*one[0], "x", 1)], SCHEMA))), brute(one)[0], 1e-5)


def test_known_text_scores_better_than_new_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    text = max((r.text for r in docs.collect()), key=len).split()
    backwards = " ".join(text[::-1])
    new = " ".join(sorted(text, key=lambda x: x[::-1]))
    both = docs.union(spark.createDataFrame([(10**6, " ".join(text)), (10**6 + 1, new), (10**6 + 2, backwards), (10**6 + 3, backwards)], docs.schema))
    p = {r.doc_id: r.perplexity for r in L.scores(both).where("doc_id >= 1000000").collect()}
    assert p[10**6] < 0.5 * p[10**6 + 1] and p[10**6 + 2] < 0.5 * p[10**6 + 1]  # what stands twice is known, what stands once isn't


def test_packing_of_integers():
    for x in ([0, 1, 255, 256, 70000, 2**32 - 1, 2**62], [0, 0, 0], []):
        assert L.unpacked(L.packed(np.array(x, np.int64))).tolist() == x
