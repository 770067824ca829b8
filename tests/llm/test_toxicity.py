import re

import numpy as np

from colophon.llm import textops as T
from colophon.llm import toxicity as X

SCHEMA = "doc_id long, text string, score string, clauses int"


def found(text, extra=()):
    raw = np.frombuffer(text.encode(), np.uint8)
    w = T.words_of(raw, np.array([0, len(raw)]))
    return list(X.clauses_of(w, X.Lexicon.of(extra), X.grammar())), len(w.hash)


def score(text, extra=()):
    return [round(c.score, 6) for c in found(text, extra)[0]]


def total(text):
    return X.document_score(*found(text))


def test_insults():
    assert score("A plain text about you. It says nothing, ever.") == []
    assert score("What an idiot.") == [0.7] and total("What an idiot.") < X.THRESHOLD  # a lone word isn't enough
    assert score("You are an idiot") == [1.5] and score("such an Idiot, you") == [0.7]
    assert score("he is not an idiot") == [0.1] and score("il n'est pas un imbécile") == [0.1]
    assert score("she is a loser, he is not a loser") == [1.5, 0.1]
    assert total("idiots; clowns") >= X.THRESHOLD and total("fine words. " * 5000 + "scum. trash.") < X.THRESHOLD
    assert total("nobody likes you, drop dead") >= X.THRESHOLD and total("I hope you get cancer") >= X.THRESHOLD and total("please don't drop dead") < X.THRESHOLD


def test_reported_speech_goes_over_commas_and_quotation_marks():
    assert score("not that he said much of the old idiot") == [0.4]
    assert score('He said, "you are an idiot"') == [0.4] and score("he wrote: you are an idiot. You are an idiot") == [0.4, 1.5]
    assert total('He said "you idiot". ' * 50) < X.THRESHOLD and total("He is not an idiot. " * 50) < X.THRESHOLD


def test_threats():
    assert score("I will kill you") == [1.0] and score("we should hang them all") == [1.0] and score("ich werde dich töten") == [1.0]
    assert score("kill the lights") == [0.0] and score("he said we would kill him") == [0.4] and score("ich töte dich nicht") == [0.0] and score("I will never hurt you") == [0.0]
    for text in ("I will kill time with you", "We shoot photos of you", "They hang them on the wall", "Burn the candle for her"):
        assert total(text) < X.THRESHOLD


def test_composition_equals_running_one_after_another():
    rng = np.random.default_rng(3)
    machine, parts = X.grammar(), [X.negation(), X.reported(), X.insult(), X.target(), X.threat()]
    for _ in range(500):
        word = [X.NAMES[k] for k in rng.integers(0, len(X.NAMES), 14)]
        states, total_, state, got = [p.start for p in parts], 0, machine.start, 0
        for s in word:
            out = s
            for k, p in enumerate(parts):
                out, w, states[k] = p.step(states[k], out)
                total_ += w
            _, w, state = machine.step(state, s)
            got += w
        assert total_ == got


def plain(text, extra):
    """Score of a text by regular expressions, lists and the rules as the module states them, without machines; extra: words."""
    kinds, phrases = {x: "ABUSE" for x in extra}, []
    for lists in X.lexicon_data().values():
        for name, words in lists.items():
            if name == "ABUSE":
                phrases += [tuple(x.split()) for x in words]
            else:
                kinds |= dict.fromkeys(words, name)
    low = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x)
    find = lambda x: [(m.start(), low(m.group())) for m in re.finditer("[0-9A-Za-z\u0080-\U0010ffff]+", x)]
    rest = lone = told = 0.0
    for sentence in re.split("[.!?\n\r]", text or ""):
        report, items = False, []
        clause = 0
        at = 0
        for pos, x in find(sentence):
            clause += bool(re.search("[;:,]", sentence[at:pos])) and bool(items)
            items.append([clause, x, kinds.get(x, "OTHER")])
            at = pos + len(x)
        for n in sorted({len(p) for p in phrases}):
            for i in range(len(items) - n + 1):
                if tuple(x for _, x, _ in items[i : i + n]) in phrases:
                    for k in range(n):
                        items[i + k][2] = "ABUSE" if k == 0 else "OTHER"
        intent_in, targets, insults = {}, {}, {}
        for i, (c, _, k) in enumerate(items):
            same = [(j, items[j][2]) for j in range(len(items)) if items[j][0] == c]
            if k == "REPORT":
                report = True
            if k == "INTENT":
                intent_in[c] = i
            if k == "TARGET":
                targets.setdefault(c, []).append(i)
            if k not in ("INSULT", "ABUSE", "THREAT"):
                continue
            denied = any(name in ("NEGATION", "LATE_NEGATION") and 0 < i - j <= X.REACH for j, name in same) or any(name == "LATE_NEGATION" and 0 < j - i <= X.LATE + 1 for j, name in same)
            if denied:
                told += 0 if k == "THREAT" else X.DENIES
            elif k == "THREAT":
                weight = threat(same, i, report, intent_in.get(c))
                if report:
                    told += weight
                else:
                    rest += weight
            elif report:
                told += X.REPORTED
            elif k == "ABUSE":
                rest += X.ABUSIVE
            else:
                insults.setdefault(c, []).append(i)
        for c, places in insults.items():
            if any(k == "TARGET" and cc == c for cc, _, k in items):
                rest += X.LONE * len(places) + X.AIMED
            else:
                lone += X.LONE * len(places)
    return round(rest + lone * min(1, X.SPARSE * lone / X.LONE / max(len(find(text or "")), 1)) + min(told, X.TOLD), 6)


def threat(same, i, report, intent):
    """Weight of the threat at i: a target within reach after it, before another threat or intent; or, after an intent, a target within reach before it."""
    if intent is not None:
        before = [(j, k) for j, k in same if intent < j < i]
        last = max((j for j, k in before if k == "TARGET"), default=None)
        if last is not None and i - last <= X.OBJECT and all(k not in ("THREAT", "INTENT") for j, k in before if j > last):
            return X.REPORTED if report else X.MEANT
    for j, k in same:
        if i < j <= i + X.OBJECT:
            if k == "TARGET":
                return X.REPORTED if report else X.MEANT if intent is not None else X.LOOSE
            if k in ("THREAT", "INTENT"):
                break
    return 0.0


def test_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    extra = X.learned_insults(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = {low for t in texts.values() for low in set(re.findall("[0-9A-Za-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))}
    words = sorted(words)
    learned = {x for x, h in zip(words, T.hash_words(words).tolist()) if h in set(extra)}
    got = {r.doc_id: r.score for r in X.toxic_documents(docs, extra).collect()}
    want = {d: s for d, t in texts.items() if (s := plain(t, learned)) >= X.THRESHOLD}
    assert got == want and len(got) > 5
    rng = np.random.default_rng(8)
    pool = [w for lists in X.lexicon_data().values() for n, ws in lists.items() for w in ws] + ["a", "the", "b", "x"] * 20 + [",", ".", ":", "\n"] * 12
    for _ in range(400):
        text = " ".join(rng.choice(pool, 25))
        assert total(text) == plain(text, ()), text


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    even = labels.where("doc_id % 2 = 0")
    extra = X.learned_insults(docs, even)
    found_ = {r.doc_id for r in X.toxic_documents(docs, extra).collect()}
    truth = {r.doc_id: r.toxic for r in labels.where("doc_id % 2 = 1").collect()}
    toxic, clean = [d for d, t in truth.items() if t], [d for d, t in truth.items() if not t]
    assert np.mean([d in found_ for d in toxic]) > 0.9 and np.mean([d in found_ for d in clean]) < 0.01
    kept = {r.doc_id for r in X.without_toxic(docs, extra).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()} - found_


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "c", 1), (2, "", "c", 1), (None, "you idiot", "c", 1), (3, "fine words. " * 20000 + "you scum", "c", 1), (4, "trash\nfilth\n", "c", 1), (4, "trash\nfilth\n", "c", 1)], SCHEMA)
    got = X.toxic_documents(docs)
    assert sorted((r.doc_id or 0, r.score, r.n_clauses) for r in got.collect()) == [(0, 1.5, 1), (3, 1.5, 1), (4, 1.4, 2), (4, 1.4, 2)]
    assert got.where("doc_id = 3").first().clauses[0].clause == "you scum"
    assert sorted(r.doc_id for r in X.without_toxic(docs).collect()) == [1, 2]
    empty, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, None), (None, 1), (3, 1)], "doc_id long, toxic int")
    assert X.toxic_documents(empty).collect() == [] and X.without_toxic(empty).collect() == []
    assert X.learned_insults(docs, labels) == [] and X.learned_insults(empty, labels) == [] and X.learned_insults(docs, labels.limit(0)) == []
