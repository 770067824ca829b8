"""Toxicity by a weighted finite-state pattern grammar.

A text is a sequence of sentences, cut at . ! ? and line ends, and a sentence one of clauses, cut at ; : and commas. A lexicon transducer maps each word or phrase (``toxicity_lexicon.json``, by language; all
languages are looked for in every text) to a class: INSULT, ABUSE (phrases that need no target), THREAT, INTENT, TARGET, NEGATION, LATE_NEGATION (which also follows what it denies), REPORT (verbs of saying) or OTHER. Five
sequential transducers over the classes are composed into one machine:

* negation: within ``REACH`` words after a negation in the clause, or before a late one, INSULT, ABUSE and THREAT become denied ones,
* reported speech: after a REPORT in the sentence, also over commas, colons and quotation marks, what was asserted becomes reported,
* insult, threat and target: each accepts its kind and gives weights; a TARGET in the clause raises the weight of an insult; a threat counts only with a target at most
  ``OBJECT`` words after it (or, after an INTENT, before it), and in full only after an INTENT.

The composed machine runs over every sentence that holds an INSULT, ABUSE or THREAT; the sum of a clause's weights is its score. A document's score is the sum of its clauses' scores, where insults without a target
count in full only if there is one in ``SPARSE`` words or more of them, and else in proportion, and all that is denied or reported adds up to ``TOLD`` at most. A document is toxic if that is
``THRESHOLD`` or more: so an insult at somebody, a phrase of abuse, a threat with intent, or two insults in a text that isn't long, but no lone word, and nothing denied or quoted, however often.

``learned_insults`` adds words as ABUSE, if they aren't in the lexicon, from the rows
labelled toxic: words seen in so many different contexts (previous and next word) of toxic rows that no more
than ``ALPHA`` of all words would be by chance, and hardly in others. It reads at most ``sample`` toxic
rows and ten times as many others, those with the least hash of doc_id.

A null text is empty, and an empty text has no clauses. Rows without doc_id are scored as well.
Rows that repeat an id are scored one by one. Empty tables give empty results; without labels the lexicon
stays as it is. Columns besides doc_id and text don't matter. Texts are read whole.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import lean

NAMES = ["OTHER", "INSULT", "THREAT", "TARGET", "NEGATION", "REPORT", "INTENT", "ABUSE", "LATE_NEGATION", "COMMA", "DENIED_INSULT", "DENIED_THREAT", "DENIED_ABUSE"]
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, INTENT, ABUSE, LATE_NEGATION, COMMA, *_ = range(len(NAMES))
DENIED = {INSULT: NAMES.index("DENIED_INSULT"), THREAT: NAMES.index("DENIED_THREAT"), ABUSE: NAMES.index("DENIED_ABUSE")}
PASSING = ["OTHER", "TARGET", "REPORT", "INTENT"]
WORDS = ["OTHER", "REPORT", "NEGATION", "LATE_NEGATION", *(f"{p}{k}" for p in ("", "REPORTED_", "DENIED_") for k in ("INSULT", "ABUSE"))]
REACH, LATE, OBJECT, THRESHOLD, SPARSE, TOLD, SAMPLE, ALPHA, RATIO = 3, 2, 2, 1.0, 1000, 0.9, 2000, 0.5, 50.0
LONE, AIMED, ABUSIVE, MEANT, LOOSE, REPORTED, DENIES = 0.7, 0.8, 1.2, 1.0, 0.6, 0.4, 0.1


@cache
def lexicon_data() -> dict[str, dict[str, list[str]]]:
    return json.loads((Path(__file__).parent / "toxicity_lexicon.json").read_text())


def weight(asserted: float = 0, told: float = 0, insults: int = 0, aimed: int = 0) -> int:
    """What arcs pay, in hundredths, as one number that adds up: what is asserted, what is denied or reported, and numbers of insults and of targets for them."""
    return round(asserted * 100) + round(told * 100) * 10**12 + insults * 10**24 + aimed * 10**36


def parts_of(w: int) -> tuple[float, float, int, int]:
    return w % 10**12 / 100, w // 10**12 % 10**12 / 100, w // 10**24 % 10**12, w // 10**36


@dataclass
class Transducer:
    """Sequential and weighted: arcs[state][symbol] = (symbol out, weight, next state); a symbol without an arc passes unchanged."""

    start: int = 0
    arcs: dict[int, dict[str, tuple[str, int, int]]] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[str, int, int]:
        return self.arcs.get(state, {}).get(symbol) or (symbol, 0, state)

    def compose(self, other: Transducer, symbols: list[str]) -> Transducer:
        """The machine that feeds what this one puts out to the other; weights add up."""
        numbers, todo = {(self.start, other.start): 0}, [(self.start, other.start)]
        made = Transducer()
        for p, q in todo:
            row = made.arcs.setdefault(numbers[p, q], {})
            for s in symbols:
                out, w, p2 = self.step(p, s)
                out, w2, q2 = other.step(q, out)
                if (p2, q2) not in numbers:
                    numbers[p2, q2] = len(numbers)
                    todo.append((p2, q2))
                row[s] = (out, w + w2, numbers[p2, q2])
        return made


def negation(reach: int = REACH) -> Transducer:
    """State k: k more words are denied."""
    begins = {x: (x, 0, reach) for x in ("NEGATION", "LATE_NEGATION")}
    arcs: dict = {0: dict(begins)}
    for k in range(1, reach + 1):
        arcs[k] = {s: (s, 0, k - 1) for s in (*PASSING, "DENIED_INSULT", "DENIED_THREAT", "DENIED_ABUSE")} | begins
        arcs[k] |= {s: (f"DENIED_{s}", 0, k - 1) for s in ("INSULT", "THREAT", "ABUSE")} | {"COMMA": ("COMMA", 0, 0)}
    return Transducer(0, arcs)


def reported() -> Transducer:
    """State 1: a verb of saying came before in the sentence."""
    return Transducer(0, {0: {"REPORT": ("REPORT", 0, 1)}, 1: {s: (f"REPORTED_{s}", 0, 1) for s in ("INSULT", "THREAT", "ABUSE")}})


def insult() -> Transducer:
    told = {f"{p}_{s}": (f"{p}_{s}", weight(told=w), 0) for p, w in (("REPORTED", REPORTED), ("DENIED", DENIES)) for s in ("INSULT", "ABUSE")}
    return Transducer(0, {0: {"INSULT": ("INSULT", weight(insults=1), 0), "ABUSE": ("ABUSE", weight(ABUSIVE), 0)} | told})


def target() -> Transducer:
    """1: a target came in the clause, 2: an insult came, 3: both, and paid."""
    again = {"COMMA": ("COMMA", 0, 0)}
    return Transducer(0, {0: {"TARGET": ("TARGET", 0, 1), "INSULT": ("INSULT", 0, 2)}, 1: {"INSULT": ("INSULT", weight(aimed=1), 3)} | again, 2: {"TARGET": ("TARGET", weight(aimed=1), 3)} | again, 3: again})


def threat(reach: int = OBJECT) -> Transducer:
    """("wait", k, meant, told): a threat whose target may come within k words; ("near", k): after an intent, a target that came at most k words before; "meant": after an intent."""
    numbers: dict = {"none": 0}
    arcs: dict = {}

    def number(state) -> int:
        return numbers.setdefault(state, len(numbers))

    states = ["none", "meant", *(("near", k) for k in range(1, reach + 1)), *(("wait", k, m, t) for k in range(1, reach + 1) for m in (False, True) for t in (False, True))]
    for state in states:
        row = {}
        meant = state == "meant" or state[0] == "near" or (state[0] == "wait" and state[2])
        rest = "meant" if meant else "none"
        for told, symbol in ((False, "THREAT"), (True, "REPORTED_THREAT")):
            if state[0] == "near":
                row[symbol] = (symbol, weight(told=REPORTED) if told else weight(MEANT), number(rest))
            else:
                row[symbol] = (symbol, 0, number(("wait", reach, meant, told)))
        row["DENIED_THREAT"] = ("DENIED_THREAT", 0, number(rest))
        row["TARGET"] = ("TARGET", (weight(told=REPORTED) if state[3] else weight(MEANT if state[2] else LOOSE)) if state[0] == "wait" else 0, number(("near", reach) if meant else "none"))
        if state[0] in ("wait", "near"):
            k = state[1]
            for s in WORDS:
                row[s] = (s, 0, number((state[0], k - 1, *state[2:]) if k > 1 else rest))
        row["INTENT"] = ("INTENT", 0, number("meant"))
        row["COMMA"] = ("COMMA", 0, number("none"))
        arcs[number(state)] = row
    return Transducer(0, arcs)


def grammar() -> Transducer:
    made = negation()
    for t in (reported(), insult(), target(), threat()):
        made = made.compose(t, NAMES)
    return made


@dataclass
class Lexicon:
    hash: np.ndarray
    kind: np.ndarray
    phrases: dict[int, np.ndarray]  # by number of words, the sorted hashes of phrases of abuse

    @classmethod
    def of(cls, extra: list[int] = ()) -> Lexicon:
        entries = {int(h): ABUSE for h in extra}
        phrases: dict[int, list[int]] = {}
        for words in lexicon_data().values():
            for name, listed in words.items():
                if name == "ABUSE":
                    for x in listed:
                        phrases.setdefault(len(x.split()), []).append(int(T.gram_hashes(T.hash_words(x.split()), len(x.split()))[0]))
                else:
                    entries |= dict.fromkeys(T.hash_words(listed).tolist(), NAMES.index(name))
        hashes = np.array(sorted(entries), np.uint64)
        return cls(hashes, np.array([entries[h] for h in hashes.tolist()], np.int8), {n: np.array(sorted(x), np.uint64) for n, x in phrases.items()})

    def classes(self, w: T.Words) -> np.ndarray:
        """The class of each word; the first word of a phrase of abuse has its class, the others are OTHER."""
        h = w.hash
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        kind = np.where(self.hash[at] == h, self.kind[at], OTHER)
        for n, known in self.phrases.items():
            g = T.gram_hashes(h, n)
            at = np.minimum(np.searchsorted(known, g), len(known) - 1)
            for i in np.flatnonzero(known[at] == g).tolist():
                if w.last[i] >= i + n:
                    kind[i : i + n] = OTHER
                    kind[i] = ABUSE
        return kind


_SENTENCE, _CLAUSE = np.zeros(256, bool), np.zeros(256, bool)
_SENTENCE[[ord(c) for c in ".!?\n\r"]] = True
_CLAUSE[[ord(c) for c in ";:,"]] = True


@dataclass
class Clause:
    doc: int
    start: int  # first byte
    end: int
    score: float
    lone: float  # the part of the score that is insults without a target
    told: float  # the part that is denied or reported
    pattern: str


def clauses_of(w: T.Words, lexicon: Lexicon, machine: Transducer) -> Iterator[Clause]:
    """Each clause that holds an insult, abuse or a threat."""
    kind = lexicon.classes(w)
    hits = np.flatnonzero((kind == INSULT) | (kind == THREAT) | (kind == ABUSE))
    if len(hits) == 0:
        return
    ends, commas = np.r_[0, np.cumsum(_SENTENCE[w.data])], np.r_[0, np.cumsum(_CLAUSE[w.data])]
    gap = ends[w.start[1:]] != ends[w.end[:-1]]
    edge = np.r_[0, np.flatnonzero(gap | (w.doc[1:] != w.doc[:-1])) + 1, len(w.hash)]
    doc = w.doc
    for c in np.unique(np.searchsorted(edge, hits, "right") - 1):
        a, b = int(edge[c]), int(edge[c + 1])
        comma = np.r_[False, commas[w.start[a + 1 : b]] != commas[w.end[a : b - 1]]]
        kinds = kind[a:b].tolist()
        state = machine.start
        first, paid, seen, toxic = 0, 0, [], False

        def made(lo: int, hi: int) -> Clause:
            asserted, told, insults, aimed = parts_of(paid)
            lone = 0.0 if aimed else LONE * insults
            return Clause(int(doc[a]), int(w.start[a + lo]), int(w.end[a + hi - 1]), asserted + told + LONE * insults + AIMED * aimed, lone, told, " ".join(seen))

        for i, k in enumerate(kinds):
            if comma[i]:
                if toxic:
                    yield made(first, i)
                _, _, state = machine.step(state, "COMMA")
                first, paid, seen, toxic = i, 0, [], False
            if k in DENIED and LATE_NEGATION in kinds[i + 1 : i + 1 + LATE + 1] and not comma[i + 1 : i + 1 + kinds[i + 1 :].index(LATE_NEGATION) + 1].any():
                name = NAMES[DENIED[k]]
            else:
                name = NAMES[k]
            out, w_, state = machine.step(state, name)
            paid += w_
            toxic |= k in DENIED
            if k != OTHER:
                seen.append(out)
        if toxic:
            yield made(first, len(kinds))


def document_score(clauses: list[Clause], n_words: int) -> float:
    lone, told = sum(c.lone for c in clauses), sum(c.told for c in clauses)
    rest = sum(c.score for c in clauses) - lone - told
    return round(rest + lone * min(1.0, SPARSE * lone / LONE / max(n_words, 1)) + min(told, TOLD), 6)


def learned_insults(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, alpha: float = ALPHA, ratio: float = RATIO) -> list[int]:
    """Hashes of the words that mark rows labelled toxic."""
    y = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").alias("toxic"))
    order = (F.xxhash64("id"), F.col("id"))
    some = y.where("toxic = 1").orderBy(*order).limit(sample).unionAll(y.where("toxic <> 1").orderBy(*order).limit(10 * sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "id")  # at most 11 * sample rows are broadcast
    toxic, other = rows.where("toxic = 1").select("text"), rows.where("toxic <> 1").select("text")

    @lean
    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in T.each_words(b.column(0)):
                if len(w.hash):
                    doc = w.doc
                    same = doc[1:] == doc[:-1]
                    before, after = np.r_[np.uint64(0), np.where(same, w.hash[:-1], np.uint64(0))], np.r_[np.where(same, w.hash[1:], np.uint64(0)), np.uint64(0)]
                    seen = T.mix(before * np.uint64(3) + after * np.uint64(5))
                    yield pa.RecordBatch.from_arrays([pa.array(w.hash.view(np.int64)), pa.array(seen.view(np.int64))], ["word", "seen"])

    by_word = toxic.mapInArrow(contexts, "word long, seen long").groupBy("word").agg(F.countDistinct("seen").alias("n"), F.count("*").alias("all")).where("n >= 3").toPandas()  # bounded by the sample
    if len(by_word) == 0:
        return []
    candidates = np.sort(by_word.word.to_numpy().view(np.uint64))

    @lean
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(len(candidates), np.int64), 0
        for b in batches:
            for w in T.each_words(b.column(0)):
                total += len(w.hash)
                at = np.minimum(np.searchsorted(candidates, w.hash), len(candidates) - 1)
                found += np.bincount(at[candidates[at] == w.hash], minlength=len(candidates))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[some, -1]), pa.array(np.r_[found[some], total])], ["k", "n"])

    found, total = np.zeros(len(candidates)), 0
    for r in other.mapInArrow(counts, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        if r.k < 0:
            total = r.n
        else:
            found[r.k] = r.n
    own = toxic.mapInArrow(counts, "k long, n long").where("k < 0").agg(F.sum("n")).first()[0] or 0
    if not total or not own:
        return []
    least = max(3, math.ceil(math.log(alpha / len(candidates)) / math.log(own / (own + total))))
    n = dict(zip(by_word.word.to_numpy().view(np.uint64).tolist(), by_word.n))
    return [h for h, f in zip(candidates.tolist(), found) if n[h] >= least and (n[h] + 0.5) / own >= ratio * (f + 0.5) / total]


def _by_document(w: T.Words, lexicon: Lexicon, machine: Transducer) -> Iterator[tuple[int, float, list[Clause]]]:
    """(document, score, clauses) of each document with any."""
    found: dict[int, list[Clause]] = {}
    for c in clauses_of(w, lexicon, machine):
        found.setdefault(c.doc, []).append(c)
    for d, clauses in found.items():
        yield d, document_score(clauses, int(w.first[d + 1] - w.first[d])), clauses


def toxic_documents(docs: DataFrame, extra: list[int] = (), threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, n_clauses, clauses) for each document found toxic. clauses: the matched clauses (text, score, what was matched), in order."""
    lexicon, machine = Lexicon.of(extra), grammar()
    kind = pa.list_(pa.struct([("clause", pa.string()), ("score", pa.float64()), ("pattern", pa.string())]))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in T.each_words(b.column(1)):
                rows = [(d, s, c) for d, s, c in _by_document(w, lexicon, machine) if s >= threshold]
                if rows:
                    ids = b.column(0).take(pa.array([w.lo + r[0] for r in rows]))
                    clauses = [[{"clause": w.data[c.start : c.end].tobytes().decode(errors="replace"), "score": round(c.score, 6), "pattern": c.pattern} for c in r[2]] for r in rows]
                    yield pa.RecordBatch.from_arrays([ids, pa.array([r[1] for r in rows]), pa.array([len(r[2]) for r in rows], pa.int32()), pa.array(clauses, kind)], ["doc_id", "score", "n_clauses", "clauses"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, n_clauses int, clauses array<struct<clause: string, score: double, pattern: string>>")


def without_toxic(docs: DataFrame, extra: list[int] = (), threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that aren't toxic."""
    lexicon, machine, at = Lexicon.of(extra), grammar(), docs.columns.index("text")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stays = np.ones(b.num_rows, bool)
            for w in T.each_words(b.column(at)):
                for d, s, _ in _by_document(w, lexicon, machine):
                    stays[w.lo + d] = s < threshold
            yield b.filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)
