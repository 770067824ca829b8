"""Citations: found by two state machines, or given by marks; then resolved to works, with their author and their locators.

The machines and the enrichment look at a citation's tokens in order, within a document: one map-only pass in Arrow batches. Nothing is exchanged but what a
report adds up."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions.lexicon import known, table

from . import columns
from .resolve import expansion_of, is_plain, lookup, normalize_key, resolve, ruled, work_of
from .scan import KIND, TEXT, TOK

TWO_WORDS = {("ex", "parte")}
HANDED_BACK = ("ad", "in", "ibi")


def _plain(t: list) -> str | None:
    """A token's text; a split word has none of its own."""
    return None if t[KIND] == "word_lb" else t[TEXT]


def is_author(t: list) -> bool:
    return (t[KIND] == "abbrev_dot" and t[TEXT] in known("author_abbreviations")) or (t[KIND] in ("word", "word_lb") and t[TEXT] in known("author_names"))


def goes_on(t: list) -> bool:
    """Whether a token may stand within a citation."""
    kind, x = t[KIND], t[TEXT]
    if kind in ("abbrev_dot", "pc", "dot", "amp"):
        return True
    return kind == "word" and (x in known("bibl_intra") or x in known("bibl_inter") or x.isdigit() or (x[:1].isupper() and x not in known("author_names")))


def stands_between(t: list, after: list | None) -> bool:
    """Whether a token stands between two citations."""
    kind, x = t[KIND], t[TEXT]
    if kind == "word":
        return x in known("bibl_inter") or (after is not None and (x, _plain(after)) in TWO_WORDS)
    return kind == "amp" and after is not None and (is_author(after) or _plain(after) in known("bibl_inter"))


def bibl_groups(tokens: list[list]) -> list[list[tuple[str, list[int]]]]:
    """Places of blocks of citations, each a list of (bibl or inter, places of its tokens): an author opens one, tokens that go on extend it, another author begins the next."""
    blocks, i, n = [], 0, len(tokens)
    for author in [k for k, t in enumerate(tokens) if is_author(t)]:
        if author < i:  # in a block already
            continue
        i = author
        groups, current, pending = [], [i], []
        i += 1
        while i < n:
            t, after = tokens[i], tokens[i + 1] if i + 1 < n else None
            last = _plain(tokens[current[-1]])
            honoured, expected = last in known("honorifics"), last in known("bibl_expect")
            if is_author(t) and not honoured and not expected:
                groups.append(("bibl", current))
                if pending:
                    groups.append(("inter", pending))
                current, pending = [i], []
            elif stands_between(t, after) and not expected:
                pending.append(i)
                if t[KIND] == "word" and after is not None and after[KIND] == "word" and (t[TEXT], after[TEXT]) in TWO_WORDS:
                    i += 1
                    pending.append(i)
            elif goes_on(t) or expected:
                current += [*pending, i]
                pending = []
            else:
                break
            i += 1
        groups.append(("bibl", current))
        if pending:
            groups.append(("inter", pending))
        for a, b in zip(groups, groups[1:]):
            if a[0] == "bibl" and b[0] == "inter" and tokens[a[1][-1]][KIND] == "amp":
                b[1].insert(0, a[1].pop())
        blocks.append(groups)
    return blocks


def _legal_from(tokens: list[list], i: int, taken: set[int]) -> tuple[list[int], int]:
    """Places of the legal citation that begins at i, and where to go on."""
    begun, places = i, [i]
    expect, source, prep = tokens[i][TEXT] == "l.", False, False
    i += 1
    if not expect:  # reg. iuris
        places.append(i)
        i += 1
    while i < len(tokens) and i not in taken:
        kind, x = tokens[i][KIND], tokens[i][TEXT]
        if kind == "amp" or (kind == "pc" and x == ","):
            break
        if kind == "dot" and x == ".":
            prep = False
        elif kind == "abbrev_dot":
            if x == "l." and prep:
                prep = False
            elif x in known("legal_sources"):
                source, expect, prep = True, False, False
            elif x == "§.":
                expect, prep = True, False
            elif expect:
                expect = prep = False
            else:
                break
        elif kind == "word":
            if x in known("legal_prose"):
                break
            if expect:
                expect = prep = False
            elif x.isdigit():
                prep = False
            elif x in HANDED_BACK:
                prep = True
            elif x in known("legal_titles") or not source:
                prep = False
            else:
                break
        elif kind == "word_lb":
            if expect or not source:
                expect = prep = False
            elif x.isdigit() or x in known("legal_titles"):
                prep = False
            else:
                break
        else:
            break
        places.append(i)
        i += 1
    while places and tokens[places[-1]][KIND] == "word" and tokens[places[-1]][TEXT] in HANDED_BACK:
        places.pop()
        i -= 1
    return places, max(i, begun + 1)


def legal_citations(tokens: list[list], taken: set[int]) -> list[list[int]]:
    """Places of the citations of law (l. …, reg. iuris …) among tokens that no block of citations has taken."""
    out, i = [], 0
    while i < len(tokens):
        t, after = tokens[i], tokens[i + 1] if i + 1 < len(tokens) and i + 1 not in taken else None
        begins = t[KIND] == "abbrev_dot" and (t[TEXT] == "l." or (t[TEXT] == "reg." and after is not None and _plain(after) == "iuris"))
        if i in taken or not begins:
            i += 1
            continue
        places, i = _legal_from(tokens, i, taken)
        if places:
            out.append(places)
    return out


GROUP = "block int, part int, kind string, first_tok int, last_tok int, surface string"


def _opens(kind: int, x: str) -> bool:
    """Whether a form may open what a machine finds: without one, a stretch has nothing."""
    name = columns.KINDS[kind]
    return is_author([None, None, None, name, x]) or (name == "abbrev_dot" and x in ("l.", "reg."))


def _groups(texts: list) -> tuple[list, list]:
    c = columns.scanned(texts)
    opens = np.concatenate([[0], np.cumsum(c.of_form(_opens, np.int64))])
    a, z = c.runs(c.sent_id, c.italic)
    some = opens[z] > opens[a]
    rows, docs, block, last = [], [], 0, None
    for i, j, doc in zip(a[some].tolist(), z[some].tolist(), c.doc[a[some]].tolist()):
        if doc != last:
            last, block = doc, 0
        run = [[None, k, None, columns.KINDS[kind], x] for k, kind, x in zip(c.tok_n[i:j].tolist(), c.kind[i:j].tolist(), c.texts[i:j])]
        blocks = bibl_groups(run)
        found = [(places[0], kind, k, places) for b in blocks for k, (kind, places) in enumerate(b, 1) if places]
        taken = {p for b in blocks for _, places in b for p in places}
        found += [(places[0], "legal", 1, places) for places in legal_citations(run, taken)]
        for _, kind, k, places in sorted(found):
            block += k == 1
            rows.append((block, k, kind, run[places[0]][TOK], run[places[-1]][TOK], " ".join(run[p][TEXT] for p in places)))
        docs += [doc] * len(found)
    return docs, list(zip(*rows)) if rows else [()] * 6


def groups_of(text: str) -> list[tuple]:
    return list(zip(*_groups([text])[1]))


def machine_citations(docs: DataFrame) -> DataFrame:
    """(doc_id, GROUP): what the two machines find in each sentence, whatever its marks. kind: bibl, inter (what joins two of them) or legal."""
    return columns.columns_of(docs, GROUP, _groups)


class Child:
    """What a form is as a child of a citation: a plain word (w), a choice, or a mark; and what the steps below ask of it."""

    __slots__ = ("text", "is_word", "is_choice", "abbr", "direct", "words", "subs", "all", "stem", "free", "names", "sub", "reading", "chosen", "number", "unit")

    def __init__(self, kind: str, x: str):
        self.text, self.is_word, self.is_choice, self.abbr, self.direct, self.words, self.subs = x, False, False, None, None, [], []
        if kind in ("pc", "dot"):
            self.all = [x]
        elif kind == "amp":
            self.is_choice, self.abbr, self.direct, self.words, self.subs = True, "&", "&", ["&", "et"], ["&"]
            self.all = self.words
        else:
            c = resolve(kind, x)
            print_ = c.inner or c.orig
            if kind == "abbrev_dot" or c.kind in ("macron", "long_s_macron"):  # an abbreviation, with or without an expansion
                nested = c.inner is not None or c.kind in ("long_s", "long_s_macron")
                self.is_choice, self.abbr = True, x
                self.direct = None if nested else x
                self.subs = [] if nested else [x]
                self.words = [*([print_] if nested else []), x, *([c.reg] if c.reg != x else [])]
            elif c.kind == "plain":
                self.is_word, self.words = True, [x]
            else:
                self.is_choice, self.subs = True, [c.reg] if c.inner else [c.orig, c.reg]
                self.words = [*([c.inner] if c.inner else []), c.orig, c.reg]
            self.all = self.words
        units, free = table("units"), lambda w: bool(w) and not structural(w)
        self.stem = self.abbr and self.abbr.rstrip(".")
        self.free = self.abbr is not None and not structural(self.stem.lower())
        self.names = self.is_word and not structural(x)
        self.sub = next(filter(free, self.subs), None)
        self.reading = next((w for w in self.words if free(w) and not w.isdigit()), None)
        self.chosen = self.is_choice and self.direct is not None and not structural(self.direct.rstrip(".").lower())
        self.number = self.is_word and x.strip().isdigit()
        self.unit = next((u for u in (w.strip().rstrip(".").lower() for w in reversed(self.words)) if u in units), None) or (self.stem or "").lower() or None


def structural(x: str) -> bool:
    return normalize_key(x) in known("structural")


class Named(NamedTuple):
    abbr: str  # the reading that names the author best, or nothing
    work: tuple[str | None, str | None, str | None]  # bib_id, pers_id, cert
    status: str
    author: int | None  # place of the author's first token
    author_tokens: int


CITATION = "cit_n int, first_tok int, last_tok int, surface string, abbr string, bib_id string, pers_id string, cert string, status string, author_first int, author_tokens int"
LOCATOR = "cit_n int, tok_n int, number string, unit string"


class Cited:
    """The marked citations of scanned documents, resolved. What is asked of every token of a citation is found by form; what looks for the first of something stops there."""

    def __init__(self, c: columns.Tokens):
        self.c, self.form = c, c.form.tolist()
        self.cited = np.zeros(len(c.forms), bool)
        self.cited[c.form[c.bibl_id > 0]] = True
        self.children: list[Child | None] = [None if not used or (k == columns.WORD and is_plain(x)) else Child(columns.KINDS[k], x) for (k, x), used in zip(c.forms, self.cited.tolist())]  # none for a word at a glance plain
        some = lambda of, plain: np.flatnonzero(np.array([of(x) if x else plain(f) for x, f in zip(self.children, c.forms)], bool)[c.form] & (c.bibl_id > 0)).tolist() if c.n else []
        never, units = (lambda f: False), table("units")
        self.abbrs, self.free, self.chosen = some(lambda x: x.abbr is not None, never), some(lambda x: x.free, never), some(lambda x: x.chosen, never)
        self.numbers = some(lambda x: x.number, lambda f: f[1].isdigit())
        self.units = some(lambda x: x.unit, lambda f: f[1].lower() in units)
        self._names: dict[int, bool] = {}

    def _first(self, places: list[int], i: int, j: int, n: int = 1) -> list[int]:
        at = bisect_left(places, i)
        return [p for p in places[at : at + n] if p < j]

    def names(self, f: int) -> bool:
        """Whether a form is a plain word that may be a name."""
        found = self._names.get(f)
        if found is None:
            found = self._names[f] = self.children[f].names if self.children[f] else not structural(self.c.forms[f][1])
        return found

    def candidates(self, i: int, j: int) -> list[str]:
        """Readings that may name the author, best first."""
        children, form, texts = self.children, self.form, self.c.texts
        two, out = self._first(self.abbrs, i, j, 2), []
        if len(two) == 2:
            out.append(children[form[two[0]]].stem + children[form[two[1]]].stem)
        out += [children[form[p]].abbr for p in self._first(self.free, i, j)]
        for f in form[i:j]:
            if self.names(f):
                out.append(self.c.forms[f][1])
                break
            if children[f] and children[f].sub is not None:
                out.append(children[f].sub)
        for p in range(i, j):
            x = children[form[p]]
            reading = x.reading if x else texts[p] if self.names(form[p]) and not texts[p].isdigit() else None
            if reading is not None:
                return [*out, reading]
        return out

    def author_of(self, i: int, j: int) -> tuple[int | None, int]:
        """(place, number) of the tokens that name the author: a plain word and the one after it, or, where an abbreviation may be one, that and the one after it."""
        if two := self._first(self.chosen, i, j, 2):
            return two[0], 1 + (two[-1] == two[0] + 1)
        ok = lambda p: p < j and self.names(self.form[p]) and not self.c.texts[p].isdigit()
        at = next((p for p in range(i, j) if ok(p)), None)
        return at, 0 if at is None else 1 + ok(at + 1)

    def locators_of(self, i: int, j: int) -> list[tuple[int, str]]:
        """(place, unit) of plain words that are numbers: the unit of the latest abbreviation, or word that is a unit, before; ? where that is no unit."""
        numbers = self.numbers[bisect_left(self.numbers, i) : bisect_left(self.numbers, j)]
        if not numbers:
            return []
        units, out = table("units"), []
        for p in numbers:
            at = bisect_left(self.units, p) - 1
            q = self.units[at] if at >= 0 and self.units[at] >= i else None
            x = None if q is None else self.children[self.form[q]]
            out.append((p, "?" if q is None else units.get(x.unit if x else self.c.texts[q].lower(), "?")))
        return out

    def surface(self, i: int, j: int) -> str:
        return "".join(y for f in self.form[i:j] for y in (self.children[f].all if self.children[f] else (self.c.forms[f][1],))).lower()

    def named(self, i: int, j: int) -> Named:
        names = self.candidates(i, j)
        key = next((k for k in (work_of(k) for k in map(normalize_key, names) if len(k) >= 2) if k), None)
        if key is None:
            return Named(names[0] if names else "", (None, None, None), "NO_MATCH", None, 0)
        return Named(names[0], lookup(key, self.surface(i, j) if key in ruled() else ""), "OK", *self.author_of(i, j))

    def __iter__(self) -> Iterator[tuple[int, int, int, int]]:
        """(document, cit_n, first, end) of each citation; one that goes over the edge of italics or a sentence is several."""
        c = self.c
        a, z = c.runs(c.sent_id, c.italic, c.bibl_id)
        cited = c.bibl_id[a] > 0
        a, z = a[cited], z[cited]
        last = n = None
        for doc, i, j in zip(c.doc[a].tolist(), a.tolist(), z.tolist()):
            last, n = doc, n + 1 if doc == last else 1
            yield doc, n, i, j


def _citations(texts: list, locators: bool = False) -> tuple[list, list]:
    c = columns.scanned(texts)
    cited, tok, rows, docs = Cited(c), c.tok_n.tolist(), [], []
    for doc, n, i, j in cited:
        x = cited.named(i, j)
        docs.append(doc)
        row = (n, tok[i], tok[j - 1], " ".join(c.texts[i:j]), x.abbr, *x.work, x.status, None if x.author is None else tok[x.author], x.author_tokens)
        rows.append((*row, [{"tok_n": tok[p], "number": c.texts[p], "unit": u} for p, u in cited.locators_of(i, j)] if x.work[0] else []) if locators else row)
    return docs, list(zip(*rows)) if rows else [()] * (11 + locators)


def _locators(texts: list) -> tuple[list, list]:
    c = columns.scanned(texts)
    cited, tok, rows, docs = Cited(c), c.tok_n.tolist(), [], []
    for doc, n, i, j in cited:
        found = cited.locators_of(i, j)
        if found and cited.named(i, j).work[0]:
            rows += [(n, tok[p], c.texts[p], u) for p, u in found]
            docs += [doc] * len(found)
    return docs, list(zip(*rows)) if rows else [()] * 4


def citations_of(text: str) -> list[tuple]:
    """Fields of CITATION and the locators."""
    return list(zip(*_citations([text], True)[1]))


def cit_id(column: Column) -> Column:
    """The id of a citation (bib_id, cit_n) in a column of that name."""
    return F.concat_ws("_", F.lit("cit"), column, F.coalesce(F.regexp_replace("bib_id", "^bib_", ""), F.lit("noref")), F.col("cit_n").cast("string"))


def citations(docs: DataFrame, key: str = "doc_id", column: str = "concat('c', doc_id)", locators: bool = False) -> DataFrame:
    """(key, CITATION, cit_id): the marked citations of each document, resolved to works. column: SQL for the name of the column in ids. locators: with them, as an array."""
    schema = CITATION + (", locators array<struct<tok_n: int, number: string, unit: string>>" if locators else "")
    return columns.columns_of(docs, schema, lambda t: _citations(t, locators), key).withColumn("cit_id", cit_id(F.expr(column)))


def locators(docs: DataFrame) -> DataFrame:
    """(doc_id, cit_n, tok_n, number, unit) of citations that were resolved."""
    return columns.columns_of(docs, LOCATOR, _locators)


def report(citations: DataFrame) -> DataFrame:
    """(abbr, bib_id, cert, status, n): what the names of citations were resolved to, and those that were not."""
    return citations.groupBy("abbr", "bib_id", "cert", "status").agg(F.count("*").alias("n"))


def reported(docs: DataFrame) -> DataFrame:
    """The report of the marked citations of documents, added up within a portion first."""

    def made(texts: list) -> list:
        cited = Cited(columns.scanned(texts))
        n = Counter((x.abbr, x.work[0], x.work[2], x.status) for x in (cited.named(i, j) for _, _, i, j in cited))
        return [*(list(zip(*n)) or [()] * 4), list(n.values())]

    d = columns.columns_of(docs, "abbr string, bib_id string, cert string, status string, n long", made, None)
    return d.groupBy("abbr", "bib_id", "cert", "status").agg(F.sum("n").alias("n"))


def expansions_missing(docs: DataFrame) -> DataFrame:
    """(text, n) of abbreviations within marked citations that no table expands; an editor is to fill them in."""

    def made(texts: list) -> list:
        c = columns.scanned(texts)
        found, _, n = columns.counted(c, (c.bibl_id > 0) & (c.kind == columns.ABBREV))
        rows = [(x, k) for (_, x), k in zip(found, n.tolist()) if not expansion_of(x)]
        return list(zip(*rows)) if rows else [(), ()]

    return columns.columns_of(docs, "text string, n long", made, None).groupBy("text").agg(F.sum("n").alias("n"))
