"""The scan of marked documents as columns: the tokens of many documents at a time, without an object for each token.

The rules are those of ``scan`` (which goes over one document and gives lists; tests hold one against the other). State changes at marks and lines only, so Python goes over these, and
what is between two of them is a run of tokens: regular expressions make its texts, numpy its columns. What depends on a form alone (its kind, its choice, its element) is asked once for each
form of a portion. A portion of documents holds some ``PORTION`` bytes of text, so memory doesn't depend on how many rows a batch has, nor on how many tokens, citations or elements they give."""

from __future__ import annotations

import gc
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .scan import MARK, _arrow, _sets

PORTION = 1 << 20
SPACE = "".join(map(chr, (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
STOP = SPACE + r",;:.?!\[\]()\-&"
LEX = re.compile(rf"[^{STOP}]+(?:-[^{STOP}]+)*|&amp;|[&\[\](),;:?!]|\.\.\.|\.")  # scan.LEXEME, words first: a set of letters listed one by one is looked up, a class among them is not
APART = frozenset(SPACE + ",:?![]()")  # no token goes over one of these
MARKS = re.compile(f"({MARK.pattern})")
KINDS = ["amp", "pc", "dot", "word", "abbrev_dot", "word_lb"]
AMP, PC, DOT, WORD, ABBREV, WORD_LB = range(len(KINDS))
PUNCTUATION = {"&": AMP, "&amp;": AMP, ".": DOT, "...": DOT} | dict.fromkeys("[](),;:?!", PC)
ENDS = frozenset([".", "...", ";"])
LAST = (None, None)


def kind_of(x: str) -> int:
    """The kind of a token by its text, split words aside: no word holds a dot or semicolon."""
    return PUNCTUATION.get(x, ABBREV if x[-1] in ".;" else WORD)


def _merge(xs: list, starts: list | None) -> list[int]:
    """Known abbreviations with their dots or semicolons become one token, in place. Gives the places of those."""
    dotted, semicolons = _sets()
    gone = []
    for i in [i for i, x in enumerate(xs) if x in ENDS]:
        t = xs[i - 1] if i else "."
        if t not in PUNCTUATION and t[-1] not in ".;" and not t.isdigit():
            joined, known = (t + ";", semicolons) if xs[i] == ";" else (t + ".", dotted)
            if joined in known or joined.lower() in known:
                xs[i - 1] = joined
                gone.append(i)
    for i in reversed(gone):
        del xs[i]
        if starts is not None:
            del starts[i]
    return gone


def _lexed(text: str, at: int, to: int, placed: bool) -> tuple[list, list | None]:
    xs, starts = LEX.findall(text, at, to), None
    if placed:  # before a token are only white space and hyphens, which none begins with
        starts = []
        for x in xs:
            at = text.find(x, at)
            starts.append(at)
            at += len(x)
    if "." in text or ";" in text:
        _merge(xs, starts)
    return xs, starts


def _between(text: str, marks: list) -> tuple[list, list] | None:
    """(tokens, how many come before each mark) of a line whose marks stand between tokens, as most do; null where one may stand within a token."""
    end = len(text)
    for off, _ in marks:
        if 0 < off < end and text[off - 1] not in APART and text[off] not in APART:
            return None
    xs, places, lo = [], [], 0
    for off, _ in marks:
        if off > lo:
            xs += LEX.findall(text, lo, off)
            lo = off
        places.append(len(xs))
    xs += LEX.findall(text, lo)
    if "." in text or ";" in text:
        gone = _merge(xs, None)
        if gone:
            places = [p - bisect_left(gone, p) for p in places]
    return xs, places


def lines_of(text: str | None, marked: bool = True) -> list[tuple[int, str, bool, list]]:
    """(number, text without marks, hyphen, marks as (offset, mark)) of lines that aren't blank."""
    out = []
    for n, raw in enumerate((text or "").split("\n"), 1):
        raw = raw.strip()
        if not raw:
            continue
        marks, parts = [], MARKS.split(raw) if marked else [raw]
        if len(parts) > 1:
            at = 0
            for i in range(1, len(parts), 2):
                at += len(parts[i - 1])
                marks.append((at, parts[i]))
            raw = "".join(parts[::2]).rstrip()
        hyphen = raw.endswith("¬")
        out.append((n, raw[:-1].rstrip() if hyphen else raw, hyphen, marks))
    return out


class Tokens:
    """Tokens of documents, in order: arrays doc (place of the document), line_n, tok_n, kind (place in KINDS), para_id, sent_id, italic, bibl_id; start (if asked for); left_len, sol_n, eol_n, lb_n,
    0 where there is none. texts: a list. forms: distinct (kind, text); form: the place of each token's."""

    def __init__(self, docs: list[list[tuple]], placed: bool = False, joins: bool = True):
        """docs: lines_of each document. placed: with start. joins: the parts of split words become one token."""
        texts, starts = [], []
        per_doc, line_n, per_line = [], [], []
        seg, para_s, sent_s, italic_s, bibl_s = [], [], [], [], []
        sol, eol, lb, left = {}, {}, {}, {}
        for lines in docs:
            begun = len(texts)
            full = [x for x in lines if x[1] and not x[1].isspace()]
            begins = {b[0] for b in full[1:] if any(m == "¶" for _, m in b[3])}
            nexts = {a[0]: b[0] for a, b in zip(full, full[1:]) if b[0] not in begins}
            has_text = {x[0] for x in full}
            every = [m for x in lines for _, m in x[3]]
            stars, signs = every.count("*"), sum(m[0] == "@" for m in every)
            star = sign = bibl = breaks = sent = 0
            cited, para, last, para_seen, pending = False, 1, None, None, None
            for n, text, hyphen, marks in lines:
                has = n in has_text
                if has and n in begins:
                    para += 1
                    breaks += 1
                    bibl = int(cited and sign < signs)
                xs, places = [], None
                if has:
                    cuts = [off for off, m in marks if m == "//"]
                    if not cuts and not placed:
                        if not marks:
                            xs, places = _lexed(text, 0, len(text), False)[0], []
                        elif found := _between(text, marks):
                            xs, places = found
                    if places is None:
                        xs, at = [], []
                        for lo, hi in zip([0, *cuts], [*cuts, len(text)]):
                            if hi > lo:
                                more, starts_ = _lexed(text, lo, hi, True)
                                xs += more
                                at += starts_
                        places = [bisect_left(at, off) for off, _ in marks]
                else:
                    places = [0] * len(marks)
                total, k, first = len(xs), 0, True
                base = len(texts)
                for j, (_, mark) in zip([*places, total], [*marks, LAST]):
                    if j > k:
                        if (para, breaks) != last:
                            last, sent = (para, breaks), sent + 1
                        size = j - k
                        if first:
                            first = False
                            if pending is not None:
                                i, following, at_sent = pending
                                pending = None
                                if joins and at_sent == sent and kind_of(texts[i]) == WORD == kind_of(xs[0]):
                                    lb[i], left[i] = following, len(texts[i])
                                    texts[i] += xs[0]
                                    del xs[0]
                                    size -= 1
                                    if placed:
                                        at_out = at[1:]
                                    if not xs and nexts.get(n):
                                        eol[i] = nexts[n]
                                else:
                                    eol[i] = following
                            if para_seen != para and xs:
                                sol[base] = n
                                para_seen = para
                        if size:
                            seg.append(size)
                            para_s.append(para)
                            sent_s.append(sent)
                            italic_s.append(star % 2 == 1 and star < stars)
                            bibl_s.append(bibl if cited and sign < signs else 0)
                        k = j
                    if mark == "*":
                        star += 1
                    elif mark == "//":
                        breaks += 1
                    elif mark is not None and mark[0] == "@":
                        sign += 1
                        cited = mark == "@@" or not cited
                        bibl += cited
                if xs:
                    texts += xs
                    if placed:
                        starts += at if len(at) == len(xs) else at_out
                    line_n.append(n)
                    per_line.append(len(xs))
                    if n in nexts:
                        if hyphen:
                            pending = (len(texts) - 1, nexts[n], sent_s[-1])
                        else:
                            eol[len(texts) - 1] = nexts[n]
            if pending is not None:
                eol[pending[0]] = pending[1]
            per_doc.append(len(texts) - begun)
        n = len(texts)
        self.n, self.per_doc = n, np.array(per_doc, np.int64)
        self.ends = np.cumsum(self.per_doc)
        self.doc = np.repeat(np.arange(len(per_doc)), self.per_doc)
        self.tok_n = (np.arange(n) - np.repeat(self.ends - self.per_doc, self.per_doc) + 1).astype(np.int32)
        self.line_n = np.repeat(np.array(line_n, np.int32), per_line)
        self.start = np.array(starts, np.int32)
        self.para_id, self.sent_id, self.bibl_id = (np.repeat(np.array(x, np.int32), seg) for x in (para_s, sent_s, bibl_s))
        self.italic = np.repeat(np.array(italic_s, bool), seg)
        self.sol_n, self.eol_n, self.lb_n, self.left_len = (self._sparse(x) for x in (sol, eol, lb, left))
        self.texts, places = texts, {x: i for i, x in enumerate(dict.fromkeys(texts))}
        self.form = np.fromiter(map(places.__getitem__, texts), np.int64, n)
        self.forms = [(kind_of(x), x) for x in places]
        split: dict[str, int] = {}
        for i in left:
            self.form[i] = len(self.forms) + split.setdefault(texts[i], len(split))
        self.forms += [(WORD_LB, x) for x in split]
        self.kind = self.of_form(lambda k, x: k, np.int8)
        self.mark = (self.kind == PC) | (self.kind == DOT)  # punctuation

    def _sparse(self, found: dict[int, int]) -> np.ndarray:
        out = np.zeros(self.n, np.int32)
        out[np.fromiter(found, np.int64, len(found))] = np.fromiter(found.values(), np.int32, len(found))
        return out

    def of_form(self, f: Callable[[int, str], object], kind) -> np.ndarray:
        """f(kind, text) of each token, asked once for each form."""
        return np.array([f(k, x) for k, x in self.forms], kind)[self.form] if self.n else np.zeros(0, kind)

    def strings_of_form(self, f: Callable[[int, str], str | None], where: np.ndarray | None = None) -> pa.Array:
        return pa.array([f(k, x) for k, x in self.forms], pa.string()).take(pa.array(self.form if where is None else self.form[where]))

    def runs(self, *fields: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) of the runs of tokens of one document that agree in the fields."""
        if not self.n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.ones(self.n, bool)
        new[1:] = self.doc[1:] != self.doc[:-1]
        for f in fields:
            new[1:] |= f[1:] != f[:-1]
        first = np.flatnonzero(new)
        return first, np.append(first[1:], self.n)

    def last_line(self, at: np.ndarray) -> np.ndarray:
        return np.where(self.lb_n[at] > 0, self.lb_n[at], self.line_n[at])

    def per_document(self, x: np.ndarray) -> np.ndarray:
        """Sums of x, a number for each token, by document."""
        return np.bincount(self.doc, x, len(self.per_doc)).astype(np.int64)


def scanned(texts: list[str | None], placed: bool = False) -> Tokens:
    return Tokens([lines_of(t) for t in texts], placed)


def plain(texts: list[str | None]) -> Tokens:
    """Of unmarked documents, split words left in their parts."""
    return Tokens([lines_of(t, False) for t in texts], joins=False)


def nullable(x: np.ndarray) -> pa.Array:
    return pa.array(x, mask=x == 0)


def portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(from, to): rows of some PORTION bytes together."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) if len(texts) else ()
    a = 0
    while a < len(size):
        z = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + PORTION, "right")))
        yield a, z
        a = z


def columns_of(docs: DataFrame, schema: str, made: Callable[[list], tuple], key: str | None = "doc_id", text: str = "text") -> DataFrame:
    """(key, schema): made gives for a list of texts (places of the rows' texts in the list, columns). Map-only, a portion at a time. Without a key made gives columns only."""
    names = [x.split()[0] for x in re.split(r",\s*(?![^<]*>)", schema)]
    full = f"{key} {dict(docs.dtypes)[key]}, {schema}" if key else schema
    kinds = [_arrow(f.dataType) for f in docs.sparkSession.createDataFrame([], schema).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # a portion makes many objects and no cycles
        try:
            yield from each(batches)
        finally:
            gc.enable()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z in portions(b.column(b.num_columns - 1)):
                part = b.slice(a, z - a)
                found = made(part.column(part.num_columns - 1).to_pylist())
                which, columns = found if key else (None, found)
                columns = [c.cast(k) if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(which, pa.int64())), *columns] if key else columns, [key, *names] if key else names)

    return docs.select(*([key] if key else []), text).mapInArrow(run, full)


def named(kind: np.ndarray) -> pa.Array:
    return pa.array(KINDS).take(pa.array(kind.astype(np.int64)))


def token_columns(texts: list) -> tuple[np.ndarray, list]:
    """Fields of scan.TOKEN."""
    c = scanned(texts, placed=True)
    same = lambda k, x: x
    return c.doc, [
        c.line_n, c.tok_n, c.start, named(c.kind), c.strings_of_form(same), nullable(c.left_len), c.para_id, c.sent_id, pa.array(c.italic), c.bibl_id, nullable(c.sol_n), nullable(c.eol_n), nullable(c.lb_n), pa.nulls(c.n, pa.string()),
    ]


FORM = "kind string, text string, left_len int, n long"


def counted(c: Tokens, where: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
    """Distinct (form, left_len) of some tokens: the forms, left_len and how many there are."""
    key, n = np.unique(c.form[where] << 32 | c.left_len[where], return_counts=True)
    return [c.forms[i] for i in key >> 32], (key & 0xFFFFFFFF).astype(np.int32), n


def forms(docs: DataFrame, marked: bool, kinds: tuple[int, ...]) -> DataFrame:
    """(kind, text, left_len, n): distinct forms of some kinds, added up within a portion first. Not marked: split words are left in their parts."""
    from pyspark.sql import functions as F

    def made(texts: list) -> list:
        c = scanned(texts) if marked else plain(texts)
        found, left, n = counted(c, np.isin(c.kind, kinds))
        return [named(np.array([k for k, _ in found], np.int8)), pa.array([x for _, x in found], pa.string()), nullable(left), pa.array(n)]

    return columns_of(docs, FORM, made, None).groupBy("kind", "text", "left_len").agg(F.sum("n").alias("n"))
