"""Editorial marks, paragraphs, sentences and split words: one pass over each document, in the row that holds it.

A document is a column of a page. Its lines carry marks: ¶ begins a paragraph with this line, // ends a sentence, * turns italics on and off, @ a citation; @@
ends one citation and begins the next. Longer marks go first; a single / is text. Italics and citations go over line ends; what is never closed doesn't count.
A line that ends in ¬ (after the marks are taken out) goes on in the next line, and its last word, if the next token of its sentence is a word, is one token with that.

All this state lives within a document, so the pass is map-only (Arrow batches): a window over tokens would exchange every token of a corpus to bring together
what already stands in one row. Nothing depends on doc_id: rows that repeat an id, and rows without one, are scanned one by one. Null and empty texts have no tokens.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions.lexicon import table

MARK = re.compile(r"¶|//|@@|@|\*")
LEXEME = re.compile(r"(&amp;|&)|([\[\]()]|[,;:?!])|(\.\.\.|\.)|([^\s,;:.?!\[\]()\-&]+(?:-[^\s,;:.?!\[\]()\-&]+)*)")
KINDS = (None, "amp", "pc", "dot", "word")
INDENT = 60  # a first x beyond this begins a paragraph

TOKEN = "line_n int, tok_n int, start int, kind string, text string, left_len int, para_id int, sent_id int, italic boolean, bibl_id int, sol_n int, eol_n int, lb_n int, expansion string"
FIELDS = [x.split()[0] for x in TOKEN.split(", ")]
(LINE, TOK, START, KIND, TEXT, LEFT, PARA, SENT, ITALIC, BIBL, SOL, EOL, LB, EXP) = range(len(FIELDS))


def lexemes(text: str) -> list[tuple[str, str, int]]:
    """(kind, text, start). A word and a dot, or a word and a semicolon, that make a known abbreviation are one token of kind abbrev_dot."""
    found = [(KINDS[m.lastindex], m.group(), m.start()) for m in LEXEME.finditer(text)]
    dotted, semicolons = _sets()
    out, i, n = [], 0, len(found)
    while i < n:
        kind, t, at = found[i]
        if kind == "word" and i + 1 < n:
            after = found[i + 1]
            known = dotted if after[0] == "dot" else semicolons if after[1] == ";" else None
            if known is not None and not t.isdigit():
                joined = t + ("." if after[0] == "dot" else ";")
                if joined in known or joined.lower() in known:
                    out.append(("abbrev_dot", joined, at))
                    i += 2
                    continue
        out.append(found[i])
        i += 1
    return out


def _sets() -> tuple[frozenset, frozenset]:
    global _KNOWN
    if _KNOWN is None:
        _KNOWN = frozenset(table("dotted")), frozenset(table("semicolons"))
    return _KNOWN


_KNOWN = None


class Line:
    """A line without its marks. marks: (offset in the clean text, mark)."""

    __slots__ = ("n", "text", "marks", "hyphen", "indent", "starts", "next_n", "spans")

    def __init__(self, n: int, raw: str, indent: int = 0, spans: list[tuple[int, int, str, str]] = ()):
        """spans: (offset, length, abbrev or sic, expansion or correction) that stand off, with offsets in the raw line."""
        clean, at, pos, self.marks = [], 0, 0, []
        for m in MARK.finditer(raw):
            clean.append(raw[pos : m.start()])
            at += m.start() - pos
            pos = m.end()
            self.marks.append((at, m.group()))
        clean.append(raw[pos:])
        text = "".join(clean).rstrip()
        self.hyphen = text.endswith("¬")
        self.n, self.indent, self.starts, self.next_n = n, indent, False, None
        self.text = text[:-1].rstrip() if self.hyphen else text
        gone = [(m.start(), len(m.group())) for m in MARK.finditer(raw)] if spans else []
        self.spans = [(o - sum(k for p, k in gone if p < o), *rest) for o, *rest in sorted(spans)]

    def pieces(self, lo: int, hi: int) -> Iterator[tuple[str, str, int, str | None]]:
        """(kind, text, start, expansion) of the tokens from lo to hi: what a span covers is lexed by itself, and its words have the span's value."""
        at = lo
        for o, n, kind, value in self.spans:
            if lo <= o < hi:
                yield from ((k, t, at + i, None) for k, t, i in lexemes(self.text[at:o]))
                for k, t, i in lexemes(self.text[o : o + n]):
                    yield ("sic" if kind == "sic" and k == "word" else k), t, o + i, (value or ("" if kind == "sic" else None)) if k == "word" else None
                at = o + n
        yield from ((k, t, at + i, None) for k, t, i in lexemes(self.text[at:hi]))


def lines_of(text: str) -> list[Line]:
    """The lines of a text that aren't blank, numbered with the blank ones."""
    return [Line(n, raw.strip()) for n, raw in enumerate((text or "").split("\n"), 1) if raw.strip()]


def paragraphs_of(lines: list[Line]) -> list[Line]:
    """The lines that have text, told which begin a paragraph (after the first) and which line comes next in theirs."""
    full = [x for x in lines if x.text.strip()]
    for a, b in zip([None, *full], full):
        if a is not None:
            b.starts = any(m == "¶" for _, m in b.marks) or (b.indent > INDENT and not a.hyphen)
            a.next_n = None if b.starts else b.n
    return full


def scanned(lines: list[Line]) -> list[list]:
    """Tokens (FIELDS) of a document's lines, split words not yet joined."""
    paragraphs_of(lines)
    stars = sum(m == "*" for x in lines for _, m in x.marks)
    signs = sum(m[0] == "@" for x in lines for _, m in x.marks)
    star = sign = bibl = breaks = sent = 0
    cited, para, last = False, 1, None
    out: list[list] = []
    for line in lines:
        has_text = bool(line.text.strip())
        if has_text and line.starts:
            para += 1
            breaks += 1
            bibl = int(cited and sign < signs)
        marks, k = line.marks, 0

        def apply(mark: str) -> None:
            nonlocal star, sign, bibl, breaks, cited
            if mark == "*":
                star += 1
            elif mark == "//":
                breaks += 1
            elif mark[0] == "@":
                sign += 1
                cited = mark == "@@" or not cited
                bibl += cited

        if has_text:
            cuts = [0, *(off for off, m in marks if m == "//"), len(line.text)]
            first = len(out)
            for lo, hi in zip(cuts, cuts[1:]):
                for kind, text, at, value in line.pieces(lo, hi) if hi > lo else ():
                    while k < len(marks) and marks[k][0] <= at:
                        apply(marks[k][1])
                        k += 1
                    if (para, breaks) != last:
                        last, sent = (para, breaks), sent + 1
                    out.append([line.n, 0, at, kind, text, None, para, sent, star % 2 == 1 and star < stars, bibl if cited and sign < signs else 0, None, None, None, value])
            if len(out) > first:
                out[-1][LB if line.hyphen else EOL] = line.next_n
                if first == 0 or out[first - 1][PARA] != para:
                    out[first][SOL] = line.n
        for _, m in marks[k:]:
            apply(m)
    return out


def joined(tokens: list[list]) -> list[list]:
    """Tokens with the two parts of each split word as one of kind word_lb: lb_n is the number of the line that its second part is on. Numbers all tokens, from 1."""
    out, i, n = [], 0, len(tokens)
    while i < n:
        t = tokens[i]
        if t[LB] is not None:
            after = tokens[i + 1] if i + 1 < n else None
            if t[KIND] in ("word", "sic") and after is not None and after[KIND] == "word" and after[SENT] == t[SENT]:
                t = t.copy()
                t[LEFT], t[TEXT], t[KIND] = len(t[TEXT]), t[TEXT] + after[TEXT], t[KIND] + "_lb"
                if t[KIND] == "word_lb" and (t[EXP] or after[EXP]):
                    t[EXP] = (t[EXP] or t[TEXT][: t[LEFT]]) + (after[EXP] or after[TEXT])
                t[EOL] = after[EOL] if after[EOL] is not None else after[LB]
                i += 1
            else:
                t = t.copy()
                t[EOL], t[LB] = t[LB], None
        t[TOK] = len(out) + 1
        out.append(t)
        i += 1
    return out


def tokens_of(text: str) -> list[list]:
    return joined(scanned(lines_of(text)))


def rows_of(docs: DataFrame, schema: str, made: Callable[[str], list], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, schema): the rows that ``made`` gives for each text. Map-only, a portion of documents at a time."""
    from .columns import columns_of

    width = len(re.split(r",\s*(?![^<]*>)", schema))

    def portion(texts: list) -> tuple[list, list]:
        rows, which = [], []
        for i, t in enumerate(texts):
            found = made(t)
            rows += found
            which += [i] * len(found)
        return which, list(zip(*rows)) if rows else [()] * width

    return columns_of(docs, schema, portion, key, text)


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, TOKEN): the tokens of each document, in order of tok_n. sol_n: the line that a paragraph begins with, at its first token; eol_n: the line
    that follows this token; lb_n: the line within it. left_len: length of the first part of a split word. bibl_id: the citation, numbered within the paragraph; 0 without one.
    para_id and sent_id count from 1; sentences without tokens aren't counted."""
    from . import columns

    return columns.columns_of(docs, TOKEN, columns.token_columns)


def raw_tokens(docs: DataFrame) -> DataFrame:
    """The same, before split words are joined; lb_n: the line that follows a word that is split."""
    return rows_of(docs, TOKEN, lambda t: scanned(lines_of(t)))


SPAN = "kind string, line_n int, start int, length int, continued boolean"


def spans_of(text: str) -> list[tuple]:
    """(kind, line_n, start, length, continued) of each part of an italic span, a citation or a sentence within a line; parts without a letter are left out."""
    lines, out = lines_of(text), []
    paragraphs_of(lines)
    full = [x for x in lines if x.text.strip()]
    for kind, opens in (("italic", "*"), ("bibl", "@")):
        begun = None
        for li, line in enumerate(lines):
            for off, m in line.marks:
                if m[0] != opens:
                    continue
                if begun is not None:
                    a, at = begun
                    for k in range(a, li + 1):
                        lo, hi = at if k == a else 0, off if k == li else len(lines[k].text)
                        lo, hi = min(lo, len(lines[k].text)), min(hi, len(lines[k].text))
                        if hi > lo:
                            out.append((kind, lines[k].n, lo, hi - lo, k > a))
                begun = (li, off) if begun is None or m == "@@" else None
    broken = True  # whether a sentence begins with the next text
    ends = {id(x) for x in full}
    for line in lines:
        cuts = [off for off, m in line.marks if m == "//"]
        if id(line) in ends:
            broken = broken or line.starts
            at = [0, *(min(c, len(line.text)) for c in cuts), len(line.text)]
            for k, (lo, hi) in enumerate(zip(at, at[1:])):
                if k:
                    broken = True
                if line.text[lo:hi].strip():
                    out.append(("sentence", line.n, lo, hi - lo, not broken))
                    broken = False
        elif cuts:
            broken = True
    return out


def spans(docs: DataFrame) -> DataFrame:
    return rows_of(docs, SPAN, spans_of)


def runs(tokens: DataFrame, within: list[str]) -> DataFrame:
    """(within…, run columns): the outer runs of italics and the inner runs of citations of each sentence: tokens that agree in sentence, italics and citation and
    follow one another. ``within`` names the columns that tell documents apart."""
    from pyspark.sql import Window

    order = Window.partitionBy(*within).orderBy("tok_n")
    state = F.struct("sent_id", "italic", "bibl_id")
    d = tokens.withColumn("new", F.coalesce((F.lag(state).over(order) != state).cast("int"), F.lit(1)))
    d = d.withColumn("run_id", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*within, "run_id").agg(F.first("sent_id").alias("sent_id"), F.first("italic").alias("italic"), F.first("bibl_id").alias("bibl_id"), F.min("tok_n").alias("first_tok"), F.count("*").alias("n_tokens"))


def in_span(spans: Column, offset: Column) -> Column:
    """Whether a character offset lies within one of an array of spans (start, length); a null length goes to the end of the line."""
    return F.exists(spans, lambda s: (s["start"] <= offset) & (s["length"].isNull() | (offset < s["start"] + s["length"])))
