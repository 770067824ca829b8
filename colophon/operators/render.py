"""Editions as TEI XML and as HTML: the last step, text for each document. Map-only: a document's tokens are made, resolved and written where its row is."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache
from xml.sax.saxutils import escape, quoteattr, unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.functions.lexicon import table

from . import citations as C
from . import columns as K
from . import scan
from .resolve import is_plain, resolve
from .scan import EOL, EXP, KIND, LB, LEFT, PARA, SENT, SOL, TEXT

TEI = "http://www.tei-c.org/ns/1.0"


def _w(x: str, t: list, split: bool) -> str:
    if split and t[LEFT] is not None:
        n = f' n="{t[LB]}"' if t[LB] else ""
        return f'<w>{escape(x[: t[LEFT]])}<lb break="no"{n}/>{escape(x[t[LEFT] :])}</w>'
    return f"<w>{escape(x)}</w>"


def element(t: list) -> str:
    """A token as TEI, with the line breaks before and after it."""
    sol = f'<lb n="{t[SOL]}"/>' if t[SOL] else ""
    return sol + _element(t) + (f'<lb n="{t[EOL]}"/>' if t[EOL] else "")


def _element(t: list) -> str:
    kind, x = t[KIND], t[TEXT]
    if kind in ("pc", "dot"):
        sub = ' subtype="open"' if x in "[(" else ' subtype="close"' if x in "])" else ""
        made = f'<pc type="{table("mark_types").get(x, "other")}"{sub}>{escape(x)}</pc>'
    elif kind == "amp":
        made = "<choice><abbr><w>&amp;</w></abbr><expan><w>et</w></expan></choice>"
    elif kind.startswith("sic"):
        first = x if t[LEFT] is None else x[: t[LEFT]]
        made = f"<choice><sic><w>{escape(first)}</w></sic><corr>{escape(t[EXP] or '')}</corr></choice>"
        if t[LEFT] is not None:
            made += f'<lb break="no" n="{t[LB]}"/>' + element(["", 0, 0, "word", x[t[LEFT] :], *[None] * 9])
    else:
        c = resolve(kind, x, t[EXP]) if t[EXP] else resolve(kind, x)
        if c.kind == "plain":
            made = _w(x, t, True)
        elif c.kind in ("abbr", "macron"):
            print_ = f"<choice><orig>{_w(c.inner, t, True)}</orig><reg>{_w(x, t, False)}</reg></choice>" if c.inner else _w(c.orig, t, True)
            made = f"<choice><abbr>{print_}</abbr><expan><w>{escape(c.reg)}</w></expan></choice>"
        elif c.kind == "long_s_macron":
            made = f"<choice><abbr><choice><orig>{_w(c.orig, t, True)}</orig><reg>{_w(x, t, False)}</reg></choice></abbr><expan><w>{escape(c.reg)}</w></expan></choice>"
        else:
            print_ = f"<choice><orig>{_w(c.inner, t, True)}</orig><reg>{_w(x, t, False)}</reg></choice>" if c.inner else _w(c.orig, t, True)
            made = f"<choice><orig>{print_}</orig><reg><w>{escape(c.reg)}</w></reg></choice>"
    return made


def form_element(kind: str, x: str) -> str:
    """A token of this form, without line breaks."""
    if kind == "word" and is_plain(x):
        return f"<w>{escape(x)}</w>"
    return _element([None, None, None, kind, x, *[None] * 9])


def _citation(cited: C.Cited, i: int, j: int, stretch: Callable[[int, int], list[str]], made: Callable[[int], str], breaks: Callable[[int, str], list[str]]) -> tuple[list[str], str]:
    """(pieces of the bibl of a marked citation, with its work, author and locators; its base for an id). stretch: the pieces of tokens between those that are told apart here."""
    x, c = cited.named(i, j), cited.c
    bib, person, cert = x.work
    if not bib:
        return ["<bibl>", *stretch(i, j), "</bibl>"], "noref"
    of, out, at = dict(cited.locators_of(i, j)), [f'<bibl corresp="#{bib}" cert="{cert}">'], i
    end = None if x.author is None else x.author + x.author_tokens - 1
    short = cited.abbrs[bisect_left(cited.abbrs, i) : bisect_left(cited.abbrs, j)]
    for k in sorted({*of, *short, *(() if end is None else (x.author, end))}):
        out += stretch(at, k)
        at = k + 1
        if k == x.author:
            out.append("<author>" if not person else f'<author ref="#{person}">')
        e = made(k)
        if c.kind[k] == K.ABBREV and "<choice>" not in e:
            w = f"<w>{escape(c.texts[k])}</w>"
            e = e.replace(w, f'<choice><abbr>{w}</abbr><expan><w/><supplied cert="low">[expansion wanted]</supplied></expan></choice>')
        if k in of:
            e = re.sub(r"(<w>.*?</w>)", lambda m: f"<biblScope unit={quoteattr(of[k])}>{m[1]}</biblScope>", e, count=1)  # noqa: B023
        out += breaks(k, e)
        if k == end:
            out.append("</author>")
    return [*out, *stretch(at, j), "</bibl>"], bib.removeprefix("bib_")


def pieces_of(texts: list, columns_: list[str] | None = None, enrich: bool = True) -> Iterator[list[str]]:
    """The tags, elements of tokens, line breaks and citations of each document, one after another. columns_: their names, for the ids of citations; without, these have none."""
    lines = [K.lines_of(t) for t in texts]
    c = K.Tokens(lines)
    kinds = [(K.KINDS[k], x) for k, x in c.forms]
    whole = [form_element(*f) if f[0] != "word_lb" else "" for f in kinds]
    form, sol, eol, lb, left = (x.tolist() for x in (c.form, c.sol_n, c.eol_n, c.lb_n, c.left_len))
    broken = np.flatnonzero((c.sol_n > 0) | (c.eol_n > 0) | (c.left_len > 0)).tolist()  # tokens with a line break
    first, end = c.runs(c.para_id, c.sent_id, c.italic, c.bibl_id)
    runs = list(zip(first.tolist(), end.tolist(), c.para_id[first].tolist(), c.sent_id[first].tolist(), c.italic[first].tolist(), c.bibl_id[first].tolist()))
    per_doc = np.bincount(c.doc[first], minlength=len(texts)).tolist()
    at = 0

    def made(i: int) -> str:
        return _element([None, None, None, *kinds[form[i]], left[i], *[None] * 6, lb[i], None]) if left[i] else whole[form[i]]

    def breaks(i: int, e: str) -> list[str]:
        return [*([f'<lb n="{sol[i]}"/>'] if sol[i] else []), e, *([f'<lb n="{eol[i]}"/>'] if eol[i] else [])]

    def stretch(i: int, j: int) -> list[str]:
        out: list[str] = []
        for k in broken[bisect_left(broken, i) : bisect_left(broken, j)]:
            out += [whole[f] for f in form[i:k]]
            out += breaks(k, made(k))
            i = k + 1
        return out + [whole[f] for f in form[i:j]] if out else [whole[f] for f in form[i:j]]

    cited = C.Cited(c) if enrich else None
    for d, x in enumerate(lines):
        out, n, open_ = [], 0, (None, None, None)
        for i, j, para, sent, italic, bibl in runs[at : at + per_doc[d]]:
            state = (para, sent, italic)
            if state != open_:
                _turn(out, open_, state)
                open_ = state
            if bibl and enrich:
                n += 1
                pieces, base = _citation(cited, i, j, stretch, made, breaks)
                out += [f"<cit xml:id={quoteattr(f'cit_{columns_[d]}_{base}_{n}')}>" if columns_ else "<cit>", *pieces, "</cit>"]
                continue
            if bibl:
                out.append("<bibl>")
            out += stretch(i, j)
            if bibl:
                out.append("</bibl>")
        at += per_doc[d]
        _turn(out, open_, (None, None, None))
        if next((h for _, t, h, _ in reversed(x) if t and not t.isspace()), False):  # the column ends within a word
            k = next((k for k in range(len(out) - 1, -1, -1) if "</w>" in out[k]), None)
            if k is not None:
                before, _, after = out[k].rpartition("</w>")
                out[k] = before + '<lb break="no"/></w>' + after
        yield out


def _turn(out: list[str], old: tuple, new: tuple) -> None:
    """Tags between two runs of tokens (paragraph, sentence, italics)."""
    ends = ["</hi>" if old[2] else "", "</s>" if old[1] and new[:2] != old[:2] else "", "</p>" if old[0] and new[0] != old[0] else ""]
    starts = ["<p>" if new[0] and new[0] != old[0] else "", "<s>" if new[1] and new[:2] != old[:2] else "", '<hi rend="italic">' if new[2] else ""]
    out += filter(None, ends + starts)


def teis_of(texts: list, columns_: list[str], pages: list[str], enrich: bool = True) -> list[str]:
    """The divs of columns."""
    return [f'<div xmlns="{TEI}" type="page" n={quoteattr(page)}>{"".join(p)}</div>' for p, page in zip(pieces_of(texts, columns_, enrich), pages)]


def tei_of(text: str, column: str = "col", page: str = "", enrich: bool = True) -> str:
    """The div of a column."""
    return teis_of([text], [column], [page], enrich)[0]


def tei(docs: DataFrame, enrich: bool = True) -> DataFrame:
    """(doc_id, tei)"""
    return K.columns_of(docs, "tei string", lambda t: (range(len(t)), [teis_of(t, ["col"] * len(t), [""] * len(t), enrich)]))


def heading_of(lines: list[scan.Line], kind: str | None = None) -> str:
    """Lines of a heading: each begins with its number; a split word takes the first token of the next line; a line that is italic for four fifths is so whole."""
    out, used = [], False
    tokens = [[[x.n, 0, at, k, t, None, 1, 1, False, 0, None, None, None, v] for k, t, at, v in x.pieces(0, len(x.text))] for x in lines]
    for i, x in enumerate(lines):
        row = tokens[i]
        out.append("" if used else f'<lb n="{x.n}"/>')
        used = False
        if x.hyphen and i + 1 < len(lines) and row and tokens[i + 1]:
            row[-1][LB] = lines[i + 1].n
            row.append(tokens[i + 1].pop(0))
            used = True
        made = "".join(map(element, scan.joined(row)))
        stars = [off for off, m in x.marks if m == "*"]
        whole = len(stars) >= 2 and stars[0] == 0 and stars[1] >= 0.8 * len(x.text.rstrip())
        out.append(f'<hi rend="italic">{made}</hi>' if whole else made)
    return f'<head type="{kind}">' + "".join(out) + "</head>" if kind else "<head>" + "".join(out) + "</head>"


def trimmed(text: str, spans: list[tuple[int, int]], offset: int) -> tuple[str, list[tuple[int, int]]]:
    """A line from offset on, without white space before it, and its spans (start, length) moved with it."""
    rest = text[offset:].lstrip()
    at = len(text) - len(rest)
    return rest, [(max(0, s - at), n - max(0, at - s)) for s, n in spans if s + n > at]


def summary_items(lines: list[tuple[str, list[tuple[int, int]], bool]]) -> list[tuple[str | None, list[str]]]:
    """(label, lines) of each item of a summary, from lines (text, index entries, whether its first sentence goes on): an item begins with an index entry, which is its label, or where
    no sentence goes on."""
    items: list[list] = []
    for text, entries, goes_on in lines:
        if not text.strip():
            continue
        if not items or entries or not goes_on:
            items.append([])
        items[-1].append((text, entries))
    out = []
    for item in items:
        text, entries = item[0]
        label = None
        if entries:
            s, n = entries[0]
            label, text = text[s : s + n].strip(), trimmed(text, [], s + n)[0]
        out.append((label, [text, *(t for t, _ in item[1:])]))
    return out


def block_of(kind: str | None, lines: list[tuple]) -> str:
    """A block of page lines of one structure type as TEI; lines: (line_n, text, first_x, spans, index entries, whether the first sentence goes on)."""
    if kind in ("heading", "header", "subheading"):
        return heading_of([scan.Line(n, t, x, s) for n, t, x, s, _, _ in lines], "sub" if kind == "subheading" else None)
    if kind == "summarium":
        items = []
        for label, texts in summary_items([(t, e, g) for _, t, _, _, e, g in lines]):
            inner = "".join(element(t) for t in scan.tokens_of("\n".join(texts)))
            items.append(f"<item n={quoteattr(label)}><label>{escape(label)}</label><s>{inner}</s></item>" if label else f"<item><s>{inner}</s></item>")
        return '<div type="summarium"><list>' + "".join(items) + "</list></div>"
    tokens, out, before = scan.joined(scan.scanned([scan.Line(n, t, x, s) for n, t, x, s, _, _ in lines])), [], (None, None)
    for t in tokens:
        now = (t[PARA], t[SENT])
        if now != before:
            out.append(("</s>" if before[1] else "") + ("</p>" if before[0] and before[0] != now[0] else "") + ("<p>" if before[0] != now[0] else "") + "<s>")
            before = now
        out.append(element(t))
    return "".join(out) + ("</s></p>" if tokens else "")


def page_tei(lines: DataFrame) -> DataFrame:
    """(path, tei) of page lines (sources.files.page_lines): blocks of one structure type in order, stand-off abbreviations and errors resolved."""
    from colophon.sources.files import spans

    custom = F.col("custom")
    off = lambda tag, value: F.transform(spans(custom, tag, value), lambda s: F.struct(s["start"].alias("o"), s["length"].alias("n"), F.lit(tag).alias("k"), s["value"].alias("v")))
    row = F.struct(
        "line_n", "structure_type", F.regexp_replace("raw", r"(?U)\s+$", "").alias("text"), "first_x", F.concat(off("abbrev", "expansion"), off("sic", "corr")).alias("spans"),
        F.transform(spans(custom, "index_entry"), lambda s: F.struct(s["start"].alias("s"), s["length"].alias("n"))).alias("entries"), F.coalesce(F.get(spans(custom, "sentence"), 0)["continued"], F.lit(True)).alias("goes_on"),
    )
    d = lines.groupBy("path").agg(F.to_json(F.array_sort(F.collect_list(row))).alias("text"))  # a group is a page

    def made(text: str) -> list[tuple]:
        import json
        from itertools import groupby

        rows = json.loads(text)
        parts = []
        for kind, group in groupby(rows, key=lambda r: r.get("structure_type")):
            parts.append(block_of(kind, [(r["line_n"], r["text"], r["first_x"], [(s["o"], s["n"], s["k"], s.get("v") or "") for s in r["spans"]], [(s["s"], s["n"]) for s in r["entries"]], r["goes_on"]) for r in group]))
        return [(f'<div xmlns="{TEI}" type="page">{"".join(parts)}</div>',)]

    return scan.rows_of(d, "tei string", made, "path")


def assembled(columns: DataFrame, header: str = "") -> DataFrame:
    """(tei): one edition of columns (col_seq, tei) in reading order, after a header. One row: what a reader opens. Its size is the edition's; for a corpus, assemble by work."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_seq", "tei"))), lambda x: x["tei"]), "\n")
    return columns.agg(F.concat(F.lit(f'<TEI xmlns="{TEI}">{header}<text><body>'), body, F.lit("</body></text></TEI>")).alias("tei"))


CLASSES = {"p": "p", "s": "s", "q": "q", "item": "li", "list": "ul", "label": "span", "head": "h2", "cit": "span", "author": "span", "biblScope": "span", "bibl": "span", "note": "span", "num": "span", "hi": "i"}


def _name(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def html_element(e: ET.Element, tooltips: bool = True) -> str:
    """An element of TEI as HTML."""

    def word(e: ET.Element) -> str:
        out = escape(e.text or "")
        for x in e:
            out += ("<br class='within'/>" if _name(x) == "lb" else "") + escape(x.tail or "")
        return out

    def shown(e: ET.Element) -> tuple[str, str]:
        """(printed, read) of a choice."""
        words = [w for w in e.iter() if _name(w) == "w" and (w.text or len(w))]
        read = next((r for r in e if _name(r) in ("expan", "reg", "corr")), None)
        return (word(words[0]) if words else ""), ("".join(read.itertext()).strip() if read is not None else "")

    def tip(e: ET.Element, read: str) -> str:
        w = next((x for x in e.iter() if x.get("lemma")), None)
        said = [read] if read else []
        if w is not None:
            said += [w.get("lemma"), w.get("pos") or ""] + [f"{k}: {v}" for k, _, v in (f.partition("=") for f in (w.get("msd") or "").split("|") if f)]
        return f" title={quoteattr('; '.join(x for x in said if x))}" if tooltips and said else ""

    def many(parent: ET.Element) -> str:
        out, children = "", list(parent)
        for i, e in enumerate(children):
            after = _name(children[i + 1]) if i + 1 < len(children) else ""
            gap = "" if after == "pc" or (after == "lb" and children[i + 1].get("break") == "no") else " "
            out += one(e) + (gap if _name(e) in ("w", "choice", "pc", "cit", "hi", "bibl") else "")
        return out

    def one(e: ET.Element) -> str:
        name = _name(e)
        if name in ("fw", "cb", "teiHeader", "note", "num") and e.get("place") != "margin":
            return ""
        if name == "w":
            return f"<span class='w'{tip(e, '')}>{word(e)}</span>"
        if name == "pc":
            return f"<span class='pc'>{escape(e.text or '')}</span>"
        if name == "choice":
            print_, read = shown(e)
            kind = _name(e[0]) if len(e) else "choice"
            return f"<span class='choice {kind}'{tip(e, read)}>{print_}</span>"
        if name == "lb":
            n = e.get("n")
            if e.get("break") == "no":
                return "<br class='within'/>"
            return "<br/>" if not n else f"<br/><span class='n{' fifth' if int(n) % 5 == 0 else ''}'>{n}</span>"
        if name in CLASSES:
            extra = "".join(f" data-{k}={quoteattr(e.get(k))}" for k in ("corresp", "ref", "unit", "cert", "part") if e.get(k))
            return f"<{CLASSES[name]} class='{name}'{extra}>{many(e)}</{CLASSES[name]}>"
        return f"<div class={quoteattr(e.get('type') or name)}>{many(e)}</div>"

    return one(e)


def html_of(tei: str, tooltips: bool = True) -> str:
    """A column's TEI as HTML: the printed reading is shown, what is read (and lemma, part of speech, features) is its tooltip; no blank before punctuation or a break
    within a word; every fifth line has its number; the other reading of a choice, running titles and comments are left out."""
    return html_element(ET.fromstring(tei), tooltips)


TAGS = {"<p>": "<p class='p'>", "<s>": "<s class='s'>", '<hi rend="italic">': "<i class='hi'>", "</p>": "</p>", "</s>": "</s>", "</hi>": "</i>", "<cit>": "<span class='cit'>", "</cit>": "</span>", "</bibl>": "</span>", "</author>": "</span>"}


_CHOICE = re.compile(r"<choice><(orig|abbr)><w>([^<]*)</w></\1><(reg|expan)><w>([^<]*)</w></\3></choice>")


class _Html(dict):
    """(HTML before a mark, HTML before anything else, whether it is a mark) of pieces."""

    def __init__(self, tooltips: bool):
        self.tooltips = tooltips

    def made(self, piece: str) -> str:
        if piece in TAGS:
            return TAGS[piece]
        if piece.startswith("<w>") and piece.find("<", 3) == len(piece) - 4:  # rare words, which no cache holds: without a parser
            return f"<span class='w'>{piece[3:-4]}</span>"
        if m := _CHOICE.fullmatch(piece):
            read = unescape(m[4]).strip()
            return f"<span class='choice {m[1]}'{f' title={quoteattr(read)}' if self.tooltips and read else ''}>{m[2]}</span>"
        if piece.startswith(("<author", "<bibl>", "<bibl ")):  # an opening tag
            return html_element(ET.fromstring(piece[:-1] + "/>"), self.tooltips).removesuffix("</span>")
        return html_element(ET.fromstring(piece), self.tooltips)

    def __missing__(self, piece: str) -> tuple[str, str, bool]:
        made = self.made(piece)
        if len(self) >= 20_000:
            self.clear()
        self[piece] = found = made, made + " " * piece.startswith(("<w", "<choice", "<pc", "</cit", "</hi", "</bibl")), piece.startswith("<pc")
        return found


_html_piece = cache(_Html)


def htmls_of(texts: list, tooltips: bool = True) -> list[str]:
    """html_of of the editions of texts, without the editions: what one of pieces_of looks like depends on it alone, and the blank after it on whether a mark comes next."""
    of, out = _html_piece(tooltips).__getitem__, []
    for pieces in pieces_of(texts):
        made = list(map(of, pieces))
        out.append(f'<div class="page">{"".join([x[not after[2]] for x, after in zip(made, [*made[1:], ("", "", False)])])}</div>')
    return out


def html_of_documents(docs: DataFrame, tooltips: bool = True) -> DataFrame:
    """(doc_id, html): html(tei(docs)) in one pass; an edition is many times its text, so none is handed from one pass to another."""
    return K.columns_of(docs, "html string", lambda t: (range(len(t)), [htmls_of(t, tooltips)]))


def html(editions: DataFrame, tooltips: bool = True, key: str = "doc_id") -> DataFrame:
    """(key, html) of (key, tei)"""
    return scan.rows_of(editions, "html string", lambda t: [(html_of(t, tooltips),)] if t else [], key, "tei")


def page_html(columns: list[str], title: str) -> str:
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'/><title>{escape(title)}</title></head><body>" + "".join(f"<section class='column'>{c}</section>" for c in columns) + "</body></html>"

