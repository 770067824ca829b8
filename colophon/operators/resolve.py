"""The choice resolver for one form at a time, for operators that build an element tree and so go over a document's tokens in order. ``tokens.choices`` is the same
for a table of forms; tests hold one against the other."""

from __future__ import annotations

import re
import unicodedata
from functools import cache, lru_cache
from typing import NamedTuple

from colophon.functions.lexicon import table

FINAL = {v: p + "m" for v, p in zip("āēīōūĀĒĪŌŪ", "aeiouAEIOU")}
MEDIAL = {v: p + "n" for v, p in zip("āēīōūĀĒĪŌŪ", "aeiouAEIOU")}


class Choice(NamedTuple):
    kind: str
    orig: str
    inner: str | None
    reg: str


def macrons(x: str) -> str:
    end = len(x.rstrip(".")) - 1
    return "".join(FINAL.get(c, c) if i == end else MEDIAL.get(c, c) for i, c in enumerate(x))


def _initial(form: str, x: str) -> str:
    return form[0].upper() + form[1:] if x[:1].isupper() else form


def long_s_by_rule(x: str) -> str | None:
    low = made = x.lower()
    for a, b in table("long_s_roots").items():
        if a in made:
            made = made.replace(a, b, 1)
            break
    if "ss" in made:
        made = re.sub(r"ss(?=\w)", "ſſ", made)
    return None if made == low else _initial(made, x)


def expansion_of(x: str) -> str | None:
    one, two = table("expansions"), table("semicolon_expansions")
    return one.get(x, one.get(x.lower(), "")) or two.get(x, two.get(x.lower(), "")) or None


def classify_tag(x: str, expansion: str | None) -> str:
    if not expansion:
        return "orig"
    if x.strip() in ("&", "&amp;") or x.rstrip().endswith(".") or any(c in FINAL for c in x) or len(expansion) - len(x.rstrip(".")) > 3:
        return "abbr"
    plain = x
    for name in ("plain_letters", "macron_letters"):
        for a, b in table(name).items():
            plain = plain.replace(a, b)
    plain = plain.rstrip(".")
    return "orig" if plain.lower() == expansion.lower() or abs(len(plain) - len(expansion)) <= 1 else "abbr"


_ODD = re.compile("[sSſęĘ" + "".join(FINAL) + "]|ae")


def is_plain(x: str) -> bool:
    """Whether a word is told to be plain at a glance: no table has it, and it has none of the letters that a rule is about (each root of a long s has an s). Most distinct forms of a large table are rare
    words, which no cache holds, so this goes first."""
    return _ODD.search(x) is None and x not in table("regular_forms") and x.lower() not in table("long_s_forms")


@lru_cache(20_000)
def resolve(kind: str, x: str, expansion: str | None = None) -> Choice:
    """kind: word, abbrev_dot or word_lb. expansion: one that the source gives; abbreviations have theirs from the lexicon."""
    short, split = kind == "abbrev_dot" or expansion is not None, kind == "word_lb"
    expansion = expansion or (expansion_of(x) if kind == "abbrev_dot" else None)
    regular, forms = table("regular_forms"), table("long_s_forms")
    reg, long = regular.get(x) or regular.get(x.replace("ſ", "s")), None
    if x.lower() in forms:
        long = forms[x.lower()]
    elif split or not reg:
        long = long_s_by_rule(x)
        long = long and (long if x.isupper() and split else long)
    if long is not None:
        long = long.upper() if x.isupper() and (split or x.lower() in forms) else _initial(long, x)
        long = long if long != x else None
    if expansion:
        return Choice("abbr", x, long, expansion) if classify_tag(x, expansion) == "abbr" else Choice("reg", x, None, expansion)
    if reg:
        return Choice("reg", x, None if split else long, reg)
    macron = any(c in FINAL for c in x)
    if long:
        return Choice("long_s_macron", long, None, macrons(long).replace("ſ", "s")) if split and any(c in FINAL for c in long) else Choice("long_s", long, None, x)
    if not short and not (split and macron):
        if "ae" in x:
            return Choice("ae", x.replace("ae", "æ"), None, x)
        if not split and ("ę" in x or "Ę" in x):
            plain = x.replace("ę", "ae").replace("Ę", "Ae")
            print_ = forms.get(plain) or forms.get(plain.lower()) or long_s_by_rule(plain) or plain
            for a, b in (("ae", "ę"), ("æ", "ę"), ("Ae", "Ę"), ("Æ", "Ę")):
                print_ = print_.replace(a, b)
            return Choice("ae", print_, None, plain)
    if macron and not short:
        return Choice("macron", x, None, macrons(x).replace("ſ", "s"))
    return Choice("plain", x, None, x)


def normalize_key(x: str) -> str:
    if x.isascii() and x.isalnum():
        return x.lower()
    return re.sub("[^a-z0-9]", "", "".join(c for c in unicodedata.normalize("NFD", x.strip().lower()) if unicodedata.category(c) != "Mn"))


@lru_cache(20_000)
def work_of(key: str) -> str | None:
    """The key of a work in the catalogue: exact, else by four letters that one key begins with, else, if none does, by three."""
    works = table("works")
    if key in works:
        return key
    if len(key) < 3:
        return None
    hits = [k for k in works if k.startswith(key[:4])] or [k for k in works if k.startswith(key[:3])]
    return hits[0] if len(hits) == 1 else None


def lookup(key: str, surface: str) -> tuple[str, str | None, str] | None:
    """(bib_id, pers_id, cert) of a key; then the rules of context."""
    found = work_of(key)
    if found is None:
        return None
    bib, person, cert = table("works")[found]
    for who, word, other in _rules():
        if who == found and word in surface:
            return other, person, cert
    return bib, person, cert


@cache
def _rules() -> list[tuple[str, str, str]]:
    return [(*rule.split("|"), other) for rule, other in table("context_rules").items()]


@cache
def ruled() -> frozenset:
    """Works that a rule of context is about."""
    return frozenset(who for who, _, _ in _rules())
