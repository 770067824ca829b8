"""Spelling rules as SQL text of built-ins; each takes and gives SQL expressions."""

from __future__ import annotations

from .lexicon import table

VOWELS = "āēīōūĀĒĪŌŪ"
PLAIN = "aeiouAEIOU"


def initial_upper(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) = substr({x}, 1, 1) AND lower(substr({x}, 1, 1)) <> substr({x}, 1, 1))"


def with_initial_of(form: str, x: str) -> str:
    return f"CASE WHEN {initial_upper(x)} THEN concat(upper(substr({form}, 1, 1)), substr({form}, 2)) ELSE {form} END"


def _replaced(e: str, pairs) -> str:
    for a, b in pairs:
        e = f"replace({e}, '{a}', '{b}')"
    return e


def macrons(x: str) -> str:
    """A vowel with a macron is followed by m as the last letter before final dots, else by n."""
    stem = f"rtrim('.', {x})"
    head, last = f"substr({stem}, 1, length({stem}) - 1)", f"substr({stem}, length({stem}), 1)"
    to = lambda end: [(v, p + end) for v, p in zip(VOWELS, PLAIN)]
    return f"concat({_replaced(head, to('n'))}, {_replaced(last, to('m'))}, substr({x}, length({stem}) + 1))"


def has_macron(x: str) -> str:
    return f"(translate({x}, '{VOWELS}', '{'.' * len(VOWELS)}') <> {x})"


def long_s_hit(low: str) -> str:
    """The first of the roots that a word in small letters holds, or null."""
    return "CASE " + " ".join(f"WHEN instr({low}, '{a}') > 0 THEN '{a}'" for a in table("long_s_roots")) + " END"


def long_s_of_hit(hit: str) -> str:
    return f"CASE {hit} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table("long_s_roots").items()) + " END"


def plain_letters(x: str) -> str:
    return _replaced(x, table("plain_letters").items())


def plain_form(x: str) -> str:
    """x in plain letters, macrons written out, without final dots."""
    return f"rtrim('.', {_replaced(plain_letters(x), table('macron_letters').items())})"


def classify_tag(x: str, expansion: str, plain: str) -> str:
    """abbr or orig of a form, its expansion and its plain_form, by rules in order."""
    return (
        f"CASE WHEN {expansion} IS NULL OR {expansion} = '' THEN 'orig' WHEN trim({x}) IN ('&', '&amp;') THEN 'abbr' WHEN rtrim({x}) LIKE '%.' THEN 'abbr' WHEN {has_macron(x)} THEN 'abbr' "
        f"WHEN length({expansion}) - length(rtrim('.', {x})) > 3 THEN 'abbr' WHEN lower({plain}) = lower({expansion}) THEN 'orig' WHEN abs(length({plain}) - length({expansion})) <= 1 THEN 'orig' ELSE 'abbr' END"
    )


def normalize_key(x: str) -> str:
    """Small letters and digits only, without accents: letters are taken apart and their marks dropped, by a table of all Latin letters."""
    accented, bare = latin_letters()
    return f"regexp_replace(translate(lower({x}), '{accented}', '{bare}'), '[^a-z0-9]', '')"


def latin_letters() -> tuple[str, str]:
    """Small Latin letters with marks, and the letter without: what Unicode's decomposition gives."""
    import unicodedata

    pairs = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        low = chr(code).lower()
        base = unicodedata.normalize("NFD", low)[0]
        if len(low) == 1 and base != low and base in "abcdefghijklmnopqrstuvwxyz":
            pairs[low] = base
    return "".join(pairs), "".join(pairs.values())
