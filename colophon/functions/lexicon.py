"""Lexical tables, kept as data in lexicon.json."""

from __future__ import annotations

import json
from functools import cache
from pathlib import Path


@cache
def table(name: str) -> dict | tuple:
    """A dict for tables of pairs, a tuple for sets."""
    found = json.loads((Path(__file__).parent / "lexicon.json").read_text())[name]
    return dict(zip(found["keys"], found["values"])) if isinstance(found, dict) else tuple(found)


@cache
def known(name: str) -> frozenset:
    """The same as a set: of the keys of a table of pairs."""
    return frozenset(table(name))


def quoted(words) -> str:
    """A comma-separated list of SQL string literals."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
