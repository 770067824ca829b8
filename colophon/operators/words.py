"""Words for annotation: which form of each word is annotated, and an annotation of distinct forms joined back.

An annotator sees one word at a time, without context, so it is asked once for each distinct form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import columns
from .resolve import is_plain, resolve

WORD = "tok_n int, form string, norm string, reading string"


def norm_text(left: Column, right: Column) -> Column:
    """A word without its line break, and without the hyphen at its end."""
    return F.regexp_replace(F.trim(F.concat(left, F.coalesce(right, F.lit("")))), "-$", "")


READING = {"abbr": "expan", "macron": "expan", "long_s_macron": "expan", "plain": "w"}


def _form(kind: int, x: str) -> tuple[str, str, str] | None:
    if kind in (columns.PC, columns.DOT):
        return None
    if kind == columns.AMP:
        return "&", "et", "expan"
    if kind == columns.WORD and is_plain(x):
        return x, x, "w"  # no word ends in a hyphen
    c = resolve(columns.KINDS[kind], x)
    norm = c.reg.strip().removesuffix("-")
    return (c.inner or c.orig, norm, READING.get(c.kind, "orig")) if norm else None


def _words(texts: list) -> tuple:
    c = columns.scanned(texts)
    forms = [_form(k, x) for k, x in c.forms]
    known = np.array([f is not None for f in forms], bool)[c.form] & (c.bibl_id == 0)
    at = pa.array(c.form[known])
    return c.doc[known], [c.tok_n[known], *(pa.array([f and f[i] for f in forms], pa.string()).take(at) for i in range(3))]


def annotatable(docs: DataFrame) -> DataFrame:
    """(doc_id, WORD): (place, form as printed, form for the annotator, which reading is annotated) of words outside citations: of an abbreviation its expansion, of another choice the
    printed form with the regular one's annotation, else the word. Abbreviations without expansion aren't annotated."""
    return columns.columns_of(docs, WORD, _words)


def norms(docs: DataFrame) -> DataFrame:
    """(norm, n): the distinct forms for the annotator among annotatable words, and how many words have each; added up within a portion first."""

    def made(texts: list) -> list:
        c = columns.scanned(texts)
        found, _, n = columns.counted(c, c.bibl_id == 0)
        forms = [_form(k, x) for k, x in found]
        return [[f[1] for f in forms if f], [k for f, k in zip(forms, n.tolist()) if f]]

    return columns.columns_of(docs, "norm string, n long", made, None).groupBy("norm").agg(F.sum("n").alias("n"))


def annotated(words: DataFrame, annotator: DataFrame) -> DataFrame:
    """words with (lemma, pos, msd) of an annotator's table (text, lemma, pos, msd as Feature=Value|…); msd becomes a map. Words that the table doesn't know have nulls.
    A form may hold a large share of all words, so the join is left to the planner: adaptive execution broadcasts a table that is small and splits a skewed form where it isn't."""
    a = annotator.dropDuplicates(["text"]).select(F.col("text").alias("norm"), "lemma", "pos", features(F.col("msd")).alias("msd"))
    return words.join(a, "norm", "left")


def features(msd: Column) -> Column:
    return F.when(F.length(msd) > 0, F.str_to_map(msd, F.lit("[|]"), F.lit("=")))


def feature_rows(annotated: DataFrame) -> DataFrame:
    """(feature, value, n); annotated may have a column n, how many words a row stands for."""
    n = F.sum("n") if "n" in annotated.columns else F.count("*")
    return annotated.select(F.explode("msd").alias("feature", "value"), *(["n"] if "n" in annotated.columns else [])).groupBy("feature", "value").agg(n.alias("n"))


def shows_number(line_n: Column) -> Column:
    """Every fifth line has its number shown."""
    return line_n % 5 == 0
