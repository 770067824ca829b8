"""Lines of documents: a document is a column of a page, its line ends separate the lines. Lines stay an array of their row until they are needed one by one, so
that what looks at a line's neighbours exchanges nothing, and rows that repeat an id, or have none, stay apart. White space is Unicode's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRIM = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def line_array(text: Column) -> Column:
    """array<struct<line_n, text, soft_hyphen>>: lines that aren't blank; line_n counts the blank ones too, from 1. A soft hyphen at the end is taken off. A null text has none."""
    trimmed = F.transform(F.split(text, "\n"), lambda x, i: F.struct((i + 1).alias("line_n"), F.regexp_replace(x, TRIM, "").alias("t")))
    full = F.filter(trimmed, lambda x: x["t"] != "")
    return F.transform(full, lambda x: F.struct(x["line_n"].alias("line_n"), F.regexp_replace(x["t"], r"(?U)[\s\x1c-\x1f]*¬$", "").alias("text"), x["t"].endswith("¬").alias("soft_hyphen")))


def with_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, ls)"""
    return docs.select("doc_id", line_array(F.col("text")).alias("ls"))


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_n, text, soft_hyphen), a row for each line."""
    return with_lines(docs).select("doc_id", F.inline("ls"))


def normalized(text: Column) -> Column:
    """Without white space at the ends, and runs of blanks as one."""
    return F.regexp_replace(F.regexp_replace(text, TRIM, ""), "  +", " ")


def line_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_cleaned): lines kept, blank lines that go, and lines that normalisation changes."""
    raw = F.transform(F.split("text", "\n"), lambda x: F.regexp_replace(x, TRIM, ""))
    d = docs.where("text is not null").select("doc_id", raw.alias("raw"))
    return d.select(
        "doc_id", F.size(F.filter("raw", lambda x: x != "")).alias("n_lines"), F.size(F.filter("raw", lambda x: x == "")).alias("n_removed"), F.size(F.filter("raw", lambda x: normalized(x) != x)).alias("n_cleaned")
    )


def suspicious_continuations(docs: DataFrame) -> DataFrame:
    """(doc_id, line_n, text, next_text): lines without a hyphen at the end before one that starts with a small letter."""
    pairs = F.transform("ls", lambda x, i: F.struct(x["line_n"].alias("line_n"), x["text"].alias("text"), F.get(F.col("ls"), i + 1)["text"].alias("next_text"), x["soft_hyphen"].alias("h")))
    odd = F.filter(pairs, lambda x: ~x["h"] & ~x["text"].endswith("-") & x["next_text"].rlike(r"^\p{Ll}"))
    return with_lines(docs).select("doc_id", F.inline(odd)).drop("h")


def catchword(ls: Column) -> Column:
    """The last line, where it has two words at most, no hyphen, and is short or follows a hyphen; else null."""
    last, before = F.get(ls, F.size(ls) - 1), F.get(ls, F.size(ls) - 2)
    short = (F.length(last["text"]) <= 5) | F.coalesce(F.when(F.size(ls) > 1, before["soft_hyphen"]), F.lit(False))
    return F.when(~last["soft_hyphen"] & (F.size(F.split(last["text"], r"(?U)\s+")) <= 2) & short, last)


def catchwords(docs: DataFrame) -> DataFrame:
    """(doc_id, line_n, catchword, stem): stem without the dots and hyphens at its end, as the next column gets it."""
    d = with_lines(docs).where(F.size("ls") > 0).select("doc_id", catchword(F.col("ls")).alias("c")).where("c is not null")
    return d.select("doc_id", "c.line_n", F.col("c.text").alias("catchword"), F.regexp_replace(F.regexp_replace("c.text", r"[.\-]+$", ""), TRIM, "").alias("stem"))


def without_catchword(docs: DataFrame) -> DataFrame:
    """(doc_id, ls, catchword): the lines without the catchword's."""
    d = with_lines(docs).withColumn("c", catchword(F.col("ls")))
    return d.select("doc_id", F.when(F.col("c").isNotNull(), F.slice("ls", F.lit(1), F.size("ls") - 1)).otherwise(F.col("ls")).alias("ls"), F.col("c.text").alias("catchword"))


def clean_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the lines again, with hyphens; documents without lines have no row."""
    d = with_lines(docs).where(F.size("ls") > 0)
    return d.select("doc_id", F.array_join(F.transform("ls", lambda x: F.concat(x["text"], F.when(x["soft_hyphen"], "¬").otherwise(""))), "\n").alias("text"))


def region_text(lines: DataFrame, within: list[str]) -> DataFrame:
    """(within…, text): the same of lines (line_n, region_id, text, soft_hyphen), with a blank line where the region changes."""
    row = F.struct("line_n", "region_id", F.concat("text", F.when(F.col("soft_hyphen"), "¬").otherwise("")).alias("t"))
    d = lines.groupBy(*within).agg(F.array_sort(F.collect_list(row)).alias("a"))
    part = F.transform("a", lambda x, i: F.concat(F.when((i > 0) & (F.get(F.col("a"), i - 1)["region_id"] != x["region_id"]), "\n").otherwise(""), x["t"]))
    return d.select(*within, F.array_join(part, "\n").alias("text"))
