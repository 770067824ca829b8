"""The steps of an edition, each a function from DataFrame to DataFrame, and a command line that runs them: normalize, tei, annotate, enrich, assemble, sentences, validate, html.

    python -m colophon.plans.steps STEP INPUT OUTPUT [--header FILE] [--annotator TABLE] [--simple] [--report] [--dry-run]

INPUT: staging files (or page-layout files, for normalize). With --dry-run nothing is written; with --report the step's report is shown."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators import citations, render, structure, words
from colophon.sources import files


def columns(spark: SparkSession, path: str) -> DataFrame:
    """Columns of staging files as documents: doc_id is the place in the reading order."""
    return files.staging(spark, path).withColumn("doc_id", F.col("col_seq").cast("long"))


def normalize(spark: SparkSession, path: str) -> DataFrame:
    return files.staged(files.page_lines(spark, path, by_order_only=True))


def edition(docs: DataFrame, enrich: bool = True) -> DataFrame:
    """(doc_id, column, tei)"""
    made = render.scan.rows_of(docs.select(F.struct("doc_id", "column").alias("row"), F.to_json(F.struct("column", F.col("page").cast("string").alias("page"), "text")).alias("text")), "tei string", lambda t: [(_tei(t, enrich),)], "row")
    return made.select("row.doc_id", "row.column", "tei")


def _tei(packed: str, enrich: bool) -> str:
    import json

    x = json.loads(packed)
    return render.tei_of(x.get("text", ""), x.get("column", "col"), x.get("page") or "", enrich)


def enrich(docs: DataFrame) -> DataFrame:
    named = citations.citations(docs.select(F.struct("doc_id", "column").alias("row"), "text"), "row", "row.column", locators=True)
    return named.select("row.doc_id", "row.column", "cit_id", *[c for c in named.columns if c not in ("row", "cit_id")])


def validate(editions: DataFrame) -> DataFrame:
    """(id, n): the first five xml:ids that stand more than once. A tei that isn't well formed raises."""
    ids = F.regexp_extract_all("tei", F.lit('xml:id="([^"]*)"'), F.lit(1))
    formed = editions.where(F.length(F.xpath_string("tei", F.lit("name(/*)"))) > 0)
    return formed.select(F.explode(ids).alias("id")).groupBy("id").agg(F.count("*").alias("n")).where("n > 1").orderBy("id").limit(5)


def main(args: list[str] | None = None) -> None:
    a = argparse.ArgumentParser(description=__doc__)
    a.add_argument("step", choices=["normalize", "tei", "annotate", "enrich", "assemble", "sentences", "validate", "html"])
    a.add_argument("input")
    a.add_argument("output", nargs="?")
    a.add_argument("--header")
    a.add_argument("--annotator")
    a.add_argument("--simple", action="store_true")
    a.add_argument("--report", action="store_true")
    a.add_argument("--dry-run", action="store_true")
    o = a.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if o.step == "normalize":
        made = normalize(spark, o.input)
    else:
        docs = columns(spark, o.input)
        if o.step == "tei":
            made = edition(docs, enrich=False)
        elif o.step == "enrich":
            made = enrich(docs)
        elif o.step == "annotate":
            made = words.annotated(words.annotatable(docs), spark.read.parquet(o.annotator))
        elif o.step == "assemble":
            header = open(o.header, encoding="utf-8").read() if o.header else ""  # noqa: SIM115
            made = render.assembled(edition(docs).select(F.col("doc_id").alias("col_seq"), "tei"), header)
        elif o.step == "sentences":
            made = structure.boundaries(docs)
        elif o.step == "validate":
            made = validate(edition(docs))
        else:
            made = render.html(edition(docs), not o.simple)
    if o.report or o.dry_run or not o.output:
        (citations.report(made) if o.step == "enrich" else made).show(50, truncate=60)
    if o.output and not o.dry_run:
        made.write.mode("ignore" if o.step == "normalize" else "overwrite").parquet(o.output)


if __name__ == "__main__":
    main()
