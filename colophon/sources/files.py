"""Columns of pages from files: light staging files, page-layout files, annotated editions, and the authority lists of a header.

A file is one element tree with mixed content, so a task reads whole files (``binaryFile``) and gives rows; files are small (a column), their number is what grows."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIDES = ("izq", "der", "left", "right", "a", "b")
XML_ID = "{http://www.w3.org/XML/1998/namespace}id"


def local(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def column_key(path: Column) -> Column:
    """The label of a column from its file's name: p{page}_{side}. The page is the last part that is a number of two digits or more, the side the last part that names one."""
    stem = F.replace(F.regexp_replace(F.lower(F.element_at(F.split(path, "/"), -1)), r"\.[^.]*$", ""), F.lit("_bibl"), F.lit(""))
    parts = F.split(stem, "_")
    page = F.element_at(F.filter(parts, lambda x: x.rlike(r"^\p{Nd}{2,}$")), -1)
    side = F.element_at(F.filter(parts, lambda x: x.isin(*SIDES)), -1)
    return F.concat(F.coalesce(F.concat(F.lit("p"), page, F.lit("_")), F.lit("")), F.coalesce(side, F.lit("col")))


def with_column(df: DataFrame, path: str = "path") -> DataFrame:
    """df with (column, page, side, col_seq): col_seq is the reading order, the left column of a page before the right one."""
    d = df.withColumn("column", column_key(F.col(path)))
    page, side = F.nullif(F.regexp_extract("column", r"^p(\d+)_", 1), F.lit("")).cast("int"), F.regexp_extract("column", "([a-z]+)$", 1)
    return d.withColumn("page", page).withColumn("side", side).withColumn("col_seq", F.col("page") * 2 + F.col("side").isin("der", "right", "b").cast("int"))


def _parsed(spark: SparkSession, path: str | list[str], schema: str, made: Callable[[ET.Element], list]) -> DataFrame:
    """(path, schema): the rows made of each file. A file that isn't well formed raises."""
    empty = spark.createDataFrame([], f"path string, {schema}")
    from pyspark.sql.pandas.types import to_arrow_type

    names, kinds, full = empty.columns, [to_arrow_type(f.dataType) for f in empty.schema], empty.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = [(name, *r) for r in made(ET.fromstring(content))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, full)


def staging(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, text, column, page, side, col_seq): a row for each staging file, the lines of text as they stand in it, marks and hyphens included."""
    found = _parsed(spark, path, "text string", lambda root: [("\n".join((x.text or "").replace("\n", " ") for x in root.findall("line")),)] if root.tag == "lines" else [])
    return with_column(found)


LAYOUT = "line_id string, line_n int, region_id string, reading_order int, raw string, custom string, first_x int"


def page_lines(spark: SparkSession, path: str | list[str], by_order_only: bool = False) -> DataFrame:
    """(path, LAYOUT, text, soft_hyphen, structure_type, column…): the lines of page-layout files that have text, numbered in the order of region and reading order, or by
    reading order alone, where regions mix and lines without an order come last."""

    def made(root: ET.Element) -> list:
        rows = []
        for region in root.iter():
            for line in region:
                if local(line) != "TextLine":
                    continue
                equiv = next((u for e in (line if by_order_only else line.iter()) if local(e) == "TextEquiv" for u in e if local(u) == "Unicode"), None)
                custom = line.get("custom", "")
                order = re.search(r"readingOrder\s*\{index:(\d+)", custom)
                points = next((e.get("points", "") for e in line if local(e) == "Baseline"), "")
                if equiv is not None and (equiv.text or "").strip():
                    rows.append((line.get("id", ""), 0, region.get("id", ""), int(order[1]) if order else 9999 if by_order_only else 999, equiv.text, custom, int(points.split()[0].split(",")[0]) if points.strip() else 0))
        rows.sort(key=lambda r: r[3] if by_order_only else (r[2], r[3]))
        return [(r[0], n, *r[2:]) for n, r in enumerate(rows, 1)]

    d = _parsed(spark, path, LAYOUT, made)
    text = F.regexp_replace("raw", r"(?U)\s+$", "")
    d = d.withColumn("soft_hyphen", text.endswith("¬")).withColumn("text", F.regexp_replace(text, r"(?U)\s*¬$", "")).withColumn("structure_type", structure_type(F.col("custom")))
    return with_column(d)


def staged(lines: DataFrame) -> DataFrame:
    """(line_id, text) of page lines as the staging writer has them: normalised, without the blank ones."""
    from .lines import normalized

    return lines.select("path", "line_n", F.col("line_id").alias("_id"), normalized(F.col("raw")).alias("_VALUE"))


def write_staging(lines: DataFrame, path: str) -> None:
    """staged() lines of one column as <lines><line id=…>; a second run leaves what is there (it may have been edited)."""
    lines.orderBy("line_n").select("_id", "_VALUE").coalesce(1).write.mode("ignore").format("xml").option("rootTag", "lines").option("rowTag", "line").save(path)


def _bodies(custom: Column, tag: str) -> Column:
    return F.regexp_extract_all(custom, F.lit(rf"(?U)(?<![\w]){re.escape(tag)}\s*\{{([^}}]*)\}}"), F.lit(1))


def _field(body: Column, name: str) -> Column:
    return F.regexp_extract(body, rf"{name}:\s*([^;}}]+)", 1)


def spans(custom: Column, tag: str, value: str | None = None) -> Column:
    """array<struct<start, length, continued, italic, value>> of a tag's spans in a line's custom attribute, by start: sentence, index_entry, summary_item, textStyle; with
    ``value``: abbrev (expansion) and sic (corr). Spans without offset or length are left out."""
    number = lambda b, n: F.nullif(F.regexp_extract(b, rf"{n}:\s*(\d+)", 1), F.lit("")).cast("int")

    def one(b: Column) -> Column:
        v = F.regexp_replace(F.trim(_field(b, value)), r"""^['"]+|['"]+$""", "") if value else F.lit(None).cast("string")
        v = F.replace(v, F.lit("¬"), F.lit("-")) if value == "corr" else v
        return F.struct(number(b, "offset").alias("start"), number(b, "length").alias("length"), F.contains(b, F.lit("continued:true")).alias("continued"), F.contains(b, F.lit("italic:true")).alias("italic"), v.alias("value"))

    return F.array_sort(F.filter(F.transform(_bodies(custom, tag), one), lambda s: s["start"].isNotNull() & s["length"].isNotNull()))


def structure_type(custom: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(custom, r"structure\s*\{[^}]*?type:([^;}]+)", 1)), F.lit(""))


ELEMENT = "n int, kind string, left string, right string, lb_n int, sent_id int, para_id int, italic boolean, in_bibl boolean, in_abbr boolean, reading string, cit_id string, corresp string, lemma string, pos string, msd string"


def edition(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, ELEMENT): the words, punctuation marks, line breaks and choices of annotated editions, in order. reading: the element of a choice that a word stands in."""

    def made(root: ET.Element) -> list:
        rows, count = [], {"s": 0, "p": 0}

        def walk(e: ET.Element, up: dict) -> None:
            name = local(e)
            here = dict(up)
            if name in count:
                count[name] += 1
                here[name] = count[name]
            if name == "hi":
                here["italic"] = True
            if name in ("bibl", "corr", "supplied"):
                here["bibl"] = True
            if name == "bibl":
                here["corresp"] = e.get("corresp")
            if name == "cit":
                here["cit"] = e.get(XML_ID)
            if name in ("abbr", "expan", "orig", "reg", "sic", "corr"):
                here["reading"] = name
                here["abbr"] = up.get("abbr", False) or name == "abbr"
            if name in ("w", "pc", "lb", "choice"):
                inner = next((x for x in e if local(x) == "lb"), None)
                lb = e if name == "lb" else inner
                number = lb.get("n") if lb is not None else None
                rows.append(
                    (len(rows) + 1, name, (e.text or "").strip(), (inner.tail or "").strip() if inner is not None and name == "w" else None, int(number) if number else None, here.get("s"), here.get("p"), here.get("italic", False), here.get("bibl", False),
                     here.get("abbr", False), here.get("reading"), here.get("cit"), here.get("corresp"), e.get("lemma"), e.get("pos"), e.get("msd"))
                )
            for x in e:
                if name != "w":
                    walk(x, here)

        walk(root, {})
        return rows

    return _parsed(spark, path, ELEMENT, made)


WORK = "id string, cert string, author_ref string, author string, titles array<struct<lang: string, type: string, text: string>>, note string"
PERSON = "id string, names array<struct<lang: string, type: string, text: string>>, birth_year int, death_year int, affiliation string"


def _named(e: ET.Element, name: str) -> list[dict]:
    lang = "{http://www.w3.org/XML/1998/namespace}lang"
    return [{"lang": x.get(lang), "type": x.get("type"), "text": " ".join("".join(x.itertext()).split())} for x in e.iter() if local(x) == name]


def authority_works(spark: SparkSession, path: str) -> DataFrame:
    """(path, WORK): the catalogue of works in a header."""

    def made(root: ET.Element) -> list:
        first = lambda e, n: next((x for x in e if local(x) == n), None)
        text = lambda x: None if x is None else " ".join("".join(x.itertext()).split())
        out = []
        for e in root.iter():
            if local(e) == "bibl" and e.get(XML_ID):
                a = first(e, "author")
                out.append((e.get(XML_ID), e.get("cert"), None if a is None else a.get("ref"), text(a), _named(e, "title"), text(first(e, "note"))))
        return out

    return _parsed(spark, path, WORK, made)


def authority_persons(spark: SparkSession, path: str) -> DataFrame:
    """(path, PERSON): the persons of a header; years before Christ are negative."""

    def made(root: ET.Element) -> list:
        def year(e: ET.Element, name: str) -> int | None:
            found = next((x for x in e if local(x) == name), None)
            when = None if found is None else next((found.get(k) for k in ("when", "notBefore", "notAfter", "from") if found.get(k)), (found.text or "").strip())
            m = re.match(r"-?\d+", when or "")
            return int(m[0]) if m else None

        out = []
        for e in root.iter():
            if local(e) == "person" and e.get(XML_ID):
                where = next((x for x in e if local(x) == "affiliation"), None)
                out.append((e.get(XML_ID), _named(e, "persName"), year(e, "birth"), year(e, "death"), None if where is None else " ".join("".join(where.itertext()).split())))
        return out

    return _parsed(spark, path, PERSON, made)


def missing_ids(catalogue: DataFrame, works: DataFrame, persons: DataFrame) -> DataFrame:
    """(id) that a catalogue (bib_id, pers_id) names and the header doesn't have."""
    have = works.select("id").union(persons.select("id"))
    return catalogue.select(F.explode(F.array("bib_id", "pers_id")).alias("id")).where("id is not null").distinct().join(have, "id", "left_anti")
