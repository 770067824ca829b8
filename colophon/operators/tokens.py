"""Tokens of lines, and what an edition shows for each form. The lexer is one regular expression, known abbreviations included, so a line's tokens are made and
exploded in generated code, and no line is exchanged."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions import spelling as S
from colophon.functions.lexicon import table
from colophon.sources.lines import line_array

STOP = r"\s\x1c-\x1f,;:.?!\[\]()\-&"
WORD = rf"[^{STOP}]+(?:-[^{STOP}]+)*"


def _abbreviations(name: str, end: str) -> str:
    """Entries in small letters match whatever the case, others as they stand; between the word and its end may be what the lexer drops."""
    stems = [x[:-1] for x in table(name)]
    both = lambda x: "".join(f"[{c}{c.upper()}]" if c.upper() != c else re.escape(c) for c in x)  # noqa: E731  # a flag for case would take ſ for s
    either = "|".join(both(x) if x == x.lower() else re.escape(x) for x in sorted(stems, key=len, reverse=True))
    return rf"(?:{either})[\s\x1c-\x1f\-]*{end}"


def lexer() -> str:
    before_end = rf"(?=[^{STOP}]+[\s\x1c-\x1f\-]*[.;])"  # only words before a dot or semicolon are looked up
    known = f"{before_end}(?:{_abbreviations('dotted', r'(?:\.\.\.|\.)')}|{_abbreviations('semicolons', ';')})"
    return "(?U)" + "|".join([r"&amp;|&|[\[\]()]|[,;:?!]|\.\.\.|\.", known, WORD])


def kind_of(x: Column) -> Column:
    plain = F.when(x.isin("&", "&amp;"), "amp").when(x.isin(*"[](),;:?!"), "pc").when(x.isin(".", "..."), "dot")
    return plain.when(F.substring(x, -1, 1).isin(".", ";"), "abbrev_dot").otherwise("word")


def tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, line_n, tok_n, kind, text). A word and a dot, or a word and a semicolon, that make a known abbreviation are one token of kind abbrev_dot."""
    lines = docs.select("doc_id", F.inline(line_array(F.col("text"))))
    found = lines.select("doc_id", "line_n", F.posexplode(F.regexp_extract_all("text", F.lit(lexer()), F.lit(0))).alias("n", "x"))
    kind = kind_of(F.col("x"))
    word = F.concat(F.regexp_replace("x", r"(?U)[\s\x1c-\x1f\-]*[.;]+$", ""), F.substring("x", -1, 1))
    return found.select("doc_id", "line_n", (F.col("n") + 1).alias("tok_n"), kind.alias("kind"), F.when(kind == "abbrev_dot", word).otherwise(F.col("x")).alias("text"))


def forms(tokens: DataFrame) -> DataFrame:
    """(kind, text, left_len, n): distinct words, abbreviations and split words. Rules are applied to these, once for each form, not for each token."""
    left = F.col("left_len") if "left_len" in tokens.columns else F.lit(None).cast("int")
    return tokens.where("kind in ('word', 'abbrev_dot', 'word_lb')").groupBy("kind", "text", left.alias("left_len")).agg(F.count("*").alias("n"))


def _lookup(spark, name: str, to: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(table(name).items()), f"k string, {to} string"))  # a fixed table of the package


def _joined(d: DataFrame, name: str, to: str, key: Column) -> DataFrame:
    return d.join(_lookup(d.sparkSession, name, to), key == F.col("k"), "left").drop("k")


def with_expansion(d: DataFrame) -> DataFrame:
    """d (kind, text) with the column expansion: of an abbreviation as it stands, else in small letters; an empty one blocks the small letters', and is none."""
    for name, a, b in (("expansions", "e1", "e2"), ("semicolon_expansions", "e3", "e4")):
        d = _joined(_joined(d, name, a, F.col("text")), name, b, F.lower("text"))
    none = lambda x: F.nullif(x, F.lit(""))
    found = F.coalesce(none(F.coalesce("e1", "e2")), none(F.coalesce("e3", "e4")))
    return d.withColumn("expansion", F.when(F.col("kind") == "abbrev_dot", found)).drop("e1", "e2", "e3", "e4")


def _with_long_s(d: DataFrame, x: str, to: str) -> DataFrame:
    """d with the column ``to``: the word x with a long s by the first of the roots that it holds, and before letters, and its initial; null where no rule applies. In steps, so that
    no step's code repeats another's."""
    d = d.withColumn("_low", F.lower(x)).withColumn("_hit", F.expr(S.long_s_hit("_low"))).withColumn("_to", F.expr(S.long_s_of_hit("_hit")))
    d = d.withColumn("_at", F.expr("instr(_low, _hit)")).withColumn("_made", F.expr("CASE WHEN _hit IS NULL THEN _low ELSE concat(substr(_low, 1, _at - 1), _to, substr(_low, _at + length(_hit))) END"))
    d = d.withColumn("_made", F.regexp_replace("_made", r"(?U)ss(?=\w)", "ſſ"))
    return d.withColumn(to, F.when(F.col("_made") != F.col("_low"), F.expr(S.with_initial_of("_made", x)))).drop("_low", "_hit", "_to", "_at", "_made")


def _with_tag(d: DataFrame, x: str, expansion: str, to: str) -> DataFrame:
    d = d.withColumn("_plain", F.expr(S.plain_form(x)))
    return d.withColumn(to, F.expr(S.classify_tag(x, expansion, "_plain"))).drop("_plain")


def choices(forms: DataFrame) -> DataFrame:
    """forms with (choice_kind, orig, inner_orig, reg), by priority: the expansion of an abbreviation (abbr), a regular form (reg), a long s (long_s), ae or ę (ae), a
    macron (macron), or plain. orig is what the print has, reg what is read; where the print has a long s under an abbreviation or a regular form, inner_orig has it.
    A split word with both a long s and a macron has the kind long_s_macron. An abbreviation without expansion gets neither ae nor macron."""
    d = with_expansion(forms)
    d = _joined(_joined(d, "regular_forms", "r1", F.col("text")), "regular_forms", "r2", F.replace("text", F.lit("ſ"), F.lit("s")))
    d = _joined(d, "long_s_forms", "ls", F.lower("text")).withColumn("r", F.coalesce("r1", "r2")).drop("r1", "r2")
    d = _with_tag(_with_long_s(d, "text", "root"), "text", "expansion", "tag")
    text, split, short = F.col("text"), F.col("kind") == "word_lb", F.col("kind") == "abbrev_dot"
    d = d.withColumn("caps", (F.upper("text") == text) & (F.lower("text") != text))
    known = F.expr(f"CASE WHEN caps THEN upper(ls) ELSE {S.with_initial_of('ls', 'text')} END")
    ruled = F.when(split, F.when(F.col("caps"), F.upper("root")).otherwise(F.col("root"))).when(F.col("r").isNull(), F.col("root"))
    d = d.withColumn("long", F.when(F.col("ls").isNotNull(), known).otherwise(ruled)).withColumn("long", F.when(F.col("long") != text, F.col("long")))
    d = d.withColumn("macron", F.expr(S.has_macron("text"))).withColumn("long_macron", F.expr(S.has_macron("long")))
    kind = (
        F.when(F.col("expansion").isNotNull() & (F.col("tag") == "abbr"), "abbr").when(F.col("expansion").isNotNull() | F.col("r").isNotNull(), "reg")
        .when(F.col("long").isNotNull() & split & F.col("long_macron"), "long_s_macron").when(F.col("long").isNotNull(), "long_s")
        .when(~short & ((F.instr("text", "ae") > 0) | (~split & text.rlike("[ęĘ]"))) & ~(split & F.col("macron")), "ae").when(~short & F.col("macron"), "macron").otherwise("plain")
    )
    d = d.withColumn("choice_kind", kind)
    k = F.col("choice_kind")
    d = d.withColumn("plain_e", F.when((k == "ae") & (F.instr("text", "ae") == 0), F.replace(F.replace(text, F.lit("ę"), F.lit("ae")), F.lit("Ę"), F.lit("Ae"))))
    d = _joined(_joined(d, "long_s_forms", "p1", F.col("plain_e")), "long_s_forms", "p2", F.lower("plain_e"))
    d = _with_long_s(d, "plain_e", "p3").withColumn("printed", F.coalesce("p1", "p2", "p3", "plain_e"))
    printed = F.col("printed")
    for a, b in (("ae", "ę"), ("æ", "ę"), ("Ae", "Ę"), ("Æ", "Ę")):
        printed = F.replace(printed, F.lit(a), F.lit(b))
    d = d.withColumn("read_macron", F.when(k == "macron", F.col("text")).when(k == "long_s_macron", F.col("long")))
    d = d.withColumn("read_macron", F.replace(F.expr(S.macrons("read_macron")), F.lit("ſ"), F.lit("s")))
    orig = F.when(k.isin("long_s", "long_s_macron"), F.col("long")).when(k == "ae", F.coalesce(printed, F.replace(text, F.lit("ae"), F.lit("æ")))).otherwise(text)
    reg = F.coalesce("expansion", F.when(k == "reg", F.col("r")), "read_macron", F.when(k == "ae", F.col("plain_e")), "text")
    return d.select(*forms.columns, "choice_kind", orig.alias("orig"), F.when((k == "abbr") | ((k == "reg") & ~split & F.col("expansion").isNull()), F.col("long")).alias("inner_orig"), reg.alias("reg"))


def split_words(forms: DataFrame) -> DataFrame:
    """Split words (forms of kind word_lb) with the two parts of what the print has: (text, left, right, choice_kind, orig_left, orig_right, reg, n)."""
    d = choices(forms.where("kind = 'word_lb'"))
    return d.select(
        "text", F.expr("substr(text, 1, left_len)").alias("left"), F.expr("substr(text, left_len + 1)").alias("right"), "choice_kind",
        F.expr("substr(orig, 1, left_len)").alias("orig_left"), F.expr("substr(orig, left_len + 1)").alias("orig_right"), "reg", "n",
    )


def mark_types(tokens: DataFrame) -> DataFrame:
    """(text, type, subtype, n) of punctuation; a type that isn't listed is other, brackets are open or close."""
    d = tokens.where("kind in ('pc', 'dot')").groupBy("text").agg(F.count("*").alias("n"))
    d = _joined(d, "mark_types", "type", F.col("text"))
    return d.select("text", F.coalesce("type", F.lit("other")).alias("type"), F.when(F.col("text").isin("[", "("), "open").when(F.col("text").isin("]", ")"), "close").alias("subtype"), "n")


def classified(forms: DataFrame) -> DataFrame:
    """(text, expansion, tag) of abbreviations and of words with a macron: whether the two are an abbreviation (abbr) or merely spelt in another way (orig)."""
    d = with_expansion(forms.where("kind <> 'word_lb'"))
    d = d.withColumn("expansion", F.coalesce("expansion", F.when((F.col("kind") == "word") & F.expr(S.has_macron("text")), F.expr(S.macrons("text"))), F.when(F.col("text").rlike("[ſęæ]"), F.expr(S.plain_letters("text")))))
    return _with_tag(d.where("expansion is not null"), "text", "expansion", "tag").select("text", "expansion", "tag", "n")
