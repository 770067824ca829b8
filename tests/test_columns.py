"""The scan as columns against the scan of one document, and what keeps queries in bounds on large tables."""

import random

import pyarrow as pa

from colophon.operators import citations as C
from colophon.operators import columns as K
from colophon.operators import render, resolve, scan, structure, words
from colophon.plans import catalogue, edition

SF = "/root/testdata/sf0.001"
PARTS = ["a", "b", "lib", "lib.", "D.", "n. 12", "12", "Itaq;", "...", "¬", "\n", "\n", "¶", "//", "/", "@", "@@", "*", "&", "&amp;", " ", " ", "-", ",", "(", "\xa0", "con¬\n", "Caiet. q. 77", "D. Th.", "Soto lib. 4", "ſt", "ēt", "quę", "Salōn ad 3", "l. si", "<x>", "aest"]


def texts(n=2000):
    r = random.Random(7)
    return ["".join(r.choice(PARTS) + r.choice(["", " "]) for _ in range(r.randint(0, 40))) for _ in range(n)] + [None, ""]


def rows(c):
    none = lambda x: int(x) or None
    return [
        [int(c.line_n[i]), int(c.tok_n[i]), int(c.start[i]), K.KINDS[c.kind[i]], c.texts[i], none(c.left_len[i]), int(c.para_id[i]), int(c.sent_id[i]), bool(c.italic[i]), int(c.bibl_id[i]), none(c.sol_n[i]), none(c.eol_n[i]), none(c.lb_n[i]), None]
        for i in range(c.n)
    ]


def test_columns_agree_with_the_scan_of_one_document():
    found = texts()
    c = K.scanned(found, placed=True)
    got, at = rows(c), 0
    for t, n in zip(found, c.per_doc.tolist()):
        assert got[at : at + n] == scan.tokens_of(t)
        at += n
    fast = K.scanned(found)  # without start, lines are lexed between their marks
    assert at == len(got) and fast.texts == c.texts
    assert all((getattr(fast, f) == getattr(c, f)).all() for f in ("doc", "line_n", "tok_n", "kind", "left_len", "para_id", "sent_id", "italic", "bibl_id", "sol_n", "eol_n", "lb_n"))


def test_portions_are_bounded():
    size = [10, K.PORTION // 2, K.PORTION // 2, K.PORTION * 3, 0, 5]
    found = list(K.portions(pa.array(["x" * n if n else None for n in size])))
    assert [i for a, z in found for i in range(a, z)] == list(range(6)) and all(z - a == 1 or sum(size[a:z]) <= K.PORTION for a, z in found) and len(found) == 4
    assert list(K.portions(pa.array([], pa.string()))) == []


def test_words_told_to_be_plain_are():
    forms = {x for t in texts() for k, x in K.scanned([t]).forms if k == K.WORD} | {"vt", "Vt", "Poſſe", "ESSE", "ae", "Ęgo", "mundū", "homo", "Deus"}
    assert all(resolve.resolve("word", x) == ("plain", x, None, x) for x in forms if resolve.is_plain(x)) and resolve.is_plain("homo") and not resolve.is_plain("vt")


def test_html_without_the_edition_between():
    assert render.htmls_of(texts(300)) == [render.html_of(render.tei_of(t)) for t in texts(300)]
    assert render.htmls_of(texts(300), False) == [render.html_of(render.tei_of(t), False) for t in texts(300)]


def passes(df):
    """How often a plan goes over documents in Python."""
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")


def test_documents_are_scanned_once(spark):
    for name in ("boundary_diagnosis", "boundary_summary", "words_across_columns", "joins_left", "annotated_features"):
        assert passes(catalogue.QUERIES[name](spark, SF)) == 0, name  # of rows written by the one scan
    for name in ("html_text", "citation_report", "choices", "author_resolution"):
        assert passes(catalogue.QUERIES[name](spark, SF)) in (1, 3), name  # one for each part of the table


def test_marks_of_plain_columns_are_text(spark):
    docs = spark.createDataFrame([(1, "a b c d\nab*"), (2, "@x.y// *Fi¬\nnis\nlonger last line here"), (3, "foo\nab\n¬"), (4, "rest of it")], "doc_id long, text string")
    assert [tuple(r) for r in structure.joins_left(docs).collect()] == [(1, 2, "ab*", "@x", "ab*@x")]  # the second's last line is no catchword, nor is what stands before a lone hyphen


def test_stars_in_a_catchword_are_text(spark):
    docs = spark.createDataFrame([(1673, "a b c¬\nEnlichie### ach.***"), (1674, "That*** in")], "doc_id long, text string")  # as in sf0.1
    assert [tuple(r)[2:4] for r in structure.joins_left(docs).collect()] == [("Enlichie### ach.***", "That***")]


def test_added_up_within_portions(spark):
    docs = edition.edition(spark, SF, True)
    want = {(r.abbr, r.bib_id, r.cert, r.status): r.n for r in C.report(C.citations(docs)).collect()}
    assert {(r.abbr, r.bib_id, r.cert, r.status): r.n for r in C.reported(docs).collect()} == want
    assert {r.norm: r.n for r in words.norms(docs).collect()} == {r.norm: r["count"] for r in words.annotatable(docs).groupBy("norm").count().collect()}
    with_units = C.citations(docs, locators=True).selectExpr("doc_id", "cit_n", "inline(locators)")
    assert sorted(map(str, with_units.collect())) == sorted(map(str, C.locators(docs).collect()))
