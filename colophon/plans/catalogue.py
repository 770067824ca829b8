"""Registered queries and the DuckDB SQL for each. All run over the whole table of documents, as ``edition`` sets letters and marks in. The SQL states its own rules: white space, accents, roots
and the scan aren't taken from the expressions that Spark runs, only word lists are."""

from __future__ import annotations

from pyspark.sql import functions as F

from colophon.functions.lexicon import quoted, table
from colophon.operators import authority, citations, columns, ordered, render, scan, structure, words
from colophon.operators import tokens as T
from colophon.sources import files
from colophon.sources import lines as L

from . import edition as E
from . import edition_sql as Q


def _plain(s, d):
    return E.edition(s, d, marks=False)


def _marked(s, d):
    return E.edition(s, d, marks=True)


def _forms(s, d):
    return columns.forms(_plain(s, d), False, (columns.WORD, columns.ABBREV))


def _all_forms(s, d, *kinds):
    """Of marked documents, so that split words are there."""
    return columns.forms(_marked(s, d), True, kinds or (columns.WORD, columns.ABBREV, columns.WORD_LB))


def token_kind_counts(s, d):
    return T.tokens(_plain(s, d)).groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


def choice_kinds(s, d):
    return T.choices(_forms(s, d)).groupBy("choice_kind").agg(F.count("*").alias("n_forms"), F.sum("n").alias("n_tokens"))


def corpus_stats(s, d):
    docs, hyphen = _plain(s, d), lambda x: x["soft_hyphen"]
    abbreviations = F.aggregate("ls", F.lit(0), lambda a, x: a + F.size(F.filter(F.regexp_extract_all(x["text"], F.lit(T.lexer()), F.lit(0)), lambda t: T.kind_of(t) == "abbrev_dot")))
    letters = F.aggregate("ls", F.lit(0), lambda a, x: a + F.length(x["text"]))
    return L.with_lines(docs).where(F.size("ls") > 0).select("doc_id", F.size("ls").alias("n_lines"), F.size(F.filter("ls", hyphen)).alias("n_hyphens"), abbreviations.alias("n_abbreviations"), letters.alias("n_letters"))


def duplicate_ids(s, d):
    """The first five ids that stand more than once."""
    return _plain(s, d).where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").orderBy("doc_id").limit(5)


def column_keys(s, d):
    """Keys of columns from names of files; documents stand for columns."""
    side = F.when(F.col("doc_id") % 2 == 0, "izq").otherwise("der")
    name = F.concat(F.lit("/x/pg_63_"), (F.col("doc_id") % 100).cast("string"), F.lit("_"), side, F.lit("_bibl.xml"))
    return files.with_column(s.read.parquet(f"{d}/documents.parquet").select("doc_id", name.alias("path"))).select("doc_id", "column", "page", "side", "col_seq")


def first_columns(s, d):
    """Distinct pages with the first document of each, in reading order."""
    k = column_keys(s, d)
    return k.groupBy("page").agg(F.min_by("doc_id", F.struct("col_seq", "doc_id")).alias("first_doc"), F.count("*").alias("n_columns"))


_CUSTOM = (
    "concat('readingOrder {index:', cast(doc_id as string), ';} structure {type:', lang, ';} abbrev {offset:', cast(n_chars as string), '; length:4; expansion:capitulo;} abbrev {offset:2;length:3;} "
    "sic {offset:5;length:', cast(doc_id as string), ';corr:ab¬;} textStyle {offset:0;length:9;italic:true;} sentence {offset:7; length:1;continued:true;} sentence {length:3;}')"
)


def custom_spans(s, d):
    """Spans and structure of lines' custom attributes."""
    docs = s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.expr(_CUSTOM).alias("custom"))
    tags = [("abbrev", "expansion"), ("sic", "corr"), ("textStyle", None), ("sentence", None), ("index_entry", None)]
    tagged = lambda t, v: F.transform(files.spans(F.col("custom"), t, v), lambda x: F.struct(F.lit(t).alias("tag"), *(x[c].alias(c) for c in ("start", "length", "continued", "italic", "value"))))
    every = F.concat(*(tagged(t, v) for t, v in tags))
    return docs.select("doc_id", files.structure_type(F.col("custom")).alias("structure_type"), F.inline(every))


def structure_blocks(s, d):
    """Runs of lines of one type; a line's type is that of its first letter here."""
    kind = F.when(F.col("text").rlike(r"^\p{Lu}"), "paragraph").when(F.col("text").rlike(r"^\p{Ll}"), "heading")
    keyed = E.edition(s, d, marks=False).select(F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("doc_id"), "text")  # equal rows stay apart
    return structure.blocks(L.lines(keyed).withColumn("structure_type", kind), ["doc_id"]).withColumn("doc_id", F.col("doc_id.doc_id"))


def annotated_features(s, d):
    """Features of annotated words; the annotator's table is made of the words' first letters."""
    w = ordered.written(words.norms(_marked(s, d)), "norms")  # a form is annotated once, whatever its number
    annotator = w.select(F.col("norm").alias("text"), F.lower("norm").alias("lemma"), F.lit("X").alias("pos"), F.concat(F.lit("First="), F.translate(F.substring(F.lower("norm"), 1, 1), "|=", "__"), F.lit("|Length="), F.length("norm").cast("string")).alias("msd"))
    return words.feature_rows(words.annotated(w, annotator))


def numbered_lines(s, d):
    return L.lines(_plain(s, d)).where(words.shows_number(F.col("line_n"))).select("doc_id", "line_n")


def citation_report(s, d):
    return citations.reported(_marked(s, d))


def cit_ids(s, d):
    return citations.citations(_marked(s, d))


QUERIES = {
    "lines_extract": lambda s, d: L.lines(_plain(s, d)),
    "normalize_lines": lambda s, d: L.lines(_plain(s, d)).select("doc_id", "line_n", F.regexp_replace("text", "  +", " ").alias("text")),
    "line_counts": lambda s, d: L.line_counts(_plain(s, d)),
    "suspicious_continuations": lambda s, d: L.suspicious_continuations(_plain(s, d)),
    "catchwords": lambda s, d: L.catchwords(_plain(s, d)),
    "clean_text": lambda s, d: L.clean_text(_plain(s, d)),
    "tokenize": lambda s, d: T.tokens(_plain(s, d)),
    "token_kind_counts": token_kind_counts,
    "mark_types": lambda s, d: T.mark_types(T.tokens(_plain(s, d))),
    "choices": lambda s, d: T.choices(_all_forms(s, d)),
    "choice_kinds": choice_kinds,
    "classified_forms": lambda s, d: T.classified(_forms(s, d)),
    "split_words": lambda s, d: T.split_words(_all_forms(s, d, columns.WORD_LB)),
    "marked_tokens": lambda s, d: scan.tokens(_marked(s, d)).drop("expansion"),
    "mark_spans": lambda s, d: scan.spans(_marked(s, d)),
    "paragraphs": lambda s, d: structure.paragraphs(_marked(s, d)),
    "sentences": lambda s, d: structure.sentences(_marked(s, d)),
    "italic_bibl_runs": lambda s, d: structure.italic_bibl_runs(_marked(s, d)),
    "boundary_diagnosis": lambda s, d: structure.boundaries(_marked(s, d)),
    "boundary_summary": lambda s, d: structure.boundaries(_marked(s, d), False).groupBy("result").agg(F.count("*").alias("n")),
    "words_across_columns": lambda s, d: structure.words_across(structure.boundaries(_marked(s, d), False)),
    "joins_left": lambda s, d: structure.joins_left(_plain(s, d)),
    "structure_blocks": structure_blocks,
    "tei_counts": lambda s, d: structure.tei_counts(_marked(s, d)),
    "corpus_totals": lambda s, d: structure.totals(_marked(s, d)),
    "author_resolution": lambda s, d: authority.resolved(_all_forms(s, d)),
    "cit_ids": cit_ids,
    "citation_report": citation_report,
    "locator_units": lambda s, d: citations.locators(_marked(s, d)),
    "expansions_missing": lambda s, d: citations.expansions_missing(_marked(s, d)),
    "machine_citations": lambda s, d: citations.machine_citations(_marked(s, d)),
    "annotatable_words": lambda s, d: words.annotatable(_marked(s, d)),
    "annotated_features": annotated_features,
    "corpus_stats": corpus_stats,
    "duplicate_ids": duplicate_ids,
    "column_keys": column_keys,
    "first_columns": first_columns,
    "custom_spans": custom_spans,
    "numbered_lines": numbered_lines,
    "tei_text": lambda s, d: render.tei(_marked(s, d)),
    "html_text": lambda s, d: render.html_of_documents(_marked(s, d)),
}


def _pairs(name: str, alias: str, *columns: str) -> str:
    rows = ", ".join(f"({quoted([k, v])})" for k, v in table(name).items())
    return f"(VALUES {rows}) AS {alias}({', '.join(columns)})"


_ROOTS = ", ".join(f"({i}, {quoted([a, b])})" for i, (a, b) in enumerate(table("long_s_roots").items()))
_SPELL = "list_reduce([x] || ['ā','ē','ī','ō','ū','Ā','Ē','Ī','Ō','Ū'], lambda a, v: replace(a, v, strip_accents(v) || '{0}'))"


def _macrons(x: str) -> str:
    """The vowel before final dots gets m, others n."""
    stem = f"regexp_extract({x}, '^(.*?)(\\.*)$', 1)"
    inner, last = _SPELL.format("n").replace("[x]", f"[{stem}[1:len({stem}) - 1]]"), _SPELL.format("m").replace("[x]", f"[{stem}[len({stem}):len({stem})]]")
    return f"({inner} || {last} || regexp_extract({x}, '(\\.*)$', 1))"


def _cap(form: str, x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^\\p{{Lu}}') THEN upper({form}[1:1]) || {form}[2:] ELSE {form} END"


def _plain_form(x: str) -> str:
    for name in ("plain_letters", "macron_letters"):
        for a, b in table(name).items():
            x = f"replace({x}, '{a}', '{b}')"
    return f"rtrim({x}, '.')"


def _tag(x: str, e: str) -> str:
    p = _plain_form(x)
    return f"""CASE WHEN coalesce({e}, '') = '' THEN 'orig' WHEN trim({x}) IN ('&', '&amp;') OR suffix(rtrim({x}), '.') OR regexp_matches({x}, '[āēīōūĀĒĪŌŪ]') OR length({e}) - length(rtrim({x}, '.')) > 3 THEN 'abbr'
      WHEN lower({p}) = lower({e}) OR abs(length({p}) - length({e})) <= 1 THEN 'orig' ELSE 'abbr' END"""


def _choices(forms: str) -> str:
    """c: forms (kind, text, left_len, n, id) with their choices. Roots: the first in the list that the word holds."""
    return rf"""
rt(i, a, b) AS (VALUES {_ROOTS}),
w0 AS (SELECT DISTINCT text, lower(text) AS low FROM {forms}),
wp AS (SELECT DISTINCT replace(replace(text, 'ę', 'ae'), 'Ę', 'Ae') AS text FROM w0 WHERE regexp_matches(text, '[ęĘ]')),
w1 AS (SELECT text, low FROM w0 UNION SELECT text, lower(text) FROM wp),
w2 AS (SELECT text, low, arg_min(a, i) AS a, arg_min(b, i) AS b FROM w1 LEFT JOIN rt ON contains(low, a) GROUP BY 1, 2),
w3 AS (SELECT text, low, regexp_replace(CASE WHEN a IS NULL THEN low ELSE low[1:strpos(low, a) - 1] || b || low[strpos(low, a) + length(a):] END, 'ss([\p{{L}}\p{{N}}_])', 'ſſ\1', 'g') AS made FROM w2),
rr AS (SELECT text, CASE WHEN made <> low THEN {_cap("made", "text")} END AS root FROM w3),
x0 AS (SELECT DISTINCT kind, text FROM {forms}),
x1 AS (SELECT x0.*, CASE WHEN kind = 'abbrev_dot' THEN coalesce(nullif(coalesce(a1.v, a2.v), ''), nullif(coalesce(s1.v, s2.v), '')) END AS e, coalesce(r1.v, r2.v) AS r, l1.v AS ls, rr.root AS root
  FROM x0 LEFT JOIN {_pairs("expansions", "a1", "k", "v")} ON a1.k = x0.text LEFT JOIN {_pairs("expansions", "a2", "k", "v")} ON a2.k = lower(x0.text)
  LEFT JOIN {_pairs("semicolon_expansions", "s1", "k", "v")} ON s1.k = x0.text LEFT JOIN {_pairs("semicolon_expansions", "s2", "k", "v")} ON s2.k = lower(x0.text)
  LEFT JOIN {_pairs("regular_forms", "r1", "k", "v")} ON r1.k = x0.text LEFT JOIN {_pairs("regular_forms", "r2", "k", "v")} ON r2.k = replace(x0.text, 'ſ', 's')
  LEFT JOIN {_pairs("long_s_forms", "l1", "k", "v")} ON l1.k = lower(x0.text) LEFT JOIN rr ON rr.text = x0.text),
x2 AS (SELECT *, upper(text) = text AND lower(text) <> text AS caps FROM x1),
x3 AS (SELECT *, CASE WHEN ls IS NOT NULL THEN CASE WHEN caps THEN upper(ls) ELSE {_cap("ls", "text")} END WHEN kind = 'word_lb' THEN CASE WHEN caps THEN upper(root) ELSE root END WHEN r IS NULL THEN root END AS l0 FROM x2),
x4 AS (SELECT * EXCLUDE (l0), CASE WHEN l0 <> text THEN l0 END AS long, regexp_matches(text, '[āēīōūĀĒĪŌŪ]') AS mac FROM x3),
x5 AS (SELECT *, CASE WHEN e IS NOT NULL AND {_tag("text", "e")} = 'abbr' THEN 'abbr' WHEN e IS NOT NULL OR r IS NOT NULL THEN 'reg' WHEN long IS NOT NULL AND kind = 'word_lb' AND regexp_matches(long, '[āēīōūĀĒĪŌŪ]') THEN 'long_s_macron'
  WHEN long IS NOT NULL THEN 'long_s' WHEN kind = 'word' AND (contains(text, 'ae') OR regexp_matches(text, '[ęĘ]')) THEN 'ae' WHEN kind = 'word_lb' AND contains(text, 'ae') AND NOT mac THEN 'ae' WHEN kind <> 'abbrev_dot' AND mac THEN 'macron' ELSE 'plain' END AS choice_kind FROM x4),
x6 AS (SELECT x5.*, p, coalesce(q1.v, q2.v, rr.root, p) AS printed FROM (SELECT *, CASE WHEN choice_kind = 'ae' AND NOT contains(text, 'ae') THEN replace(replace(text, 'ę', 'ae'), 'Ę', 'Ae') END AS p FROM x5) AS x5
  LEFT JOIN {_pairs("long_s_forms", "q1", "k", "v")} ON q1.k = p LEFT JOIN {_pairs("long_s_forms", "q2", "k", "v")} ON q2.k = lower(p) LEFT JOIN rr ON rr.text = p),
cc AS (SELECT kind, text, choice_kind, e AS expansion,
  CASE WHEN choice_kind IN ('long_s', 'long_s_macron') THEN long WHEN choice_kind = 'ae' AND p IS NULL THEN replace(text, 'ae', 'æ') WHEN choice_kind = 'ae' THEN replace(replace(replace(replace(printed, 'ae', 'ę'), 'æ', 'ę'), 'Ae', 'Ę'), 'Æ', 'Ę') ELSE text END AS orig,
  CASE WHEN choice_kind = 'abbr' OR (choice_kind = 'reg' AND kind <> 'word_lb' AND e IS NULL) THEN long END AS inner_orig,
  CASE WHEN e IS NOT NULL THEN e WHEN choice_kind = 'reg' THEN r WHEN choice_kind = 'macron' THEN replace({_macrons("text")}, 'ſ', 's') WHEN choice_kind = 'long_s_macron' THEN replace({_macrons("long")}, 'ſ', 's') WHEN choice_kind = 'ae' THEN coalesce(p, text) ELSE text END AS reg FROM x6),
c AS (SELECT f.*, choice_kind, orig, inner_orig, reg FROM {forms} AS f JOIN cc USING (kind, text))"""


_PLAIN = Q.PLAIN_TOKENS
_FORMS = _PLAIN + ", f AS (SELECT kind, text, NULL::INTEGER AS left_len, count(*) AS n FROM t WHERE kind IN ('word', 'abbrev_dot') GROUP BY 1, 2)"
_KFORMS = Q.TOKENS + ", f AS (SELECT kind, text, left_len, count(*) AS n FROM k WHERE kind IN ('word', 'abbrev_dot', 'word_lb') GROUP BY 1, 2, 3)"
_LINES = Q.lines(False)
_LAST = "coalesce(lb_n, line_n)"
_ENDS = _KFORMS + "," + _choices("f") + rf""",
kc AS (SELECT k.*, choice_kind, orig, reg, inner_orig FROM k LEFT JOIN cc USING (kind, text)),
fi AS (SELECT r, arg_min(CASE WHEN choice_kind IN ('reg', 'ae', 'long_s') THEN reg ELSE text END, tok_n) FILTER (kind NOT IN ('pc', 'dot')) AS first_word, arg_min(text, tok_n) FILTER (kind = 'word') AS first_plain FROM kc WHERE sent_id = 1 GROUP BY 1),
ls_ AS (SELECT r, max(sent_id) AS n_sentences, arg_max(text, tok_n) IN ('.', '?', '!') AS closes FROM kc GROUP BY 1),
lw AS (SELECT kc.r, arg_max(text, tok_n) AS last_word FROM kc JOIN ls_ ON kc.r = ls_.r AND sent_id = n_sentences WHERE kind NOT IN ('pc', 'dot') GROUP BY 1),
hy AS (SELECT r, arg_max(hyphen, line_n) AS hyphen FROM l8 WHERE full_ GROUP BY 1),
en AS (SELECT doc_id, md5(coalesce(text, '')) AS tie, coalesce(first_word, CASE WHEN n_sentences IS NOT NULL THEN '' END) AS first_word, first_plain, closes, hyphen AND last_word IS NOT NULL AS split, last_word, coalesce(n_sentences, 0) AS n_sentences
  FROM src LEFT JOIN fi USING (r) LEFT JOIN ls_ USING (r) LEFT JOIN lw USING (r) LEFT JOIN hy USING (r) WHERE doc_id IS NOT NULL),
b0 AS (SELECT doc_id AS from_doc, tie, lead(doc_id) OVER o AS to_doc, n_sentences, lead(n_sentences) OVER o AS n2, CASE WHEN n_sentences > 0 THEN split END AS split, closes, lead(first_word) OVER o AS first_word, last_word FROM en WINDOW o AS (ORDER BY doc_id, tie)),
b1 AS (SELECT *, coalesce(regexp_matches(first_word, '^\p{{Ll}}'), false) AS small FROM b0 WHERE to_doc IS NOT NULL),
b2 AS (SELECT *, CASE WHEN n_sentences = 0 OR n2 = 0 THEN 'no sentence' WHEN split THEN 'split word' WHEN NOT closes AND small THEN 'open, small letter' WHEN closes AND NOT small THEN 'closed, no small letter' WHEN NOT closes THEN 'open, no small letter' ELSE 'closed, small letter' END AS reason FROM b1),
b3 AS (SELECT *, CASE WHEN reason IN ('split word', 'open, small letter') THEN 'continues' WHEN reason = 'closed, no small letter' THEN 'new' ELSE 'uncertain' END AS result FROM b2),
b4 AS (SELECT *, CASE WHEN result = 'continues' THEN sum((result = 'continues')::INTEGER) OVER (ORDER BY from_doc, tie, to_doc ROWS UNBOUNDED PRECEDING)::INTEGER END AS n FROM b3),
b AS MATERIALIZED (SELECT from_doc, to_doc, result, reason, split, closes, first_word, last_word, 's_' || n || '_I' AS id_i, 's_' || n || '_F' AS id_f, CASE WHEN result = 'uncertain' THEN 'low' END AS cert FROM b4)"""
_WORKS = ", ".join("(" + ", ".join("NULL" if x is None else quoted([x]) for x in (k, *v)) + ")" for k, v in table("works").items())


def _norm(x: str) -> str:
    return f"regexp_replace(strip_accents(lower({x})), '[^a-z0-9]', '', 'g')"


_RESOLVED = _KFORMS + rf""",
w(k, b, p, c) AS (VALUES {_WORKS}),
g AS (SELECT text, n, {_norm("text")} AS key FROM f WHERE {_norm("text")} NOT IN ({quoted(table("structural"))})),
h AS (SELECT g.*, (SELECT min(k) FROM w WHERE k = key) AS k0,
  (SELECT count(*) FROM w WHERE starts_with(k, substr(key, 1, 4))) AS c4, (SELECT min(k) FROM w WHERE starts_with(k, substr(key, 1, 4))) AS k4,
  (SELECT count(*) FROM w WHERE starts_with(k, substr(key, 1, 3))) AS c3, (SELECT min(k) FROM w WHERE starts_with(k, substr(key, 1, 3))) AS k3
  FROM g WHERE length(key) >= 2)
SELECT text, n, key, b AS bib_id, p AS pers_id, c AS cert, CASE WHEN k0 IS NOT NULL THEN 'exact' ELSE 'prefix' END AS matched
FROM h JOIN w ON k = CASE WHEN k0 IS NOT NULL THEN k0 WHEN c4 = 1 THEN k4 ELSE k3 END WHERE k0 IS NOT NULL OR (length(key) >= 3 AND (c4 = 1 OR (c4 = 0 AND c3 = 1)))"""

# Marked citations: runs of tokens, then lists of each run's readings in order.
_STRUCTURAL = quoted(table("structural"))
_UNITS = quoted(table("units"))
_RULES = ", ".join(f"({i}, {quoted([*k.split('|'), v])})" for i, (k, v) in enumerate(table("context_rules").items()))
_CITED = _KFORMS + "," + _choices("f") + rf""",
units(u, unit) AS (VALUES {", ".join(f"({quoted([a, b])})" for a, b in table("units").items())}),
z0 AS (SELECT k.*, CASE WHEN kind = 'amp' THEN '&' WHEN kind = 'abbrev_dot' OR choice_kind IN ('macron', 'long_s_macron') THEN text END AS abbr,
    coalesce(choice_kind, kind) AS ck, orig, inner_orig, reg,
    lag((sent_id, italic, bibl_id)) OVER (PARTITION BY r ORDER BY tok_n) IS DISTINCT FROM (sent_id, italic, bibl_id) AS fresh FROM k LEFT JOIN cc USING (kind, text)),
z1 AS (SELECT *, sum((fresh AND bibl_id > 0)::INTEGER) OVER (PARTITION BY r ORDER BY tok_n)::INTEGER AS cit_n FROM z0),
z2 AS (SELECT *, abbr IS NOT NULL AND (inner_orig IS NOT NULL OR ck IN ('long_s', 'long_s_macron')) AS nested, kind NOT IN ('pc', 'dot', 'amp') AND ck = 'plain' AND abbr IS NULL AS is_word FROM z1 WHERE bibl_id > 0),
z3 AS (SELECT *, CASE WHEN kind IN ('pc', 'dot') THEN [] WHEN kind = 'amp' THEN ['&', 'et'] WHEN abbr IS NOT NULL THEN CASE WHEN nested THEN [coalesce(inner_orig, orig)] ELSE [] END || [text] || CASE WHEN reg <> text THEN [reg] ELSE [] END
      WHEN is_word THEN [text] ELSE CASE WHEN inner_orig IS NULL THEN [] ELSE [inner_orig] END || [orig, reg] END AS ws,
    CASE WHEN kind IN ('pc', 'dot') OR is_word OR nested THEN [] WHEN kind = 'amp' THEN ['&'] WHEN abbr IS NOT NULL THEN [text] WHEN inner_orig IS NOT NULL THEN [reg] ELSE [orig, reg] END AS subs FROM z2),
z4 AS (SELECT *, CASE WHEN kind IN ('pc', 'dot') THEN text ELSE array_to_string(ws, '') END AS surf, is_word AND {_norm("text")} NOT IN ({_STRUCTURAL}) AS names FROM z3),
z5 AS (SELECT *, coalesce(sum(names::INTEGER) OVER (PARTITION BY r, cit_n ORDER BY tok_n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS before_name FROM z4),
z6 AS (SELECT r, doc_id, cit_n, min(tok_n) AS first_tok, max(tok_n) AS last_tok, string_agg(text, ' ' ORDER BY tok_n) AS surface, lower(string_agg(surf, '' ORDER BY tok_n)) AS whole,
    list(rtrim(abbr, '.') ORDER BY tok_n) FILTER (abbr IS NOT NULL) AS abbrs, list(abbr ORDER BY tok_n) FILTER (abbr IS NOT NULL AND {_norm("rtrim(abbr, '.')")} NOT IN ({_STRUCTURAL})) AS free,
    list(CASE WHEN names THEN text ELSE list_filter(subs, lambda x: x <> '' AND {_norm("x")} NOT IN ({_STRUCTURAL}))[1] END ORDER BY tok_n) FILTER (before_name) AS third,
    flatten(list(ws ORDER BY tok_n)) AS all_w FROM z5 GROUP BY 1, 2, 3),
z7 AS (SELECT *, list_filter(CASE WHEN len(coalesce(abbrs, [])) >= 2 THEN [abbrs[1] || abbrs[2]] ELSE [] END || coalesce(free, [])[1:1] || coalesce(third, []) || list_filter(all_w, lambda x: x <> '' AND NOT regexp_full_match(x, '[0-9]+') AND {_norm("x")} NOT IN ({_STRUCTURAL}))[1:1], lambda x: x IS NOT NULL) AS cands FROM z6),
z8 AS (SELECT r, cit_n, unnest(range(1, len(cands) + 1)) AS i, unnest(cands) AS cand FROM z7),
w(k, b, p, c) AS (VALUES {_WORKS}),
ke AS (SELECT key, CASE WHEN key IN (SELECT k FROM w) THEN key WHEN length(key) >= 3 AND c4 = 1 THEN k4 WHEN length(key) >= 3 AND c4 = 0 AND c3 = 1 THEN k3 END AS hit FROM (
  SELECT key, count(k) FILTER (starts_with(k, substr(key, 1, 4))) AS c4, min(k) FILTER (starts_with(k, substr(key, 1, 4))) AS k4, count(k) FILTER (starts_with(k, substr(key, 1, 3))) AS c3, min(k) FILTER (starts_with(k, substr(key, 1, 3))) AS k3
  FROM (SELECT DISTINCT {_norm("cand")} AS key FROM z8) CROSS JOIN w WHERE length(key) >= 2 GROUP BY 1)),
z9 AS (SELECT r, cit_n, arg_min(hit, i) AS hit FROM z8 JOIN ke ON key = {_norm("cand")} WHERE hit IS NOT NULL GROUP BY 1, 2),
ru(i, who, word, other) AS (VALUES {_RULES}),
za AS (SELECT z7.*, hit, coalesce((SELECT arg_min(other, i) FROM ru WHERE who = hit AND contains(whole, word)), b) AS bib_id, p AS pers_id, c AS cert FROM z7 LEFT JOIN z9 USING (r, cit_n) LEFT JOIN w ON k = hit),
ab AS (SELECT r, cit_n, tok_n, kind NOT IN ('pc', 'dot') AND NOT is_word AND abbr IS NOT NULL AND NOT nested AND {_norm("rtrim(abbr, '.')")} NOT IN ({_STRUCTURAL}) AS chosen, names AND NOT regexp_full_match(text, '[0-9]+') AS plain FROM z5),
ac AS (SELECT *, CASE WHEN bool_or(chosen) OVER (PARTITION BY r, cit_n) THEN chosen ELSE plain END AS ok FROM ab),
ad AS (SELECT r, cit_n, min(tok_n) FILTER (ok) AS author_first FROM ac GROUP BY 1, 2),
ae AS (SELECT r, cit_n, author_first, 1 + (SELECT count(*) FROM ac WHERE ac.r = ad.r AND ac.cit_n = ad.cit_n AND tok_n = author_first + 1 AND ok)::INTEGER AS author_tokens FROM ad WHERE author_first IS NOT NULL),
ci AS MATERIALIZED (SELECT doc_id, r, cit_n, first_tok, last_tok, surface, coalesce(cands[1], '') AS abbr, bib_id, pers_id, cert, CASE WHEN hit IS NULL THEN 'NO_MATCH' ELSE 'OK' END AS status, CASE WHEN hit IS NOT NULL THEN author_first END AS author_first,
    CASE WHEN hit IS NOT NULL THEN coalesce(author_tokens, 0) ELSE 0 END::INTEGER AS author_tokens, concat_ws('_', 'cit', 'c' || doc_id, coalesce(replace(bib_id, 'bib_', ''), 'noref'), cit_n) AS cit_id FROM za LEFT JOIN ae USING (r, cit_n)),
lo0 AS (SELECT r, cit_n, tok_n, text, is_word, list_filter(CASE WHEN abbr IS NULL THEN [] ELSE [lower(rtrim(abbr, '.'))] END || list_filter(list_transform(ws, lambda x: lower(rtrim(trim(x), '.'))), lambda x: x IN ({_UNITS})), lambda x: x <> '')[-1] AS s FROM z5),
lo1 AS (SELECT *, last_value(s IGNORE NULLS) OVER (PARTITION BY r, cit_n ORDER BY tok_n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM lo0),
lo AS (SELECT doc_id, cit_n, tok_n, text AS number, coalesce(unit, '?') AS unit FROM lo1 LEFT JOIN units ON u = prev JOIN ci USING (r, cit_n) WHERE is_word AND regexp_full_match(text, '[0-9]+') AND status = 'OK')"""
_WORDS = _KFORMS + "," + _choices("f") + r""",
an AS (SELECT doc_id, tok_n, CASE WHEN kind = 'amp' THEN '&' ELSE coalesce(inner_orig, orig) END AS form, CASE WHEN kind = 'amp' THEN 'et' ELSE regexp_replace(reg, '-$', '') END AS norm,
  CASE WHEN kind = 'amp' OR choice_kind IN ('abbr', 'macron', 'long_s_macron') THEN 'expan' WHEN choice_kind = 'plain' THEN 'w' ELSE 'orig' END AS reading FROM k LEFT JOIN cc USING (kind, text) WHERE bibl_id = 0 AND kind NOT IN ('pc', 'dot'))"""
_COUNTS = _KFORMS + "," + _choices("f") + r""",
co AS (SELECT k.r, doc_id, para_id, sent_id, italic, bibl_id, kind, (sol_n IS NOT NULL)::INTEGER + (eol_n IS NOT NULL)::INTEGER + (lb_n IS NOT NULL)::INTEGER AS lbs, CASE WHEN kind IN ('pc', 'dot') THEN 0 WHEN kind = 'amp' OR (choice_kind <> 'plain' AND inner_orig IS NULL AND choice_kind <> 'long_s_macron') THEN 1 WHEN choice_kind = 'plain' THEN 0 ELSE 2 END AS extra,
  lag((sent_id, italic)) OVER w IS DISTINCT FROM (sent_id, italic) AND italic AS hi, lag((sent_id, italic, bibl_id)) OVER w IS DISTINCT FROM (sent_id, italic, bibl_id) AND bibl_id > 0 AS cited FROM k LEFT JOIN cc USING (kind, text) WINDOW w AS (PARTITION BY k.r ORDER BY tok_n)),
tc AS (SELECT src.doc_id, count(DISTINCT para_id)::INTEGER AS p, count(DISTINCT sent_id)::INTEGER AS s, coalesce(sum((kind NOT IN ('pc', 'dot'))::INTEGER + extra), 0)::INTEGER AS w, count(*) FILTER (kind IN ('pc', 'dot'))::INTEGER AS pc, coalesce(sum(lbs), 0)::INTEGER AS lb, coalesce(sum(extra), 0)::INTEGER AS choice,
  coalesce(sum(hi::INTEGER), 0)::INTEGER AS hi, coalesce(sum(cited::INTEGER), 0)::INTEGER AS bibl FROM src LEFT JOIN co USING (r) GROUP BY src.r, src.doc_id)"""
_KEYS = "k AS (SELECT doc_id, 'p' || (doc_id % 100) || '_' || CASE WHEN doc_id % 2 = 0 THEN 'izq' ELSE 'der' END AS c2, doc_id % 100 AS n FROM documents), keys AS (SELECT doc_id, CASE WHEN n < 10 THEN 'p63' ELSE 'p' || n END || '_' || split_part(c2, '_', 2) AS \"column\", CASE WHEN n < 10 THEN 63 ELSE n END::INTEGER AS page, split_part(c2, '_', 2) AS side FROM k), kk AS (SELECT *, page * 2 + (side = 'der')::INTEGER AS col_seq FROM keys)"
_SPANS = rf"""sp0 AS (SELECT doc_id, {_CUSTOM} AS x FROM documents),
sp1 AS (SELECT doc_id, tag, x, unnest(regexp_extract_all(x, tag || '\s*\{{([^}}]*)\}}', 1)) AS body FROM sp0, (VALUES ('abbrev'), ('sic'), ('textStyle'), ('sentence'), ('index_entry')) AS g(tag)),
sp AS (SELECT doc_id, regexp_extract(x, 'structure\s*\{{type:([^;]*)', 1) AS structure_type, tag, regexp_extract(body, 'offset:\s*(\d+)', 1) AS o, regexp_extract(body, 'length:\s*(\d+)', 1) AS l, contains(body, 'continued:true') AS continued, contains(body, 'italic:true') AS italic,
  CASE tag WHEN 'abbrev' THEN regexp_extract(body, 'expansion:\s*([^;]*)', 1) WHEN 'sic' THEN replace(regexp_extract(body, 'corr:\s*([^;]*)', 1), '¬', '-') END AS value FROM sp1)"""

ORACLE = {
    "lines_extract": f"WITH {_LINES} SELECT doc_id, line_n, text, soft_hyphen FROM l",
    "normalize_lines": f"WITH {_LINES} SELECT doc_id, line_n, regexp_replace(text, '  +', ' ', 'g') AS text FROM l",
    "line_counts": f"WITH {_LINES} SELECT doc_id, (count(*) FILTER (t <> ''))::INTEGER AS n_lines, (count(*) FILTER (t = ''))::INTEGER AS n_removed, (count(*) FILTER (contains(t, '  ')))::INTEGER AS n_cleaned FROM l0 GROUP BY r, doc_id",
    "suspicious_continuations": rf"WITH {_LINES} SELECT doc_id, line_n, text, next_text FROM (SELECT *, lead(text) OVER (PARTITION BY r ORDER BY line_n) AS next_text FROM l) WHERE NOT soft_hyphen AND NOT suffix(text, '-') AND regexp_matches(next_text, '^\p{{Ll}}')",
    "catchwords": rf"WITH {_LINES} SELECT doc_id, line_n, text AS catchword, regexp_replace(text, '[.\-]+$', '') AS stem FROM (SELECT *, lag(soft_hyphen) OVER o AS before, lead(line_n) OVER o AS after FROM l WINDOW o AS (PARTITION BY r ORDER BY line_n)) WHERE after IS NULL AND NOT soft_hyphen AND len(string_split_regex(text, '[{Q.SPACE}]+')) <= 2 AND (length(text) <= 5 OR coalesce(before, false))",
    "clean_text": f"WITH {_LINES} SELECT doc_id, string_agg(text || CASE WHEN soft_hyphen THEN '¬' ELSE '' END, chr(10) ORDER BY line_n) AS text FROM l GROUP BY r, doc_id",
    "tokenize": f"WITH {_PLAIN} SELECT doc_id, line_n, tok_n, kind, text FROM t",
    "token_kind_counts": f"WITH {_PLAIN} SELECT kind, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM t GROUP BY 1",
    "mark_types": f"WITH {_PLAIN} SELECT text, coalesce(v, 'other') AS type, CASE WHEN text IN ('[', '(') THEN 'open' WHEN text IN (']', ')') THEN 'close' END AS subtype, count(*) AS n FROM t LEFT JOIN {_pairs('mark_types', 'm', 'k', 'v')} ON k = text WHERE kind IN ('pc', 'dot') GROUP BY ALL",
    "choices": f"WITH {_KFORMS}, {_choices('f')} SELECT * FROM c",
    "choice_kinds": f"WITH {_FORMS}, {_choices('f')} SELECT choice_kind, count(*) AS n_forms, sum(n)::BIGINT AS n_tokens FROM c GROUP BY 1",
    "classified_forms": f"WITH {_FORMS}, {_choices('f')}, q AS (SELECT text, n, coalesce(expansion, CASE WHEN kind = 'word' AND regexp_matches(text, '[āēīōūĀĒĪŌŪ]') THEN {_macrons('text')} WHEN regexp_matches(text, '[ſęæ]') THEN replace(replace(replace(replace(replace(replace(replace(text, 'ſ', 's'), 'æ', 'ae'), 'Æ', 'Ae'), 'œ', 'oe'), 'Œ', 'Oe'), 'ę', 'ae'), 'Ę', 'Ae') END) AS expansion FROM f JOIN cc USING (kind, text)) SELECT text, expansion, {_tag('text', 'expansion')} AS tag, n FROM q WHERE expansion IS NOT NULL",
    "split_words": f"WITH {_KFORMS}, {_choices('f')} SELECT text, text[1:left_len] AS left, text[left_len + 1:] AS right, choice_kind, orig[1:left_len] AS orig_left, orig[left_len + 1:] AS orig_right, reg, n FROM c WHERE kind = 'word_lb'",
    "marked_tokens": f"WITH {Q.TOKENS} SELECT * EXCLUDE (r, expansion) FROM k",
    "paragraphs": f"WITH {Q.TOKENS} SELECT doc_id, para_id, min(line_n) AS first_line, arg_max({_LAST}, tok_n) AS last_line, count(DISTINCT sent_id)::INTEGER AS n_sentences, count(*)::INTEGER AS n_tokens FROM k GROUP BY r, doc_id, para_id",
    "sentences": f"WITH {Q.TOKENS} SELECT doc_id, sent_id, min(para_id) AS para_id, min(line_n) AS first_line, arg_max({_LAST}, tok_n) AS last_line, count(*)::INTEGER AS n_tokens, string_agg(text, ' ' ORDER BY tok_n) AS text FROM k GROUP BY r, doc_id, sent_id",
    "italic_bibl_runs": f"WITH {Q.TOKENS}, q AS (SELECT *, lag((sent_id, italic, bibl_id)) OVER (PARTITION BY r ORDER BY tok_n) IS DISTINCT FROM (sent_id, italic, bibl_id) AS fresh FROM k), p AS (SELECT *, sum(fresh::INTEGER) OVER (PARTITION BY r ORDER BY tok_n)::INTEGER AS run_id FROM q) SELECT doc_id, run_id, min(sent_id) AS sent_id, bool_and(italic) AS italic, min(bibl_id) AS bibl_id, min(tok_n) AS first_tok, count(*)::INTEGER AS n_tokens FROM p GROUP BY r, doc_id, run_id",
    "boundary_diagnosis": f"WITH {_ENDS} SELECT * FROM b",
    "boundary_summary": f"WITH {_ENDS} SELECT result, count(*) AS n FROM b GROUP BY 1",
    "words_across_columns": f"WITH {_ENDS}, q AS (SELECT from_doc, to_doc, last_word || first_word AS text, length(last_word) AS n, 'word_lb' AS kind, NULL::INTEGER AS left_len FROM b WHERE split AND result = 'continues'), "
    + _choices("q").replace("cc AS", "cq AS").replace("JOIN cc USING", "JOIN cq USING").replace("c AS (SELECT f.*", "cx AS (SELECT f.*")
    .replace("rt(i", "rt2(i").replace("JOIN rt ON", "JOIN rt2 ON").replace("rr AS", "rr2 AS").replace("JOIN rr ON rr.", "JOIN rr2 ON rr2.").replace("rr.root", "rr2.root").replace("w0", "v0_").replace("wp AS", "vp AS").replace("FROM wp", "FROM vp").replace("w1", "v1_").replace("w2", "v2_").replace("w3", "v3_")
    .replace("x0", "y0").replace("x1", "y1").replace("x2", "y2").replace("x3", "y3").replace("x4", "y4").replace("x5", "y5").replace("x6", "y6")
    + ", pr AS (SELECT *, CASE WHEN choice_kind IN ('long_s', 'long_s_macron') THEN orig ELSE text END AS o FROM cx) SELECT from_doc, to_doc, text[1:n] AS left, text[n + 1:] AS right, text AS reg, o[1:n] AS orig_left, o[n + 1:] AS orig_right FROM pr",
    "joins_left": rf"""WITH {_PLAIN}, la AS (SELECT *, lag(soft_hyphen) OVER o AS before, lead(line_n) OVER o AS after FROM l WINDOW o AS (PARTITION BY r ORDER BY line_n)),
cw AS (SELECT r, line_n, rtrim(rtrim(text, '.-')) AS c FROM la WHERE after IS NULL AND NOT soft_hyphen AND len(string_split_regex(text, '[{Q.SPACE}]+')) <= 2 AND (length(text) <= 5 OR coalesce(before, false))),
lt AS (SELECT t.r, t.line_n, t.kind, t.text, row_number() OVER (PARTITION BY t.r ORDER BY t.line_n, t.tok_n) AS n, row_number() OVER (PARTITION BY t.r, t.line_n ORDER BY t.tok_n DESC) = 1 AS last_ FROM t LEFT JOIN cw ON cw.r = t.r AND cw.line_n = t.line_n WHERE cw.r IS NULL),
nl AS (SELECT r, line_n, lead(line_n) OVER (PARTITION BY r ORDER BY line_n) AS nx, soft_hyphen FROM l LEFT JOIN cw USING (r, line_n) WHERE cw.r IS NULL),
jj AS (SELECT lt.*, last_ AND soft_hyphen AND nx IS NOT NULL AND kind = 'word' AND coalesce(lead(kind) OVER (PARTITION BY lt.r ORDER BY n) = 'word', false) AS can FROM lt JOIN nl USING (r, line_n)),
ji AS (SELECT *, n - row_number() OVER (PARTITION BY r, can ORDER BY n) AS isl FROM jj),
jk AS (SELECT *, can AND row_number() OVER (PARTITION BY r, can, isl ORDER BY n) % 2 = 1 AS joins FROM ji), jl AS (SELECT *, coalesce(lag(joins) OVER (PARTITION BY r ORDER BY n), false) AS gone FROM jk),
fp AS (SELECT r, arg_min(text, n) AS w FROM jl WHERE kind = 'word' AND NOT joins AND NOT gone GROUP BY 1),
o AS (SELECT doc_id, c, lead(doc_id) OVER q AS to_doc, lead(w) OVER q AS w FROM src LEFT JOIN cw USING (r) LEFT JOIN fp USING (r) WHERE doc_id IS NOT NULL WINDOW q AS (ORDER BY doc_id, md5(coalesce(src.text, ''))))
SELECT doc_id AS from_doc, to_doc, c AS left, w AS right, c || w AS word FROM o WHERE c IS NOT NULL AND w IS NOT NULL""",
    "structure_blocks": rf"WITH {_LINES}, y AS (SELECT *, CASE WHEN regexp_matches(text, '^\p{{Lu}}') THEN 'paragraph' WHEN regexp_matches(text, '^\p{{Ll}}') THEN 'heading' END AS structure_type FROM l), q AS (SELECT *, row_number() OVER w = 1 OR lag(structure_type) OVER w IS DISTINCT FROM structure_type AS fresh FROM y WINDOW w AS (PARTITION BY r ORDER BY line_n)), p AS (SELECT *, sum(fresh::INTEGER) OVER (PARTITION BY r ORDER BY line_n)::BIGINT AS block_id FROM q) SELECT doc_id, block_id, min(structure_type) AS structure_type, min(line_n) AS first_line, max(line_n) AS last_line, count(*) AS n_lines FROM p GROUP BY r, doc_id, block_id",
    "tei_counts": f"WITH {_COUNTS} SELECT * FROM tc",
    "corpus_totals": f"WITH {_COUNTS} SELECT sum(w)::BIGINT AS words, sum(s)::BIGINT AS sentences, sum(p)::BIGINT AS paragraphs FROM tc",
    "author_resolution": f"WITH {_RESOLVED}",
    "cit_ids": f"WITH {_CITED} SELECT * EXCLUDE (r) FROM ci",
    "citation_report": f"WITH {_CITED} SELECT abbr, bib_id, cert, status, count(*) AS n FROM ci GROUP BY ALL",
    "locator_units": f"WITH {_CITED} SELECT * FROM lo",
    "expansions_missing": f"WITH {_CITED} SELECT k.text, count(*) AS n FROM k JOIN cc USING (kind, text) WHERE bibl_id > 0 AND kind = 'abbrev_dot' AND cc.expansion IS NULL GROUP BY 1",
    "annotatable_words": f"WITH {_WORDS} SELECT * FROM an WHERE norm <> ''",
    "annotated_features": f"WITH {_WORDS} SELECT 'First' AS feature, translate(lower(norm)[1:1], '|=', '__') AS value, count(*) AS n FROM an WHERE norm <> '' GROUP BY ALL UNION ALL SELECT 'Length', length(norm)::VARCHAR, count(*) FROM an WHERE norm <> '' GROUP BY ALL",
    "corpus_stats": f"WITH {_PLAIN}, q AS (SELECT r, doc_id, count(*)::INTEGER AS n_lines, sum(soft_hyphen::INTEGER)::INTEGER AS n_hyphens, sum(length(text))::INTEGER AS n_letters FROM l GROUP BY 1, 2) SELECT doc_id, n_lines, n_hyphens, coalesce((SELECT count(*) FROM t WHERE t.r = q.r AND kind = 'abbrev_dot'), 0)::INTEGER AS n_abbreviations, n_letters FROM q",
    "duplicate_ids": f"SELECT doc_id, count(*) AS n FROM ({E.sql(False)}) WHERE doc_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 5",
    "column_keys": f"WITH {_KEYS} SELECT * FROM kk",
    "first_columns": f"WITH {_KEYS} SELECT page, arg_min(doc_id, (col_seq, doc_id)) AS first_doc, count(*) AS n_columns FROM kk GROUP BY 1",
    "custom_spans": f"WITH {_SPANS} SELECT doc_id, structure_type, tag, o::INTEGER AS start, l::INTEGER AS length, continued, italic, value FROM sp WHERE o <> '' AND l <> ''",
    "numbered_lines": f"WITH {_LINES} SELECT doc_id, line_n FROM l WHERE line_n % 5 = 0",
}
