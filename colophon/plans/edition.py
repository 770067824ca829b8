"""The table that the queries run over: documents with the letters, abbreviations and marks of an edition set in.

The driver's documents hold no soft hyphen, macron, long s, paragraph or sentence mark. So each text gets them by a chain of literal replacements, the same in
Spark and in SQL; a part of the rows is there a second time under its id with another text, and another part without an id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = [
    (".\nT", "¬\nt"), (".\nE", " con¬\nE"), (" the ", " the "), ("ent", "ēt"), ("an ", "ā "), ("st", "ſt"), ("ea ", "eę "), (" is ", " vt "), (" and ", " & "), (" la ", " Itaq; "),
    (" les ", " Rep. vſu "), (" el ", " Salōn. lib. 3 ... cap.4 "), (" in ", " sub-lib. Nau. n. 7 "), (" das ", " aestimationem. mensuram 12. "), (".\nO", ".\n\n con\nO"), (".\nD", ".\n - \nd"), (" des ", " D. Th. q. 4. Caiet. 9 "),
]
MARKS = [
    (". E", ". //E"), (". O", ". //O"), (". D", "//D"), ("\nO", "\n¶//O"), ("\nL", "\n¶ L"), (" of ", " *@Caiet. q. 77. art. 2. cap. 3. & ibi@* "), (" un", " *un"), (" que ", " *Soto lib. 4 diſp. 2* & l. si quis ff. ad l. Falcid. "),
    (" und ", " @D. Th. 2. 2. q. 27. ar. 1.@, @Nau. lib. 4 de reſtitut. n. 9@@Salōn ad 3@ "), (" der ", " @Molin. tract. 2 "), (" die ", " @Ari¬\nſtot. lib. 5@ "), (" de ", " @Aug. de trinitat. lib. 3@ & @Reginaldus lib. 25. sect. 3@ / "),
    (" du ", " /*/ @@ xx"), ("\nA", " //\nA"), ("\nQ", "\n¶\nQ"), (" to ", " *a*b¬*\n"), (" with ", " @Fauſt. S. Auguſt. q. 2@ "),
]


def _set_in(x: str, pairs: list[tuple[str, str]]) -> str:
    return reduce(lambda e, p: f"replace({e}, '{p[0]}', '{p[1]}')", pairs, x)


def texts(marks: bool) -> list[tuple[str, str, str]]:
    """(id, text, condition) of each part of the table, as SQL that both engines read."""
    x = _set_in("text", LETTERS + (MARKS if marks else []))
    x = f"concat({x}, CASE WHEN lang = 'fr' THEN ' conſ¬' WHEN lang = 'es' THEN ' mundū quas¬' ELSE '' END)"  # columns that end within a word
    return [("doc_id", x, "true"), ("doc_id", f"replace({x}, 'e', 'é')", "lang = 'es'"), ("CAST(NULL AS BIGINT)", x, "lang = 'de'")]


def edition(spark, sf_dir: str, marks: bool) -> DataFrame:
    """(doc_id, text)"""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    parts = [docs.where(where).select(F.expr(i).alias("doc_id"), F.expr(t).alias("text")) for i, t, where in texts(marks)]
    return reduce(DataFrame.union, parts)


def sql(marks: bool) -> str:
    """r tells rows apart."""
    return "SELECT row_number() OVER () AS r, * FROM (" + " UNION ALL ".join(f"SELECT {i} AS doc_id, {t} AS text FROM documents WHERE {where}" for i, t, where in texts(marks)) + ")"
