"""Works by name: abbreviated names of a whole table resolved to a catalogue by equi-joins. ``resolve.lookup`` does it for one name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.functions import spelling as S
from colophon.functions.lexicon import table


def works(spark) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in table("works").items()], "work_key string, bib_id string, pers_id string, cert string")


def resolved(forms: DataFrame) -> DataFrame:
    """(text, n, key, bib_id, pers_id, cert, matched): forms that name a work and are no structural word: by the whole key, else by four letters that only one key begins with, else, if none
    does, by three. All equi-joins with the catalogue, a fixed table of the package."""
    spark = forms.sparkSession
    w = works(spark)
    d = forms.withColumn("key", F.expr(S.normalize_key("text"))).where("length(key) >= 2")
    kept = F.broadcast(spark.createDataFrame([(x,) for x in table("structural")], "key string"))
    d = d.join(kept, "key", "left_anti")

    def prefix(n: int) -> DataFrame:
        found = F.min(F.struct("bib_id", "pers_id", "cert"))
        return F.broadcast(w.where(F.length("work_key") >= n).groupBy(F.substring("work_key", 1, n).alias(f"p{n}")).agg(F.count("*").alias(f"c{n}"), found.alias(f"b{n}")))

    exact = F.broadcast(w.select(F.col("work_key").alias("key"), F.struct("bib_id", "pers_id", "cert").alias("b")))
    d = d.withColumn("p4", F.when(F.length("key") >= 3, F.substring("key", 1, 4))).withColumn("p3", F.when(F.length("key") >= 3, F.substring("key", 1, 3)))
    # A key of three letters is its own prefix of four.
    d = d.join(exact, "key", "left").join(prefix(4), "p4", "left").join(prefix(3), "p3", "left")
    short = F.length("key") == 3
    hit4 = ~short & (F.col("c4") == 1)
    hit3 = (short | F.col("c4").isNull()) & (F.col("c3") == 1)
    how = F.when(F.col("b").isNotNull(), "exact").when(hit4, "prefix").when(hit3, "prefix")
    found = F.when(F.col("b").isNotNull(), F.col("b")).when(hit4, F.col("b4")).otherwise(F.col("b3"))
    return d.withColumn("matched", how).where("matched is not null").select("text", "n", "key", found["bib_id"].alias("bib_id"), found["pers_id"].alias("pers_id"), found["cert"].alias("cert"), "matched")
