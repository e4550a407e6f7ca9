"""Chat formatting: multi-party perspective rotation [native].

For every participant of a conversation (each role but the system's) the whole
dialogue is rendered once with that speaker as the assistant and the others as
named users.  A rendering comes as segments, one per turn, each with its place in the
rendered text and whether its content is trained on; joined in order of ``seq`` they are the text.
So a conversation of any length never lies in one row or task: turns are
numbered in buckets of `TURNS`, whose offsets are summed first.

Turns are ordered by (turn, role, text); null turns come last; a null role speaks as
'unknown'; null text is empty; repeated turns are rendered as often as they occur; system turns alone have no participant
and give no row; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURNS, SALTS = 256, 16
OPEN, CLOSE = "<|", "<|end|>\n"


def tag(speaker: Column, perspective: Column, system: str) -> Column:
    """Header of a segment."""
    return (F.when(speaker == system, F.lit(f"{OPEN}system|>\n"))
            .when(speaker == perspective, F.lit(f"{OPEN}assistant|>\n"))
            .otherwise(F.concat(F.lit(f"{OPEN}user name="), speaker, F.lit("|>\n"))))


def perspectives(turns: DataFrame, system: str = "system") -> DataFrame:
    """One row per (conversation, perspective, turn): conv_id, perspective, seq (from 0), speaker,
    segment, in_loss, start and end (characters of the rendered text whose loss counts; the content and its end mark)."""
    base = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("speaker"), F.coalesce("text", F.lit("")).alias("content"))
    # participants are few per conversation and map-side distinct; salts split the turns of a hot conversation
    who = base.where(F.col("speaker") != system).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    who = who.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("conv_id", "c")
    base = base.withColumn("salt", F.pmod(F.xxhash64("turn", "speaker", "content"), F.lit(SALTS)).cast("int"))
    rows = base.join(who, base["conv_id"].eqNullSafe(who["c"]) & (base["salt"] == who["salt"])).drop("salt", "c")
    head = tag(F.col("speaker"), F.col("perspective"), system)
    rows = rows.select("conv_id", "perspective", "turn", "speaker", F.concat(head, "content", F.lit(CLOSE)).alias("segment"),
                       F.length(head).alias("head"), F.floor(F.col("turn") / TURNS).alias("bucket"))
    rows = rows.withColumn("size", F.length("segment").cast("long"))
    key = ["conv_id", "perspective"]
    sums = rows.groupBy(*key, "bucket").agg(F.count("*").alias("n"), F.sum("size").alias("chars"))
    ahead = W.partitionBy(*key).orderBy(F.col("bucket").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("bucket").alias("b"),
                       F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n0"), F.coalesce(F.sum("chars").over(ahead), F.lit(0)).alias("chars0"))
    order = [F.col("turn").asc_nulls_last(), "speaker", "segment"]
    inside = W.partitionBy(*key, "bucket").orderBy(*order)
    rows = rows.withColumn("i", F.row_number().over(inside) - 1).withColumn(
        "at", F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.join(sums, rows["conv_id"].eqNullSafe(sums["c"]) & (rows["perspective"] == sums["p"]) & rows["bucket"].eqNullSafe(sums["b"]))
    start = F.col("chars0") + F.col("at")
    return rows.select("conv_id", "perspective", (F.col("n0") + F.col("i")).cast("long").alias("seq"), "speaker", "segment",
                       (F.col("speaker") == F.col("perspective")).alias("in_loss"),
                       (start + F.col("head")).cast("long").alias("start"), (start + F.col("size") - 1).cast("long").alias("end"))
