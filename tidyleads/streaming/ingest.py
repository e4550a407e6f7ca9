"""Incremental ingestion of vendor exports with Structured Streaming.

The reference has no streaming; its only incremental step is "a new export
file arrives and is staged".  Here that is a file-source stream: every new
delimited file in a folder is read under an explicit all-string schema, the
row-level (stateless) rules run on it, and the rows are appended to a
parquet staging table.  The caller names the checkpoint folder,
so a restarted driver or lost executor resumes exactly where it stopped.
Whole-set rules (duplicates, quotas, coverage) stay in the batch jobs, which
read the staged table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import contact as C
from ..functions import geo
from ..functions.values import null_if_missing, to_long0
from ..sources.files import string_schema


def stage_rules(df: DataFrame) -> DataFrame:
    """Stateless per-row rules applied while staging."""
    out = df
    if "custom_id" in out.columns:
        out = out.withColumn("custom_id", to_long0("custom_id"))
    for c in ("email", "linkedin_url", "work_phone", "mobile_phone", "country", "source"):
        if c in out.columns:
            out = out.withColumn(c, null_if_missing(c))
    if "email" in out.columns:
        out = out.withColumns({"bad_email_format": C.bad_email_format("email"),
                               "private_email": C.is_private_email("email")})
    if "country" in out.columns:
        out = out.withColumn("country_code", geo.country_to_code("country"))
    if "work_phone" in out.columns:
        out = out.withColumn("work_phone", C.phone_plus("work_phone"))
    return out.withColumn("staged_file", F.input_file_name())


def stage_stream(spark: SparkSession, source_dir: str, columns: list[str], target_dir: str,
                 checkpoint: str, sep: str = ",", available_now: bool = True):
    """Start the staging stream; returns the ``StreamingQuery``.  ``checkpoint`` is the
    stream's own folder on shared storage, the same at every start: a new driver
    goes on where the last one stopped.  A file whose header is not ``columns`` fails the stream."""
    stream = (spark.readStream.schema(string_schema(columns)).option("header", True).option("enforceSchema", False).option("sep", sep)
              .option("quote", '"').option("escape", '"').csv(source_dir))
    writer = (stage_rules(stream).writeStream.format("parquet").option("path", target_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
