"""Sources and sinks: delimited / parquet tables under explicit schemas.

Header discovery reads at most a few lines of each file on the driver (plan-time
metadata, like a schema); the scan itself is a normal parallel ``spark.read`` over all files.
"""

from __future__ import annotations

import csv
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """';' when it outnumbers ',' in the first line, else ','."""
    rows = spark.read.option("lineSep", "\n").text(path).limit(1).collect()
    return _delimiter(rows[0].value) if rows else ","


def read_table(spark: SparkSession, path: str, fmt: str = "csv", columns: list[str] | None = None,
               sep: str | None = None, multi_line: bool = False) -> DataFrame:
    """Delimited (header, UTF-8 BOM tolerated) or parquet scan.  Delimited sources are
    read all-string, by the names of the header; ``columns`` picks them by name, in any
    order, and raises if one is missing; a further file with another header raises.
    ``multi_line`` reads quoted line breaks as part of a cell; such files are not
    split, so use it only for them."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    sep = sep or sniff_delimiter(spark, path)
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"') \
                  .option("escape", '"').option("multiLine", multi_line).option("encoding", "UTF-8") \
                  .option("inferSchema", False).option("enforceSchema", False)
    df = reader.csv(path)
    first = df.columns[0] if df.columns else None
    if first and first.startswith("﻿"):
        df = df.withColumnRenamed(first, first.lstrip("﻿"))
    if columns is None:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {missing}; its header is {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def head_lines(spark: SparkSession, path: str, n: int) -> dict[str, list[str]]:
    """The first ``n`` lines of every file under a path.  Only the blocks that begin a file are
    looked at, and only n lines a file come to the driver (as the listing of the files does)."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
             .where(F.col("block") == 0).select("file", "value", F.monotonically_increasing_id().alias("line")))
    first = lines.withColumn("n", F.row_number().over(Window.partitionBy("file").orderBy("line"))).where(F.col("n") <= n)
    out: dict[str, list[str]] = {}
    for r in first.orderBy("file", "n").collect():
        out.setdefault(r["file"], []).append(r["value"].lstrip("\ufeff").rstrip("\r"))
    return out


def _cells(line: str, sep: str) -> list[str]:
    return [" ".join(c.split()) for c in next(csv.reader([line], delimiter=sep), [])]


def _delimiter(line: str) -> str:
    return ";" if line.count(";") > line.count(",") else ","


def _by_header(heads: dict[str, list[str]], header_at, sep: str | None) -> dict[tuple, list[str]]:
    """(delimiter, column names) -> files."""
    groups: dict[tuple, list[str]] = {}
    for file, lines in heads.items():
        at, used = header_at(file, lines)
        names = _cells(lines[at], used)
        # a cell without a name, or whose name was there, cannot be asked for
        names = [c if c and c not in names[:i] else f"_c{i}" for i, c in enumerate(names)]
        groups.setdefault((used, tuple(names)), []).append(file)
    return groups


def _scan(spark: SparkSession, files: list[str], names: tuple, sep: str) -> DataFrame:
    return (spark.read.option("header", False).option("sep", sep).option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).schema(string_schema(list(names))).csv(files)
            .withColumn("_file", F.col("_metadata.file_path")))


def read_with_preamble(spark: SparkSession, path: str, required: list[str], id_col: str,
                       max_scan: int = 10, sep: str | None = None) -> DataFrame:
    """Delimited files, each with a preamble and a header of its own.

    The header of every file is found in its first ``max_scan`` lines (the first line whose cells,
    trimmed, hold every required name; a file without one raises).  Files are then read by
    header, in parallel and without header, and united by column name, so neither the length
    of a preamble nor the order of columns need agree.  Rows whose ``id_col`` is not numeric
    (preamble, header, notes, blanks) are dropped."""
    from ..functions.values import is_numeric

    def header_at(file, lines):
        tried = [sep] if sep else [",", ";", "\t"]
        for i, line in enumerate(lines):
            for used in tried:
                if set(required) <= set(_cells(line, used)):
                    return i, used
        raise ValueError(f"could not find a header row with {required} in the first {len(lines)} lines of {file}")
    out = None
    for (used, names), files in sorted(_by_header(head_lines(spark, path, max_scan), header_at, sep).items()):
        part = _scan(spark, files, names, used).where(is_numeric(F.col(f"`{id_col}`"))).drop("_file")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"{path} has no lines")
    return out


def read_fixed_preamble(spark: SparkSession, path: str, skip: int = 6, sep: str | None = None) -> DataFrame:
    """Delimited files with ``skip`` preamble lines, then the header, united by column name.  No
    numeric ID is guaranteed here, so the rows of a file that equal one of its own first ``skip + 1``
    lines, cell by cell, are dropped after the parallel scan (by one join on file and cells)."""
    heads = head_lines(spark, path, skip + 1)

    def header_at(file, lines):
        if len(lines) <= skip:
            raise ValueError(f"no header row after the preamble of {file}")
        return skip, sep or _delimiter(lines[skip])
    out = None
    for (used, names), files in sorted(_by_header(heads, header_at, sep).items()):
        cells = F.xxhash64(*[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names])
        lines = spark.createDataFrame([(f, x) for f in files for x in heads[f]], "_file string, line string")
        # the preamble's lines are parsed as the scan parses them
        parsed = lines.select("_file", F.from_csv("line", _ddl(names), {"sep": used, "quote": '"', "escape": '"'}).alias("r"))
        drop = parsed.select("_file", "r.*").select("_file", cells.alias("_cells")).distinct()
        part = _scan(spark, files, names, used).withColumn("_cells", cells)
        part = part.join(drop, ["_file", "_cells"], "left_anti").drop("_file", "_cells")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no header row after the preamble")
    return out


def _ddl(names) -> str:
    return ", ".join("`" + n.replace("`", "``") + "` string" for n in names)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Hadoop FileSystem check at plan time (works for any cluster FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  prefix: str | None = None, id_col: str = "prospect_id") -> DataFrame:
    """Optional earlier output: missing -> empty table with the schema;
    present -> projected/extended to the schema, rows of ``prefix`` only."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(path) if fmt == "parquet" else read_table(spark, path)
    if prefix and id_col in df.columns:
        df = df.where(F.col(id_col).startswith(prefix))
    return df.select([F.col(f.name).cast(f.dataType) if f.name in df.columns
                      else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", sort_by: list[str] = ()) -> None:
    """Table sink (a directory of part files; CSV with header, no index).  With ``sort_by`` (those
    columns that the table has) rows are dealt by sampled ranges and sorted inside each, ascending and
    nulls last, so the part files in the order of their names hold the rows in order."""
    keys = [F.col(f"`{c}`").asc_nulls_last() for c in sort_by if c in df.columns]
    if keys:
        df = df.orderBy(*keys)
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def stage(df: DataFrame, staging_path: str) -> DataFrame:
    """Write a pre-filtered input to a separate staging path and read it
    back (Spark must not overwrite what it is reading)."""
    write_table(df, staging_path, "parquet")
    return df.sparkSession.read.parquet(staging_path)


MANIFEST = "MANIFEST.json"


def _file_context(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())


def published(spark: SparkSession, base: str) -> dict | None:
    """The manifest of the current version under ``base``: {"version", "format", "tables": {name: path}}."""
    path = f"{base}/{MANIFEST}"
    if not path_exists(spark, path):
        return None
    text = "\n".join(r.value for r in spark.read.text(path).collect())  # one small file
    return json.loads(text)


def publish(tables: dict[str, DataFrame], base: str, fmt: str = "parquet",
            sort_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """A workbook of named sheets becomes one table directory per sheet, all of them or none.

    Every call writes a new version folder; readers go by the manifest, which is switched to
    the new version last, by one atomic rename.  A job that is lost half-way leaves the old
    manifest and the old tables as they are; earlier versions are kept.  ``sort_by`` gives
    the sort columns of a table."""
    spark = next(iter(tables.values())).sparkSession
    now = published(spark, base)
    version = (now["version"] if now else 0) + 1
    folder = f"{base}/v{version:06d}-{uuid.uuid4().hex[:8]}"  # two writers never share a folder
    out = {}
    for name, df in tables.items():
        path = f"{folder}/{name.replace(' ', '_').lower()}"
        write_table(df, path, fmt, mode="errorifexists", sort_by=(sort_by or {}).get(name, ()))
        out[name] = path
    _switch(spark, base, json.dumps({"version": version, "format": fmt, "tables": out}))
    return out


def _switch(spark: SparkSession, base: str, text: str) -> None:
    jvm = spark.sparkContext._jvm
    fresh, context = _file_context(spark, f"{base}/.{MANIFEST}.{uuid.uuid4().hex}")
    fs = fresh.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(fresh)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{base}/{MANIFEST}"), overwrite)


def read_published(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of the current version."""
    now = published(spark, base)
    if now is None or name not in now["tables"]:
        raise ValueError(f"no table {name!r} is published under {base}")
    path = now["tables"][name]
    return read_table(spark, path, sep=",") if now["format"] == "csv" else spark.read.parquet(path)


def emails(df: DataFrame, col: str = "email") -> DataFrame:
    """E-mail export: the e-mail column of every row (no dedup)."""
    return df.select(F.col(col).alias("email"))
