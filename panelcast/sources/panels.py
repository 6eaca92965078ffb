"""Panels derived from fact tables, CSV folders and uploaded tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelcast.functions.calendar import bucket, spark_pattern


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def panel_from_facts(facts: DataFrame, key: Column, ts: Column, measure: Column,
                     freq: str = "W-MON", decimals: int = 2) -> DataFrame:
    """Sum a measure per key and calendar period.

    The sum is combined on the map side, so a key that owns a third of the
    facts still sends one row per period and task.  What comes out has at most
    one row per series and period, however large the fact table.
    """
    return (facts.groupBy(key.cast("string").alias("series_id"), bucket(ts, freq).alias("ds"))
            .agg(F.round(F.sum(measure), decimals).alias("y")))


def orders_by_priority(spark: SparkSession, folder: str, freq: str = "W-MON") -> DataFrame:
    return panel_from_facts(read_table(spark, folder, "orders"), F.col("o_orderpriority"),
                            F.col("o_orderdate"), F.col("o_totalprice"), freq)


def orders_by_nation(spark: SparkSession, folder: str, freq: str = "W-MON") -> DataFrame:
    """Orders meet their customer once; the sum per nation and period is combined on the map side."""
    named = (read_table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
             .join(read_table(spark, folder, "customer").select("c_custkey", "c_nationkey"),
                   F.col("o_custkey") == F.col("c_custkey"))
             .join(read_table(spark, folder, "nation").select("n_nationkey", "n_name"),
                   F.col("c_nationkey") == F.col("n_nationkey")))
    return panel_from_facts(named, F.col("n_name"), F.col("o_orderdate"), F.col("o_totalprice"), freq)


def shipments_by_supplier(spark: SparkSession, folder: str, freq: str = "W-MON") -> DataFrame:
    return panel_from_facts(read_table(spark, folder, "lineitem"), F.col("l_suppkey"),
                            F.col("l_shipdate"), F.col("l_quantity"), freq)


def events_by_type(spark: SparkSession, folder: str, freq: str = "H") -> DataFrame:
    return panel_from_facts(read_table(spark, folder, "events"), F.col("event_type"),
                            F.col("ts"), F.col("value"), freq)


# Marks of a missing value in upper case.
MISSING_MARKS = ("", "NA", "N/A", "#N/A", "NAN", "NULL", "NONE", "-NAN", "<NA>")


def read_series_csv(spark: SparkSession, folder: str, date_format: str = "%Y-%m-%d",
                    named_by: str = "file", config: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Every ``*.csv`` below ``folder`` as one panel.

    With ``config`` (``series_id, format``, as ``read_series_config`` returns
    it) every file's dates are read by its own format; files it does not name
    follow ``date_format``.  A date or value that is there but cannot be read
    stops the job (``strict``), or becomes NULL; the usual marks of a missing
    value are NULL either way.

    The first column is the date, the second the value; the header of each
    file is skipped.  The series is the file name without its extension
    (``named_by='file'``), or the folder ``series_id=<name>`` that holds the
    file (``'folder'``, the layout ``write_per_series`` produces).
    """
    reader = (spark.read.schema("date string, value string").option("header", True)
              .option("enforceSchema", True).option("pathGlobFilter", "*.csv")
              .option("recursiveFileLookup", True))
    raw = reader.csv(folder)
    # Paths come URL-encoded from the scan.
    if named_by == "file":
        name = F.regexp_replace(F.url_decode(F.col("_metadata.file_name")), r"\.csv$", "")
    else:
        inside = F.regexp_extract(F.col("_metadata.file_path"), "series_id=([^/]+)/", 1)
        # Hive-style escapes of the folder name are themselves escaped in the path.
        name = F.url_decode(F.url_decode(inside))
    named = raw.withColumns({"series_id": name, "format": F.lit(date_format)})
    formats = [date_format]
    if config is not None:
        formats += [row[0] for row in config.select("format").where("format IS NOT NULL").distinct().collect()]
        own = config.select("series_id", F.col("format").alias("own_format"))
        named = named.join(own, "series_id", "left").withColumn("format", F.coalesce("own_format", "format"))
    dated = parse_dates(named.withColumn("date", F.trim("date")), "date", sorted(set(formats)), strict=strict)
    value, text = F.expr("try_cast(trim(value) AS double)"), F.upper(F.trim("value"))
    if strict:
        message = F.concat(F.lit("value that is no number in "), F.col("series_id"), F.lit(": "), F.col("value"))
        bad = value.isNull() & text.isNotNull() & ~text.isin(*MISSING_MARKS)
        value = F.when(bad, F.raise_error(message).cast("double")).otherwise(value)
    return dated.select("series_id", "ds", value.alias("y"))


def read_series_csv_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Per file: its header names and whether it is a CSV, for the data gate."""
    lines = (spark.read.option("recursiveFileLookup", True).text(folder)
             .select(F.url_decode(F.col("_metadata.file_name")).alias("file_name"),
                     F.col("_metadata.file_block_start").alias("block_start"),
                     F.monotonically_increasing_id().alias("position"), "value"))
    header = (lines.groupBy("file_name")
              .agg(F.min_by("value", F.struct("block_start", "position")).alias("header")))
    names = F.transform(F.split("header", ","), lambda c: F.lower(F.replace(c, F.lit(" "), F.lit(""))))
    return header.select(
        F.regexp_replace("file_name", r"\.csv$", "").alias("series_id"),
        F.col("file_name").endswith(".csv").alias("is_csv"),
        F.element_at(names, 1).alias("first_column"),
        (F.size(names) - 1).alias("n_value_columns"))


def _sql_text(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def parse_dates(df: DataFrame, text: str = "date", formats: list[str] | None = None,
                format_column: str = "format", out: str = "ds", strict: bool = False) -> DataFrame:
    """Parse date text by the strftime format named on each row.

    ``formats`` lists the formats in use; each becomes one branch of a CASE.
    Another format on a row stops the job; so does, if ``strict``, a text that
    does not follow its format.
    """
    formats = formats or ["%Y-%m-%d", "%m/%d/%y", "%d.%m.%Y", "%Y/%m/%d"]
    unknown = F.concat(F.lit("date format that is not listed: "), F.col(format_column))
    parsed = F.when(F.col(format_column).isNotNull() & ~F.col(format_column).isin(*formats),
                    F.raise_error(unknown).cast("date"))
    for fmt in formats:
        attempt = F.expr(f"try_to_timestamp(`{text}`, '{_sql_text(spark_pattern(fmt))}')").cast("date")
        if "%y" in fmt:
            # Two-digit years mean 1969 to 2068; the pattern letter reads 2000 to 2099.
            attempt = F.when(F.year(attempt) > 2068, F.add_months(attempt, -1200)).otherwise(attempt)
        parsed = F.when(F.col(format_column) == fmt, attempt).otherwise(parsed)
    if strict:
        message = F.concat(F.lit("date that does not follow "), F.col(format_column), F.lit(": "), F.col(text))
        parsed = F.when(parsed.isNull() & (F.trim(text) != ""), F.raise_error(message).cast("date")).otherwise(parsed)
    return df.withColumn(out, parsed)


def normalize_names(df: DataFrame) -> DataFrame:
    """Column names in lower case without spaces."""
    return df.toDF(*[c.lower().replace(" ", "") for c in df.columns])


def project_name(name: Column) -> Column:
    """A project title as an identifier: spaces to underscores, lower case."""
    return F.lower(F.replace(name, F.lit(" "), F.lit("_")))
