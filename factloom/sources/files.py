"""Scans: contract CSV, generic CSV, zipped CSV, HTML tables, JSON lines, registries, SQL."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The columns of a contract row.
REQUIRED = ["source_id", "source_url", "source_document", "retrieved_date", "row_position"]
VERBATIM = ["name_verbatim", "address_verbatim", "city_verbatim", "state_verbatim", "zip_verbatim"]
OTHER = ["country", "source_identifier", "naics_verbatim", "status_verbatim", "status_basis", "expiry_date", "lat", "lon", "notes"]
OPTIONAL = ["website", "sq_ft", "operating_status", "phone", "email", "primary_capability", "secondary_capability", "material", "sector", "throughput", "throughput_unit", "utilisation_pct", "vacant_capacity", "annual_revenue_usd", "automation_level", "states_serviced", "country_based", "value_basis"]
STATUS_BASES = ["dated_expiry", "on_current_list", "explicit_status_field", "certified_as_of_date", "none"]


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def header(spark: SparkSession, path: str) -> list[str]:
    """The first line's names, a byte order mark dropped; read by Spark, so any store will do."""
    line = spark.read.text(path).first()
    names = next(iter(pd.read_csv(io.StringIO(line[0].lstrip("﻿")), header=None, dtype=str).itertuples(index=False))) if line else ()
    return [str(n) for n in names]


def csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text in the file's order; blank is '' and nothing is inferred."""
    return spark.read.schema(text_schema(header(spark, path))).option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE").option("enforceSchema", True).csv(path).na.fill("")


def contract(spark: SparkSession, path: str) -> DataFrame:
    """A contract CSV; required columns that lack are an error, optional ones are ''."""
    df = csv(spark, path)
    needed = [*REQUIRED, *VERBATIM, *OTHER]
    if missing := [c for c in needed if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*needed, *[F.col(c) if c in df.columns else F.lit("").alias(c) for c in OPTIONAL])


def problems(rows: DataFrame, source_id: str) -> DataFrame:
    """(row_position, problem) for every rule a contract row breaks."""
    checks = [F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) == "", F.lit(f"{c} is blank")) for c in REQUIRED + ["name_verbatim"]]
    checks.append(F.when(~F.col("status_basis").isin(STATUS_BASES), F.lit("status_basis is unknown")))
    checks.append(F.when(F.col("source_id") != source_id, F.lit("source_id is another")))
    checks.append(F.when((F.coalesce("expiry_date", F.lit("")) != "") & ~F.col("expiry_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit("expiry_date is not ISO")))
    return rows.select("row_position", F.explode(F.array_compact(F.array(*checks))).alias("problem"))


def normalised(rows: DataFrame) -> DataFrame:
    """Adds city_norm, street_key, state, no_fixed_plant and row_hash; what was printed stays as it is."""
    from factloom.functions.streets import street_key
    from factloom.functions.text import hashed, norm_city, us_state

    return rows.withColumns(
        {
            "city_norm": norm_city(F.col("city_verbatim")),
            "street_key": street_key("address_verbatim"),
            "state": us_state(F.col("state_verbatim")),
            "no_fixed_plant": F.contains(F.upper(F.coalesce("notes", F.lit(""))), F.lit("NO-FIXED-PLANT")),
            "row_hash": hashed(*[F.col(c) for c in [*VERBATIM, "source_id", "source_identifier"]]),
        }
    )


def zipped_csv(spark: SparkSession, path: str, member: str, columns: list[str]) -> DataFrame:
    """Rows of one CSV in each zip file, the named columns as text; a zip is read by one task, in pieces."""

    def run(batches):
        for pdf in batches:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(member) as f:
                    yield from pd.read_csv(f, dtype=str, keep_default_na=False, usecols=columns, chunksize=50_000)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(lambda b: (x[columns] for x in run(b)), text_schema(columns))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def registry(spark: SparkSession, sources: list[dict]) -> DataFrame:
    """Source registry entries as rows; only active sources of classes A to D run."""
    rows = [(s["id"], s.get("class"), s.get("status"), s.get("fetcher")) for s in sources]
    df = spark.createDataFrame(rows, "source_id string, source_class string, status string, fetcher string")
    return df.withColumn("runs", F.coalesce((F.col("status") == "active") & F.col("source_class").isin("A", "B", "C", "D"), F.lit(False)))


def sql(spark: SparkSession, query: str, tables: dict[str, DataFrame], **args) -> DataFrame:
    """Ad-hoc SQL over named tables, with named parameters."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=args)


def newest_part(paths: DataFrame) -> DataFrame:
    """(source, path) of the newest dated folder of each source; paths: .../source=/date=/..."""
    p = paths.select("path", F.regexp_extract("path", "source=([^/]+)", 1).alias("source"), F.regexp_extract("path", r"date=(\d{4}-\d{2}-\d{2})", 1).alias("date"))
    newest = p.where("date <> ''").groupBy("source").agg(F.max("date").alias("date"))
    return p.join(newest, ["source", "date"])
