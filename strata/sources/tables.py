"""Scans. Parquet is the native format; CSV is read with an explicit schema
(or header inference when asked), as the reference's loader does."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegerType, StringType, StructField, StructType

from ..spec import PanelSpec

#: Where ``from_csv`` puts a line that does not fit the schema.
_BROKEN = "_broken_line"

# Column roles of the weekly store-sales layout (raw file: Date is text).
WEEKLY_SALES = PanelSpec(
    entity="Store",
    time="Date",
    value="Weekly_Sales",
    flag="Holiday_Flag",
    covariates=("Temperature", "Fuel_Price", "CPI", "Unemployment"),
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``name`` under ``sf_dir`` (a path or any URI Spark reads),
    as its files are now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Column names, types and order of the raw file.
def weekly_sales_schema(exact: bool = True) -> StructType:
    """The fixed 8-column raw layout of weekly store sales (all nullable).

    ``exact`` reads the money column as DECIMAL(18,2) and the covariates as
    double straight from the text; ``exact=False`` keeps 32-bit floats, where
    1643690.90 reads as 1643690.875."""
    money = DecimalType(18, 2) if exact else FloatType()
    num = DoubleType() if exact else FloatType()
    return StructType(
        [
            StructField("Store", IntegerType(), True),
            StructField("Date", StringType(), True),
            StructField("Weekly_Sales", money, True),
            StructField("Holiday_Flag", IntegerType(), True),
            StructField("Temperature", num, True),
            StructField("Fuel_Price", num, True),
            StructField("CPI", num, True),
            StructField("Unemployment", num, True),
        ]
    )


def load_weekly_sales(spark: SparkSession, path: str, exact: bool = True) -> DataFrame:
    """The weekly store-sales CSV with its fixed schema (header row, no
    inference pass). Use with ``WEEKLY_SALES`` and ``clean_panel(df,
    WEEKLY_SALES, "Date")`` to parse the text dates."""
    return load_csv(spark, path, schema=weekly_sales_schema(exact), header=True)


def load_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """CSV scan. With a schema nothing is inferred (no extra pass over the
    files); without one, ``infer_schema`` decides between typed and all-string
    columns. ``mode`` is Spark's parse mode (PERMISSIVE / DROPMALFORMED / FAILFAST)."""
    r = spark.read.format("csv").option("header", header).option("mode", mode)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", infer_schema)
    return r.load(path)


def load_csv_checked(
    spark: SparkSession, path: str, schema: StructType, header: bool = True, sep: str = ","
) -> tuple[DataFrame, DataFrame]:
    """A CSV scan that loses no line: (good, rejects).

    ``good`` has the columns of ``schema``, a row for each line that fits it;
    ``rejects`` has ``file`` and ``line`` (the text as it stands) of every line
    that does not: a value of another type, too few fields or too many. Blank
    lines are neither, nor are header lines (those equal to the joined column
    names). A record is one line."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    if header:
        lines = lines.where(F.col("value") != sep.join(schema.fieldNames()))
    # each line is parsed once, whichever of the two tables reads it
    parsed = StructType([*schema.fields, StructField(_BROKEN, StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN, "sep": sep}
    rows = lines.select("file", "value", F.from_csv("value", parsed.simpleString()[len("struct<") : -1].replace(":", " "), options).alias("r"))
    broken = F.col(f"r.{_BROKEN}").isNotNull()
    good = rows.where(~broken).select(*[F.col(f"r.`{c}`").alias(c) for c in schema.fieldNames()])
    return good, rows.where(broken).select("file", F.col("value").alias("line"))
