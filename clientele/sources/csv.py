"""Delimited-text source for the customer table (header row, ';' by default).

The delimiter can be detected: the first line is read with ``spark.read.text``
(one small read of the file head), each candidate delimiter is counted and the
most frequent one wins - the intent of the reference's "only one column parsed,
try , tab |" fallback, decided before the real read instead of after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.session import freeze

DELIMITERS = [";", ",", "\t", "|"]

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("Year_Birth", T.IntegerType()),
    T.StructField("Education", T.StringType()),
    T.StructField("Marital_Status", T.StringType()),
    T.StructField("Income", T.DoubleType()),
    T.StructField("Kidhome", T.IntegerType()),
    T.StructField("Teenhome", T.IntegerType()),
    T.StructField("Dt_Customer", T.StringType()),
    T.StructField("Recency", T.IntegerType()),
    *[T.StructField(c, T.LongType()) for c in ["MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts",
                                               "MntSweetProducts", "MntGoldProds", "NumDealsPurchases",
                                               "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases",
                                               "NumWebVisitsMonth"]],
    *[T.StructField(c, T.IntegerType()) for c in ["AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5", "AcceptedCmp1",
                                                  "AcceptedCmp2", "Complain", "Z_CostContact", "Z_Revenue",
                                                  "Response"]],
])


def detect_delimiter(spark: SparkSession, path: str, candidates=DELIMITERS) -> str:
    """Most frequent candidate in the header line (first candidate wins ties)."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return candidates[0]
    line = first[0][0]
    counts = [(line.count(c), -i, c) for i, c in enumerate(candidates)]
    best = max(counts)
    return best[2] if best[0] > 0 else candidates[0]


def header_names(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Column names of the header line, without quotes or a byte-order mark."""
    first = spark.read.text(path).limit(1).collect()
    return [c.strip().strip('"').lstrip("\ufeff") for c in first[0][0].split(sep)] if first else []


BAD_ROW = "_bad_row"


def read_customers_csv(spark: SparkSession, path: str, sep: str | None = ";", schema: T.StructType | None = None,
                       detect: bool = True, keep_bad_rows: bool = False) -> DataFrame:
    """Read the customer CSV.  With ``detect`` and a header that does not split on ``sep``,
    the delimiter is detected.  ``schema=None`` infers types (one extra pass).

    A schema is matched to the header by name, whatever the file's order;
    columns the schema does not know are read as text.  Rows that do not fit
    (too few or many fields, unreadable numbers) are dropped, or kept with
    their raw text in ``_bad_row`` to be counted (:func:`bad_rows`)."""
    if sep is None or (detect and _splits_to_one(spark, path, sep)):
        sep = detect_delimiter(spark, path)
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    known = {f.name: f for f in schema.fields}
    names = header_names(spark, path, sep)
    fields = [known.get(n, T.StructField(n, T.StringType())) for n in names]
    rows = (reader.option("enforceSchema", False).option("columnNameOfCorruptRecord", BAD_ROW)
            .schema(T.StructType([*fields, T.StructField(BAD_ROW, T.StringType())])).csv(path))
    if keep_bad_rows:
        return rows
    wanted = [f.name for f in schema.fields if f.name in names] + [n for n in names if n not in known]
    return rows.where(F.col(BAD_ROW).isNull()).select(*[F.col(f"`{n}`") for n in wanted])


def bad_rows(spark: SparkSession, path: str, sep: str | None = ";", schema: T.StructType = CUSTOMER_SCHEMA) -> DataFrame:
    """One row: how many lines of the file do not fit the schema."""
    rows = freeze(read_customers_csv(spark, path, sep, schema, keep_bad_rows=True))  # parsed whole, not only the raw text
    return rows.agg(F.count_if(F.col(BAD_ROW).isNotNull()).alias("bad_rows"))


def _splits_to_one(spark: SparkSession, path: str, sep: str) -> bool:
    first = spark.read.text(path).limit(1).collect()
    return bool(first) and sep not in first[0][0]
