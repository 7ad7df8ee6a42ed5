"""Sources and sinks and the literal dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a named parquet table (S1).  Column pruning and filters that a
    caller applies later are pushed into this scan by Catalyst."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Make a query result addressable by name (S3).

    Without ``path`` the result is a temp view (a named logical plan, no
    data copy).  With ``path`` it is written as parquet (overwrite, which
    replaces drop-and-rebuild) and read back, cutting the lineage; use that
    when the result is reused by several later jobs.
    """
    if path is not None:
        df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def append_rows(df: DataFrame, rows: Iterable[Sequence]) -> DataFrame:
    """Union literal rows onto a table, matched by column name."""
    extra = rows_table(df.sparkSession, rows, df.schema)
    return df.unionByName(extra)


def _sql_literal(v, dtype: T.DataType) -> str:
    t = dtype.simpleString()
    if v is None:
        return f"CAST(NULL AS {t})"
    if isinstance(dtype, T.StringType):
        text = str(v).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"
    if isinstance(dtype, T.BooleanType):
        return "TRUE" if v else "FALSE"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return f"CAST({int(v)} AS {t})"
    if isinstance(dtype, T.DateType):
        return f"DATE '{v}'"
    if isinstance(dtype, T.TimestampNTZType):
        return f"TIMESTAMP_NTZ '{v}'"
    return f"CAST('{v}' AS {t})"


def rows_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A new table from literal rows with a declared schema.

    Built as an inline ``VALUES`` table, which Spark plans as a
    LocalRelation with exact size statistics (so joins against it can be
    broadcast under a size check); a DataFrame made from a Python list would
    instead be an RDD scan of unknown size.
    """
    rows = [tuple(r) for r in rows]
    if not rows:
        return spark.createDataFrame([], schema)
    fields = schema.fields
    body = ", ".join(
        "(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(r, fields)) + ")"
        for r in rows)
    cols = ", ".join(f"c{i}" for i in range(len(fields)))
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({cols})")
    return df.select(*[df[f"c{i}"].cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


# --------------------------------------------------------------------------
# literal dimensions
# --------------------------------------------------------------------------

PLANS_SCHEMA = T.StructType([
    T.StructField("plan_id", T.IntegerType(), False),
    T.StructField("plan_name", T.StringType(), False),
    T.StructField("price", T.DecimalType(12, 2), True),
])

PIZZA_NAMES_SCHEMA = T.StructType([
    T.StructField("pizza_id", T.IntegerType(), False),
    T.StructField("pizza_name", T.StringType(), False),
])

PIZZA_RECIPES_SCHEMA = T.StructType([
    T.StructField("pizza_id", T.IntegerType(), False),
    T.StructField("toppings", T.StringType(), False),
])

# The subscription plans (id, name, monthly or yearly price).
PLAN_ROWS = [
    (0, "trial", "0.00"),
    (1, "basic monthly", "9.90"),
    (2, "pro monthly", "19.90"),
    (3, "pro annual", "199.00"),
    (4, "churn", None),
]

# The delivery menu and its recipes (comma lists of topping ids).
PIZZA_NAME_ROWS = [
    (1, "Meatlovers"),
    (2, "Vegetarian"),
]
PIZZA_RECIPE_ROWS = [
    (1, "1, 2, 3, 4, 5, 6, 8, 10"),
    (2, "4, 6, 7, 9, 11, 12"),
]


def plans(spark: SparkSession) -> DataFrame:
    return rows_table(spark, PLAN_ROWS, PLANS_SCHEMA)


def pizza_names(spark: SparkSession) -> DataFrame:
    return rows_table(spark, PIZZA_NAME_ROWS, PIZZA_NAMES_SCHEMA)


def pizza_recipes(spark: SparkSession) -> DataFrame:
    return rows_table(spark, PIZZA_RECIPE_ROWS, PIZZA_RECIPES_SCHEMA)
