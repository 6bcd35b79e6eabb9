"""File sources: staging Parquet (S2) and partitioned Parquet paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, NumericType, StringType, StructField, StructType

from salesflow.schema import SALES_PARTITION_COLUMNS, raw_sales_schema, sales_file_schema


def exact_cast(df: DataFrame, field: StructField) -> Column:
    """The column cast to the field's type; a value that the type can't hold fails the job, whatever the
    session's ANSI mode (a plain cast wraps integers or gives NULL with ANSI off)."""
    have, value = df.schema[field.name].dataType, F.col(field.name)
    if have == field.dataType:
        return value.alias(field.name)
    made = value.try_cast(field.dataType)
    lost = value.isNotNull() & made.isNull()
    if isinstance(have, NumericType) and isinstance(field.dataType, NumericType):
        lost = lost | (made.cast(have) != value)
    told = F.concat(F.lit(f"{field.name} does not fit {field.dataType.simpleString()}: "), value.cast("string"))
    return F.when(lost, F.raise_error(told).cast(field.dataType)).otherwise(made).alias(field.name)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns by name, cast to the declared types without losing a value."""
    return df.select(*[exact_cast(df, f) for f in schema.fields])


def write_staging_file(df: DataFrame, path: str, id_type: str = "int") -> str:
    """Write raw sales rows as an unpartitioned Parquet dataset with the declared types
    (so a table declaring ``id`` INT can read it back). Each task writes its own file; there
    is no coalesce to one file, which would funnel all rows through one task."""
    conform(df, raw_sales_schema(id_type)).write.mode("overwrite").parquet(path)
    return path


PARTITION_PATTERN = "category=*/year=*/month=*/"


def read_partitioned(
    spark: SparkSession,
    root: str,
    id_type: str = "int",
    integer_dates: bool = True,
    pattern: str | None = None,
) -> DataFrame:
    """Read ``root/category=*/year=*/month=*/`` with declared file and partition types.

    ``category`` is STRING whatever its values look like ('007' stays '007'). With
    ``integer_dates`` year and month are INT, so '01' reads as 1; otherwise they are STRING
    and keep their padding.

    Spark's partition discovery lists the root, each level that has many folders as a
    parallel job. With ``pattern`` (``PARTITION_PATTERN``) the wildcard is expanded on the
    driver instead, one folder level after another, and folders that do not match are left
    out; a pattern without any match raises PATH_NOT_FOUND."""
    date_type = IntegerType() if integer_dates else StringType()
    kinds = {"category": StringType(), "year": date_type, "month": date_type}
    parts = [StructField(c, kinds[c], True) for c in SALES_PARTITION_COLUMNS]
    schema = StructType(sales_file_schema(id_type).fields + parts)
    base = root.rstrip("/")
    return spark.read.option("basePath", base).schema(schema).parquet(f"{base}/{pattern}" if pattern else base)
