"""Table sources and sinks (parquet / CSV / JSON)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table ``{sf_dir}/{name}.parquet``; projecting early lets the
    scan read only the needed columns (filters still reach the scan)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Header CSV; an explicit schema avoids a full inference pass, empty -> NULL."""
    r = spark.read.option("header", True).option("nullValue", "")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Overwrite sink. Never point ``path`` at an input of the same plan."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def read_json_document(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Multi-line JSON state document (one object per file)."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)
