"""Catalog helpers (S8): tables of a stored database, their columns and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


def file_system(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path of any path that Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def list_tables(spark: SparkSession, root: str) -> list[str]:
    """Stored tables under a database folder (one Parquet folder each)."""
    fs, p = file_system(spark, root)
    found = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p)]
    return sorted(n for n, folder in found if folder and not n.startswith(("_", ".")))


def table_columns(df: DataFrame) -> list[str]:
    return list(df.columns)


def table_keys(table: str) -> list[str]:
    """Primary key columns of a stored table (not enforced; see I12)."""
    return list(schemas.PRIMARY_KEYS[table])


def base_properties() -> dict:
    """Base tables fed by a raw batch, their keys, columns and the lower-cased columns."""
    return {"tables": list(schemas.BASE_TABLE_KEYS), "pkeys": dict(schemas.BASE_TABLE_KEYS),
            "tablevars": {k: list(v) for k, v in schemas.BASE_TABLE_COLUMNS.items()},
            "lowercase_vars": list(schemas.LOWERCASE_COLUMNS)}


def register_views(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Every stored table as a temp view, for ad-hoc ``spark.sql``."""
    names = list_tables(spark, root)
    for n in names:
        spark.read.parquet(f"{root}/{n}").createOrReplaceTempView(prefix + n)
    return names
