"""K5/K6: named datasets and parameterised SQL over them.

The reference registers a file under a name and runs SQL with positional
``?`` parameters against it. Here a name is a temporary view over a Parquet
(or JSON / CSV) path and the SQL runs through Catalyst with bound parameters;
queries are reads, results stay DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_dataset(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                     **options) -> DataFrame:
    """K5: make ``path`` usable as ``name`` in SQL; registering again
    replaces the earlier binding."""
    df = spark.read.format(fmt).options(**options).load(path)
    df.createOrReplaceTempView(name)
    return df


def execute_query(spark: SparkSession, sql: str, params: tuple | list = (),
                  fetch: str | None = None, dataset: str | None = None) -> DataFrame:
    """K6: run ``sql`` with positional ``?`` parameters.

    ``fetch='one'`` -> at most the first row, ``'all'`` or ``None`` -> all
    rows. ``dataset`` names a dataset that must be registered (an unknown
    name is an error). ``sql`` runs as a subquery, so anything but a query is a
    syntax error and nothing is changed."""
    if dataset is not None and not spark.catalog.tableExists(dataset):
        raise ValueError(f"no dataset is registered as {dataset!r}")
    read = f"SELECT * FROM (\n{sql}\n)"
    df = spark.sql(read, args=list(params)) if params else spark.sql(read)
    if fetch == "one":
        return df.limit(1)
    if fetch not in (None, "all"):
        raise ValueError(f"unknown fetch mode {fetch!r}")
    return df
