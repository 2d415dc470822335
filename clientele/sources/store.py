"""Stored tables of one run: a snapshot of the sources, and levels that several branches read."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.timefns import as_of_literal, minus_days
from clientele.operators.losses import Losses
from clientele.session import checkpoint_dir
from clientele.sources.tables import TABLE_COLUMNS


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that ``path`` lies in, and the path in its terms."""
    sc = spark.sparkContext
    found = sc._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(sc._jsc.hadoopConfiguration()), found


class Store:
    """A folder of its own in shared storage, with one Parquet table a name.

    ``keep`` computes a DataFrame once; whoever reads what it returns reads
    stored rows, so branches of a plan agree, a lost executor recomputes
    nothing upstream, and Catalyst knows the table's real size.  The folder lies
    in the cluster's checkpoint folder unless ``base`` names another.  As a
    context manager a store is removed at the end: nothing read from it can be
    evaluated afterwards.
    """

    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark = spark
        self.folder = f"{(base or checkpoint_dir(spark)).rstrip('/')}/run-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        files, path = file_system(self.spark, self.folder)
        files.delete(path, True)

    def __enter__(self) -> Store:
        return self

    def __exit__(self, *_) -> None:
        self.remove()


def snapshot(
    tables: dict[str, DataFrame],
    store: Store,
    as_of,
    email_days: int = 90,
    losses: Losses | None = None,
    conditions: dict[str, dict[str, Column]] | None = None,
) -> dict[str, DataFrame]:
    """The four source tables, each read exactly once and stored: what every branch of the run then reads.

    A source that changes while a run goes on - a live database, a folder being
    rewritten - would otherwise give each branch rows of another moment.  Only
    what a run can use is kept: the canonical columns, verified items, orders
    with a customer, storefront orders of the e-mail window.  These filters and
    projections reach the source; rows are written where they are read, without
    a shuffle, so a hot order or customer costs nothing extra.

    With ``losses`` the ``conditions`` of each source are counted as it is read.
    Rows must then be read to be counted: the filter of a counted source no
    longer reaches it.
    """
    since = minus_days(as_of_literal(as_of), email_days)
    wanted = {
        "orders": F.col("customer_id").isNotNull(),
        "items": F.col("finance_verified_at").isNotNull(),
        "customers": F.col("id_customer").isNotNull(),
        "storefront_orders": F.col("fk_customer").isNotNull() & (F.col("created_at") >= since),
    }
    kept = {}
    for name, condition in wanted.items():
        rows = tables[name].select(*TABLE_COLUMNS[name])
        if losses is not None and (counted := (conditions or {}).get(name)):
            rows = losses.watch(rows, **counted)
        kept[name] = store.keep(rows.where(condition), name)
    return kept
