"""S6 reuse: monthly partial aggregates, merged for any choice of months.

A dashboard asks the same questions of ever other month sets. Instead of
reading lines again, or keeping one result for each set, the store holds for
each month what its answers are made of:

``lines``      sums per day and place
``orders``     one row per transaction and place: its first line's number and value
``customers``  the month's distinct customers
``places``     the number of each place (store, city, province) that any line had

All but the places are partitioned by year and month. Lines and orders hold a
place's number, and identifiers are held as bytes (a pseudonym's 40 hex digits
are 20), so that a line's share of what is shuffled and stored stays small. Sums add up over months; the first line
of a transaction is the least of its months' first lines; distinct orders of
several months are counted over the transactions, which a month has fewer of
than lines. A month that is ingested again, or late, replaces its own
partitions and no others.

Rows are kept apart by ``counted`` (the dashboard's filter: quantity known and
not negative), so that a question is answered for all lines or for those only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from kassa.functions.clean import month_start, safe_ratio
from kassa.functions.privacy import packed
from kassa.operators.common import zsum
from kassa.operators.joins import sized_broadcast
from kassa.operators.kpi import highlight_row
from kassa.operators.rank import global_order
from kassa.operators.stores import CITY_KEYS, STORE_KEYS, city_labels, rank_performance, rank_profitability, store_labels
from kassa.session import new_path, shuffles_dropped

PLACE = ["store_id", "store_name", "city", "province"]
Month = tuple[int, int]  # year, month
ROWS_A_FILE = 2_000_000
DAYS_A_MONTH, LINES_A_CELL = 31, 4  # a day and place with fewer lines is not worth a map-side sum


def chosen(months: Iterable[Month] | None) -> Column:
    """Partition filter of the chosen (year, month) pairs."""
    if months is None:
        return F.lit(True)
    out = F.lit(False)
    for y, m in months:
        out = out | ((F.col("year") == y) & (F.col("month") == m))
    return out


class MonthlyPartials:
    """The store at ``path`` (shared storage; a table of its own in the shared folder if none is given)."""

    TABLES = ("lines", "orders", "customers")

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, "partials")

    # ------------------------------------------------------------ ingestion
    def refresh(self, curated: DataFrame, months: Iterable[Month] | None = None) -> None:
        """Reckon the given months (all that ``curated`` has, by default) anew and replace them.

        ``curated`` is filtered by year and month, which prunes the partitions
        of a curated table; other months of the store are not touched.
        """
        months = None if months is None else list(months)
        lines = curated.where(chosen(months)).withColumn("counted", F.coalesce(F.col("quantity_item") >= 0, F.lit(False)))
        month = ["year", "month"]
        self._add_places(lines)
        lines = self._joined(lines, self._places(), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE])
        most = lines.groupBy(*month).count().agg(F.max("count")).first()[0] or 0
        for name, df in self._tables(lines, most, self._places().count()).items():
            self._write(df, name)
        if months is not None:
            here = {tuple(r) for r in lines.select(*month).distinct().collect()}  # of the months asked for
            self._drop(set(months) - here)

    def _write(self, df: DataFrame, name: str) -> None:
        with shuffles_dropped(self.spark):
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("year", "month").parquet(f"{self.path}/{name}"))

    @staticmethod
    def _tables(lines: DataFrame, most: int, places: int) -> dict[str, DataFrame]:
        """The tables of ``lines`` with their places, of which the largest month has ``most``.

        Rows that grouping makes few are combined map-side and shuffled again
        by month. Orders, and sums of so many places that each line has nearly
        a row of its own, are dealt once, by month and key, and lie so in files.
        """
        month = ["year", "month"]

        def dealt(df: DataFrame, *key: str) -> DataFrame:
            return df.withColumn("part", F.pmod(F.xxhash64(*key), F.lit(most // ROWS_A_FILE + 1))).repartition(*month, "part")

        def sums(df: DataFrame, *part: str) -> DataFrame:
            return df.groupBy(*month, *part, "date_transaction", "counted", "place").agg(
                F.sum("transaction_value").alias("value"), F.sum("quantity_item").alias("units"), F.sum("line_discount").alias("discount"))

        by_order = lines.select(*month, packed("transaction_id").alias("transaction"), "counted", "place", "_seq", "transaction_value")
        by_place = lines.select(*month, "date_transaction", "counted", "place", "transaction_value", "quantity_item", "line_discount")
        few = places * DAYS_A_MONTH * LINES_A_CELL <= most
        return {
            "lines": sums(by_place).hint("rebalance", *month) if few else sums(dealt(by_place, "date_transaction", "place"), "part").drop("part"),
            "orders": dealt(by_order, "transaction").groupBy(*month, "part", "transaction", "counted", "place").agg(
                F.min("_seq").alias("first"), F.min_by("transaction_value", "_seq").alias("value")).drop("part"),
            "customers": lines.select(*month, "counted", packed("contact_id").alias("customer")).distinct().hint("rebalance", *month),
        }

    def _places(self) -> DataFrame:
        """``place`` and the columns of each place, named ``_``."""
        schema = "place long, " + ", ".join(f"_{c} string" for c in PLACE)
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/places")
        except AnalysisException:  # nothing ingested yet
            return self.spark.createDataFrame([], schema)

    def _add_places(self, lines: DataFrame) -> None:
        """Places not seen before get the next numbers; numbers once given stay."""
        known = self._places()
        new = lines.select(*[F.col(c).alias(f"_{c}") for c in PLACE]).distinct()
        new = new.alias("n").join(known.alias("k"), [F.col(f"n._{c}").eqNullSafe(F.col(f"k._{c}")) for c in PLACE], "left_anti")
        last = known.agg(F.coalesce(F.max("place"), F.lit(0)).alias("n")).first()[0]
        numbered = global_order(new, [F.col(f"_{c}").asc_nulls_first() for c in PLACE], rank_col="place")
        with shuffles_dropped(self.spark):
            numbered.withColumn("place", F.col("place") + F.lit(last)).select("place", *[f"_{c}" for c in PLACE]).write.mode("append").parquet(f"{self.path}/places")

    @staticmethod
    def _joined(df: DataFrame, places: DataFrame, same: list[Column]) -> DataFrame:
        """Places are as many as stores and their names: broadcast under the checked bound."""
        return df.join(sized_broadcast(places), same)

    def _drop(self, months: set[Month]) -> None:
        """A refreshed month without lines leaves no rows behind."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for y, m in months:
            for name in self.TABLES:
                folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/year={y}/month={m}")
                folder.getFileSystem(conf).delete(folder, True)

    def _table(self, name: str, months: Iterable[Month] | None, counted: bool) -> DataFrame:
        df = self.spark.read.parquet(f"{self.path}/{name}").where(chosen(months))
        return df.where("counted") if counted else df

    def _placed(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns of its place."""
        named = self._places().select(F.col("place").alias("_place"), *[F.col(f"_{c}").alias(c) for c in PLACE])
        return self._joined(df, named, [F.col("place") == F.col("_place")]).drop("_place", "place")

    # ------------------------------------------------------------ answers
    def _first_lines(self, months, counted: bool) -> DataFrame:
        """One row per transaction: its first line's month and value."""
        orders = self._table("orders", months, counted).withColumn("m", F.make_date("year", "month", F.lit(1)))
        return orders.groupBy("transaction").agg(F.min_by("value", "first").alias("value"), F.min_by("m", "first").alias("month"))

    def highlights(self, months: Iterable[Month] | None = None, counted: bool = True) -> DataFrame:
        """G1."""
        by_place = self._table("lines", months, counted).groupBy("place").agg(F.sum("value").alias("value"), F.sum("units").alias("units"))
        cities = self._placed(by_place).groupBy("city").agg(zsum("value").alias("rev"), zsum("units").alias("units"))
        best = F.when(F.col("city").isNotNull(), F.struct(-F.col("rev"), "city"))
        sums = cities.agg(zsum("units").alias("total_units"), zsum(F.when(F.lower("city") == "online", F.col("rev"))).alias("_online"), F.min(best).alias("_top"))
        orders = self._first_lines(months, counted).agg(zsum("value").alias("total_revenue"), F.count(F.lit(1)).cast("long").alias("total_orders"))
        return highlight_row(orders.crossJoin(F.broadcast(sums)))  # one row each

    def monthly_kpi_summary(self, months: Iterable[Month] | None = None, counted: bool = False) -> DataFrame:
        """Months do not share rows, so each partition answers for itself."""
        month = F.make_date("year", "month", F.lit(1)).alias("month")
        sums = self._table("lines", months, counted).groupBy(month).agg(zsum("value").alias("revenue"), zsum("units").alias("units"))
        orders = (self._table("orders", months, counted).select(month, "transaction").distinct()
                      .groupBy("month").agg(F.count("transaction").cast("long").alias("orders")))
        customers = (self._table("customers", months, counted).select(month, "customer").distinct()
                         .groupBy("month").agg(F.count("customer").cast("long").alias("unique_customers")))
        out = sums.join(orders, "month", "left").join(customers, "month", "left")  # one row a month
        return out.withColumn("avg_order_value", safe_ratio("revenue", "orders"))

    def monthly_sales_series(self, months: Iterable[Month] | None = None, counted: bool = True) -> DataFrame:
        """G3."""
        orders = self._first_lines(months, counted).groupBy("month").agg(zsum("value").alias("revenue"), F.count(F.lit(1)).cast("long").alias("orders"))
        units = (self._table("lines", months, counted).groupBy(month_start("date_transaction").alias("month"))
                     .agg(zsum("units").alias("units")))
        return orders.join(units, "month", "left").select("month", "revenue", "orders", F.coalesce("units", F.lit(0.0)).alias("units"))

    def daily_units(self, months: Iterable[Month] | None = None, counted: bool = True) -> DataFrame:
        """G4."""
        return self._table("lines", months, counted).groupBy("date_transaction").agg(zsum("units").alias("units"))

    def store_profitability(self, months: Iterable[Month] | None = None, counted: bool = False) -> DataFrame:
        """G14."""
        g = self._placed(self._table("lines", months, counted)).groupBy("store_name", "city").agg(
            zsum("value").alias("revenue"), zsum("units").alias("units"), zsum("discount").alias("discount"))
        return rank_profitability(g)

    def _performance(self, labels, keys: list[str], months, counted: bool) -> DataFrame:
        sums = labels(self._placed(self._table("lines", months, counted))).groupBy(*keys).agg(zsum("value").alias("gmv"), zsum("units").alias("units"))
        # places with the same labels are numbered as one, so that orders meet by numbers
        every = labels(self._places().select(F.col("place").alias("_place"), *[F.col(f"_{c}").alias(c) for c in PLACE]))
        alike = every.groupBy(*keys).agg(F.min("_place").alias("group"))
        member = every.alias("a").join(alike.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]).select("_place", "group")
        orders = self._joined(self._table("orders", months, counted), member, [F.col("place") == F.col("_place")])
        met = orders.select("group", "transaction").distinct().groupBy("group").agg(F.count("transaction").cast("long").alias("orders"))
        orders = alike.join(met, "group").select(*[F.col(k).alias(f"_{k}") for k in keys], "orders")
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        met = sums.join(orders, same, "left").drop(*[f"_{k}" for k in keys])  # one row a place
        return rank_performance(met.withColumn("orders", F.coalesce("orders", F.lit(0).cast("long"))), keys)

    def store_deep_dive(self, months: Iterable[Month] | None = None, counted: bool = False) -> DataFrame:
        """G15."""
        return self._performance(store_labels, STORE_KEYS, months, counted)

    def city_performance(self, months: Iterable[Month] | None = None, counted: bool = False) -> DataFrame:
        """G16."""
        return self._performance(city_labels, CITY_KEYS, months, counted)
