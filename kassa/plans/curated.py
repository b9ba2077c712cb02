"""The curated sales table.

raw sales + dims -> normalise keys, 4 left joins (J1-J4) -> store lookup (A3,
A4) -> store masking (A5) -> identifier hashing (A1) -> typing and derived
columns (P1-P8) -> snake_case schema. One lazy plan; dims are broadcast under a
checked row bound, and the fact is never collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kassa.constants import ALBERTA_CITIES, DEFAULT_COUNTRY, DEFAULT_PROVINCE
from kassa.functions.clean import (coerce_numeric, normalise_identifier, parse_yyyymmdd,
                                   strip, to_number, truthy)
from kassa.operators.common import stored
from kassa.operators.joins import hot_keys, left_join_one_row, left_join_skew_safe, size_bound_ok
from kassa.operators.enrich import COPY, FACT_KEYS, merge_sales_with_references, needed_rows, numbered_copies, prepared_dimension, strip_headers
from kassa.operators.privacy import (apply_identifier_hashing, apply_store_masking, build_store_lookup, masked_contacts, masked_store_columns,
                                     masked_stores)
from kassa.session import compiled_methods, new_path, shuffles_dropped

# raw (reference) name -> curated name
CURATED_COLUMNS = (
    ("Transaction_ID", "transaction_id"),
    ("Contact_ID", "contact_id"),
    ("Item_ID", "item_id"),
    ("Promotion_ID", "promotion_id"),
    ("STORE_ID", "store_id"),
    ("PROMO_ID", "promo_id"),
    ("SKU", "sku"),
    ("EAN", "ean"),
    ("LIBELLE_x", "promo_label"),
    ("LIBELLE_y", "store_name"),
    ("CITY", "city"),
    ("PROVINCE", "province"),
    ("COUNTRY", "country"),
    ("Latitude", "latitude"),
    ("Longitude", "longitude"),
    ("PostalCode", "postal_code"),
    ("Store_Of_Creation", "store_of_creation"),
    ("Catégorie", "category"),
    ("Style - Description FR", "sku_description"),
    ("Date_transaction", "date_transaction"),
    ("Unit_original_price", "unit_original_price"),
    ("Unit_sale_price", "unit_sale_price"),
    ("Transaction_value", "transaction_value"),
    ("Quantity_item", "quantity_item"),
    ("Line_Sales_Value", "line_sales_value"),
    ("Line_Original_Value", "line_original_value"),
    ("Line_Discount", "line_discount"),
    ("Promo_Flag", "promo_flag"),
    ("Has_Web_Account", "has_web_account"),
    ("Year", "year"),
    ("Quarter", "quarter"),
    ("Month", "month"),
    ("days_since_epoch", "days_since_epoch"),
    ("YearOfBirth", "year_of_birth"),
    ("Customer_Age", "customer_age"),
    ("_seq", "_seq"),
)
CURATED_TYPES = {
    "latitude": "double", "longitude": "double", "date_transaction": "date",
    "unit_original_price": "double", "unit_sale_price": "double", "transaction_value": "double",
    "quantity_item": "double", "line_sales_value": "double", "line_original_value": "double",
    "line_discount": "double", "promo_flag": "boolean", "has_web_account": "boolean",
    "year": "int", "quarter": "int", "month": "int", "days_since_epoch": "int",
    "year_of_birth": "double", "customer_age": "double",
}


def parse_numeric_and_date_fields(df: DataFrame) -> DataFrame:
    """Parse date (drop bad rows) and numbers."""
    types = {f.name: f.dataType for f in df.schema.fields}
    df = df.withColumn("Date_transaction", parse_yyyymmdd("Date_transaction", types.get("Date_transaction"))) \
           .where(F.col("Date_transaction").isNotNull())
    qty_t = types.get("Quantity_item")
    qty = F.col("Quantity_item").cast("double") if isinstance(qty_t, T.NumericType) else to_number(F.col("Quantity_item"))
    return df.withColumns({
        "Unit_original_price": coerce_numeric("Unit_original_price", types.get("Unit_original_price")),
        "Unit_sale_price": coerce_numeric("Unit_sale_price", types.get("Unit_sale_price")),
        "Transaction_value": coerce_numeric("Transaction_value", types.get("Transaction_value")),
        "Quantity_item": qty,
    })


def derive_fields(df: DataFrame, clean_keys: bool = False) -> DataFrame:
    """Line measures, flags and calendar of parsed fields (``clean_keys``: the keys are normalised)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    q0 = F.coalesce(F.col("Quantity_item"), F.lit(0.0))
    d = F.col("Date_transaction")
    yob_t = types.get("YearOfBirth")
    yob = (F.col("YearOfBirth").cast("double") if isinstance(yob_t, T.NumericType)
           else to_number(F.col("YearOfBirth")) if "YearOfBirth" in types else F.lit(None).cast("double"))
    df = df.withColumns({
        "Line_Sales_Value": F.col("Unit_sale_price") * q0,
        "Line_Original_Value": F.col("Unit_original_price") * q0,
    }).withColumns({
        "Line_Discount": F.col("Line_Original_Value") - F.col("Line_Sales_Value"),
        "Promo_Flag": (F.col("Promotion_ID") if clean_keys else normalise_identifier("Promotion_ID")) != "",
        "Year": F.year(d),
        "Quarter": F.quarter(d),
        "Month": F.month(d),
        "days_since_epoch": F.unix_date(d),
        "YearOfBirth": yob,
    })
    age = F.year(d).cast("double") - F.col("YearOfBirth")
    web_t = types.get("Has_Web_Account")
    has_web = (F.coalesce("Has_Web_Account", F.lit(False)) if isinstance(web_t, T.BooleanType)
               else truthy("Has_Web_Account") if web_t else F.lit(False))
    return df.withColumns({
        "Customer_Age": F.when(age < 0, F.lit(None).cast("double")).otherwise(age),
        "Has_Web_Account": has_web,
    })


def prepare_numeric_and_date_fields(df: DataFrame) -> DataFrame:
    """Parse date (drop bad rows), numbers, line measures, flags, calendar."""
    return derive_fields(parse_numeric_and_date_fields(df))


def to_curated_schema(df: DataFrame) -> DataFrame:
    cols = []
    for raw, name in CURATED_COLUMNS:
        typ = CURATED_TYPES.get(name, "string")
        if raw in df.columns:
            c = F.col(f"`{raw}`")
            cols.append((c if raw == "_seq" else c.cast(typ)).alias(name))
        elif raw != "_seq":
            cols.append(F.lit(None).cast(typ).alias(name))
    return df.select(*cols)


def curate(sales: DataFrame, dims: dict[str, DataFrame], cities: Sequence[tuple] = ALBERTA_CITIES,
           province: str = DEFAULT_PROVINCE, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """Whole curation job; returns the curated (snake_case) frame, lazily.

    Identifiers are whole digests; ``display_ids`` gives their short forms.
    """
    compiled_methods(sales.sparkSession)
    sales = strip_headers(sales)
    if "Source_File" in sales.columns:
        sales = sales.drop("Source_File")
    stores = strip_headers(dims["store"]).withColumnRenamed("LIBELLE", "LIBELLE_y")
    if "_seq" not in stores.columns:
        stores = stores.withColumn("_seq", F.monotonically_increasing_id())
    stores_small = size_bound_ok(stores)  # checked once: store join and both lookup joins
    # numbers are shorter than their texts, and lines without a date need no joins
    lookup = stored(build_store_lookup(stores, cities), "stores")  # at most one (narrower) row per store
    merged = merge_sales_with_references(parse_numeric_and_date_fields(sales), dims, known_small={"store": stores_small},
                                         prepare=lambda name, dim: joined_columns(name, dim, lookup))
    masked = apply_store_masking(merged, lookup, province, country, lookup_is_small=stores_small)
    return to_curated_schema(derive_fields(hashed_lines(masked), clean_keys=True))


def materialise(df: DataFrame, name: str = "curated", partition_by: Sequence[str] = ("year", "month"),
                bucket_by: str | None = None, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    ``bucket_by`` instead saves an external catalog table bucketed and sorted
    on that key (shuffle-free transaction-grain operators). Measured at
    sf0.1 it is ~3x slower overall (16 buckets x 80 months = 1,280 tiny
    files), so the default is the rebalanced layout; at 100 TB the bucket
    files are GB-sized and the saved shuffles dominate.

    Partitioned by year/month (partition pruning for month selections, S5)
    and a lineage cut, so executor loss never recomputes the curation.
    The REBALANCE hint clusters rows by the partition columns (few files per
    month folder) while AQE splits a hot month into several
    advisory-sized tasks and merges small ones — no sampling pass, no
    single-task month.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if bucket_by:
        # external table in the shared folder, bucketed + sorted on the key
        table = "kassa_" + path.rpartition("/kassa-")[2].replace("-", "_")
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        (df.write.mode("overwrite").option("path", path).partitionBy(*partition_by)
           .bucketBy(n, bucket_by).sortBy(bucket_by).saveAsTable(table))
        back = spark.table(table)
    else:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        back = spark.read.parquet(path)
    return back.select(*[F.col(f"`{c}`").cast(df.schema[c].dataType).alias(c) for c in df.columns])


#: a dimension's name, the fact's key and its own, and what the curated table takes from it
DIMENSIONS = (
    ("contact", "Contact_ID", "Contact_ID", ("YearOfBirth", "Has_Web_Account", "Store_Of_Creation", "PostalCode")),
    ("item", "Item_ID", "SKU", ("EAN", "Catégorie", "Style - Description FR")),
    ("promotion", "Promotion_ID", "PROMO_ID", ("LIBELLE_x",)),
    ("store", "Store_transaction_ID", "STORE_ID", ()),
)
#: identifiers that the curated table takes from dimensions beside their keys
DIMENSION_IDS = ("EAN", "LIBELLE_x")


def joined_columns(name: str, dim: DataFrame, lookup: DataFrame) -> DataFrame:
    """What the curated table takes from a dimension: parsed and masked once a row of it and not once a line."""
    _, _, dkey, columns = next(d for d in DIMENSIONS if d[0] == name)
    own = [c for c in (dkey, *columns, COPY.format(name)) if c in dim.columns]
    types = {f.name: f.dataType for f in dim.schema.fields}
    dim = dim.select(*[F.col(f"`{c}`") for c in own])
    if name == "contact":
        parsed = {"YearOfBirth": F.col("YearOfBirth").cast("double") if isinstance(types.get("YearOfBirth"), T.NumericType) else to_number(F.col("YearOfBirth")),
                  "Has_Web_Account": truthy("Has_Web_Account")}
        return masked_contacts(dim.withColumns({c: x for c, x in parsed.items() if c in own}), lookup)
    if name == "store":
        return masked_stores(dim, lookup)
    return dim.withColumns({c: strip(F.coalesce(F.col(c).cast("string"), F.lit("nan"))) for c in DIMENSION_IDS if c in own})


def hashed_lines(df: DataFrame) -> DataFrame:
    """A1 of lines with normalised keys and what :func:`joined_columns` gave them."""
    return apply_identifier_hashing(df, stripped=DIMENSION_IDS, clean=FACT_KEYS, joined={"SKU": "Item_ID", "PROMO_ID": "Promotion_ID"})


#: what a fact row is stored with: its keys and numbers, and the place found by its store
FACT_COLUMNS = ("Transaction_ID", "Contact_ID", "Item_ID", "Promotion_ID", "Store_transaction_ID", "Date_transaction",
                "Unit_original_price", "Unit_sale_price", "Transaction_value", "Quantity_item", "_seq")
PLACE_COLUMNS = ("city", "latitude", "longitude")
#: numbers and dates that are stored as the curated table has them
FINAL = {raw: name for raw, name in CURATED_COLUMNS if raw in FACT_COLUMNS and name in CURATED_TYPES}


def _dimension_tables(dims: dict[str, DataFrame], facts: DataFrame) -> tuple[dict[str, DataFrame], dict[str, int], DataFrame]:
    """The dimensions with numbered copies of a repeated key, the most copies of each, and the fact with a row for each copy.

    The fact's ``_seq`` numbers its copies as :func:`merge_sales_with_references` does.
    """
    tables, copies = {}, {}
    for name, fkey, dkey, columns in DIMENSIONS:
        dim = prepared_dimension(dims[name], dkey, {"LIBELLE": "LIBELLE_x" if name == "promotion" else "LIBELLE_y"})
        dim, copies[name] = numbered_copies(dim, dkey, COPY.format(name))
        number = COPY.format(name)
        if copies[name] > 1:
            many = dim.groupBy(F.col(dkey).alias("__many")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
            facts = left_join_skew_safe(facts, many, fkey, "__many", salt_source=["_seq"]).drop("__many")
            facts = facts.withColumn(number, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__n"), F.lit(1)).cast("int") - 1))).drop("__n")
            facts = facts.withColumn("_seq", F.col("_seq") * copies[name] + F.col(number))
        keep = [c for c in columns if c in dim.columns] + ([number] if copies[name] > 1 else [])
        tables[name] = dim.select(dkey, *[F.col(f"`{c}`") for c in keep])
    return tables, copies, facts


@dataclass
class Star:
    """A stored narrow fact and the stored dimensions it is joined with: which are small, the fact's hot keys, the most copies of a key."""

    facts: DataFrame
    tables: dict[str, DataFrame]
    small: dict[str, bool]
    hot: dict[str, list]
    copies: dict[str, int]


def curated_star(sales: DataFrame, dims: dict[str, DataFrame], cities: Sequence[tuple] = ALBERTA_CITIES,
                 province: str = DEFAULT_PROVINCE, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """What :func:`curate` gives, over a stored narrow fact and stored dimensions (``_seq`` is a long)."""
    return star_frame(stored_star(sales, dims, cities), province, country)


def stored_star(sales: DataFrame, dims: dict[str, DataFrame], cities: Sequence[tuple] = ALBERTA_CITIES) -> Star:
    """The fact and the dimensions of :func:`curated_star`.

    A line is shuffled once, by its year and month, and stored with its keys and
    numbers and its place; pseudonyms, labels and measures are made when they
    are read. A dimension has one row for each key (and copy), so that Spark
    leaves out the joins of those whose columns a question does not ask for.
    """
    compiled_methods(sales.sparkSession)
    sales = strip_headers(sales)
    stores = strip_headers(dims["store"]).withColumnRenamed("LIBELLE", "LIBELLE_y")
    if "_seq" not in stores.columns:
        stores = stores.withColumn("_seq", F.monotonically_increasing_id())
    lookup = stored(build_store_lookup(stores, cities), "stores")
    lookup_small = size_bound_ok(lookup)
    facts = sales.select(*[normalise_identifier(c).alias(c) if c in FACT_KEYS else F.col(c) for c in FACT_COLUMNS])
    tables, copies, facts = _dimension_tables(dims, parse_numeric_and_date_fields(facts))
    facts = facts.withColumns({"year": F.year("Date_transaction"), "month": F.month("Date_transaction")})
    place = lookup.select(F.col("store_key").alias("__place"), F.col("new_city").alias("city"), "latitude", "longitude")
    tables = {n: joined_columns(n, t, lookup) for n, t in tables.items()}
    # a small lookup is joined after the shuffle, so that lines travel without it
    facts = facts.hint("rebalance", "year", "month") if lookup_small else facts
    facts = left_join_skew_safe(facts, place, "Store_transaction_ID", "__place", salt_source=["_seq"], assume_small=lookup_small,
                                broadcast_max_bytes=-1).drop("__place").withColumn("city", F.coalesce("city", F.lit("")))
    facts = facts if lookup_small else facts.hint("rebalance", "year", "month")
    path, facts = new_path(sales.sparkSession, "facts"), facts.withColumnsRenamed(FINAL)
    facts = facts.select(*[c for c in facts.columns if c in PLACE_COLUMNS], *[c for c in facts.columns if c not in PLACE_COLUMNS])
    with shuffles_dropped(sales.sparkSession):
        facts.write.partitionBy("year", "month").parquet(path)
    facts = sales.sparkSession.read.schema(facts.schema).parquet(path)
    tables = {n: stored(t, n) for n, t in tables.items()}
    small = {n: size_bound_ok(t) for n, t in tables.items()}
    tables |= needed_rows(facts, {n: (tables[n], fkey, dkey) for n, fkey, dkey, _ in DIMENSIONS if not small[n]})
    small |= {n: size_bound_ok(tables[n]) for n in small if not small[n]}
    large = [fkey for n, fkey, _, _ in DIMENSIONS if not small[n]]
    return Star(facts, tables, small, hot_keys(facts, large) if large else {}, copies)


def star_frame(star: Star, province: str = DEFAULT_PROVINCE, country: str = DEFAULT_COUNTRY, whole_rows: bool = False) -> DataFrame:
    """The curated table of a stored star.

    ``whole_rows`` is the same table for questions that ask for all columns:
    lines then travel to large dimensions without what their date and their
    store tell (month and place), which they take afterwards.
    """
    place = {"__city1": "__city", "__lat1": "__latitude", "__lon1": "__longitude"}
    df = star.facts.withColumnsRenamed({c: f"__{c}" for c in ("year", "month", *PLACE_COLUMNS)} | {name: raw for raw, name in FINAL.items()})
    if whole_rows:
        df = df.drop("__year", "__month", *place.values())
    for name, fkey, dkey, _ in DIMENSIONS:
        number, table = COPY.format(name), star.tables[name]
        table = table if whole_rows else table.drop(*place)
        df = left_join_one_row(df, table, fkey, dkey, star.small[name], star.hot.get(fkey, ()), copy=number if star.copies[name] > 1 else None)
    if not whole_rows:
        df = df.withColumns({c: F.col(own) for c, own in place.items()})
    df = masked_store_columns(df, province, country)
    df = derive_fields(hashed_lines(df), clean_keys=True)
    stored_columns = {"Year": "__year", "Month": "__month", "CITY": "__city", "Latitude": "__latitude", "Longitude": "__longitude"}
    return to_curated_schema(df if whole_rows else df.withColumns({c: F.col(own) for c, own in stored_columns.items()}))


_CACHE: dict[tuple, Star] = {}


def curated_from_testdata(spark: SparkSession, sf_dir: str, cache: bool = True, whole_rows: bool = False) -> DataFrame:
    """Curated table of the driver test tables, built once per session (``whole_rows``: see :func:`star_frame`)."""
    from kassa.sources.testdata import raw_tables
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if not cache or key not in _CACHE:
        t = raw_tables(spark, sf_dir)
        if not cache:
            return curate(t.sales, t.dims())
        _CACHE[key] = stored_star(t.sales, t.dims())
    star = _CACHE[key]
    return star_frame(star, whole_rows=whole_rows and not all(star.small.values()))
