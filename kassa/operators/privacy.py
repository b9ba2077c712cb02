"""Store and location masking as table-wide jobs (A3 city remap, A4 store
lookup, A5 masking of the fact).

Numbering follows first appearance in the store file (``_seq``); it is
computed with the distributed global order, so it is independent of how the
store table is partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kassa.constants import (ALBERTA_CITIES, DEFAULT_COUNTRY, DEFAULT_PROVINCE, ONLINE_CITY,
                             ONLINE_NAME_MARKERS, ONLINE_STORE_ID_FORMAT, ONLINE_STORE_NAME_FORMAT,
                             STORE_FALLBACK_PREFIX, STORE_ID_FORMAT, STORE_NAME_FALLBACK_PREFIX,
                             STORE_NAME_FALLBACK_SEED, STORE_NAME_FORMAT)
from kassa.functions.clean import normalise_identifier, strip
from kassa.functions.privacy import DIGEST_DIGITS, DISPLAY_DIGITS, hashed_postal, hashed_token
from kassa.operators.joins import left_join_skew_safe, size_bound_ok, sized_broadcast
from kassa.operators.rank import global_order


def city_table(spark: SparkSession, cities: Sequence[tuple] = ALBERTA_CITIES) -> DataFrame:
    """The constant remap list as a frame (city_idx, city_label, latitude, longitude)."""
    rows = [(i, name, float(lat), float(lon)) for i, (name, lat, lon) in enumerate(cities)]
    return spark.createDataFrame(rows, "city_idx int, city_label string, latitude double, longitude double")


def build_city_mapping(stores: DataFrame, cities: Sequence[tuple] = ALBERTA_CITIES) -> DataFrame:
    """A3: distinct lower/stripped CITY in first-seen order -> remap city round-robin.

    Empty and 'online' cities are skipped. Output: city_key, city_idx,
    city_label, latitude, longitude.
    """
    key = F.lower(strip(F.coalesce(F.col("CITY").cast("string"), F.lit(""))))
    first = (stores.select(key.alias("city_key"), F.col("_seq"))
                   .where(~F.col("city_key").isin("", "online"))
                   .groupBy("city_key").agg(F.min("_seq").alias("_first")))
    numbered = global_order(first, [F.col("_first").asc(), F.col("city_key").asc()], rank_col="_rn")
    mapped = numbered.select("city_key", ((F.col("_rn") - 1) % len(cities)).cast("int").alias("city_idx"))
    return mapped.join(F.broadcast(city_table(stores.sparkSession, cities)), "city_idx")


def build_store_lookup(stores: DataFrame, cities: Sequence[tuple] = ALBERTA_CITIES) -> DataFrame:
    """A4: one row per store id (first row wins) with its masked identity.

    Input columns: STORE_ID, LIBELLE_y, CITY, _seq. Online stores (name
    contains 'ecom'/'online') are numbered ABWEB01.., physical ones AB001..;
    physical stores take the remapped city (unknown city -> first list city).
    Stores whose id is a missing token still consume a number but are left
    out of the lookup (no fact row can match them).
    Output: store_key, new_id, new_name, new_city, latitude, longitude, postal.
    """
    spark = stores.sparkSession
    base = stores.select(
        F.coalesce(strip(F.col("STORE_ID").cast("string")), F.lit("nan")).alias("store_key"),
        F.coalesce(F.col("LIBELLE_y").cast("string"), F.lit("")).alias("_lib"),
        F.coalesce(F.col("CITY").cast("string"), F.lit("")).alias("_city"),
        F.col("_seq"))
    first = base.groupBy("store_key").agg(
        F.min_by(F.struct("_lib", "_city"), F.col("_seq")).alias("_row"), F.min("_seq").alias("_seq"))
    lib = F.lower(F.col("_row._lib"))
    online = None
    for marker in ONLINE_NAME_MARKERS:
        cond = lib.contains(marker)
        online = cond if online is None else (online | cond)
    first = first.select("store_key", "_seq", online.alias("_online"),
                         F.lower(strip(F.col("_row._city"))).alias("city_key"))
    ranked = global_order(first, [F.col("_online").asc(), F.col("_seq").asc(), F.col("store_key").asc()], rank_col="_r")
    n_physical = first.agg(F.count_if(~F.col("_online")).cast("long")).scalar()
    num = F.when(F.col("_online"), F.col("_r") - n_physical).otherwise(F.col("_r")).cast("int")
    mapping = build_city_mapping(stores, cities).select("city_key", "city_idx")
    ctab = city_table(spark, cities)
    out = (ranked.withColumn("_num", num)
                 .join(sized_broadcast(mapping), "city_key", "left")
                 .withColumn("city_idx", F.coalesce(F.col("city_idx"), F.lit(0)))
                 .join(F.broadcast(ctab), "city_idx", "left"))
    is_on = F.col("_online")
    new_id = F.when(is_on, F.format_string(ONLINE_STORE_ID_FORMAT, F.col("_num"))).otherwise(
        F.format_string(STORE_ID_FORMAT, F.col("_num")))
    return out.select(
        "store_key",
        new_id.alias("new_id"),
        F.when(is_on, F.format_string(ONLINE_STORE_NAME_FORMAT, F.col("_num")))
         .otherwise(F.format_string(STORE_NAME_FORMAT, F.col("_num"), F.col("city_label"))).alias("new_name"),
        F.when(is_on, F.lit(ONLINE_CITY)).otherwise(F.col("city_label")).alias("new_city"),
        F.when(is_on, F.lit(None).cast("double")).otherwise(F.col("latitude")).alias("latitude"),
        F.when(is_on, F.lit(None).cast("double")).otherwise(F.col("longitude")).alias("longitude"),
        hashed_postal(new_id).alias("postal"),
    ).where(normalise_identifier(F.col("store_key")) != "")


def apply_store_masking(df: DataFrame, lookup: DataFrame,
                        province: str = DEFAULT_PROVINCE, country: str = DEFAULT_COUNTRY,
                        lookup_is_small: bool | None = None) -> DataFrame:
    """A5: replace store identity, creation store, city, geo and postal code.

    Uses the *joined* STORE_ID (empty when the fact's store found no match).
    Both lookups are left joins (broadcast under a checked bound, salted on
    the empty key otherwise). ``lookup_is_small`` passes a bound already
    proven upstream (the lookup has at most one narrower row per store).
    Where the dimensions' rows were masked before the joins
    (:func:`masked_contacts`, :func:`masked_stores`) their masks are taken.
    """
    if {"__creation", "__masked_id"} <= set(df.columns):
        return masked_store_columns(df, province, country)
    df = with_store_keys(df)
    salt = ["_seq"] if "_seq" in df.columns else None
    if lookup_is_small is None:
        lookup_is_small = size_bound_ok(lookup)
    bound = None if lookup_is_small else -1
    df = left_join_skew_safe(df, store_names(lookup), "__sk", "__k1", salt_source=salt, broadcast_max_bytes=bound,
                             assume_small=lookup_is_small)
    df = left_join_skew_safe(df, creation_stores(lookup), "__soc", "__k2", salt_source=salt, broadcast_max_bytes=bound,
                             assume_small=lookup_is_small)
    return masked_store_columns(df, province, country)


def with_store_keys(df: DataFrame) -> DataFrame:
    """``df`` with the keys of its store (``__sk``) and of its customer's creation store (``__soc``)."""
    for c in ("Store_Of_Creation", "PostalCode", "STORE_ID"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.withColumn("__sk", F.coalesce(strip(F.col("STORE_ID").cast("string")), F.lit(""))) \
             .withColumn("__soc", F.coalesce(strip(F.col("Store_Of_Creation").cast("string")), F.lit("")))


def store_names(lookup: DataFrame) -> DataFrame:
    """What a line takes from the lookup by its store."""
    return lookup.select(F.col("store_key").alias("__k1"), F.col("new_id").alias("__id1"),
                         F.col("new_name").alias("__name1"), F.col("new_city").alias("__city1"),
                         F.col("latitude").alias("__lat1"), F.col("longitude").alias("__lon1"))


def creation_stores(lookup: DataFrame) -> DataFrame:
    """What a line takes from the lookup by its customer's creation store."""
    return lookup.select(F.col("store_key").alias("__k2"), F.col("new_id").alias("__id2"))


def _masked_store(x: Column, found: str, name: str) -> tuple[Column, Column]:
    """Masked id and name of a store by its key and what the lookup holds for it."""
    fallback = hashed_token(F.when(x == "", F.lit(STORE_NAME_FALLBACK_SEED)).otherwise(x), STORE_NAME_FALLBACK_PREFIX)
    return _masked_id(x, found), F.coalesce(F.col(name), fallback)


def _masked_id(x: Column, found: str) -> Column:
    return F.coalesce(F.col(found), F.when(x != "", hashed_token(x, STORE_FALLBACK_PREFIX)).otherwise(F.lit("")))


def _masked_postal(c: Column) -> Column:
    pc = F.coalesce(c.cast("string"), F.lit("nan"))
    return F.when(strip(pc) == "", F.lit("")).otherwise(hashed_postal(pc))


def masked_contacts(contact: DataFrame, lookup: DataFrame) -> DataFrame:
    """A5 of customers: ``__creation`` and ``__postal`` instead of their creation store and postal code."""
    df = left_join_skew_safe(with_store_keys(contact).drop("__sk"), creation_stores(lookup), "__soc", "__k2")
    return df.withColumns({"__creation": _masked_id(F.col("__soc"), "__id2"), "__postal": _masked_postal(F.col("PostalCode"))}) \
             .drop("__soc", "__k2", "__id2", "STORE_ID", "Store_Of_Creation", "PostalCode")


def masked_stores(store: DataFrame, lookup: DataFrame) -> DataFrame:
    """A5 of stores: ``__masked_id``, ``__masked_name`` and their places."""
    df = left_join_skew_safe(with_store_keys(store).drop("__soc"), store_names(lookup), "__sk", "__k1")
    masked_id, name = _masked_store(F.col("__sk"), "__id1", "__name1")
    return df.withColumns({"__masked_id": masked_id, "__masked_name": name}) \
             .drop("__sk", "__k1", "__id1", "__name1", "Store_Of_Creation", "PostalCode")


def masked_store_columns(df: DataFrame, province: str = DEFAULT_PROVINCE, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """A5 of lines that have their keys and what the lookup holds for them, or the masks of their store and customer."""
    if "__masked_id" in df.columns:
        masked_id = F.coalesce(F.col("__masked_id"), F.lit(""))
        name = F.coalesce(F.col("__masked_name"), hashed_token(F.lit(STORE_NAME_FALLBACK_SEED), STORE_NAME_FALLBACK_PREFIX))
        creation, postal = F.coalesce(F.col("__creation"), F.lit("")), F.coalesce(F.col("__postal"), hashed_postal(F.lit("nan")))
    else:
        masked_id, name = _masked_store(F.col("__sk"), "__id1", "__name1")
        creation, postal = _masked_id(F.col("__soc"), "__id2"), _masked_postal(F.col("PostalCode"))
    df = df.withColumns({
        "STORE_ID": masked_id,
        "Store_transaction_ID": masked_id,
        "LIBELLE_y": name,
        "Store_Of_Creation": creation,
        "CITY": F.coalesce(F.col("__city1"), F.lit("")),
        "PROVINCE": F.lit(province),
        "COUNTRY": F.lit(country),
        "Latitude": F.col("__lat1"),
        "Longitude": F.col("__lon1"),
        "PostalCode": postal,
    })
    return df.drop("__sk", "__soc", "__k1", "__id1", "__name1", "__city1", "__lat1", "__lon1", "__k2", "__id2",
                   "__masked_id", "__masked_name", "__creation", "__postal")


def apply_identifier_hashing(df: DataFrame, prefixes: Sequence[tuple[str, str]] | None = None, stripped: Sequence[str] = (),
                             clean: Sequence[str] = (), joined: dict[str, str] | None = None) -> DataFrame:
    """A1: pseudonymise the identifier columns that exist (others skipped).

    The whole sha1 is kept, so different identifiers stay different; reports
    show its first 8 digits (:func:`kassa.functions.privacy.display_id`).
    ``stripped`` are texts of dimensions (null: no match); ``clean`` are
    normalised keys of the lines; ``joined`` are the keys of dimensions by the
    clean key that found them, whose text (and digest) they share.
    """
    from kassa.constants import ID_HASH_PREFIXES
    from kassa.functions.privacy import pseudonymise
    clean, joined = [c for c in clean if c in df.columns], {c: k for c, k in (joined or {}).items() if c in df.columns}
    df = df.withColumns({f"__sha_{c}": F.upper(F.sha1(F.col(c))) for c in clean})

    def pseudonym(c: str, p: str) -> Column:
        unmatched = F.when(F.col(c).isNull(), hashed_token(F.lit("nan"), p))
        if c in stripped:
            return unmatched.when(F.col(c) == "", F.lit("")).otherwise(hashed_token(F.col(c), p))
        key = joined.get(c, c)
        if key not in clean:
            return pseudonymise(c, p)
        shown = F.when(F.col(key) == "", F.lit("")).otherwise(F.concat(F.lit(p), F.col(f"__sha_{key}")))
        return shown if key == c else unmatched.otherwise(shown)

    return df.withColumns({c: pseudonym(c, p) for c, p in (prefixes or ID_HASH_PREFIXES) if c in df.columns}) \
             .drop(*[f"__sha_{c}" for c in clean])


def _common_prefix(a: Column, b: Column) -> Column:
    """Number of characters that two texts begin with alike (0 if either is null)."""
    same = F.filter(F.sequence(F.lit(1), F.greatest(F.least(F.length(a), F.length(b)), F.lit(1))), lambda n: F.substring(a, F.lit(1), n) == F.substring(b, F.lit(1), n))
    return F.coalesce(F.array_max(same), F.lit(0))


def short_identifiers(df: DataFrame, column: str, prefix: str, known: DataFrame | None = None) -> DataFrame:
    """``identifier, short``: a short form for each different pseudonym, no two alike.

    It is the display form (8 digits) where no other identifier begins so, else
    as many digits as tell it from its neighbours in the order of the digests;
    only identifiers that share the display form meet, a few at a time. ``known``
    is an earlier result: its identifiers keep their forms, and later ones get
    forms that none of them has. Texts that are no pseudonym stay as they are;
    null is left out.
    """
    head, whole = len(prefix) + DISPLAY_DIGITS, len(prefix) + DIGEST_DIGITS
    ids = df.select(F.col(column).cast("string").alias("identifier"), F.lit(None).cast("string").alias("short")).where("identifier is not null")
    if known is not None:
        ids = ids.unionByName(known.select("identifier", "short"))
    ids = ids.groupBy("identifier").agg(F.max("short").alias("short"))
    alike = ids.groupBy(F.substring("identifier", 1, head).alias("head")).agg(F.array_sort(F.collect_list(F.struct("identifier", "short"))).alias("g"))

    def form(x: Column, i: Column) -> Column:
        own = x["identifier"]
        beside = [_common_prefix(own, F.get("g", i + d)["identifier"]) for d in (-1, 1)]
        digits = F.when(F.size("g") == 1, F.lit(head)).otherwise(F.greatest(F.lit(head), *[n + 1 for n in beside]))
        pseudonym = (F.length(own) == whole) & own.startswith(prefix)
        return F.struct(own.alias("identifier"), F.coalesce(x["short"], F.when(pseudonym, F.substring(own, F.lit(1), digits)).otherwise(own)).alias("short"))

    return alike.select(F.explode(F.transform("g", form)).alias("x")).select("x.identifier", "x.short")
