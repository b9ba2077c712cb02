"""Sample extract — at most N transactions per month, whole transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.functions.clean import month_start
from kassa.operators.common import stored, top_k_per_group
from kassa.operators.joins import sized_broadcast


def sample_transactions(df: DataFrame, per_month: int = 1000, salt_buckets: int = 256,
                        key: str = "transaction_id", date: str = "date_transaction") -> DataFrame:
    """Keep every line of up to ``per_month`` transactions per month.

    Transactions are chosen by the order of sha1(transaction id) — stable
    and reproducible. The per-month choice is a two-stage top-k (salted), so a
    hot month is never ranked in one task; the chosen set (bounded by
    per_month x months) is semi-joined back to the lines.
    """
    tx = df.select(month_start(date).alias("_m"), F.col(key).alias("_tx")).distinct() \
           .withColumn("_h", F.sha1("_tx"))
    chosen = top_k_per_group(tx, per_month, ["_m"], [F.col("_h").asc(), F.col("_tx").asc()],
                             salt_buckets=salt_buckets)
    ids = sized_broadcast(stored(chosen.select("_tx").distinct(), "sample"))
    return df.join(ids, df[key] == ids["_tx"], "left_semi")


def sample_dimension(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str) -> DataFrame:
    """Dimensions keep only rows referenced by the sampled fact (left semi join)."""
    refs = fact.select(F.col(fact_key).alias("_k")).distinct()
    return dim.join(refs, dim[dim_key] == refs["_k"], "left_semi")


def extract_sample(sales: DataFrame, dims: dict[str, DataFrame], per_month: int = 1000) -> dict[str, DataFrame]:
    """S8 as a whole: sampled raw sales plus dimensions cut to referenced rows.

    Works on the raw tables (reference column names); months come from the
    ``yyyymmdd`` transaction date. Returns {'sales', 'contact', 'item',
    'promotion', 'store'}.
    """
    from kassa.functions.clean import normalise_identifier, parse_yyyymmdd
    types = {f.name: f.dataType for f in sales.schema.fields}
    keyed = sales.withColumns({
        "__tx": F.col("Transaction_ID").cast("string"),
        "__date": parse_yyyymmdd("Date_transaction", types.get("Date_transaction")),
    })
    sampled = sample_transactions(keyed.where(F.col("__date").isNotNull()), per_month, key="__tx", date="__date") \
        .drop("__tx", "__date")
    norm = sampled.withColumns({k: normalise_identifier(k) for k in
                                ("Contact_ID", "Item_ID", "Promotion_ID", "Store_transaction_ID")})
    refs = (("contact", "Contact_ID", "Contact_ID"), ("item", "SKU", "Item_ID"),
            ("promotion", "PROMO_ID", "Promotion_ID"), ("store", "STORE_ID", "Store_transaction_ID"))
    out = {"sales": sampled}
    for name, dim_key, fact_key in refs:
        dim = dims[name]
        out[name] = sample_dimension(dim.withColumn("__k", normalise_identifier(dim_key)), norm, "__k", fact_key) \
            .drop("__k")
    return out
