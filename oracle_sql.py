"""DuckDB SQL twins of the registered Spark queries.

``CURATED`` is an independent SQL rendering of the whole curation job over the
driver's raw tables (retail mapping -> normalise -> 4 left joins -> store
lookup -> masking -> hashing -> typing). Each oracle query is ``CURATED`` plus
its own SELECT. Doubles are rounded to ~9 significant digits on both sides
(``R``), because summation order differs between engines.
"""

from __future__ import annotations

# target cities of the remap: name, latitude, longitude
CITIES = """Calgary 51.0447 -114.0719|Edmonton 53.5461 -113.4938|Red Deer 52.2681 -113.8112|Lethbridge 49.6956 -112.8450
St. Albert 53.6305 -113.6256|Medicine Hat 50.0405 -110.6765|Grande Prairie 55.1707 -118.7947|Airdrie 51.2917 -114.0144
Spruce Grove 53.5464 -113.9187|Leduc 53.2597 -113.5569|Okotoks 50.7240 -113.9720|Fort McMurray 56.7260 -111.3790
Banff 51.1784 -115.5708|Canmore 51.0890 -115.3595|Brooks 50.5649 -111.8980|Camrose 53.0167 -112.8200
Chestermere 51.0379 -113.8225|Lloydminster 53.2784 -110.0054|Sherwood Park 53.5444 -113.3198|Wetaskiwin 52.9692 -113.3761"""


def R(x: str) -> str:  # noqa: N802
    """About nine significant digits: snapped to a binary grid, then rounded, both by magnitude."""
    cases = []
    for bits, grid, places in ((-10, 40, 10), (0, 30, 9), (10, 20, 6), (20, 10, 3), (24, 6, 2), (44, 2, 2)):
        cases.append(f"WHEN abs({x}) < pow(2.0, {bits}) THEN round(CAST(floor(({x}) * pow(2.0, {grid}) + 0.5) AS DOUBLE) * pow(2.0, {-grid}), {places})")
    return f"(CASE {' '.join(cases)} ELSE CAST({x} AS DOUBLE) END)"


# prefixes of the pseudonyms by column; results show the prefix and 8 digits
PREFIXES = {"transaction_id": "TRX", "contact_id": "CUST", "item_id": "ITEM", "promotion_id": "PROMO", "promo_id": "PROMO", "sku": "SKU", "ean": "EAN",
            "promo_label": "OFFER", "store_id": "ST", "store_name": "ABSTORE", "store_of_creation": "ST"}


def short(c: str, column: str | None = None) -> str:
    prefix = PREFIXES[column or c]
    n = len(prefix)
    return f"(CASE WHEN length({c}) = {n + 40} AND starts_with({c}, '{prefix}') THEN substr({c}, 1, {n + 8}) ELSE {c} END)"


def _norm(x: str) -> str:
    return (f"(CASE WHEN lower(trim(coalesce({x}, ''))) IN ('', 'na', 'nan', 'none', 'null') "
            f"THEN '' ELSE trim({x}) END)")


def _hash(x: str, prefix: str) -> str:
    t = f"trim(coalesce(CAST({x} AS VARCHAR), 'nan'))"
    return f"(CASE WHEN {t} = '' THEN '' ELSE '{prefix}' || upper(sha1({t})) END)"


def _tok(x: str, prefix: str) -> str:
    return f"('{prefix}' || upper(sha1({x})))"


def _postal(v: str) -> str:
    h = f"sha1({v})"

    def nib(i):
        return f"(strpos('0123456789abcdef', substr({h}, {i}, 1)) - 1)"

    def dig(i):
        return f"CAST({nib(i)} % 10 AS VARCHAR)"

    def let(i):
        return f"chr(CAST(65 + {nib(i)} % 26 AS INTEGER))"
    return f"('T' || {dig(1)} || {let(2)} || {dig(3)} || {let(4)} || {dig(5)})"


_CITY_VALUES = ", ".join(f"({i}, '{n}', {lat}, {lon})" for i, (n, lat, lon) in
                         enumerate(c.rsplit(" ", 2) for c in CITIES.replace("\n", "|").split("|")))

CURATED = f"""
WITH
cities(city_idx, city_label, lat, lon) AS (VALUES {_CITY_VALUES}),
raw_sales AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS Transaction_ID,
    CASE WHEN l.l_orderkey % 97 = 0 THEN '' WHEN l.l_orderkey % 89 = 0 THEN ' null '
         ELSE CAST(o.o_custkey AS VARCHAR) END AS Contact_ID,
    CAST(l.l_partkey AS VARCHAR) AS Item_ID,
    CASE WHEN l.l_discount >= 0.05 THEN 'P' || CAST(CAST(round(l.l_discount * 100) AS INTEGER) AS VARCHAR) ELSE '' END
      AS Promotion_ID,
    CAST(l.l_suppkey AS VARCHAR) AS Store_transaction_ID,
    CASE WHEN l.l_orderkey % 1013 = 0 THEN strftime(o.o_orderdate, '%Y') || '0231'
         ELSE strftime(o.o_orderdate, '%Y%m%d') END AS Date_transaction,
    CASE WHEN l.l_quantity = 0 THEN NULL ELSE l.l_extendedprice / l.l_quantity END AS Unit_original_price,
    CASE WHEN l.l_quantity = 0 THEN NULL ELSE l.l_extendedprice / l.l_quantity END * (1.0 - l.l_discount) AS Unit_sale_price,
    o.o_totalprice AS Transaction_value,
    CASE WHEN l.l_linenumber = 7 AND l.l_partkey % 5 = 0 THEN NULL ELSE l.l_quantity END AS Quantity_item,
    l.l_orderkey AS s1, l.l_linenumber AS s2, l.l_partkey AS s3, l.l_suppkey AS s4,
    l.l_extendedprice AS s5, l.l_discount AS s6, l.l_quantity AS s7
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
raw_contact AS (
  SELECT CAST(c_custkey AS VARCHAR) AS Contact_ID,
    CAST(1940 + c_custkey % 90 AS VARCHAR) AS YearOfBirth,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'True' WHEN 'MACHINERY' THEN 'yes' WHEN 'FURNITURE' THEN NULL ELSE '0' END
      AS Has_Web_Account,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 130 AS VARCHAR) END AS Store_Of_Creation,
    CASE WHEN c_custkey % 17 = 0 THEN NULL
         ELSE 'T' || CAST(c_nationkey AS VARCHAR) || ' ' || CAST(c_custkey % 1000 AS VARCHAR) END AS PostalCode
  FROM customer),
raw_item AS (
  SELECT CAST(p_partkey AS VARCHAR) AS SKU,
    '400' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS EAN,
    CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS category,
    p_name AS sku_description
  FROM part),
raw_promo AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS PROMO_ID,
    'Offer ' || p_brand AS LIBELLE_x,
    CASE WHEN p_partkey % 11 = 0 THEN NULL
         ELSE strftime(DATE '1995-01-01' + CAST(p_size * 30 AS INTEGER), '%Y-%m-%d') END AS START_DATE,
    CASE WHEN p_partkey % 7 = 0 THEN NULL
         ELSE strftime(DATE '1995-01-01' + CAST(p_size * 30 AS INTEGER) + CAST(p_partkey % 400 - 20 AS INTEGER),
                       '%Y-%m-%d') END AS END_DATE
  FROM part),
raw_store AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS STORE_ID,
    CASE WHEN s_suppkey % 40 = 7 THEN 'ECOM ' || s_name ELSE s_name END AS LIBELLE_y,
    r_name AS COUNTRY, n_name AS PROVINCE,
    CASE WHEN n_nationkey % 21 = 20 THEN 'Online' ELSE n_name END AS CITY,
    strftime(DATE '1996-01-01' + CAST(s_suppkey * 97 AS INTEGER), '%Y-%m-%d') AS OPEN_DATE,
    s_suppkey AS sseq
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
city_first AS (
  SELECT lower(trim(coalesce(CITY, ''))) AS ckey, min(sseq) AS first_seq FROM raw_store GROUP BY 1),
city_map AS (
  SELECT ckey, CAST((row_number() OVER (ORDER BY first_seq, ckey) - 1) % 20 AS INTEGER) AS city_idx
  FROM city_first WHERE ckey NOT IN ('', 'online')),
store_first AS (
  SELECT * FROM (
    SELECT trim(coalesce(STORE_ID, 'nan')) AS skey, coalesce(LIBELLE_y, '') AS lib,
      lower(trim(coalesce(CITY, ''))) AS ckey, sseq,
      row_number() OVER (PARTITION BY trim(coalesce(STORE_ID, 'nan')) ORDER BY sseq) AS rn
    FROM raw_store) WHERE rn = 1),
store_num AS (
  SELECT *, (strpos(lower(lib), 'ecom') > 0 OR strpos(lower(lib), 'online') > 0) AS is_online FROM store_first),
store_num2 AS (
  SELECT *, row_number() OVER (PARTITION BY is_online ORDER BY sseq, skey) AS num FROM store_num),
store_lookup AS (
  SELECT s.skey,
    CASE WHEN is_online THEN printf('ABWEB%02d', num) ELSE printf('AB%03d', num) END AS new_id,
    CASE WHEN is_online THEN printf('Alberta Online Store %02d', num)
         ELSE printf('AB Store %03d - %s', num, c.city_label) END AS new_name,
    CASE WHEN is_online THEN 'Online' ELSE c.city_label END AS new_city,
    CASE WHEN is_online THEN NULL ELSE c.lat END AS lat,
    CASE WHEN is_online THEN NULL ELSE c.lon END AS lon
  FROM store_num2 s LEFT JOIN city_map m ON s.ckey = m.ckey
  LEFT JOIN cities c ON c.city_idx = coalesce(m.city_idx, 0)
  WHERE {_norm('s.skey')} <> ''),
sales_n AS (
  SELECT *, {_norm('Contact_ID')} AS c_k, {_norm('Item_ID')} AS i_k, {_norm('Promotion_ID')} AS p_k,
    {_norm('Store_transaction_ID')} AS st_k
  FROM raw_sales),
joined AS (
  SELECT s.*, c.YearOfBirth, c.Has_Web_Account, c.Store_Of_Creation, c.PostalCode,
    i.SKU, i.EAN, i.category, i.sku_description,
    p.PROMO_ID, p.LIBELLE_x,
    st.STORE_ID AS dim_store_id
  FROM sales_n s
  LEFT JOIN (SELECT {_norm('Contact_ID')} AS ck, * EXCLUDE (Contact_ID) FROM raw_contact) c ON s.c_k = c.ck
  LEFT JOIN (SELECT {_norm('SKU')} AS SKU, * EXCLUDE (SKU) FROM raw_item) i ON s.i_k = i.SKU
  LEFT JOIN (SELECT {_norm('PROMO_ID')} AS PROMO_ID, * EXCLUDE (PROMO_ID) FROM raw_promo) p ON s.p_k = p.PROMO_ID
  LEFT JOIN (SELECT {_norm('STORE_ID')} AS STORE_ID FROM raw_store) st ON s.st_k = st.STORE_ID),
masked AS (
  SELECT j.*, trim(coalesce(j.dim_store_id, '')) AS x, trim(coalesce(j.Store_Of_Creation, '')) AS y,
    l1.new_id AS id1, l1.new_name AS name1, l1.new_city AS city1, l1.lat AS lat1, l1.lon AS lon1,
    l2.new_id AS id2
  FROM joined j
  LEFT JOIN store_lookup l1 ON trim(coalesce(j.dim_store_id, '')) = l1.skey
  LEFT JOIN store_lookup l2 ON trim(coalesce(j.Store_Of_Creation, '')) = l2.skey),
typed AS (
  SELECT *,
    CASE WHEN regexp_full_match(Date_transaction, '[0-9]{{8}}')
         THEN CAST(try_strptime(Date_transaction, '%Y%m%d') AS DATE) END AS d
  FROM masked),
curated AS (
  SELECT
    {_hash('Transaction_ID', 'TRX')} AS transaction_id,
    {_hash('c_k', 'CUST')} AS contact_id,
    {_hash('i_k', 'ITEM')} AS item_id,
    {_hash('p_k', 'PROMO')} AS promotion_id,
    coalesce(id1, CASE WHEN x <> '' THEN {_tok('x', 'ST')} ELSE '' END) AS store_id,
    {_hash('PROMO_ID', 'PROMO')} AS promo_id,
    {_hash('SKU', 'SKU')} AS sku,
    {_hash('EAN', 'EAN')} AS ean,
    {_hash('LIBELLE_x', 'OFFER')} AS promo_label,
    coalesce(name1, {_tok("CASE WHEN x = '' THEN 'Store' ELSE x END", 'ABSTORE')}) AS store_name,
    coalesce(city1, '') AS city,
    'AB' AS province,
    'CAN' AS country,
    CAST(lat1 AS DOUBLE) AS latitude,
    CAST(lon1 AS DOUBLE) AS longitude,
    CASE WHEN trim(coalesce(PostalCode, 'nan')) = '' THEN '' ELSE {_postal("coalesce(PostalCode, 'nan')")} END
      AS postal_code,
    coalesce(id2, CASE WHEN y <> '' THEN {_tok('y', 'ST')} ELSE '' END) AS store_of_creation,
    category,
    sku_description,
    d AS date_transaction,
    CAST(Unit_original_price AS DOUBLE) AS unit_original_price,
    CAST(Unit_sale_price AS DOUBLE) AS unit_sale_price,
    CAST(Transaction_value AS DOUBLE) AS transaction_value,
    CAST(Quantity_item AS DOUBLE) AS quantity_item,
    Unit_sale_price * coalesce(Quantity_item, 0.0) AS line_sales_value,
    Unit_original_price * coalesce(Quantity_item, 0.0) AS line_original_value,
    Unit_original_price * coalesce(Quantity_item, 0.0) - Unit_sale_price * coalesce(Quantity_item, 0.0)
      AS line_discount,
    p_k <> '' AS promo_flag,
    lower(trim(coalesce(Has_Web_Account, 'nan'))) IN ('1', 'true', 'yes', 'y') AS has_web_account,
    CAST(year(d) AS INTEGER) AS year,
    CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(month(d) AS INTEGER) AS month,
    CAST(d - DATE '1970-01-01' AS INTEGER) AS days_since_epoch,
    TRY_CAST(YearOfBirth AS DOUBLE) AS year_of_birth,
    CASE WHEN year(d) - TRY_CAST(YearOfBirth AS DOUBLE) < 0 THEN NULL
         ELSE year(d) - TRY_CAST(YearOfBirth AS DOUBLE) END AS customer_age,
    s1, s2, s3, s4, s5, s6, s7
  FROM typed WHERE d IS NOT NULL)
"""

# first line of each transaction, in ingestion order
FIRST_LINE = """first_line AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY s1, s2, s3, s4, s5, s6, s7) AS _fl
                 FROM curated) WHERE _fl = 1)"""


def q(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return CURATED + extra + "\n" + body


CURATED_COLS = ("transaction_id, contact_id, item_id, promotion_id, store_id, promo_id, sku, ean, promo_label, "
                "store_name, city, province, country, latitude, longitude, postal_code, store_of_creation, category, "
                "sku_description, date_transaction, unit_original_price, unit_sale_price, transaction_value, "
                "quantity_item, line_sales_value, line_original_value, line_discount, promo_flag, has_web_account, "
                "year, quarter, month, days_since_epoch, year_of_birth, customer_age")


def _rcols(cols: str, doubles: set[str]) -> str:
    out = []
    for c in [x.strip() for x in cols.split(",")]:
        out.append(f"{R(c)} AS {c}" if c in doubles else f"{short(c)} AS {c}" if c in PREFIXES else c)
    return ", ".join(out)


_CUR_DOUBLES = {"latitude", "longitude", "unit_original_price", "unit_sale_price", "transaction_value",
                "quantity_item", "line_sales_value", "line_original_value", "line_discount", "year_of_birth",
                "customer_age"}

ORACLE: dict[str, str] = {}
ORACLE["curated_sales"] = q(f"SELECT {_rcols(CURATED_COLS, _CUR_DOUBLES)} FROM curated")


# ---------------------------------------------------------------------------- helpers
def fl(src: str, name: str = "fl") -> str:
    """CTE: first line of each transaction of ``src`` in ingestion order."""
    return (f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id "
            f"ORDER BY s1, s2, s3, s4, s5, s6, s7) AS _fl FROM {src}) WHERE _fl = 1)")


F1 = "f1 AS (SELECT * FROM curated WHERE quantity_item >= 0)"


def sel(spec: str, src: str) -> str:
    """SELECT list from ``src``; names ending in * are doubles (rounded)."""
    out = []
    for c in [x.strip() for x in spec.split(",")]:
        if c.endswith("*"):
            c = c[:-1]
            out.append(f"{R(c)} AS {c}")
        else:
            out.append(f"{short(c)} AS {c}" if c in PREFIXES else c)
    return f"SELECT {', '.join(out)} FROM {src}"


def zs(x: str) -> str:
    return f"coalesce(sum({x}), 0.0)"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) END)"


def quantiles_cte(name: str, src: str, col: str, probs, names) -> str:
    """CTE ``name`` with one row of numpy-'linear' quantiles of ``col``."""
    parts = []
    for p, nm in zip(probs, names):
        h = f"(CAST(n - 1 AS DOUBLE) * {float(p)!r})"
        lo = f"CAST(floor({h}) AS BIGINT)"
        hi = f"least({lo} + 1, n - 1)"
        g = f"({h} - CAST({lo} AS DOUBLE))"
        a = f"max(CASE WHEN r = {lo} + 1 THEN x END)"
        b = f"max(CASE WHEN r = {hi} + 1 THEN x END)"
        parts.append(f"CASE WHEN any_value({g}) >= 0.5 THEN {b} - ({b} - {a}) * (1.0 - any_value({g})) "
                     f"ELSE {a} + ({b} - {a}) * any_value({g}) END AS {nm}")
    return (f"{name}_v AS (SELECT x, row_number() OVER (ORDER BY x) AS r, count(*) OVER () AS n FROM "
            f"(SELECT CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL)),\n"
            f"{name} AS (SELECT {', '.join(parts)} FROM {name}_v)")


def qrs_sql(value: str, key: str, reverse: bool, k: int = 5) -> str:
    """Quantile-rank score expression (window functions over the frame)."""
    order = f"{value} DESC, {key}" if reverse else f"{value}, {key}"
    r = f"row_number() OVER (ORDER BY {order})"
    n = "count(*) OVER ()"
    q = f"least({k}, {n})"
    raw = f"greatest(1, (({r} - 1) * {q} + ({n} - 1) - 1) // ({n} - 1))"
    stretched = f"CASE WHEN {q} < {k} THEN ({raw} * {k} + {q} - 1) // {q} ELSE {raw} END"
    s = f"CASE WHEN {n} <= 1 THEN {k // 2 + 1} ELSE {stretched} END"
    if reverse:
        s = f"CASE WHEN {n} <= 1 THEN {k // 2 + 1} ELSE {k} + 1 - ({stretched}) END"
    return f"CAST({s} AS INTEGER)"


O = ORACLE

# ---------------------------------------------------------------------------- sales KPIs
O["monthly_kpi_summary"] = q(sel(
    "month, revenue*, orders, units*, unique_customers, avg_order_value*",
    f"""(SELECT CAST(date_trunc('month', date_transaction) AS DATE) AS month,
          {zs('transaction_value')} AS revenue, count(DISTINCT transaction_id) AS orders,
          {zs('quantity_item')} AS units, count(DISTINCT contact_id) AS unique_customers,
          {ratio(zs('transaction_value'), 'count(DISTINCT transaction_id)')} AS avg_order_value
        FROM curated GROUP BY 1)"""))

_HIGHLIGHTS = lambda src: f"""(SELECT tot.total_revenue, ln.total_units, tot.total_orders,
      CASE WHEN tot.total_orders > 0 THEN tot.total_revenue / tot.total_orders ELSE 0.0 END AS avg_order_value,
      (SELECT city FROM cty) AS top_city, (SELECT rev FROM cty) AS top_city_revenue,
      CASE WHEN tot.total_revenue <> 0 THEN ln.online / tot.total_revenue ELSE 0.0 END AS online_share
    FROM (SELECT {zs('transaction_value')} AS total_revenue, count(*) AS total_orders FROM fl) tot,
         (SELECT {zs('quantity_item')} AS total_units,
                 {zs("CASE WHEN lower(city) = 'online' THEN transaction_value END")} AS online FROM {src}) ln)"""
_CTY = lambda src: (f"cty AS (SELECT city, {zs('transaction_value')} AS rev FROM {src} WHERE city IS NOT NULL "
                    f"GROUP BY city ORDER BY rev DESC, city LIMIT 1)")
_HL_SPEC = "total_revenue*, total_units*, total_orders, avg_order_value*, top_city, top_city_revenue*, online_share*"
O["highlights"] = q(sel(_HL_SPEC, _HIGHLIGHTS("f1")), F1, fl("f1"), _CTY("f1"))

O["monthly_sales_series"] = q(sel(
    "month, revenue*, orders, units*",
    f"""(SELECT m.month, m.revenue, m.orders, u.units FROM
          (SELECT CAST(date_trunc('month', date_transaction) AS DATE) AS month, {zs('transaction_value')} AS revenue,
                  count(*) AS orders FROM fl GROUP BY 1) m
          LEFT JOIN (SELECT CAST(date_trunc('month', date_transaction) AS DATE) AS month,
                            {zs('quantity_item')} AS units FROM f1 GROUP BY 1) u USING (month))"""), F1, fl("f1"))

O["daily_units"] = q(sel("date_transaction, units*",
                         f"(SELECT date_transaction, {zs('quantity_item')} AS units FROM f1 GROUP BY 1)"), F1)

O["category_revenue_share"] = q(sel(
    "category, revenue*, share*",
    f"""(SELECT category, revenue, CASE WHEN t <> 0 THEN revenue / t ELSE 0.0 END AS share
         FROM cat, (SELECT {zs('revenue')} AS t FROM cat) tot ORDER BY revenue DESC, category LIMIT 10)"""),
    f"cat AS (SELECT category, {zs('transaction_value')} AS revenue FROM curated WHERE category IS NOT NULL GROUP BY 1)")


def _pareto_sql(agg_cte: str, keys: str) -> str:
    return f"""(SELECT *, gmv_cum_share_pct <= 80.0 AS pareto_80 FROM (
      SELECT *, row_number() OVER (ORDER BY gmv DESC, {keys}) AS gmv_rank,
             sum(gmv_share_pct) OVER (ORDER BY gmv DESC, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               AS gmv_cum_share_pct
      FROM (SELECT a.*, {ratio('gmv', 'units')} AS asp, (CASE WHEN t <> 0 THEN gmv / t END) * 100.0 AS gmv_share_pct
            FROM {agg_cte} a, (SELECT {zs('gmv')} AS t FROM {agg_cte}) tot)))"""


O["category_pareto"] = q(sel(
    "category, gmv*, units*, orders, asp*, gmv_share_pct*, gmv_rank, gmv_cum_share_pct*, pareto_80",
    _pareto_sql("agg", "category")),
    f"""agg AS (SELECT coalesce(category, 'Unknown') AS category, {zs('transaction_value')} AS gmv,
        {zs('quantity_item')} AS units, count(DISTINCT transaction_id) AS orders FROM curated GROUP BY 1)""")

O["sku_top50"] = q(sel(
    "sku, sku_label, gmv*, units*, orders, asp*, gmv_share_pct*, gmv_rank, gmv_cum_share_pct*, pareto_80",
    f"""(SELECT *, gmv_cum_share_pct <= 80.0 AS pareto_80 FROM (
      SELECT *, row_number() OVER (ORDER BY gmv DESC, sku NULLS FIRST, sku_label NULLS FIRST) AS gmv_rank,
        sum(gmv_share_pct) OVER (ORDER BY gmv DESC, sku NULLS FIRST, sku_label NULLS FIRST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gmv_cum_share_pct
      FROM (SELECT a.*, {ratio('gmv', 'units')} AS asp, (CASE WHEN t <> 0 THEN gmv / t END) * 100.0 AS gmv_share_pct
            FROM agg a, (SELECT {zs('gmv')} AS t FROM agg) tot
            ORDER BY gmv DESC, sku NULLS FIRST, sku_label NULLS FIRST LIMIT 50)))"""),
    f"""agg AS (SELECT sku, coalesce(sku_description, {short('sku')}, {short('item_id')}) AS sku_label, {zs('transaction_value')} AS gmv,
        {zs('quantity_item')} AS units, count(DISTINCT transaction_id) AS orders FROM curated GROUP BY 1, 2)""")

O["units_by_location"] = q(sel("latitude*, longitude*, city, units*", f"""(SELECT latitude, longitude, city,
    {zs('quantity_item')} AS units FROM f1 WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3)"""), F1)

O["avg_transaction_value_by_location"] = q(sel(
    "latitude*, longitude*, city, avg_transaction_value*",
    """(SELECT latitude, longitude, city, avg(transaction_value) AS avg_transaction_value FROM fl
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3)"""), F1, fl("f1"))

O["avg_transaction_value"] = q(sel(
    "avg_transaction_value*, transactions",
    "(SELECT avg(transaction_value) AS avg_transaction_value, count(*) AS transactions FROM fl "
    "WHERE transaction_value >= 0)"), F1, fl("f1"))

# ---------------------------------------------------------------------------- promotions
_PROMO_SUM = lambda src: f"""(SELECT CASE WHEN promo_flag THEN 'With Promotion' ELSE 'No Promotion' END AS promotion,
      count(*) AS orders, {zs('tv')} AS revenue, avg(tv) AS avg_order_value, {zs('disc')} AS total_discount,
      avg(disc) AS avg_discount_per_order, {zs('qty')} AS units
    FROM (SELECT transaction_id, promo_flag, {zs('transaction_value')} AS tv, {zs('line_discount')} AS disc,
                 {zs('quantity_item')} AS qty FROM {src} GROUP BY 1, 2) GROUP BY 1)"""
O["promotion_summary"] = q(sel(
    "promotion, orders, revenue*, avg_order_value*, total_discount*, avg_discount_per_order*, units*",
    _PROMO_SUM("curated")))

O["promo_overall"] = q(sel(
    "promo_flag, gmv*, units*, orders, asp*, aov*, discount_value*, avg_discount_rate*, gmv_share_pct*",
    f"""(SELECT g.promo_flag, gmv, units, orders, {ratio('gmv', 'units')} AS asp, {ratio('gmv', 'orders')} AS aov,
        discount_value, {ratio('discount_value', 'original_value')} AS avg_discount_rate,
        (CASE WHEN t <> 0 THEN gmv / t END) * 100.0 AS gmv_share_pct
      FROM g, (SELECT {zs('gmv')} AS t FROM g) tot)"""),
    f"""tx AS (SELECT transaction_id, {zs('line_sales_value')} AS gmv, {zs('quantity_item')} AS units,
        {zs('line_discount')} AS discount_value, {zs('line_original_value')} AS original_value,
        bool_or(promo_flag) AS promo_flag FROM curated GROUP BY 1)""",
    f"""g AS (SELECT promo_flag, {zs('gmv')} AS gmv, {zs('units')} AS units, count(*) AS orders,
        {zs('discount_value')} AS discount_value, {zs('original_value')} AS original_value FROM tx GROUP BY 1)""")

AB = """ab AS (SELECT * REPLACE (coalesce(category, 'Unknown') AS category,
          coalesce(store_name, store_id) AS store_name, coalesce(promo_label, 'Unspecified promo') AS promo_label),
        coalesce(city, 'Unknown') AS store_city, coalesce(province, 'Unknown') AS store_province,
        line_original_value AS original_value,
        CASE WHEN line_discount < 0 THEN 0.0 ELSE line_discount END AS discount_value,
        line_sales_value AS gmv FROM curated)"""
_MEAS = (f"{zs('gmv')} AS gmv, {zs('quantity_item')} AS units, count(DISTINCT transaction_id) AS orders, "
         f"{zs('discount_value')} AS discount_value, {zs('original_value')} AS original_value")
_RAT = (f"{ratio('gmv', 'units')} AS asp, {ratio('gmv', 'orders')} AS aov, "
        f"{ratio('discount_value', 'original_value')} AS avg_discount_rate")


def _promo_effect(dims: list[str]) -> str:
    d = ", ".join(dims)
    spec = d + ", promo_flag, gmv*, units*, orders, discount_value*, original_value*, asp*, aov*, " \
               "avg_discount_rate*, gmv_share_pct*, row_rank"
    return q(sel(spec, f"""(SELECT g.*, {_RAT}, row_number() OVER (ORDER BY gmv DESC, {d}, promo_flag) AS row_rank,
        CASE WHEN sum(gmv) OVER (PARTITION BY {d}) = 0 THEN 0.0
             ELSE gmv / sum(gmv) OVER (PARTITION BY {d}) * 100.0 END AS gmv_share_pct
      FROM (SELECT {d}, promo_flag, {_MEAS} FROM ab GROUP BY ALL) g)"""), AB)


O["promo_effect_category"] = _promo_effect(["category"])
O["promo_effect_store"] = _promo_effect(["store_province", "store_name"])
O["promo_effect_label"] = _promo_effect(["promo_label"])

O["promo_hotspots"] = q(sel(
    "category, store_name, promo_label, gmv*, units*, orders, discount_value*, original_value*, asp*, aov*, "
    "avg_discount_rate*",
    f"""(SELECT g.*, {_RAT} FROM (SELECT category, store_name, promo_label, {_MEAS} FROM ab WHERE promo_flag
         GROUP BY 1, 2, 3) g ORDER BY gmv DESC, category, store_name, promo_label LIMIT 30)"""), AB)

O["top_promotions"] = q(sel(
    "promotion_id, revenue*, orders, units*",
    f"""(SELECT promotion_id, {zs('transaction_value')} AS revenue, count(DISTINCT transaction_id) AS orders,
        {zs('quantity_item')} AS units FROM f1 WHERE promotion_id IS NOT NULL GROUP BY 1
        ORDER BY revenue DESC, promotion_id LIMIT 10)"""), F1)

O["promo_share_long"] = q(sel(
    "promotion, metric, share*",
    f"""(SELECT promotion, 'Revenue Share' AS metric, CASE WHEN rt <> 0 THEN revenue / rt ELSE 0.0 END AS share
          FROM s, (SELECT {zs('revenue')} AS rt FROM s) a
        UNION ALL
        SELECT promotion, 'Order Share', CASE WHEN ot <> 0 THEN orders / ot ELSE 0.0 END
          FROM s, (SELECT coalesce(sum(orders), 0) AS ot FROM s) b)"""),
    F1, f"s AS {_PROMO_SUM('f1')}")

# ---------------------------------------------------------------------------- stores
O["store_profitability"] = q(sel(
    "store_name, city, revenue*, units*, discount*, avg_discount_per_unit*, row_rank",
    f"""(SELECT *, row_number() OVER (ORDER BY revenue DESC, store_name NULLS FIRST, city NULLS FIRST) AS row_rank FROM (SELECT store_name, city, {zs('transaction_value')} AS revenue, {zs('quantity_item')} AS units,
        {zs('line_discount')} AS discount, {ratio(zs('line_discount'), zs('quantity_item'))} AS avg_discount_per_unit
        FROM curated GROUP BY 1, 2))"""))


def _perf_sql(keys: str, base: str) -> str:
    return f"""(SELECT g.*, row_number() OVER (ORDER BY gmv DESC, {keys}) AS row_rank, {ratio('gmv', 'orders')} AS aov, {ratio('units', 'orders')} AS items_per_order,
        (CASE WHEN t <> 0 THEN gmv / t END) * 100.0 AS gmv_share_pct
      FROM (SELECT {keys}, {zs('transaction_value')} AS gmv, {zs('quantity_item')} AS units,
                   count(DISTINCT transaction_id) AS orders FROM {base} GROUP BY ALL) g,
           (SELECT {zs('transaction_value')} AS t FROM {base}) tot)"""


O["store_deep_dive"] = q(sel(
    "store_id, store_name, store_city, store_province, gmv*, units*, orders, aov*, items_per_order*, gmv_share_pct*, row_rank",
    _perf_sql("store_id, store_name, store_city, store_province",
              "(SELECT store_id, coalesce(store_name, store_id) AS store_name, coalesce(city, 'Unknown') AS store_city, "
              "coalesce(province, 'Unknown') AS store_province, transaction_value, quantity_item, transaction_id "
              "FROM curated)")))

O["store_top_bottom15"] = q(sel(
    "store_id, store_name, store_city, store_province, gmv*, units*, orders, aov*, items_per_order*, gmv_share_pct*, "
    "view, view_rank",
    """(SELECT *, 'top' AS view, row_number() OVER (ORDER BY gmv DESC, store_id) AS view_rank FROM dd
          QUALIFY view_rank <= 15
        UNION ALL
        SELECT *, 'bottom', row_number() OVER (ORDER BY gmv, store_id) FROM dd
          QUALIFY row_number() OVER (ORDER BY gmv, store_id) <= 15)"""),
    "dd AS " + _perf_sql("store_id, store_name, store_city, store_province",
                         "(SELECT store_id, coalesce(store_name, store_id) AS store_name, coalesce(city, 'Unknown') "
                         "AS store_city, coalesce(province, 'Unknown') AS store_province, transaction_value, "
                         "quantity_item, transaction_id FROM curated)"))

O["city_performance"] = q(sel(
    "province, city, gmv*, units*, orders, aov*, items_per_order*, gmv_share_pct*, row_rank",
    _perf_sql("province, city",
              "(SELECT coalesce(province, 'Unknown') AS province, coalesce(city, 'Unknown') AS city, "
              "transaction_value, quantity_item, transaction_id FROM curated)")))

O["city_category_top5"] = q(sel(
    "city, category, transaction_value*, gmv_share_pct*, rank_in_city",
    f"""(SELECT * FROM (SELECT g.*, (CASE WHEN sum(transaction_value) OVER (PARTITION BY city) <> 0
            THEN transaction_value / sum(transaction_value) OVER (PARTITION BY city) END) * 100.0 AS gmv_share_pct,
          row_number() OVER (PARTITION BY city ORDER BY transaction_value DESC, category) AS rank_in_city
        FROM (SELECT coalesce(city, 'Unknown') AS city, coalesce(category, 'Unknown') AS category,
                     {zs('transaction_value')} AS transaction_value FROM curated GROUP BY 1, 2) g)
      WHERE rank_in_city <= 5)"""))

# ---------------------------------------------------------------------------- customers
CCV = f"""ccv AS (SELECT * FROM (SELECT g.*,
      CASE WHEN quantity <> 0 THEN total_sales / quantity END AS unit_price FROM (
        SELECT contact_id, city, count_if(promo_flag) AS promotion_touches, {zs('quantity_item')} AS quantity,
          {zs('line_sales_value')} AS total_sales, {zs('line_original_value')} AS total_original
        FROM f1 GROUP BY 1, 2) g) WHERE unit_price IS NOT NULL)"""
O["customer_city_value"] = q(sel(
    "contact_id, city, promotion_touches, quantity*, total_sales*, total_original*, unit_price*", "ccv"), F1, CCV)
O["top_customers"] = q(sel(
    "contact_id, city, sales*, units*, promotion_touches",
    "(SELECT contact_id, city, total_sales AS sales, quantity AS units, promotion_touches FROM ccv "
    "ORDER BY total_sales DESC, contact_id, city LIMIT 10)"), F1, CCV)

COHORT = """pairs AS (SELECT DISTINCT contact_id, CAST(date_trunc('month', date_transaction) AS DATE) AS order_month
      FROM curated WHERE contact_id IS NOT NULL),
  cm AS (SELECT p.*, f.cohort_month,
      CAST((year(order_month) - year(cohort_month)) * 12 + (month(order_month) - month(cohort_month)) + 1 AS INTEGER)
        AS cohort_index
    FROM pairs p JOIN (SELECT contact_id, min(order_month) AS cohort_month FROM pairs GROUP BY 1) f USING (contact_id)),
  counts AS (SELECT cohort_month, cohort_index, count(*) AS c FROM cm GROUP BY 1, 2),
  sizes AS (SELECT cohort_month, c AS cohort_size FROM counts WHERE cohort_index = 1),
  ret AS (SELECT s.cohort_month, i.cohort_index,
      round_even(CAST(coalesce(c.c, 0) AS DOUBLE) / s.cohort_size, 3) AS retention
    FROM sizes s, (SELECT DISTINCT cohort_index FROM counts) i
    LEFT JOIN counts c ON c.cohort_month = s.cohort_month AND c.cohort_index = i.cohort_index)"""
O["cohort_retention"] = q(sel("cohort_month, cohort_index, retention*", "ret"), COHORT)
O["cohort_sizes"] = q("SELECT cohort_month, cohort_size FROM sizes", COHORT)
O["retention_curve"] = q(sel("cohort_month, cohort_index, retention*", "ret WHERE cohort_index <= 6"), COHORT)

RFM_DASH = f"""rfm0 AS (SELECT contact_id,
      CAST((SELECT max(date_transaction) FROM fl) + 1 - max(date_transaction) AS INTEGER) AS recency,
      count(transaction_id) AS frequency, {zs('transaction_value')} AS monetary,
      arg_min(latitude, CASE WHEN latitude IS NOT NULL THEN [s1, s2, s3, s4] END) AS latitude,
      arg_min(longitude, CASE WHEN longitude IS NOT NULL THEN [s1, s2, s3, s4] END) AS longitude,
      arg_min(city, CASE WHEN city IS NOT NULL THEN [s1, s2, s3, s4] END) AS city
    FROM fl WHERE contact_id IS NOT NULL GROUP BY 1),
  rfm1 AS (SELECT *, {qrs_sql('recency', 'contact_id', True)} AS r_score FROM rfm0),
  rfm2 AS (SELECT *, {qrs_sql('frequency', 'contact_id', False)} AS f_score FROM rfm1),
  rfm AS (SELECT *, {qrs_sql('monetary', 'contact_id', False)} AS m_score FROM rfm2),
  rfms AS (SELECT *, r_score + f_score + m_score AS rfm_score,
      CASE WHEN r_score + f_score + m_score <= 6 THEN 'At Risk' WHEN r_score + f_score + m_score <= 9 THEN 'Growth'
           WHEN r_score + f_score + m_score <= 12 THEN 'Loyal' ELSE 'Champions' END AS segment FROM rfm)"""
O["rfm_dashboard"] = q(sel(
    "contact_id, recency, frequency, monetary*, latitude*, longitude*, city, r_score, f_score, m_score, rfm_score",
    "rfms"), F1, fl("f1"), RFM_DASH)
O["rfm_segments"] = q(sel(
    "segment, customers, avg_r*, avg_f*, avg_m*, revenue*",
    f"""(SELECT l.segment, coalesce(g.customers, 0) AS customers, g.avg_r, g.avg_f, g.avg_m,
        coalesce(g.revenue, 0.0) AS revenue
      FROM (VALUES ('At Risk'), ('Growth'), ('Loyal'), ('Champions')) l(segment)
      LEFT JOIN (SELECT segment, count(*) AS customers, avg(r_score) AS avg_r, avg(f_score) AS avg_f,
                        avg(m_score) AS avg_m, {zs('monetary')} AS revenue FROM rfms GROUP BY 1) g USING (segment))"""),
    F1, fl("f1"), RFM_DASH)
O["rfm_score_distribution"] = q("SELECT rfm_score, count(*) AS customers FROM rfms GROUP BY 1", F1, fl("f1"), RFM_DASH)
O["rfm_by_location"] = q(sel(
    "latitude*, longitude*, city, avg_rfm_score*",
    "(SELECT latitude, longitude, city, avg(rfm_score) AS avg_rfm_score FROM rfms "
    "WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3)"), F1, fl("f1"), RFM_DASH)

RFM_REP = f"""per_tx AS (SELECT contact_id, transaction_id, max(date_transaction) AS tx_date,
      {zs('line_sales_value')} AS gmv FROM curated GROUP BY 1, 2),
  base AS (SELECT contact_id,
      CAST((SELECT max(date_transaction) FROM curated) - max(tx_date) AS INTEGER) AS recency,
      count(*) AS frequency, {zs('gmv')} AS monetary, max(tx_date) AS last_purchase FROM per_tx GROUP BY 1),
  {quantiles_cte('qr', 'base', 'recency', [0.2, 0.4, 0.6, 0.8], ['a', 'b', 'c', 'd'])},
  {quantiles_cte('qf', 'base', 'frequency', [0.2, 0.4, 0.6, 0.8], ['a', 'b', 'c', 'd'])},
  {quantiles_cte('qm', 'base', 'monetary', [0.2, 0.4, 0.6, 0.8], ['a', 'b', 'c', 'd'])},
  scored AS (SELECT base.*,
      CASE WHEN recency <= qr.a THEN 5 WHEN recency <= qr.b THEN 4 WHEN recency <= qr.c THEN 3
           WHEN recency <= qr.d THEN 2 ELSE 1 END AS r,
      CASE WHEN frequency <= qf.a THEN 1 WHEN frequency <= qf.b THEN 2 WHEN frequency <= qf.c THEN 3
           WHEN frequency <= qf.d THEN 4 ELSE 5 END AS f,
      CASE WHEN monetary <= qm.a THEN 1 WHEN monetary <= qm.b THEN 2 WHEN monetary <= qm.c THEN 3
           WHEN monetary <= qm.d THEN 4 ELSE 5 END AS m
    FROM base, qr, qf, qm),
  rep AS (SELECT *, CAST(r AS VARCHAR) || CAST(f AS VARCHAR) || CAST(m AS VARCHAR) AS rfm_score,
      CASE WHEN r + f + m >= 12 THEN 'Champions' WHEN r + f + m >= 9 THEN 'Loyal'
           WHEN r + f + m >= 6 THEN 'Potentials' ELSE 'At Risk' END AS rfm_segment FROM scored)"""
O["rfm_report"] = q(sel(
    "contact_id, recency, frequency, monetary*, last_purchase, CAST(r AS INTEGER) AS r, CAST(f AS INTEGER) AS f, "
    "CAST(m AS INTEGER) AS m, rfm_score, rfm_segment", "rep"), RFM_REP)
O["rfm_report_segments"] = q(sel(
    "rfm_segment, customers, avg_recency*, avg_frequency*, avg_monetary*, gmv*, customer_share_pct*, gmv_share_pct*",
    f"""(SELECT g.*, customers / (SELECT sum(customers) FROM g) * 100.0 AS customer_share_pct,
        (CASE WHEN (SELECT {zs('gmv')} FROM g) <> 0 THEN gmv / (SELECT {zs('gmv')} FROM g) END) * 100.0
          AS gmv_share_pct FROM g)"""),
    RFM_REP, f"""g AS (SELECT rfm_segment, count(DISTINCT contact_id) AS customers, avg(recency) AS avg_recency,
        avg(frequency) AS avg_frequency, avg(monetary) AS avg_monetary, {zs('monetary')} AS gmv FROM rep GROUP BY 1)""")
O["rfm_segment_category"] = q(sel(
    "rfm_segment, category, gmv*, orders, gmv_share_pct*",
    """(SELECT g.*, CASE WHEN sum(gmv) OVER (PARTITION BY rfm_segment) <> 0
          THEN gmv / sum(gmv) OVER (PARTITION BY rfm_segment) * 100.0 ELSE 0.0 END AS gmv_share_pct FROM g)"""),
    RFM_REP, f"""g AS (SELECT rfm_segment, coalesce(c.category, 'Unknown') AS category,
        {zs('line_sales_value')} AS gmv, count(DISTINCT transaction_id) AS orders
      FROM curated c JOIN rep USING (contact_id) GROUP BY 1, 2)""")
O["recency_buckets"] = q(sel(
    "recency_bucket, bucket_order, customers, gmv*, customer_share_pct*",
    """(SELECT o.*, (CASE WHEN (SELECT sum(customers) FROM o) <> 0
          THEN customers / (SELECT sum(customers) FROM o) END) * 100.0 AS customer_share_pct FROM o)"""),
    RFM_REP, f"""o AS (SELECT l.recency_bucket, l.bucket_order, coalesce(g.customers, 0) AS customers,
        coalesce(g.gmv, 0.0) AS gmv
      FROM (VALUES ('0-30 days', 0), ('31-60', 1), ('61-90', 2), ('91-180', 3), ('181-365', 4), ('365+', 5))
           l(recency_bucket, bucket_order)
      LEFT JOIN (SELECT CASE WHEN recency > 0 AND recency <= 30 THEN '0-30 days'
                             WHEN recency > 30 AND recency <= 60 THEN '31-60'
                             WHEN recency > 60 AND recency <= 90 THEN '61-90'
                             WHEN recency > 90 AND recency <= 180 THEN '91-180'
                             WHEN recency > 180 AND recency <= 365 THEN '181-365'
                             WHEN recency > 365 THEN '365+' END AS recency_bucket,
                        count(DISTINCT contact_id) AS customers, {zs('monetary')} AS gmv
                 FROM rep GROUP BY 1) g USING (recency_bucket))""")

# ---------------------------------------------------------------------------- statistics
ROLLUP = f"""tx AS (SELECT transaction_id, {zs('transaction_value')} AS transaction_value,
      {zs('quantity_item')} AS quantity_item, bool_or(promo_flag) AS promo_flag FROM curated GROUP BY 1),
  mom AS (SELECT count_if(NOT promo_flag) AS n0, count_if(promo_flag) AS n1,
      avg(CASE WHEN NOT promo_flag THEN transaction_value END) AS mean0,
      avg(CASE WHEN promo_flag THEN transaction_value END) AS mean1,
      var_samp(CASE WHEN NOT promo_flag THEN transaction_value END) AS var0,
      var_samp(CASE WHEN promo_flag THEN transaction_value END) AS var1
    FROM tx WHERE transaction_value IS NOT NULL AND promo_flag IS NOT NULL)"""
O["transaction_rollup"] = q(sel("transaction_id, transaction_value*, quantity_item*, promo_flag", "tx"), ROLLUP)
def t_tail(t: str, dof: str) -> str:
    """Two-sided p of Student's t by Simpson's rule on the density."""
    n, h = 24000, 0.0025
    f = f"exp(-({dof} + 1) / 2.0 * ln(1.0 + pow(abs({t}) + i * {h}, 2) / {dof}))"
    return f"""(SELECT least(1.0, 2.0 * exp(lgamma(({dof} + 1) / 2.0) - lgamma({dof} / 2.0)) / sqrt({dof} * pi()) * {h} / 3.0
        * sum(CASE WHEN i = 0 OR i = {n} THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END * {f})) FROM range({n + 1}) r(i))"""


O["promo_regression"] = q(sel(
    "term, coef*, std_err*, t*, p_value*",
    f"""(SELECT term, coef, std_err, t, {t_tail('t', 'dof')} AS p_value FROM (
      SELECT term, coef, std_err, dof, CASE WHEN std_err <> 0 THEN coef / std_err END AS t FROM (
      SELECT n0 + n1 - 2 AS dof, 'Intercept' AS term, CASE WHEN n0 > 0 AND n1 > 0 THEN mean0 ELSE coalesce(mean0, mean1) END AS coef,
        CASE WHEN n0 > 0 AND n1 > 0 THEN sqrt(s2 / n0) ELSE sqrt(s2 / (n0 + n1)) END AS std_err FROM m2
      UNION ALL
      SELECT n0 + n1 - 2, 'Promo_Flag', CASE WHEN n0 > 0 AND n1 > 0 THEN mean1 - mean0 END,
        CASE WHEN n0 > 0 AND n1 > 0 THEN sqrt(s2 * (1.0 / n0 + 1.0 / n1)) END FROM m2)))"""),
    ROLLUP, """m2 AS (SELECT *, (coalesce(var0, 0.0) * (n0 - 1) + coalesce(var1, 0.0) * (n1 - 1)) / (n0 + n1 - 2) AS s2
      FROM mom WHERE n0 + n1 - 2 > 0)""")
O["ab_test_promo"] = q(sel(
    "promo_mean*, nonpromo_mean*, lift*, t_stat*, dof*, p_value*",
    f"""(SELECT *, {t_tail('t_stat', 'dof')} AS p_value FROM (SELECT mean1 AS promo_mean, mean0 AS nonpromo_mean,
        CASE WHEN n0 > 0 AND n1 > 0 THEN mean1 - mean0 END AS lift,
        CASE WHEN n0 > 0 AND n1 > 0 AND var1 / n1 + var0 / n0 <> 0
             THEN (mean1 - mean0) / sqrt(var1 / n1 + var0 / n0) END AS t_stat,
        CASE WHEN n0 > 0 AND n1 > 0
             THEN (var1 / n1 + var0 / n0) * (var1 / n1 + var0 / n0)
                  / ((var1 / n1) * (var1 / n1) / (n1 - 1) + (var0 / n0) * (var0 / n0) / (n0 - 1)) END AS dof
      FROM mom))"""), ROLLUP)

QUART = quantiles_cte("qu", "ccv", "unit_price", [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
O["unit_price_quartiles"] = q(sel("q25*, q50*, q75*", "qu"), F1, CCV, QUART)
CONT = """cls AS (SELECT ccv.*, CASE WHEN unit_price <= q25 THEN 'Low Value' WHEN unit_price <= q75 THEN 'Medium Value'
        ELSE 'High Value' END AS customer_category,
      CASE WHEN promotion_touches > 0 THEN 'Used Promotion' ELSE 'No Promotion' END AS promotion_used FROM ccv, qu),
  cnt AS (SELECT customer_category, promotion_used, count(*) AS customers FROM cls GROUP BY 1, 2),
  cont AS (SELECT r.customer_category, c.promotion_used, coalesce(cnt.customers, 0) AS customers
    FROM (SELECT DISTINCT customer_category FROM cnt) r, (SELECT DISTINCT promotion_used FROM cnt) c
    LEFT JOIN cnt ON cnt.customer_category = r.customer_category AND cnt.promotion_used = c.promotion_used)"""
O["promo_usage_contingency"] = q("SELECT * FROM cont", F1, CCV, QUART, CONT)
O["promo_usage_crosstab"] = q(
    """SELECT customer_category, coalesce(sum(CASE WHEN promotion_used = 'No Promotion' THEN customers END), 0)
         AS "No Promotion",
       coalesce(sum(CASE WHEN promotion_used = 'Used Promotion' THEN customers END), 0) AS "Used Promotion"
       FROM cont GROUP BY 1""", F1, CCV, QUART, CONT)
O["chi_square_promo_usage"] = q(sel(
    "statistic*, dof, p_value*",
    """(SELECT statistic, dof, CASE WHEN dof = 2 THEN exp(-statistic / 2.0) END AS p_value FROM (
      SELECT sum((o - e) * (o - e) / e) AS statistic, any_value(dof) AS dof FROM (
        SELECT e, dof, customers + CASE WHEN dof = 1 THEN sign(e - customers) * least(0.5, abs(e - customers))
                                        ELSE 0.0 END AS o
        FROM (SELECT cont.customers, rt * ct / n AS e, (nr - 1) * (nc - 1) AS dof
              FROM cont JOIN (SELECT customer_category, sum(customers) AS rt FROM cont GROUP BY 1) USING (customer_category)
                        JOIN (SELECT promotion_used, sum(customers) AS ct FROM cont GROUP BY 1) USING (promotion_used),
                   (SELECT sum(customers) AS n, count(DISTINCT customer_category) AS nr,
                           count(DISTINCT promotion_used) AS nc FROM cont)
              WHERE nc = 2))))"""), F1, CCV, QUART, CONT)
O["box_plot_stats"] = q(sel(
    "q1*, median*, q3*, iqr*, whisker_low*, whisker_high*",
    """(SELECT q25 AS q1, q50 AS median, q75 AS q3, q75 - q25 AS iqr,
        (SELECT min(unit_price) FROM ccv WHERE unit_price >= q25 - 1.5 * (q75 - q25)) AS whisker_low,
        (SELECT max(unit_price) FROM ccv WHERE unit_price <= q75 + 1.5 * (q75 - q25)) AS whisker_high FROM qu)"""),
    F1, CCV, QUART)
O["transaction_value_histogram"] = q(sel(
    "bin, bin_start*, bin_end*, count",
    """(SELECT CAST(b.bin AS INTEGER) AS bin, lo + b.bin * 20.0 AS bin_start, lo + (b.bin + 1) * 20.0 AS bin_end,
        coalesce(c.cnt, 0) AS count
      FROM st, (SELECT range AS bin FROM range((SELECT nb FROM st))) b
      LEFT JOIN (SELECT least(CAST(floor((transaction_value - lo) / 20.0) AS BIGINT), nb - 1) AS bin, count(*) AS cnt
                 FROM fl, st WHERE transaction_value >= 0 GROUP BY 1) c ON c.bin = b.bin)"""),
    F1, fl("f1"), """st AS (SELECT lo, greatest(CAST(ceil((hi - lo + 20.0) / 20.0) AS BIGINT) - 1, 1) AS nb FROM
      (SELECT min(transaction_value) AS lo, max(transaction_value) AS hi FROM fl WHERE transaction_value >= 0))""")

# ---------------------------------------------------------------------------- quality, filters, sampling
_QCOLS = [("transaction_id", "object"), ("contact_id", "object"), ("promotion_id", "object"),
          ("transaction_value", "float64"), ("quantity_item", "float64"), ("latitude", "float64"),
          ("longitude", "float64"), ("city", "object"), ("category", "object")]
_qparts = []
for _c, _t in _QCOLS:
    _z = f"count_if({_c} = 0)" if _t == "float64" else "CAST(NULL AS BIGINT)"
    _qparts.append(f"""SELECT {len(_qparts)} AS _i, '{_c}' AS "column", '{_t}' AS dtype, count_if({_c} IS NULL) AS missing_count,
        round_even(count_if({_c} IS NULL) / count(*) * 100.0, 2) AS missing_pct, {_z} AS zero_count,
        count(DISTINCT {_c}) AS unique_values FROM f1 HAVING count(*) > 0""")
_RANKED = "(SELECT *, row_number() OVER (ORDER BY missing_pct DESC, _i) AS row_rank FROM ({}))"
_DQ_SPEC = '"column", dtype, missing_count, missing_pct*, zero_count, unique_values, row_rank'
O["data_quality"] = q(sel(_DQ_SPEC, _RANKED.format(" UNION ALL ".join(_qparts))), F1)

_TYPES = {"double": "float64", "date": "datetime64[ns]", "boolean": "bool", "int": "int32"}
_aparts = []
for _c in [x.strip() for x in CURATED_COLS.split(",")]:
    from kassa.plans.curated import CURATED_TYPES as _CT
    _t = _TYPES.get(_CT.get(_c, "string"), "object")
    if _t in ("float64", "int32"):
        _z = f"count_if({_c} = 0)"
    elif _t == "bool":
        _z = f"count_if(NOT {_c})"
    else:
        _z = "CAST(NULL AS BIGINT)"
    _aparts.append(f"""SELECT {len(_aparts)} AS _i, '{_c}' AS "column", '{_t}' AS dtype, count_if({_c} IS NULL) AS missing_count,
        round_even(count_if({_c} IS NULL) / count(*) * 100.0, 2) AS missing_pct, {_z} AS zero_count,
        count(DISTINCT {_c}) AS unique_values FROM curated HAVING count(*) > 0""")
O["data_quality_all"] = q(sel(_DQ_SPEC, _RANKED.format(" UNION ALL ".join(_aparts))))

_FILTER = ("f2 AS (SELECT * FROM f1 WHERE year IN (1996, 1997) AND quarter IN (1, 2, 4) "
           "AND days_since_epoch BETWEEN 9500 AND 10100 AND city IN ('Calgary', 'Edmonton', 'Online', 'Leduc'))")
O["filtered_highlights"] = q(sel(_HL_SPEC, _HIGHLIGHTS("f2")), F1, _FILTER, fl("f2"), _CTY("f2"))
O["facet_cities"] = q("SELECT DISTINCT city FROM f1 WHERE city IS NOT NULL", F1)
O["sample_transactions"] = q(
    f"SELECT {_rcols(CURATED_COLS, _CUR_DOUBLES)} FROM curated WHERE transaction_id IN (SELECT transaction_id FROM ("
    "SELECT transaction_id, row_number() OVER (PARTITION BY m ORDER BY sha1(transaction_id), transaction_id) AS rn FROM "
    "(SELECT DISTINCT CAST(date_trunc('month', date_transaction) AS DATE) AS m, transaction_id FROM curated)) "
    "WHERE rn <= 20)")

# ---------------------------------------------------------------------------- raw-table jobs
O["store_lookup"] = q(sel(
    "store_key, new_id, new_name, new_city, latitude*, longitude*, postal",
    f"(SELECT skey AS store_key, new_id, new_name, new_city, lat AS latitude, lon AS longitude, "
    f"{_postal('new_id')} AS postal FROM store_lookup)"))
O["store_opening_trend"] = q("""SELECT CAST(year(d) AS INTEGER) AS year, count(*) AS openings, row_number() OVER (ORDER BY year(d)) AS row_rank FROM
    (SELECT TRY_CAST(OPEN_DATE AS DATE) AS d FROM raw_store) WHERE d IS NOT NULL GROUP BY year(d)""")
O["web_account_share"] = q(sel("has_web_account, contacts, share*", """(SELECT has_web_account, contacts,
    contacts / sum(contacts) OVER () AS share FROM (SELECT upper(coalesce(Has_Web_Account, 'nan')) AS has_web_account,
    count(*) AS contacts FROM raw_contact GROUP BY 1))"""))
O["promotion_timeline"] = q("""SELECT CAST(m AS DATE) AS month, count(DISTINCT PROMO_ID) AS active_promotions FROM (
    SELECT PROMO_ID, unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM (
      SELECT PROMO_ID, CAST(date_trunc('month', TRY_CAST(START_DATE AS DATE)) AS DATE) AS s,
             CAST(date_trunc('month', coalesce(TRY_CAST(END_DATE AS DATE), DATE '2000-01-01')) AS DATE) AS e
      FROM raw_promo) WHERE s IS NOT NULL AND s <= e) GROUP BY 1""")
O["cohort_retention_matrix"] = q(f"SELECT * FROM (PIVOT (SELECT cohort_month, cohort_index, {R('retention')} AS r FROM ret) "
                                 "ON cohort_index USING max(r) GROUP BY cohort_month)", COHORT)
O["curated_from_month_files"] = O["curated_sales"]
O["short_transaction_ids"] = q("""SELECT a.d AS identifier,
    substr(a.d, 1, coalesce(max(list_max(list_filter(range(1, 44), lambda n: a.d[1:n] = b.d[1:n]))) + 1, 11)) AS short
    FROM ids a LEFT JOIN ids b ON substr(a.d, 1, 11) = substr(b.d, 1, 11) AND a.d <> b.d GROUP BY a.d""",
                                "ids AS (SELECT DISTINCT transaction_id AS d FROM curated)")
O["available_months"] = q("SELECT DISTINCT substr(Date_transaction, 1, 6) AS month FROM raw_sales")
O["pipeline_chosen_months"] = O["monthly_sales_series"].replace(
    F1, "f1 AS (SELECT * FROM curated WHERE year * 100 + month IN (199601, 199602, 199607, 199711))")
_CHOSEN = "year * 100 + month IN (199601, 199602, 199711)"
O["partials_highlights"] = O["highlights"].replace(F1, F1.replace("WHERE ", f"WHERE {_CHOSEN} AND "))
O["partials_monthly_kpi"] = O["monthly_kpi_summary"]
O["partials_sales_series"] = O["monthly_sales_series"]
O["partials_store_deep_dive"] = O["store_deep_dive"].replace("FROM typed WHERE d IS NOT NULL)",
                                                             "FROM typed WHERE d IS NOT NULL AND year(d) * 100 + month(d) IN (199601, 199602, 199711))")
_DIM_KEYS = (("contact", "raw_contact", "Contact_ID", "Contact_ID"), ("item", "raw_item", "SKU", "Item_ID"),
             ("promotion", "raw_promo", "PROMO_ID", "Promotion_ID"), ("store", "raw_store", "STORE_ID", "Store_transaction_ID"))
O["sample_extract"] = q(
    "SELECT 'sales' AS table_name, Transaction_ID AS key, count(*) AS n_rows FROM sampled GROUP BY 2" + "".join(
        f" UNION ALL SELECT '{n}', {k}, count(*) FROM {t} WHERE {_norm(k)} IN (SELECT {_norm(f)} FROM sampled) GROUP BY 2" for n, t, k, f in _DIM_KEYS),
    """dated AS (SELECT *, try_strptime(Date_transaction, '%Y%m%d') AS day FROM raw_sales),
    sampled AS (SELECT * FROM dated WHERE day IS NOT NULL AND Transaction_ID IN (SELECT Transaction_ID FROM (
      SELECT Transaction_ID, row_number() OVER (PARTITION BY m ORDER BY sha1(Transaction_ID), Transaction_ID) AS rn
      FROM (SELECT DISTINCT date_trunc('month', day) AS m, Transaction_ID FROM dated WHERE day IS NOT NULL)) WHERE rn <= 20))""")
O["filtered_lines"] = q(sel("transaction_id, item_id, month, category, store_name, quantity_item*", """(SELECT * FROM f1
    WHERE month IN (1, 2, 3, 7, 11)
      AND category IN ('ECONOMY', 'STANDARD', 'PROMO', 'SMALL')
      AND store_name IN ('AB Store 002 - Edmonton', 'AB Store 004 - Lethbridge', 'AB Store 008 - Airdrie', 'Alberta Online Store 01'))"""), F1)
O["filtered_items"] = q(sel("item_id, year, month, units*, lines", f"""(SELECT item_id, year, month, {zs('quantity_item')} AS units, count(*) AS lines
    FROM f1 WHERE item_id IN (SELECT 'ITEM' || upper(sha1(CAST(i AS VARCHAR))) FROM (VALUES (1), (5), (17), (42), (99), (150)) t(i)) GROUP BY 1, 2, 3)"""), F1)
_STEPS = [("year", "year IN (1996, 1997)"), ("quarter", "quarter IN (1, 2, 4)"), ("month", None), ("days", "days_since_epoch BETWEEN 9500 AND 10100"),
          ("category", None), ("item_id", None), ("city", "city IN ('Calgary', 'Edmonton', 'Online', 'Leduc')"), ("store_name", None)]
_facets, _passed = [], "TRUE"
for _c, _w in _STEPS:
    if _c == "days":
        _facets += [f"SELECT '{_n}' AS facet, NULL AS value, min(days_since_epoch) AS low, max(days_since_epoch) AS high FROM f1 WHERE {_p}"
                    for _n, _p in (("day_bounds", "TRUE"), ("day_default", _passed))]
    else:
        _v = short(_c) if _c in PREFIXES else f"CAST({_c} AS VARCHAR)"
        _facets.append(f"SELECT '{_c}', {_v}, NULL, NULL FROM (SELECT DISTINCT {_c} FROM f1 WHERE {_passed} AND {_c} IS NOT NULL)")
    _passed += f" AND {_w}" if _w else ""
_facets.sort(key=lambda x: "AS facet" not in x)
O["sidebar_facets"] = q(" UNION ALL ".join(_facets), F1)
