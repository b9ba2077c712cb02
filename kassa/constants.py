"""Fixed values.

The values below must equal the reference's for identical output (city
remapping, pseudonym prefixes, missing-value tokens, boolean tokens). They are
stated plainly, in natural order.
"""

# --- fixed values: remap target cities (name, latitude, longitude) -------------
ALBERTA_CITIES = (
    ("Calgary", 51.0447, -114.0719),
    ("Edmonton", 53.5461, -113.4938),
    ("Red Deer", 52.2681, -113.8112),
    ("Lethbridge", 49.6956, -112.8450),
    ("St. Albert", 53.6305, -113.6256),
    ("Medicine Hat", 50.0405, -110.6765),
    ("Grande Prairie", 55.1707, -118.7947),
    ("Airdrie", 51.2917, -114.0144),
    ("Spruce Grove", 53.5464, -113.9187),
    ("Leduc", 53.2597, -113.5569),
    ("Okotoks", 50.7240, -113.9720),
    ("Fort McMurray", 56.7260, -111.3790),
    ("Banff", 51.1784, -115.5708),
    ("Canmore", 51.0890, -115.3595),
    ("Brooks", 50.5649, -111.8980),
    ("Camrose", 53.0167, -112.8200),
    ("Chestermere", 51.0379, -113.8225),
    ("Lloydminster", 53.2784, -110.0054),
    ("Sherwood Park", 53.5444, -113.3198),
    ("Wetaskiwin", 52.9692, -113.3761),
)

# --- fixed values: identifier tokens treated as missing ------------------------
MISSING_ID_TOKENS = ("", "na", "nan", "none", "null")

# --- fixed values: CSV cells that pandas reads as missing ----------------------
MISSING_CELL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                       "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# --- fixed values: tokens read as a true boolean --------------------------------
TRUE_TOKENS = ("1", "true", "yes", "y")

# --- fixed values: pseudonym prefix per raw column -----------------------------
ID_HASH_PREFIXES = (
    ("Transaction_ID", "TRX"),
    ("Contact_ID", "CUST"),
    ("Item_ID", "ITEM"),
    ("Promotion_ID", "PROMO"),
    ("PROMO_ID", "PROMO"),
    ("SKU", "SKU"),
    ("EAN", "EAN"),
    ("LIBELLE_x", "OFFER"),
)
STORE_FALLBACK_PREFIX = "ST"
STORE_NAME_FALLBACK_PREFIX = "ABSTORE"
STORE_NAME_FALLBACK_SEED = "Store"
ONLINE_NAME_MARKERS = ("ecom", "online")
ONLINE_CITY = "Online"
DEFAULT_PROVINCE = "AB"
DEFAULT_COUNTRY = "CAN"
# the same by curated column, with the fallbacks of unknown stores
PSEUDONYM_PREFIXES = (
    ("transaction_id", "TRX"),
    ("contact_id", "CUST"),
    ("item_id", "ITEM"),
    ("promotion_id", "PROMO"),
    ("promo_id", "PROMO"),
    ("sku", "SKU"),
    ("ean", "EAN"),
    ("promo_label", "OFFER"),
    ("store_id", STORE_FALLBACK_PREFIX),
    ("store_name", STORE_NAME_FALLBACK_PREFIX),
    ("store_of_creation", STORE_FALLBACK_PREFIX),
)

# --- fixed values: masked store identities ----------------------------------------
STORE_ID_FORMAT = "AB%03d"
ONLINE_STORE_ID_FORMAT = "ABWEB%02d"
STORE_NAME_FORMAT = "AB Store %03d - %s"
ONLINE_STORE_NAME_FORMAT = "Alberta Online Store %02d"

# --- fixed values: masked postal code (first letter, then digit/letter from sha1) -
POSTAL_PREFIX = "T"
POSTAL_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# --- fixed values: labels --------------------------------------------------------
UNKNOWN_LABEL = "Unknown"
UNSPECIFIED_PROMO_LABEL = "Unspecified promo"
PROMO_LABELS = {True: "With Promotion", False: "No Promotion"}
DASHBOARD_SEGMENTS = ("At Risk", "Growth", "Loyal", "Champions")
REPORT_SEGMENTS = ("Champions", "Loyal", "Potentials", "At Risk")
RECENCY_BUCKETS = (
    ("0-30 days", 0, 30),
    ("31-60", 30, 60),
    ("61-90", 60, 90),
    ("91-180", 90, 180),
    ("181-365", 180, 365),
    ("365+", 365, None),
)
VALUE_CLASSES = ("Low Value", "Medium Value", "High Value")
PROMO_USE_LABELS = ("No Promotion", "Used Promotion")
