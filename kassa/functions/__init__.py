"""Column -> Column helpers; all JVM-side built-ins (no Python UDF)."""
from kassa.functions.clean import (  # noqa: F401
    strip, normalise_identifier, coerce_numeric, to_number, parse_yyyymmdd, parse_iso_date,
    truthy, safe_ratio, clip_at_zero, month_start, ceil_div,
)
from kassa.functions.privacy import hashed_token, hashed_postal, pseudonymise  # noqa: F401
