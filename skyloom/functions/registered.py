"""SQL functions for sessions: Catalyst inlines them, nothing runs outside the JVM."""

from __future__ import annotations

from pyspark.sql import SparkSession

from skyloom.functions.names import FILTERS, PREFIXES, UNKNOWN

_FILTER_MAP = "map(" + ", ".join("'" + s.replace("'", "\\'") + "', '" + short.replace("'", "\\'") + "'" for short, spellings in FILTERS.items() for s in spellings) + ")"

FUNCTIONS = {
    "haversine_arcsec": """(ra1 DOUBLE, dec1 DOUBLE, ra2 DOUBLE, dec2 DOUBLE) RETURNS DOUBLE RETURN
        2e0 * degrees(asin(sqrt(least(1e0, sin(radians(dec2 - dec1) / 2e0) * sin(radians(dec2 - dec1) / 2e0)
        + cos(radians(dec1)) * cos(radians(dec2)) * sin(radians(ra2 - ra1) / 2e0) * sin(radians(ra2 - ra1) / 2e0))))) * 3.6e3""",
    "normalize_object_name": rf"""(raw STRING) RETURNS STRING RETURN CASE WHEN coalesce(trim(raw), '') = '' THEN '{UNKNOWN}'
        WHEN trim(raw) RLIKE r'(?i)^[MC][_\s\-]*\d+$' THEN concat(upper(left(trim(raw), 1)), regexp_extract(trim(raw), r'(\d+)$', 1))
        WHEN trim(raw) RLIKE r'(?i)^SH2?[_\s\-]*\d+$' THEN concat('SH2-', regexp_extract(trim(raw), r'(?i)^SH2?[_\s\-]*(\d+)$', 1))
        WHEN trim(raw) RLIKE r'(?i)^ABELL[_\s\-]*\d+$' THEN concat('Abell', regexp_extract(trim(raw), r'(\d+)$', 1))
        WHEN trim(raw) RLIKE r'(?i)^({"|".join(PREFIXES)})[_\s\-]*\d+([_\s\-]\d+)*$' THEN upper(regexp_replace(trim(raw), r'[_\s\-]', ''))
        ELSE coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(replace(trim(raw), ' ', '_'), r'[^A-Za-z0-9_\-+]', ''), '_+', '_'), '^_+|_+$', ''), ''), '{UNKNOWN}') END""",
    "sky_tile": "(angle DOUBLE) RETURNS DOUBLE RETURN rint(angle / 1e-1) * 1e-1",
    "wrap180": "(angle DOUBLE) RETURNS DOUBLE RETURN -(pmod(-angle + 18e1, 36e1) - 18e1)",
    "normalize_filter": rf"(raw STRING) RETURNS STRING RETURN coalesce(try_element_at({_FILTER_MAP}, lower(nullif(trim(raw), ''))), try_element_at({_FILTER_MAP}, lower(regexp_replace(trim(raw), r'(?i)\s*filter$', ''))), nullif(trim(raw), ''))",
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to the session for SQL text; returns their names."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return sorted(FUNCTIONS)
