"""Text cleaning, surrogate keys and change-detection hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These must stay the same for keys and hashes to be comparable between loads.
NULL_TOKEN = "<NULL>"
HASH_SEPARATOR = "||"
LARGEST_KEY = 9223372036854775806

# How a surrogate key is hashed. "sha2" is slower, but any SQL engine can recompute it.
KEY_METHODS = ("xxhash64", "sha2")


def canonical(value: Column) -> Column:
    """Trimmed text of any value, with a token in the place of NULL."""
    return F.coalesce(F.trim(value.cast("string")), F.lit(NULL_TOKEN))


def clean_text(value: Column) -> Column:
    """Trimmed text; blank text counts as NULL."""
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def base64_text(data: Column) -> Column:
    """Bytes as base64 on one line; empty text for NULL."""
    return F.coalesce(F.translate(F.base64(data), "\r\n", ""), F.lit(""))


def content_hash(*values: Column) -> Column:
    """SHA-256 over the canonical values, used to see whether a row changed."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *map(canonical, values)), 256)


def surrogate_key(namespace: str, *values: Column, method: str = "xxhash64") -> Column:
    """Deterministic key in 1..2^63-1 from a namespace and the canonical values."""
    parts = [F.lit(namespace), *map(canonical, values)]
    if method == "xxhash64":
        hashed = F.pmod(F.xxhash64(*parts), F.lit(LARGEST_KEY))
    elif method == "sha2":
        digest = F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)
        hashed = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    else:
        raise ValueError(f"unknown key method {method!r}, use one of {KEY_METHODS}")
    return (hashed + 1).cast("long")


def geography_key(
    country: Column,
    region: Column,
    city: Column,
    postal_code: Column,
    address: Column,
    method: str = "xxhash64",
) -> Column:
    """Key of an address. Cleans first, so blank and NULL parts give the key the dimension row has."""
    parts = map(clean_text, (country, region, city, postal_code, address))
    return surrogate_key("geography", *parts, method=method)
