"""Log sequence numbers as fixed-width text, and operation names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the change-capture format.
OPERATION_NAMES = {1: "DELETE", 2: "INSERT", 3: "UPDATE_BEFORE", 4: "UPDATE_AFTER"}
DELETE, INSERT, UPDATE_BEFORE, UPDATE_AFTER = OPERATION_NAMES
UNKNOWN_OPERATION = "UNKNOWN"
LSN_PREFIX = "0x"


def lsn_to_text(lsn: Column) -> Column:
    """Binary LSN as 0x and upper-case hex digits; text order equals numeric order."""
    return F.concat(F.lit(LSN_PREFIX), F.hex(lsn))


def text_to_lsn(text: Column) -> Column:
    """Inverse of `lsn_to_text`; the prefix is optional and blank text is NULL."""
    digits = F.regexp_replace(text, "^0[xX]", "")
    return F.unhex(F.nullif(digits, F.lit("")))


def operation_name(code: Column) -> Column:
    pairs = [F.lit(part) for item in OPERATION_NAMES.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code.cast("int")), F.lit(UNKNOWN_OPERATION))
