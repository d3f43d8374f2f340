"""Images inside binary columns: where they start, what format they have, and a manifest of them.

Everything is expressed on columns. Bytes are viewed as ISO-8859-1 text, one character per
byte, so that text search finds binary signatures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# File signatures, the file extension of each format and header limits.
SIGNATURES = (
    ("89504E470D0A1A0A", "png"),
    ("FFD8FF", "jpeg"),
    ("474946383761", "gif"),
    ("474946383961", "gif"),
)
BMP_SIGNATURE = "424D"
JPEG_END = "FFD9"
EXTENSIONS = {"png": "png", "jpeg": "jpg", "gif": "gif", "bmp": "bmp", "unknown": "bin"}
SMALLEST_BMP = 26
BMP_HEADER = 18
DIB_HEADER_SIZES = (12, 124)
SMALLEST_PIXEL_OFFSET = 14

DATA_LAKE = "/data-lake"


def _characters(digits: str) -> Column:
    return F.lit(bytes.fromhex(digits).decode("iso-8859-1"))


def _little_endian(header: Column, start: int) -> Column:
    """Unsigned 32-bit number at a byte position of a header given as hex digits."""
    pair = [F.substring(header, 2 * (start + i) + 1, 2) for i in (3, 2, 1, 0)]
    return F.conv(F.concat(*pair), 16, 10).cast("long")


def _header(payload: Column, offset: Column) -> Column:
    return F.hex(F.substr(payload, (offset + 1).cast("int"), F.lit(BMP_HEADER)))


def _bmp_offset(payload: Column, window: Column) -> Column:
    """Offset of the first BMP signature in the window with a valid header."""
    pieces = F.split(window, "BM", -1)
    running = F.aggregate(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        F.struct(F.lit(0).alias("next"), F.lit(None).cast("int").alias("found")),
        lambda state, piece: F.struct(
            (state["next"] + F.length(piece) + 2).alias("next"),
            F.when(state["found"].isNotNull(), state["found"])
            .when(_is_bmp(payload, state["next"] + F.length(piece)), state["next"] + F.length(piece))
            .alias("found"),
        ),
    )
    return running["found"]


def _is_bmp(payload: Column, offset: Column) -> Column:
    available = F.octet_length(payload) - offset
    header = _header(payload, offset)
    declared, pixels, dib = (_little_endian(header, start) for start in (2, 10, 14))
    return (
        (available >= BMP_HEADER)
        & (pixels >= SMALLEST_PIXEL_OFFSET)
        & (pixels < available)
        & dib.between(*DIB_HEADER_SIZES)
        & (declared >= SMALLEST_BMP)
        & (declared <= available)
    )


def carve_images(rows: DataFrame, payload: str, search_window: int | None = None) -> DataFrame:
    """Add `format`, `extension`, `signature_offset` and the carved `image` of a binary column.

    The signature that starts first wins; with `search_window` only the first so many bytes are searched. A BMP ends at its declared
    size, a JPEG at its first end marker, other formats with the payload. Without a signature the
    whole payload is kept as `unknown`. NULL and empty payloads have no format.
    """
    data = F.col(payload)
    window = F.decode(data if search_window is None else F.substring(data, 1, search_window), "ISO-8859-1")
    starts = [
        F.struct(F.nullif(F.instr(window, _characters(digits)) - 1, F.lit(-1)).alias("offset"), F.lit(name).alias("format"))
        for digits, name in SIGNATURES
    ]
    starts.append(F.struct(_bmp_offset(data, window).alias("offset"), F.lit("bmp").alias("format")))
    found = F.array_min(F.filter(F.array(*starts), lambda s: s["offset"].isNotNull()))
    located = rows.withColumn("_found", found).withColumns(
        {
            "format": F.when(F.octet_length(data) > 0, F.coalesce("_found.format", F.lit("unknown"))),
            "signature_offset": F.when(F.octet_length(data) > 0, F.coalesce("_found.offset", F.lit(0))),
        }
    )
    rest_length = F.octet_length(data) - F.col("signature_offset")
    rest = F.substr(data, F.col("signature_offset") + 1, rest_length)
    declared = _little_endian(_header(data, F.col("signature_offset")), 2)
    end = F.locate(bytes.fromhex(JPEG_END).decode("iso-8859-1"), F.decode(rest, "ISO-8859-1"), 4)
    length = (
        F.when(F.col("format") == "bmp", declared)
        .when((F.col("format") == "jpeg") & (end > 0), end + 1)
        .otherwise(rest_length)
    )
    extension = F.create_map(*[F.lit(part) for item in EXTENSIONS.items() for part in item])[F.col("format")]
    return located.withColumns(
        {
            "extension": extension,
            "image": F.substr(data, F.col("signature_offset") + 1, length.cast("int")),
        }
    ).drop("_found")


def asset_manifest(carved: DataFrame, key: str, payload: str, folder: str, carried=()) -> DataFrame:
    """One entry per payload: paths, format, offset, sizes and digests of source and image."""
    stem = F.concat(F.lit("/employee_"), F.col(key).cast("string"), F.lit("."))
    return carved.where(F.octet_length(payload) > 0).select(
        key,
        *carried,
        F.concat(F.lit(f"{DATA_LAKE}/raw/{folder}"), stem, F.lit("bin")).alias("raw_path"),
        F.concat(F.lit(f"{DATA_LAKE}/curated/{folder}"), stem, "extension").alias("curated_path"),
        "format",
        "signature_offset",
        F.octet_length(payload).alias("source_bytes"),
        F.octet_length("image").alias("curated_bytes"),
        F.sha2(payload, 256).alias("source_sha256"),
        F.sha2("image", 256).alias("sha256"),
    )


def asset_counts(carved: DataFrame, payload: str) -> DataFrame:
    """Counts of the manifest head."""
    given = F.coalesce(F.octet_length(payload), F.lit(0)) > 0
    return carved.agg(
        F.count("*").alias("asset_rows"),
        F.count_if(given).alias("raw_photos"),
        F.count_if(given & (F.col("format") != "unknown")).alias("curated_images"),
        F.count_if(~given).alias("missing_photos"),
        F.count_if(given & (F.col("format") == "unknown")).alias("unknown_formats"),
    )


def assets_accepted(counts: DataFrame) -> DataFrame:
    """True when every row has a recognised image."""
    rows = F.col("asset_rows")
    complete = (F.col("raw_photos") == rows) & (F.col("curated_images") == rows)
    return counts.select("*", complete.alias("passed"))
