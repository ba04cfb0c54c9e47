"""Mapping rules from source codes to target values, one expression per rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordferry.functions.text import concat_nulls_empty, path_extension

# ---- fixed values: they must equal the migrated system's codes ----------------
STATE_CODES = {
    1: 48, 2: 22, 3: 55, 4: 35, 5: 40, 60: 1, 62: 5, 63: 7, 64: 8, 66: 10, 74: 20, 79: 26,
    81: 28, 83: 30, 85: 32, 90: 38, 91: 39, 92: 41, 93: 43, 96: 46, 98: 49, 101: 52, 102: 53,
}
INSTRUMENT_CODES = {
    0: "OGL", 1: "MOGL", 2: "OP", 3: "SOP", 4: "SMEM", 5: "REOGL", 6: "OGL", 7: "OGLEXT",
    8: "SPER", 9: "ROGL", 10: "OGLAMD", 11: "ASN", 12: "MD", 13: "RD",
}
DEPTH_CODES = {0: "All", 1: "FromTo", 2: "SurfaceTo", 3: "DeeperThan", 255: "No Data"}
LONG_TERMS = {600: 50, 1188: 99}  # months -> years, outside the regular range
REGULAR_TERM = (12, 371)          # months that map to whole years
FILE_EXTENSIONS = (".pdf", ".jpg", ".tif")  # the first one found in the name wins
URI_SCHEME = "s3://"
# --------------------------------------------------------------------------------


def code_map(c: Column, codes: dict) -> Column:
    """Look a code up in a small constant map; unknown codes give NULL."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c.cast("int"))


def state_code(c: Column) -> Column:
    return code_map(c, STATE_CODES)


def instrument_code(c: Column) -> Column:
    return code_map(c, INSTRUMENT_CODES)


def depth_type(c: Column) -> Column:
    return code_map(c, DEPTH_CODES)


def term_years(months: Column) -> Column:
    """Term in whole years; months outside the known terms give NULL."""
    years = F.when(months == 0, 0).when(
        months.between(*REGULAR_TERM), F.floor(months / 12).cast("int"))
    return reduce(lambda acc, kv: acc.when(months == kv[0], kv[1]), LONG_TERMS.items(), years)


def area_missing_flag(acres: Column) -> Column:
    return F.when(acres.isNull(), -1).otherwise(0)


def extension_flag(months: Column) -> Column:
    """0 only for an explicit zero; an unknown extension counts as one."""
    return F.when(months == 0, 0).otherwise(1)


def extension_unit(months: Column) -> Column:
    return F.when(months >= 1, "Months")


def file_extension(name: Column) -> Column:
    low = F.lower(name)
    found = [F.when(low.contains(ext), ext) for ext in FILE_EXTENSIONS]
    return F.coalesce(*found)


def source_path(root: str, directory: Column, name: Column) -> Column:
    """Share path of a file, NULL where there is no file."""
    path = concat_nulls_empty(F.lit(root), F.lit("\\"), directory, F.lit("\\"), name)
    return F.when(name.isNotNull(), path)


def storage_uri(path: Column) -> Column:
    return F.when(path.startswith(URI_SCHEME), path).otherwise(
        concat_nulls_empty(F.lit(URI_SCHEME), path))


def state_county_label(state: Column, county: Column) -> Column:
    return concat_nulls_empty(F.lower(state), F.lit("/"), F.lower(county))


def destination_key(state_county: Column, record_id: Column, source_key: Column) -> Column:
    """`state/county/abcd/abcd….ext`, keyed by the first four id characters."""
    low = F.lower(record_id)
    return F.concat(state_county, F.lit("/"), low.substr(1, 4), F.lit("/"), low,
                    path_extension(source_key))


def range_or_block(range_no: Column, direction: Column, block: Column, mode: str = "intended") -> Column:
    """Range with its direction, else (intended mode) the survey block.

    In reference mode the block is never reached, because the concatenation of
    two missing parts is '' and not NULL.
    """
    range_text = F.nullif(concat_nulls_empty(range_no.cast("int"), direction), F.lit(""))
    if mode == "reference":
        return range_text
    return F.coalesce(range_text, F.nullif(block, F.lit("")))
