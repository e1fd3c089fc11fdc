"""String, url and JSON expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def param_value(v: Column) -> Column:
    """First non-null of the four typed fields of an event parameter, as text."""
    return F.coalesce(
        v["string_value"],
        v["int_value"].cast("string"),
        v["float_value"].cast("string"),
        v["double_value"].cast("string"),
    )


def blank_coalesce(a: Column, b: Column) -> Column:
    """``a`` unless it is null or the empty string, else ``b``."""
    return F.coalesce(F.nullif(a, F.lit("")), b)


def classify_contains(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first fragment found in c, null if none."""
    out = F.when(c.contains(rules[0][0]), rules[0][1])
    for fragment, label in rules[1:]:
        out = out.when(c.contains(fragment), label)
    return out


def value_map(c: Column, mapping: Mapping[str, str], keep_unknown: bool) -> Column:
    """Rename values; unknown ones stay (``keep_unknown``) or become null."""
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out.otherwise(c) if keep_unknown else out


def classify_suffix(c: Column, sep: str, mapping: Mapping[str, str]) -> Column:
    """Map the part after the last ``sep``; unknown suffixes become null."""
    return value_map(F.substring_index(c, sep, -1), mapping, keep_unknown=False)


def url_segment_map(
    event: Column, item: Column, url: Column, menu_event: str, mapping: Mapping[str, str]
) -> Column:
    """Item name; for menu clicks without one, the page named by the url's last segment."""
    page = value_map(F.substring_index(url, "/", -1), mapping, keep_unknown=False)
    return F.when((event == menu_event) & item.isNull(), page).otherwise(item)


def contact_id_clean(c: Column) -> Column:
    """True for real member ids: no mail address, no mobile number."""
    return ~c.contains("@") & ~c.startswith("09")


def exclude_product_code(c: Column, mode: str, code: str = "D") -> Column:
    """True for products without the code: anywhere (``contains``) or in front (``prefix``)."""
    if mode == "contains":
        return ~c.contains(code)
    if mode == "prefix":
        return ~c.startswith(code)
    raise ValueError(f"unknown mode {mode!r}")


def parse_measure(c: Column, unit: str) -> Column:
    """Number in front of a unit (``"12.3 sec"``, ``"30歲"``); null where there is none."""
    return F.trim(F.replace(c, F.lit(unit), F.lit(""))).try_cast("double")


def parse_json_column(c: Column, schema: str = "array<string>") -> Column:
    return F.from_json(c, schema)
