"""Text cleansing as native Column expressions (no Python UDFs).

Every helper takes Columns (or column names) and returns a Column, so the
expressions stay inside whole-stage codegen and Catalyst can prune and push.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results must match.
ALBUM_OPEN = "《"
ALBUM_CLOSE = "》"
DEFAULT_COMPANY = "自定义曲库"
PROVINCE_MARKERS = ("自治区", "省", "市")  # precedence order, first found wins
CITY_MARKER = "市"
NULL_TEXT = "null"
DEFAULT_MACHINE_TIME = "20150814000000"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def album(s) -> Column:
    """Text from the first 《 to the last 》 inclusive; "" when absent or NULL."""
    pattern = "(?s)" + ALBUM_OPEN + ".*" + ALBUM_CLOSE
    return F.coalesce(F.regexp_extract(_col(s), pattern, 0), F.lit(""))


def _json_string_array(s: Column) -> Column:
    """Parse a JSON array into raw element texts; NULL when not an array."""
    return F.when(
        F.startswith(F.ltrim(s), F.lit("[")),
        F.from_json(s, "array<string>"),
    )


def singer(s, slot: int = 1, field: str = "name", second_index: int = 0) -> Column:
    """Field of a singer in a JSON array of singer objects.

    Slot 1 needs at least one element, slot 2 at least two. Slot 2 reads
    element ``second_index`` (0 by default, as the source data model does).
    Not an array, bad JSON or too short -> ""; element without the key -> NULL.
    """
    s = _col(s)
    arr = _json_string_array(s)
    need = 1 if slot == 1 else 2
    idx = 0 if slot == 1 else second_index
    elem = F.get(arr, idx)
    return F.when(
        (F.size(arr) >= need) & F.startswith(F.ltrim(elem), F.lit("{")),
        F.get_json_object(elem, "$." + field),
    ).otherwise(F.lit(""))


def company(s, default: str = DEFAULT_COMPANY) -> Column:
    """``name`` of a JSON object; invalid / NULL / non-object -> default."""
    s = _col(s)
    valid_object = F.startswith(F.ltrim(s), F.lit("{")) & F.try_parse_json(s).isNotNull()
    return F.when(F.coalesce(valid_object, F.lit(False)), F.get_json_object(s, "$.name")).otherwise(
        F.lit(default)
    )


INT_MAX, INT_MIN = 2147483647, -2147483648


def _double_to_int(x: Column) -> Column:
    """Truncate toward zero, saturating at the int range, NaN -> 0 (no ANSI
    overflow error: one huge number must not fail the job)."""
    return (
        F.when(F.isnan(x), F.lit(0))
        .when(x >= F.lit(float(INT_MAX)), F.lit(INT_MAX))
        .when(x <= F.lit(float(INT_MIN)), F.lit(INT_MIN))
        .otherwise(x.cast("int"))
    )


def int_list(s) -> Column:
    """``"[2.0,8.0]"`` -> ``[2, 8]`` truncating; keeps the prefix before the
    first element that is not a number; no ``[`` or NULL -> ``[]``."""
    s = _col(s)
    body = F.regexp_replace(F.trim(s), r"^\[|\]$", "")
    parsed = F.transform(F.split(body, ","), lambda e: e.try_cast("double"))
    first_bad = F.array_position(F.transform(parsed, lambda x: x.isNull()), True)
    keep = F.when(first_bad > 0, first_bad - 1).otherwise(F.size(parsed))
    ints = F.transform(F.slice(parsed, 1, keep), _double_to_int)
    empty = F.array().cast("array<int>")
    return F.when(F.coalesce(F.contains(s, F.lit("[")), F.lit(False)), ints).otherwise(empty)


def _province_pos(s: Column) -> Column:
    """1-based position of the province marker (precedence, not position)."""
    expr = F.lit(0)
    for marker in reversed(PROVINCE_MARKERS):
        expr = F.when(F.instr(s, marker) > 0, F.instr(s, marker)).otherwise(expr)
    return expr


def province(s) -> Column:
    """Text before the province marker; none / NULL / empty -> ""."""
    s = _col(s)
    p = _province_pos(s)
    return F.coalesce(F.when(p > 1, F.substring(s, F.lit(1), p - 1)), F.lit(""))


def city(s) -> Column:
    """Text between the province marker and the first 市 (see FIXTURES.md)."""
    s = _col(s)
    p = _province_pos(s)
    m = F.instr(s, CITY_MARKER)
    has = lambda mk: F.instr(s, mk) > 0

    def cut(start, length):
        return F.when(length > 0, F.substring(s, start, length)).otherwise(F.lit(""))

    out = (
        F.when(has("省") & has(CITY_MARKER), cut(p + 1, m - p - 1))
        .when(has("自治区") & has(CITY_MARKER), cut(p + 3, m - p - 3))
        .when(has(CITY_MARKER), cut(F.lit(1), m - 1))
        .otherwise(F.lit(""))
    )
    return F.coalesce(out, F.lit(""))


def default_time(s, default: str = DEFAULT_MACHINE_TIME) -> Column:
    """The text ``null`` -> a fixed start time; NULL and other values unchanged."""
    s = _col(s)
    return F.when(s == F.lit(NULL_TEXT), F.lit(default)).otherwise(s)


def json_field(s, field: str) -> Column:
    """One top-level JSON field as text; invalid JSON gives NULL."""
    return F.get_json_object(_col(s), "$." + field)


def null_text(c) -> Column:
    """Missing value written as the text ``null`` (string concatenation semantics)."""
    return F.coalesce(_col(c).cast("string"), F.lit(NULL_TEXT))
