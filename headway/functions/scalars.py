"""Column functions for names, times of day and numbers."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts for the route_type codes. The second table is the shorter form
# shown to riders.
ROUTE_TYPES = {
    0: "Tram/Streetcar/Light rail",
    1: "Subway/Metro",
    2: "Rail/Commuter rail",
    3: "Bus",
    4: "Ferry",
    5: "Cable tram",
    6: "Aerial lift/Gondola",
    7: "Funicular",
    11: "Trolleybus",
    12: "Monorail",
}
ROUTE_TYPES_SHORT = {
    0: "Tram/Light Rail",
    1: "Subway/Metro",
    2: "Rail",
    3: "Bus",
    4: "Ferry",
    5: "Cable Tram",
    6: "Gondola",
    7: "Funicular",
    11: "Trolleybus",
    12: "Monorail",
}

# Texts for the transfer_type codes.
TRANSFER_TYPES = {
    0: "Recommended transfer point",
    1: "Timed transfer (vehicle waits)",
    2: "Minimum time required",
    3: "No transfer possible",
}
OTHER_TRANSFER = "a standard transfer"
UNSTATED_TRANSFER = "a transfer"

# Marks put behind a time of the following day.
NEXT_DAY = " (next day)"
NEXT_DAY_SHORT = " (+1)"

# Fixed value: how a code outside the table is shown.
UNKNOWN_ROUTE_TYPE = "Unknown (type {code})"


def literal(text: str) -> str:
    """A text as SQL."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def _formatted(name: str, how: str) -> str:
    if how == ",":
        shown = f"format_number(bigint({name}), 0)"
    elif how.endswith("f"):
        digits = int(how[1:-1])
        shown = f"format_string('%.{digits}f', bround(double({name}), {digits}))"
    else:
        shown = {"": "string({})", "lower": "lower({})"}[how].format(name)
    return f"coalesce({shown}, '')"


def pattern_sql(pattern: str) -> str:
    """SQL for a text with each ``{name}`` of the pattern replaced by that column.

    ``{n:,}`` shows thousands separators, ``{x:.4f}`` a fixed number of decimals,
    ``{s:lower}`` lower case. NULL shows as nothing. As SQL a long text is one
    expression to build, not hundreds.
    """
    pieces = ["''"]
    for text, name, how, _ in Formatter().parse(pattern):
        if text:
            pieces.append(literal(text))
        if name:
            pieces.append(_formatted(name, how))
    return f"concat({', '.join(pieces)})"


def fill(pattern: str, **parts: Column) -> Column:
    """The text of ``pattern_sql``, places named in ``parts`` taken from those columns."""
    if not parts:
        return F.expr(pattern_sql(pattern))
    pieces = []
    for text, name, how, _ in Formatter().parse(pattern):
        if text:
            pieces.append(F.lit(text))
        if name in parts:
            pieces.append(F.coalesce(parts[name].cast("string"), F.lit("")))
        elif name:
            pieces.append(F.expr(_formatted(name, how)))
    return F.concat(*pieces)


# All characters that count as blank at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def stripped(c: Column) -> Column:
    """Text without blanks of any kind around it."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def coded(c: Column, names: dict[int, str]) -> Column:
    """Text of an integer code, NULL where the table lacks it."""
    table = F.create_map(*[F.lit(x) for item in names.items() for x in item])
    return F.try_element_at(table, c.cast("int"))


def route_type_name(
    c: Column, names: dict[int, str] = ROUTE_TYPES, unknown: str = UNKNOWN_ROUTE_TYPE
) -> Column:
    return F.when(c.isNotNull(), F.coalesce(coded(c, names), fill(unknown, code=c)))


def transfer_type_name(c: Column) -> Column:
    return F.when(c.isNull(), F.lit(UNSTATED_TRANSFER)).otherwise(
        F.coalesce(coded(c, TRANSFER_TYPES), F.lit(OTHER_TRANSFER))
    )


def _time_part(c: Column, index: int) -> Column:
    return F.try_element_at(F.split(c, ":"), F.lit(index))


def format_gtfs_time(c: Column, next_day: str = NEXT_DAY) -> Column:
    """``25:15:00`` as ``1:15 AM (next day)``; text that is no time stays as it is."""
    hour = _time_part(c, 1).try_cast("int")
    of_day = F.when(hour >= 24, hour - 24).otherwise(hour)
    twelve = F.when(of_day == 0, 12).when(of_day > 12, of_day - 12).otherwise(of_day)
    shown = F.concat(
        twelve.cast("string"),
        F.lit(":"),
        _time_part(c, 2),
        F.when(of_day < 12, " AM").otherwise(" PM"),
        F.when(hour >= 24, next_day).otherwise(""),
    )
    is_time = (F.size(F.split(c, ":")) == 3) & hour.isNotNull()
    return F.when(F.coalesce(c, F.lit("")) == "", "unknown").when(is_time, shown).otherwise(c)


def gtfs_minutes(c: Column) -> Column:
    """Minutes since the start of the service day; NULL for text that is no time."""
    return _time_part(c, 1).try_cast("int") * 60 + _time_part(c, 2).try_cast("int")


def gtfs_seconds(c: Column) -> Column:
    return gtfs_minutes(c) * 60 + _time_part(c, 3).try_cast("int")


def service_span(first: Column, last: Column) -> Column:
    return gtfs_minutes(last) - gtfs_minutes(first)


def avg_headway(first: Column, last: Column, trips: Column) -> Column:
    """Minutes between trips over the service span, NULL without a span or second trip."""
    span = service_span(first, last)
    return F.when((span > 0) & (trips > 1), F.try_divide(span, trips))


def safe_int(c: Column) -> Column:
    """Whole part of a number given as text, NULL for anything else."""
    return number(c).try_cast("bigint")


def number(c: Column) -> Column:
    """Text to double; Java-only spellings such as ``1d`` or ``0x1p3`` are no numbers."""
    return F.when(~c.rlike(r"(?i)[0-9.][df]\s*$|0x"), c.try_cast("double"))


def whole_number(c: Column, kind: str) -> Column:
    """Text to an integer type: ``1.0`` is 1, fractions and out-of-range values are NULL."""
    bits = {"tinyint": 8, "smallint": 16, "int": 32}[kind]
    value = number(c)
    fits = (value == F.floor(value)) & value.between(-(2 ** (bits - 1)), 2 ** (bits - 1) - 1)
    return F.when(fits, value).cast(kind)


def thousands(c: Column) -> Column:
    return F.format_number(c.cast("bigint"), 0)


def fixed(c: Column, digits: int) -> Column:
    """Number with a fixed count of decimals, halves to the even digit."""
    return F.format_string(f"%.{digits}f", F.bround(c.cast("double"), digits))


def display_name(short: Column, long: Column) -> Column:
    """The short name, or else the long one."""
    return F.coalesce(F.nullif(short, F.lit("")), F.nullif(long, F.lit("")))


def full_name(short: Column, long: Column) -> Column:
    """``short (long)`` where both are given."""
    both = (blank(short) != "") & (blank(long) != "")
    return F.when(both, F.concat(short, F.lit(" ("), long, F.lit(")"))).otherwise(
        display_name(short, long)
    )


def modes_list(
    by_type: Column, entry: str, separator: str, unknown: str = UNKNOWN_ROUTE_TYPE
) -> Column:
    """The entries of a route_type -> count map in code order, each shown by a pattern
    with ``{count}``, ``{mode}`` and ``{plural}``."""
    shown = F.transform(
        F.array_sort(F.map_entries(by_type)),
        lambda e: fill(
            entry,
            count=e["value"],
            mode=route_type_name(e["key"], unknown=unknown),
            plural=F.when(e["value"] == 1, "").otherwise("s"),
        ),
    )
    return F.array_join(shown, separator)


def modes_text(by_type: Column) -> Column:
    """``125 Bus routes, 1 Ferry route``; without entries ``no routes``."""
    text = modes_list(by_type, "{count} {mode} route{plural}", ", ")
    return F.when(F.coalesce(text, F.lit("")) == "", "no routes").otherwise(text)


def content_sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def clip(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)
