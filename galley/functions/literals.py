"""SQL literals, JSON text and vectors, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates that stand for none.
ZERO_DATE = r"^0000-00-00(?: 00:00:00)?$"
#: The site whose uploads get an absolute address; give your own.
SITE = "www.example.org"


def no_zero_date(c: Column) -> Column:
    """Null for empty texts and zero dates."""
    return F.when(~c.isin("", "0000-00-00", "0000-00-00 00:00:00"), c)


def quoted(c: Column) -> Column:
    """A quoted literal, NULL for null and zero dates."""
    text = c.cast("string")
    safe = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    return F.when(text.isNull() | F.regexp_like(text, F.lit(ZERO_DATE)), F.lit("NULL")).otherwise(F.concat(F.lit("'"), safe, F.lit("'")))


def flag(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("NULL")).when(c, F.lit("1")).otherwise(F.lit("0"))


def json_text(c: Column) -> Column:
    """A JSON string, `null` for null. Characters outside ASCII stay; control characters are escaped."""
    one = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    return one.substr(F.lit(6), F.length(one) - 6)


def json_list(c: Column, numbers: bool = False) -> Column:
    """An array as JSON with a space behind each comma."""
    items = F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("null")) if numbers else json_text(x))
    return F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")))


def json_map(c: Column) -> Column:
    """A map of texts as JSON in its own order."""
    items = F.transform(F.map_entries(c), lambda e: F.concat(json_text(e["key"]), F.lit(": "), json_text(e["value"])))
    return F.when(c.isNotNull(), F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}")))


def vector_text(c: Column) -> Column:
    """[0.12345678,...]; ties go to the even digit, as C and Python print them (format_string takes them up). Nulls are left out."""

    def text(x: Column) -> Column:
        x = F.when(F.abs(x) == 5e-9, x * 2).otherwise(x)  # over half of the last digit by its bits, which format_number misses
        plain = F.call_function("format_number", x, F.lit("0.00000000"))
        return F.when(F.isnan(x), F.lit("nan")).when(F.abs(x) == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf"))).otherwise(plain)

    return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: text(x.cast("double"))), ","), F.lit("]"))


def photo_url(c: Column, site: str = SITE) -> Column:
    """An absolute address for what an article links as its photo."""
    from galley.functions.names import strip

    own = strip(c)
    low = F.lower(own)
    return (
        F.when(own == "", F.lit(None).cast("string"))
        .when(F.startswith(low, F.lit("http://")) | F.startswith(low, F.lit("https://")), own)
        .when(F.startswith(own, F.lit("//")), F.concat(F.lit("https:"), own))
        .when(F.startswith(low, F.lit(f"{site}/")), F.concat(F.lit("https://"), own))
        .when(F.startswith(low, F.lit("wp-content/")), F.concat(F.lit(f"https://{site}/"), own))
        .when(F.startswith(own, F.lit("/wp-content/")), F.concat(F.lit(f"https://{site}"), own))
        .otherwise(own)
    )
