"""Typed access to raw JSON hits held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearsay.functions.lookup import let
from hearsay.functions.text import empty_to_null

# What a hit that is not an object is called in a reject reason.
_KIND_NAMES = {
    "BIGINT": "int", "DECIMAL": "float", "DOUBLE": "float", "STRING": "str",
    "BOOLEAN": "bool", "ARRAY": "list", "VOID": "NoneType", "OBJECT": "dict",
}


def kind(value: Column) -> Column:
    """Type name of a VARIANT: OBJECT, ARRAY, STRING, BIGINT, ... (null if absent)."""
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)


def kind_name(value: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in _KIND_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, kind(value)), F.lit("object"))


def field(hit: Column, key: str, data_type: str = "string") -> Column:
    """`hit[key]` as `data_type`; null if missing or not convertible."""
    return F.try_variant_get(hit, f"$.{key}", data_type)


def coerce_int(hit: Column, key: str) -> Column:
    """Whole number of a JSON number, boolean or digit text; null for anything else."""
    return field(hit, key, "bigint")


def truthy_text(hit: Column, key: str) -> Column:
    """Text of a field; null when it is missing, empty, zero, false or an empty container."""

    def read(value: Column) -> Column:
        def by_kind(found: Column) -> Column:
            text = F.try_variant_get(value, "$", "string")
            number = F.try_variant_get(value, "$", "double")
            json = F.to_json(value)
            # A fraction keeps its point, also where its digits behind it are zeros: 7.0 is not 7.
            whole = (number == F.floor(number)) & (F.abs(number) < 1e16)
            fraction = F.when(whole, F.format_string("%.1f", number)).otherwise(text)
            return (
                F.when(found == "STRING", empty_to_null(text))
                .when(found == "BIGINT", F.when(number != 0, text))
                .when(found.isin("DECIMAL", "DOUBLE"), F.when(number != 0, fraction))
                .when(found == "BOOLEAN", F.when(text == "true", "True"))
                .when(found.isin("ARRAY", "OBJECT"), F.when(~json.isin("[]", "{}"), json))
            )

        return F.when(value.isNotNull(), let(kind(value), by_kind))

    return let(field(hit, key, "variant"), read)
