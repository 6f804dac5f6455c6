"""Typed fields out of semi-structured event payloads, on Spark's VARIANT type.

Presence is tested with ``isNotNull`` on a sub-variant: a JSON ``null`` is a non-NULL variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

# Keys that may hold the price, most specific first; the first one present decides.
PRICE_KEYS = ("price", "total", "revenue", "amount", "value")

_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"

# Closes the wrapping array below. If it is not the second element, the text was not one JSON value.
_END = "\ue000end"


# An object whose first character is no quote cannot be parsed; skipping it saves a costly parser exception.
_HOPELESS = r"""^\{\s*[^"}\s]"""


def _wrapped(text: Column) -> Column:
    return F.when(~text.rlike(_HOPELESS), F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]'))))


def _unwrapped(doc: Column) -> Column:
    whole = F.try_variant_get(doc, "$[1]", "string") == _END
    value = F.try_variant_get(doc, "$[0]", "variant")
    return F.when(whole & ~F.is_variant_null(value), value)


def with_payload(df: DataFrame, text: str = "event_data", out: str = "event_data_parsed") -> DataFrame:
    """Add the parsed payload; a text that fails is retried once with single quotes turned into double quotes.

    The parser alone accepts trailing garbage, so the text is parsed as the first element of an array that
    also holds an end mark. Separate projections keep each parse from being evaluated more than once.
    """
    value = strip(F.col(text))
    return (
        df.withColumn("_doc", _wrapped(value))
        .withColumn(out, _unwrapped(F.col("_doc")))
        .withColumn("_doc", F.when(F.col(out).isNull(), _wrapped(F.replace(value, F.lit("'"), F.lit('"')))))
        .withColumn(out, F.coalesce(F.col(out), _unwrapped(F.col("_doc"))))
        .drop("_doc")
    )


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def number_of(value: Column) -> Column:
    """Double of a JSON number, boolean or numeric text, else NULL."""
    text = text_of(value)
    return F.when(_kind(value) == "STRING", F.when(text.rlike(_NUMBER), text.try_cast("double"))).otherwise(
        F.try_variant_get(value, "$", "double")
    )


def is_filled(value: Column) -> Column:
    """False for an absent key, null, false, zero, and empty text, list or object; the text '0' is filled."""
    kind = _kind(value)
    shown = text_of(value)
    filled = (
        F.when(kind == "STRING", shown != "")
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~shown.isin("[]", "{}"))
        .otherwise(F.try_variant_get(value, "$", "double") != 0)
    )
    return F.coalesce(filled, F.lit(False))


def fields_of(payload: Column) -> Column:
    """The keys that are read later, taken out of the payload in one go; NULL unless it is an object.

    An absent key is a NULL field, a JSON null is not.
    """
    keys = ", ".join(f"{key} variant" for key in (*PRICE_KEYS, "quantity", "product_id", "item_id", "sku"))
    item = ", ".join(f"{key} variant" for key in ("price", "quantity", "product_id", "item_id", "sku"))
    return F.try_variant_get(payload, "$", f"struct<{keys}, items: array<struct<{item}>>>")


def price_of(fields: Column) -> Column:
    """Number under the first price key present; a bad value there is NULL, later keys are not tried."""
    return number_of(F.coalesce(*[fields[key] for key in PRICE_KEYS]))


def _item_values(items: Column, key: str) -> Column:
    return F.filter(F.transform(items, lambda item: item[key]), lambda value: value.isNotNull())


def items_total(items: Column, key: str) -> Column:
    """Sum over the items that have the key: NULL if none has it or one is not a number, nulls skipped."""
    values = _item_values(items, key)
    numbers = F.transform(F.filter(values, lambda value: ~F.is_variant_null(value)), number_of)
    total = F.aggregate(numbers, F.lit(0.0), lambda a, b: a + b)
    return F.when(F.size(values) > 0, total)


def items_first(items: Column, key: str) -> Column:
    """Value of the first item that has the key, even if that value is null."""
    return F.get(_item_values(items, key), F.lit(0))


def _first_filled(values: list[Column]) -> Column:
    """Text of the first filled value; the last one counts as it is."""
    *tried, last = values
    return F.coalesce(*[F.when(is_filled(value), text_of(value)) for value in tried], text_of(last))


def with_payload_fields(df: DataFrame, payload: str = "event_data_parsed") -> DataFrame:
    """Add price, quantity, product_id, unit_price and total.

    Separate projections: what several columns share is computed once.
    """
    fields = F.col("_fields")
    items = fields["items"]
    nested = {f"_items_{key}": items_first(items, key) for key in ("product_id", "sku", "item_id")}
    price = F.col("price")
    product = [fields["product_id"], fields["item_id"], fields["sku"], *[F.col(name) for name in nested]]
    return (
        df.withColumn("_fields", fields_of(F.col(payload)))
        .withColumns({"price": price_of(fields), **nested})
        .withColumns(
            {
                "quantity": F.when(is_filled(fields["quantity"]), number_of(fields["quantity"])).otherwise(
                    items_total(items, "quantity")
                ),
                "unit_price": F.when(price != 0, price).otherwise(items_total(items, "price")),
                "product_id": _first_filled(product),
            }
        )
        .withColumn("total", F.col("unit_price") * F.col("quantity"))
        .drop("_fields", *nested)
    )
