"""Licence attributes of many rows: each label array is walked once, and its text is parsed only when it must be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import ATTRIBUTES, attribute, label_name


def _joined(names: Column, values: Column) -> Column:
    return F.concat(F.array_join(names, ""), F.array_join(values, ""))


def with_attributes(df: DataFrame, labels: str = "system_labels") -> DataFrame:
    """Replace the label array by ``attributes_json`` and the attributes, as the text and its parser give them.

    Names and values become two arrays, which serve the text and all attributes. Where a quote, backslash or control
    character keeps the text from meaning what the labels say, the attributes are parsed from the text instead; for all
    other rows the text is built only if it is asked for. The array of one entry that is exploded keeps filters on
    attributes above this step, where they use the attributes; below it they would compute them once more.
    """
    others = [c for c in df.columns if c != labels]
    quote = F.lit('"')
    names, values, odd = (F.col(f"_parts.{c}") for c in ("names", "values", "odd"))
    entry = F.zip_with(names, values, lambda n, v: F.concat(quote, n, F.lit('": "'), v, quote))
    text = F.concat(F.lit("{"), F.coalesce(F.array_join(entry, ", "), F.lit("")), F.lit("}"))

    def read(name: str) -> Column:
        place = F.array_position(names, name).cast("int") - 1
        return F.when(odd, attribute(text, name)).otherwise(F.get(values, place))

    # a label without a value has no name either, so nothing finds it
    named = F.transform(labels, lambda kv: F.when(kv["value"].isNotNull(), label_name(kv["key"])))
    parts = df.select(*others, named.alias("_names"), F.col(f"{labels}.value").alias("_values"))
    unclear = F.coalesce(_joined(F.col("_names"), F.col("_values")).rlike(r'["\\\p{Cntrl}]'), F.lit(False))
    part = F.struct(F.col("_names").alias("names"), F.col("_values").alias("values"), unclear.alias("odd"))
    once = parts.select(*others, F.explode(F.array(part)).alias("_parts"))
    return once.select(*others, text.alias("attributes_json"), *[read(name).alias(name) for name in ATTRIBUTES])
