"""Licence attributes held in the label array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label names read as attributes.
ATTRIBUTES = ["domain_name", "order_id", "purchase_order_id", "subscription_id", "usage_type"]


def label_name(key: Column) -> Column:
    """The part of a label key after its last slash; NULL (the label is dropped) when nothing follows it."""
    return F.when(~key.endswith("/"), F.substring_index(key, "/", -1))


def attribute(text: Column, name: str) -> Column:
    """One attribute out of the object text; NULL when absent or when the text is broken."""
    return F.get_json_object(text, f"$.{name}")


def label_value(labels: Column, name: str) -> Column:
    """One attribute straight from the array: the first label of that name. Also right for values with quotes."""
    found = F.filter(labels, lambda kv: (label_name(kv["key"]) == name) & kv["value"].isNotNull())
    return F.get(found, 0)["value"]
