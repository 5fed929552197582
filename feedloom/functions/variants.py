"""Reading semi-structured payloads without ever failing a row.

A payload node is a ``VARIANT``.  ``take`` casts a node to a typed shape and
gives null on a missing key or a wrong container, per field, so one call reads
a whole record in one pass.  Fields whose *type* matters stay ``VARIANT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def take(node: Column, shape: str = "variant", path: str = "$") -> Column:
    return F.try_variant_get(node, path, shape)


def text_of(node: Column) -> Column:
    """The node as text; scalars of any type are rendered, null stays null."""
    return take(node, "string")


def is_text(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node) == "STRING", F.lit(False))


def is_container(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node).rlike("^(OBJECT|ARRAY)"), F.lit(False))


def present(node: Column) -> Column:
    """The key exists, even if its value is a JSON null."""
    return node.isNotNull()


# How falsy scalars and containers other than text are rendered.
_FALSY = r"^(?:false|\{\}|\[\]|-?0(?:\.0*)?(?:E-?\d+)?)$"


def truthy(node: Column) -> Column:
    """False for missing, null, false, zero, and empty text, array or object."""
    text = text_of(node)
    return F.coalesce(
        F.when(is_text(node), text != "").otherwise(~text.rlike(_FALSY)), F.lit(False)
    )


def truthy_record(node: Column) -> Column:
    """``truthy`` for post records: two cheap key probes settle nearly all."""
    probe = F.coalesce(take(node, "string", "$.__typename"), take(node, "string", "$.rest_id"))
    return F.when(node.isNull(), False).when(probe.isNotNull(), True).otherwise(truthy(node))


def text_or_empty(node: Column) -> Column:
    """Text nodes as they are, every falsy node as ``''``, anything else null."""
    text = text_of(node)
    return F.when(is_text(node), text).when(F.coalesce(text, F.lit("0")).rlike(_FALSY), F.lit(""))
