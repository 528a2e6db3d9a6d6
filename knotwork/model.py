"""Layout of graph tables.

vertices  label, id, external_id, props, ...     (hot properties may be extra typed columns)
edges     label, start_label, start_id, end_label, end_id, props, ...   (a multiset)

``props`` is canonical JSON text: keys sorted, no blanks. Ids are 64-bit when a
numeric business key exists, otherwise a content digest (text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The declared labels.
VERTEX_LABELS = [
    "Person", "Company", "Product", "City", "Country",
    "Employee", "Customer", "Supplier", "Department", "Project",
]
EDGE_LABELS = ["WORKS_AT", "LOCATED_IN", "PURCHASED", "MANUFACTURED_BY", "SUPPLIES"]

VERTEX_COLUMNS = ["label", "id", "external_id", "props"]
EDGE_COLUMNS = ["label", "start_label", "start_id", "end_label", "end_id", "props"]

LABEL_SHIFT = 48


def graph_id(label_no: int, key: Column) -> Column:
    """64-bit id: label number in the high bits, business key below."""
    return F.shiftleft(F.lit(label_no).cast("bigint"), LABEL_SHIFT) + key.cast("bigint")


def content_id(label: Column, props: Column) -> Column:
    """Id of a vertex that is identified by its label and properties alone.

    It depends on the content only, so a retried task and a second load of the
    same feed produce the same id and no id table has to be joined.
    """
    return F.sha2(F.concat_ws("\u001f", label, props), 256)


def elements(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """One layout for both kinds; vertices have null endpoints."""
    return vertices.unionByName(edges, allowMissingColumns=True)
