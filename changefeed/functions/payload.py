"""Reading and building the ``data`` payload of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def build_update(old: Column, new: Column) -> Column:
    """Before and after images to one payload; a missing image is left out."""
    parts = F.array_compact(
        F.array(
            F.concat(F.lit('"old":'), old),
            F.concat(F.lit('"new":'), new),
        )
    )
    return F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))


def payload_field(data: Column, path: str) -> Column:
    """Text at a JSON path; nested JSON columns need no second decode."""
    return F.get_json_object(data, path)


def payload_as(data: Column, schema: str = "map<string,string>") -> Column:
    """The row image decoded into a struct or map.

    Give decimals a DECIMAL type: read as text, a bare number loses digits.
    """
    return F.from_json(data, schema)


def before_after(df: DataFrame, row_schema: str) -> DataFrame:
    """Add typed ``before`` and ``after`` images for row changes.

    ``row_schema`` is a column list such as ``"id bigint, name string"``.
    """
    image = f"struct<{_as_struct_fields(row_schema)}>"
    pair = F.from_json(F.col("data"), f"struct<old:{image},new:{image}>")
    flat = F.from_json(F.col("data"), image)
    kind = F.col("type")
    return df.withColumns(
        {
            "before": F.when(kind == "UPDATE", pair["old"]).when(kind == "DELETE", flat),
            "after": F.when(kind == "UPDATE", pair["new"]).when(kind == "INSERT", flat),
        }
    )


def _as_struct_fields(row_schema: str) -> str:
    from pyspark.sql.types import StructType

    return ",".join(
        f"`{field.name}`:{field.dataType.simpleString()}"
        for field in StructType.fromDDL(row_schema)
    )
