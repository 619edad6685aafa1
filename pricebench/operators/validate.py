"""Typed rows with coercion; rows that do not fit go to a rejects table with a reason."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.functions.text import python_float
from pricebench.schemas import ITEM


def _coerced(df: DataFrame, name: str, kind: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast(kind)
    if kind == "double":
        return python_float(F.col(name).cast("string"))
    return F.col(name).try_cast(kind)


def validate_items(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid items with the ITEM columns, and rejects as the given row plus ``reason``."""
    typed = F.struct(
        *[_coerced(rows, f.name, f.dataType.simpleString()).alias(f.name) for f in ITEM.fields]
    )
    problems = []
    for field in ITEM.fields:
        lost = F.col(f"_item.{field.name}").isNull()
        if not field.nullable:
            problems.append(F.when(lost, F.lit(f"{field.name} missing or not {field.dataType.simpleString()}")))
        elif field.name in rows.columns:
            bad = lost & F.col(field.name).isNotNull()
            problems.append(F.when(bad, F.lit(f"{field.name} not {field.dataType.simpleString()}")))
    checked = rows.withColumn("_item", typed).withColumn("reason", F.concat_ws("; ", *problems))
    valid = checked.filter(F.col("reason") == "").select("_item.*")
    return valid, checked.filter(F.col("reason") != "").drop("_item")
