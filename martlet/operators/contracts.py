"""Schema contracts: enforce a declared output schema, report breaking
changes between two schemas, and list column documentation.

The name/type checks are schema metadata (no job runs); the not-null part
of a contract is a row filter that raises inside the tasks on a violation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    pass


def contract_cast(df: DataFrame, contract: T.StructType, enforce_not_null: bool = True,
                  primary_key: list[str] | None = None) -> DataFrame:
    """Return ``df`` in the contract's column order and types.

    Missing or extra columns fail at once (before any job).  Casts run in
    ANSI mode, so an overflow (e.g. a decimal(22,2) sum into decimal(18,2))
    raises instead of wrapping.  Not-null columns raise on a NULL.
    Column docs are attached as field metadata.  With ``primary_key`` a second
    row of a key raises (one shuffle by the key).
    """
    have = set(df.columns)
    want = [f.name for f in contract.fields]
    missing = [c for c in want if c not in have]
    extra = [c for c in df.columns if c not in set(want)]
    if missing or extra:
        raise ContractError(f"contract mismatch: missing={missing} extra={extra}")
    cols = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in contract.fields]
    out = df.select(*cols)
    if enforce_not_null:
        required = [f.name for f in contract.fields if not f.nullable]
        if required:
            ok = F.lit(True)
            for name in required:
                ok = ok & F.col(name).isNotNull()
            msg = f"contract violation: NULL in one of {required}"
            out = out.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(msg))))
    if primary_key:
        msg = f"contract violation: primary key {primary_key} is not unique"
        place = F.row_number().over(Window.partitionBy(*primary_key).orderBy(*primary_key))
        out = (out.withColumn("_place", place)
               .filter(F.when(F.col("_place") == 1, F.lit(True)).otherwise(F.raise_error(F.lit(msg))))
               .drop("_place"))
    return out


def _type_name(dt: T.DataType | None) -> str | None:
    return None if dt is None else dt.simpleString()


def contract_diff(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """Breaking-change report between two schemas: removed columns, changed
    types, nullability tightened, and (non-breaking) added columns."""
    old_f = {f.name: f for f in old.fields}
    new_f = {f.name: f for f in new.fields}
    rows = []
    for name, f in old_f.items():
        if name not in new_f:
            rows.append((name, "removed", _type_name(f.dataType), None, True))
        elif new_f[name].dataType != f.dataType:
            rows.append((name, "type_changed", _type_name(f.dataType),
                         _type_name(new_f[name].dataType), True))
        elif f.nullable and not new_f[name].nullable:
            rows.append((name, "nullability_tightened", _type_name(f.dataType),
                         _type_name(new_f[name].dataType), True))
    for name, f in new_f.items():
        if name not in old_f:
            rows.append((name, "added", None, _type_name(f.dataType), False))
    schema = "column_name string, change string, old_type string, new_type string, breaking boolean"
    return spark.createDataFrame(rows, schema)


def column_comments(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """(column_name, data_type, comment) for the documented schema."""
    rows = [(f.name, f.dataType.simpleString(), f.metadata.get("comment")) for f in schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string, comment string")
