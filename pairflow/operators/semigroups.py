"""sumByKey (A5): "plus" chosen by the value column's type.

| value type            | plus                                 | plan                                  |
| integral / decimal / float | +                               | partial ``sum`` (nulls skipped)       |
| struct of numbers     | field by field, recursively          | one partial aggregate                 |
| map to numbers        | merge keys, plus on values           | explode, partial sum per (key, map key) |
| struct or map of others | by type all the way down           | ``nested``: partial sum per address   |
| array, ``"list"``     | concatenation (order undefined)      | explode, gather (``split``: chunks)    |
| array, ``"set"``      | union                                | explode, partial ``collect_set``      |
| any, ``"max"``/``"min"`` | larger / smaller                  | partial ``max`` / ``min``             |

Strings are refused: concatenation is not commutative, so the answer
would depend on row order.  Integer sums are ``bigint`` and raise on
overflow (ANSI mode); decimals widen by 10 digits as Spark's ``sum`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    FractionalType,
    IntegralType,
    MapType,
    StringType,
    StructType,
)

from pairflow.operators.grouping import group_by_key
from pairflow.operators.nested import nested_sum
from pairflow.operators.skew import Split, as_list, refuse


def _is_numeric(dt: DataType) -> bool:
    return isinstance(dt, (IntegralType, FractionalType, DecimalType))


def _numbers(dt: DataType) -> bool:
    """A struct of numbers and of such structs."""
    return all(_is_numeric(f.dataType) or (isinstance(f.dataType, StructType) and _numbers(f.dataType)) for f in dt.fields)


def _struct_plus(c: Column, dt: StructType) -> Column:
    fields = []
    for f in dt.fields:
        sub = c.getField(f.name)
        if _is_numeric(f.dataType):
            fields.append(F.sum(sub).alias(f.name))
        else:
            fields.append(_struct_plus(sub, f.dataType).alias(f.name))
    return F.struct(*fields)


def sum_by_key(
    df: DataFrame,
    keys,
    value: str,
    out: str | None = None,
    semigroup: str | None = None,
    flat: bool = False,
    split: Split | None = None,
    arrays: str = "list",
) -> DataFrame:
    """Sum each key's values with the semigroup of the value type (table above).

    ``flat`` returns map sums as ``keys, key, value`` rows (one per map key)
    and struct sums as one column per field, instead of nested values.
    ``split`` gives list sums the chunked layout of ``group_by_key``; its columns
    may include ``_p``, an element's position.  Null elements of lists and sets
    are elements; a key whose maps or arrays are all empty or null stays.
    ``arrays`` says whether arrays inside a struct or map are lists or sets.
    """
    keys = as_list(keys)
    out = out or value
    dt = df.schema[value].dataType
    v = F.col(value)

    if semigroup in ("max", "min"):
        agg = F.max(v) if semigroup == "max" else F.min(v)
        return df.groupBy(*keys).agg(agg.alias(out))
    if semigroup is not None and semigroup not in ("set", "list"):
        raise ValueError(f"unknown semigroup {semigroup!r}")

    if semigroup == "set":
        refuse(df, keys, "_p", "_e")
        if isinstance(dt, ArrayType):
            elems = df.select(*keys, F.posexplode_outer(v).alias("_p", "_e"))
        else:
            elems = df.select(*keys, F.lit(0).alias("_p"), v.alias("_e"))
        kind = dt.elementType if isinstance(dt, ArrayType) else dt
        if isinstance(kind, (FloatType, DoubleType)):
            # both zeros are one element, as they are one grouping key
            elems = elems.withColumn("_e", F.when(F.col("_e") == 0, F.lit(0.0).cast(kind)).otherwise(F.col("_e")))
        held = F.collect_set(F.when(F.col("_p").isNotNull(), F.struct("_e")))
        return elems.groupBy(*keys).agg(F.transform(held, lambda x: x["_e"]).alias(out))

    if _is_numeric(dt):
        return df.groupBy(*keys).agg(F.sum(v).alias(out))

    if isinstance(dt, StructType) and not _numbers(dt) or isinstance(dt, MapType) and not _is_numeric(dt.valueType):
        refuse(df, keys, "_entry", "_leaf", "_n", "_to", "_pair", "_pairs")
        res = nested_sum(df, keys, value, out, arrays)
        if flat and isinstance(dt, StructType):
            return res.select(*keys, *[F.col(out).getField(f.name).alias(f"{out}_{f.name}") for f in dt.fields])
        return res.select(*keys, F.explode(out).alias(f"{out}_key", f"{out}_value")) if flat else res

    if isinstance(dt, StructType):
        res = df.groupBy(*keys).agg(_struct_plus(v, dt).alias(out))
        if flat:
            return res.select(*keys, *[F.col(out).getField(f.name).alias(f"{out}_{f.name}") for f in dt.fields])
        return res

    if isinstance(dt, MapType):
        refuse(df, keys, "_mk", "_mv", "_sv")
        entries = df.select(*keys, F.explode(v).alias("_mk", "_mv")) if flat else df.select(*keys, F.explode_outer(v).alias("_mk", "_mv"))
        per_key = entries.groupBy(*keys, "_mk").agg(F.sum("_mv").alias("_sv"))
        if flat:
            return per_key.select(*keys, F.col("_mk").alias(f"{out}_key"), F.col("_sv").alias(f"{out}_value"))
        return per_key.groupBy(*keys).agg(
            F.map_from_entries(
                F.sort_array(F.collect_list(F.when(F.col("_mk").isNotNull(), F.struct("_mk", "_sv"))))
            ).alias(out)
        )

    if isinstance(dt, ArrayType):
        # posexplode_outer keeps keys whose arrays are all empty (or null): their
        # placeholder row has a null position and is dropped from the list, while
        # null elements of real arrays are kept.
        refuse(df, keys, "_p", "_e")
        by = [c for c in (split.by if split else ()) if c not in keys and c != "_p"]
        elems = df.select(*keys, *by, F.posexplode_outer(v).alias("_p", "_e"))
        g = group_by_key(elems, keys, ["_p", "_e"], out=out, split=split)
        kept = F.transform(F.filter(F.col(out), lambda x: x["_p"].isNotNull()), lambda x: x["_e"])
        return g.select(*keys, *(["chunk"] if split else []), kept.alias(out))

    if isinstance(dt, (StringType, BooleanType)):
        raise TypeError(f"sum_by_key: {dt.simpleString()} has no commutative plus; use reduce_by_key")
    raise TypeError(f"sum_by_key: no semigroup for {dt.simpleString()}")
