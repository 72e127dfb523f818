"""sumByKey of nested values (A5c, A5d): structs, maps, lists and sets in each other.

"Plus" follows the type all the way down: numbers add, structs go field by
field, maps merge their keys and add their values, lists are put together and
sets united.  A value is taken apart into entries, one per number, element or
map key, each with its address: which leaf of the type it belongs to and the
map keys above it.  Entries with equal address are added up, before the exchange
and after it, so a key that holds a third of the rows costs one row per address
and task; a list element is counted, a set element kept once.  Then the value
is put together again, innermost maps first, in one more exchange on the keys.
Elements and map keys are told apart as grouping keys are: both zeros are one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    FractionalType,
    IntegralType,
    MapType,
    StructType,
)

ROOT = 0


@dataclass
class Node:
    """A place in the value's type: a number, an array, a struct or a map."""

    kind: str
    type: DataType
    number: int
    children: dict = field(default_factory=dict)


def _tree(dt: DataType, numbers) -> Node:
    if isinstance(dt, (IntegralType, FractionalType, DecimalType)):
        return Node("sum", dt, next(numbers))
    if isinstance(dt, ArrayType):
        return Node("array", dt, next(numbers))
    if isinstance(dt, StructType):
        return Node("struct", dt, next(numbers), {f.name: _tree(f.dataType, numbers) for f in dt.fields})
    if isinstance(dt, MapType):
        return Node("map", dt, next(numbers), {"value": _tree(dt.valueType, numbers)})
    raise TypeError(f"sum_by_key: no semigroup for {dt.simpleString()} inside a value")


def _all(node: Node) -> list[Node]:
    return [node, *(n for c in node.children.values() for n in _all(c))]


def _near(node: Node) -> list[Node]:
    """Leaves and maps below ``node`` with no other map between."""
    if node.kind == "struct":
        return [n for c in node.children.values() for n in _near(c)]
    return [node]


def _plain(v: Column, dt: DataType) -> Column:
    return F.when(v == 0, F.lit(0.0).cast(dt)).otherwise(v) if isinstance(dt, (FloatType, DoubleType)) else v


def nested_sum(df: DataFrame, keys: list[str], value: str, out: str, arrays: str) -> DataFrame:
    """``keys..., out``; ``arrays`` ("list" or "set") says what arrays mean."""
    if arrays not in ("list", "set"):
        raise ValueError(f"unknown array semigroup {arrays!r}")
    root = _tree(df.schema[value].dataType, iter(range(1, 1 << 30)))
    nodes = _all(root)
    of = lambda kind: [n for n in nodes if n.kind == kind]
    sums, lists, maps = of("sum"), of("array"), of("map")
    key_of = {f"_k{n.number}": n.type.keyType for n in maps}
    element_of = {f"_e{n.number}": n.type.elementType for n in lists}
    addend_of = {f"_x{n.number}": n.type for n in sums}

    def entry(number: int, given: dict) -> Column:
        cells = {**key_of, **element_of, **addend_of}
        return F.struct(F.lit(number).alias("_leaf"), *[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in cells.items()])

    def entries(v: Column, node: Node, above: dict) -> Column:
        if node.kind == "sum":
            return F.array(entry(node.number, {**above, f"_x{node.number}": v}))
        if node.kind == "struct":
            return F.concat(*[entries(v[name], c, above) for name, c in node.children.items()])
        whole = F.coalesce(v, (F.array() if node.kind == "array" else F.create_map()).cast(node.type))
        if node.kind == "array":
            kind = node.type.elementType
            return F.transform(whole, lambda e: entry(node.number, {**above, f"_e{node.number}": _plain(e, kind)}))

        def of_key(kv: Column) -> Column:
            own = {**above, f"_k{node.number}": _plain(kv["key"], node.type.keyType)}
            return F.concat(F.array(entry(node.number, own)), entries(kv["value"], node.children["value"], own))

        return F.flatten(F.transform(F.map_entries(whole), of_key))

    parts = F.concat(F.array(entry(ROOT, {})), entries(F.col(value), root, {}))
    rows = df.select(*keys, F.explode(parts).alias("_entry")).select(*keys, "_entry.*")
    ks, es, xs = list(key_of), list(element_of), list(addend_of)
    rows = rows.groupBy(*keys, "_leaf", *ks, *es).agg(*[F.sum(x).alias(x) for x in xs], F.count(F.lit(1)).alias("_n"))
    if maps:
        rows = rows.repartition(*keys)
    kind_of = dict(rows.dtypes)

    def made(node: Node) -> Column:
        """The value of a place from the columns of its leaves and inner maps."""
        if node.kind == "sum":
            return F.col(f"_x{node.number}")
        if node.kind == "struct":
            return F.struct(*[made(c).alias(name) for name, c in node.children.items()])
        if node.kind == "map":
            return F.coalesce(F.col(f"_m{node.number}"), F.create_map().cast(built_type(node)))
        held = F.sort_array(F.col(f"_l{node.number}"))
        if arrays == "set":
            return F.transform(held, lambda s: s["e"])
        return F.flatten(F.transform(held, lambda s: F.array_repeat(s["e"], s["n"].cast("int"))))

    def built_type(node: Node) -> str:
        if node.kind == "sum":
            return kind_of[f"_x{node.number}"]
        if node.kind == "struct":
            return f"struct<{', '.join(f'`{name}`: {built_type(c)}' for name, c in node.children.items())}>"
        if node.kind == "map":
            return f"map<{node.type.keyType.simpleString()}, {built_type(node.children['value'])}>"
        return node.type.simpleString()

    def gathered(node: Node) -> list[Column]:
        """Aggregates that bring together what lies below a map, or the root."""
        return [
            F.collect_list(F.when(F.col("_leaf") == n.number, F.struct(F.col(f"_e{n.number}").alias("e"), F.col("_n").alias("n")))).alias(f"_l{n.number}")
            for n in _near(node)
            if n.kind == "array"
        ]

    done: list[str] = []  # columns of maps already put together
    for m in reversed(maps):  # children come after their parents in the list
        inner = m.children["value"]
        below = [m.number, *(-n.number if n.kind == "map" else n.number for n in _near(inner))]
        mine = F.col("_leaf").isin(below)
        rows = rows.withColumn("_to", F.when(mine, -m.number).otherwise(F.col("_leaf")))
        rows = rows.select("*", *[F.when(~mine, F.col(e)).alias(f"_o{e}") for e in es])
        keep = [*[F.max(x).alias(x) for x in xs], F.max("_n").alias("_n"), *[F.first(b, ignorenulls=True).alias(b) for b in done]]
        rows = rows.groupBy(*keys, "_to", *ks, *[f"_o{e}" for e in es]).agg(*keep, *gathered(inner))
        k = f"_k{m.number}"
        pair = F.when(F.col("_to") == -m.number, F.struct(F.col(k).alias("key"), made(inner).alias("value")))
        rows = rows.withColumn("_pair", pair)
        rest = [c for c in ks if c != k]
        rows = rows.groupBy(*keys, "_to", *rest, *[f"_o{e}" for e in es]).agg(*keep, F.collect_list("_pair").alias("_pairs"))
        own = F.when(F.col("_to") == -m.number, F.map_from_entries("_pairs")).alias(f"_m{m.number}")
        rows = rows.select(
            *keys, F.col("_to").alias("_leaf"), *rest, F.lit(None).cast(m.type.keyType).alias(k), *[F.col(f"_o{e}").alias(e) for e in es], *xs, "_n", *done, own
        )
        done.append(f"_m{m.number}")
    last = [*[F.max(x).alias(x) for x in xs], *[F.first(b, ignorenulls=True).alias(b) for b in done]]
    return rows.groupBy(*keys).agg(*last, *gathered(root)).select(*keys, made(root).alias(out))
