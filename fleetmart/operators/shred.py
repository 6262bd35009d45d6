"""JSON documents shredded into typed columns. What has no column of its own, or does not fit it, is kept as a rest."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Type of a column that holds any value as JSON text.
JSON = "json"
_NESTED = r"^(OBJECT|ARRAY)"


@dataclass(frozen=True)
class Member:
    """A member of the documents, the column it goes to and the column's type: a scalar SQL type or ``json``."""

    key: str
    column: str
    kind: str


def members(doc: Column) -> Column:
    """Top-level members of a JSON object by name; NULL for broken text, repeated keys and documents that are no objects."""
    return F.try_variant_get(F.try_parse_json(doc), "$", "map<string,variant>")


def fitted(value: Column, kind: str) -> Column:
    """A member as a scalar; NULL where it is nested, null or does not convert. Truth values are no numbers."""
    if kind == JSON:
        return F.to_json(value)
    is_a = F.schema_of_variant(value)
    unfit = is_a.rlike(_NESTED) | (is_a == "VOID")
    if kind not in ("boolean", "string"):
        unfit = unfit | (is_a == "BOOLEAN")
    return F.when(~unfit, F.try_variant_get(value, "$", kind))


def document_members(df: DataFrame, column: str) -> DataFrame:
    """(name, kind, documents): every member name of the documents, the type that holds all its values, and in how many
    documents it is. Types are merged before the shuffle, so a member of all documents is one row per task.
    """
    entries = df.select(F.explode(F.map_entries(members(F.col(column)))).alias("_e")).select(F.col("_e.key").alias("name"), F.col("_e.value").alias("value"))
    return entries.groupBy("name").agg(F.schema_of_variant_agg("value").alias("kind"), F.count("*").alias("documents"))


def _column_type(kind: str) -> str:
    if kind.startswith("DECIMAL") or kind in ("BIGINT", "DOUBLE", "STRING", "BOOLEAN"):
        return kind.lower()
    return "string" if kind == "VOID" else JSON


def discover(df: DataFrame, column: str, share: float = 0.01, prefix: str = "") -> list[Member]:
    """Members that at least this share of the readable documents have, the most frequent first.

    Their number is at most that of the members of an average document over ``share``, so names that are data (an id as a
    key) never reach the driver. Of names that differ by case only, the most frequent gets the column.
    """
    readable = df.where(members(F.col(column)).isNotNull()).count()
    frequent = document_members(df, column).where(F.col("documents") >= share * max(readable, 1)).orderBy(F.desc("documents"), "name")
    taken, out = {c.lower() for c in df.columns}, []
    for r in frequent.collect():
        name = prefix + r["name"]
        if name.lower() not in taken:
            taken.add(name.lower())
            out.append(Member(r["name"], name, _column_type(r["kind"])))
    return out


def shred(df: DataFrame, column: str, wanted: list[Member], rest: str = "rest") -> DataFrame:
    """The rows with a column per member and ``rest``: JSON of the members without a column and of those whose value does
    not fit theirs, or the text itself where it is no JSON object; NULL if nothing is left over. The document is parsed
    once per row.
    """
    held = "_members"
    while held in df.columns:
        held += "_"
    rows = df.withColumn(held, members(F.col(column)))
    rows = rows.withColumns({m.column: fitted(F.col(held)[m.key], m.kind) for m in wanted})
    keys = [m.key for m in wanted]

    def left_over(key: Column, _value: Column) -> Column:
        unfit = [(key == m.key) & F.col(m.column).isNull() for m in wanted]
        return reduce(or_, unfit, ~key.isin(keys) if keys else F.lit(True))

    others = F.map_filter(F.col(held), left_over)
    text = F.when(F.col(held).isNull(), F.col(column)).when(F.size(others) > 0, F.to_json(F.to_variant_object(others)))
    return rows.withColumn(rest, text).drop(held)
