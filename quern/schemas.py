"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _F = T.StringType(), T.LongType(), T.FloatType()
BULLETS = [f"bullet_point{i}" for i in range(1, 6)]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


RAW_ANSWER = _struct(answer_text=_S)
RAW_QUESTION = _struct(
    question_id=_S, asin=_S, question_text=_S, question_type=_S, answer_aggregated=_S,
    brand_name=_S, item_name=_S, product_description=_S,
    **{b: _S for b in BULLETS}, answers=T.ArrayType(RAW_ANSWER))

ENRICHED_ANSWER = _struct(answer_text=_S, name=_S, user_lat=_F, user_lon=_F, gender=_S,
                          age=_L, product_rating=_L)
QUESTION = _struct(
    question_id=_S, asin=_S, category_name=_S, question_text=_S, question_type=_S,
    answer_aggregated=_S, brand_name=_S, item_name=_S, product_description=_S, bullets=_S,
    answers=T.ArrayType(ENRICHED_ANSWER), chunk_text=_S)
PASSAGE = _struct(pid=_S, domain=_S, passage=_S, chunk_text=_S)

DENSE_FIELD = T.StructField("chunk_embedding", T.ArrayType(_F))
SPARSE_FIELD = T.StructField("chunk_sparse_embedding", T.MapType(_S, _F))


def merge_schema(base: T.StructType, updates: T.StructType) -> T.StructType:
    """Structs merge field by field; any other type in ``updates`` replaces the base type.

    Base order is kept and new fields follow. Neither argument is changed.
    """
    merged = {f.name: f for f in base.fields}
    for field in updates.fields:
        old = merged.get(field.name)
        if old is not None and isinstance(old.dataType, T.StructType) and isinstance(field.dataType, T.StructType):
            field = T.StructField(field.name, merge_schema(old.dataType, field.dataType), field.nullable)
        merged[field.name] = field
    return T.StructType(list(merged.values()))


class SchemaConflict(ValueError):
    """Fields whose stored and incoming types do not fit; ``conflicts`` lists ``(path, stored, incoming)``."""

    def __init__(self, conflicts: list[tuple[str, str, str]]):
        self.conflicts = conflicts
        super().__init__("; ".join(f"{path}: {old} stored, {new} incoming" for path, old, new in conflicts))


# Numbers that hold every value of the narrower type.
_WIDENS = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"),
           ("int", "bigint"), ("int", "double"), ("float", "double")}


def _evolved(old: T.DataType, new: T.DataType, path: str, conflicts: list) -> T.DataType:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        incoming = {f.name: f.dataType for f in new.fields}
        kept = [T.StructField(f.name, _evolved(f.dataType, incoming[f.name], f"{path}.{f.name}".lstrip("."), conflicts)
                              if f.name in incoming else f.dataType) for f in old.fields]
        return T.StructType(kept + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in old.names])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_evolved(old.elementType, new.elementType, f"{path}[]", conflicts))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(_evolved(old.keyType, new.keyType, f"{path}{{key}}", conflicts),
                         _evolved(old.valueType, new.valueType, f"{path}{{}}", conflicts))
    names = old.simpleString(), new.simpleString()
    if names[0] == names[1] or isinstance(new, T.NullType) or names[::-1] in _WIDENS:
        return old
    if isinstance(old, T.NullType) or names in _WIDENS:
        return new
    conflicts.append((path, *names))
    return old


def evolve(stored: T.StructType, incoming: T.StructType) -> T.StructType:
    """The schema that holds rows of both: fields of structs, also inside arrays and maps, are united by name, numbers widen.

    All that does not fit is reported at once by ``SchemaConflict``, one path per field.
    """
    conflicts: list[tuple[str, str, str]] = []
    merged = _evolved(stored, incoming, "", conflicts)
    if conflicts:
        raise SchemaConflict(conflicts)
    return merged


def _fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` as type ``want``; fields it lacks are null."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        types = {f.name: f.dataType for f in have.fields}
        fields = [(_fitted(value[f.name], types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType)).alias(f.name)
                  for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _fitted(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        fitted = F.transform_values(value, lambda k, v: _fitted(v, have.valueType, want.valueType))
        return fitted if have.keyType == want.keyType else F.transform_keys(fitted, lambda k, v: _fitted(k, have.keyType, want.keyType))
    return value.cast(want)


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows rewritten to ``schema``, an evolution of theirs (see ``evolve``): columns and nested fields they lack are null."""
    have = {f.name: f.dataType for f in rows.schema.fields}
    return rows.select(*((_fitted(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                         for f in schema.fields))


def add_columns(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Rows of both tables under the union of their columns; absent ones are null."""
    return existing.unionByName(added, allowMissingColumns=True)


def dotted_names(schema: T.StructType, prefix: str = "") -> list[str]:
    """Field names holding a dot, which a search server would read as a path."""
    found = []
    for f in schema.fields:
        if "." in f.name:
            found.append(prefix + f.name)
        kind = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(kind, T.StructType):
            found += dotted_names(kind, f"{prefix}{f.name}/")
    return found
