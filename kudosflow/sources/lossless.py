"""JSON lines read once as text, so that no field and no value is lost.

Each line becomes a VARIANT. Declared fields are taken from it by name without regard to
case and cast to their types; where a value does not fit, the line's text is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    IntegralType,
    MapType,
    NullType,
    NumericType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from kudosflow.observed import observed
from kudosflow.session import scratch_path

#: Spark's own name for the text of a line that does not fit.
CORRUPT = "_corrupt_record"

_LINE, _RECORD, _ENTRIES = "json__line", "json__record", "json__entries"
_MARK = "\ufeff"  # a file may begin with it


def declared_fields(spark: SparkSession, path: str | list[str], declared: StructType) -> DataFrame:
    """The declared fields alone, NULL where a value is missing or does not fit.

    One pass over the input; nothing is stored.
    """
    rows = _with_values(_records(spark, path), declared)
    return rows.select(*[_value(f, i)[0].alias(f.name) for i, f in enumerate(declared)])


def all_fields(spark: SparkSession, path: str | list[str], declared: StructType) -> DataFrame:
    """The declared fields, then ``_corrupt_record`` if a line needs it, then all others.

    The input is read once. A DataFrame needs its columns before it can be run, and these
    are known after a whole pass only. So that pass stores what it has parsed in the shared
    folder, as Parquet with a VARIANT column, and merges the types of all fields on its way;
    the rows returned are read from there.

    ``_corrupt_record`` has the text of each line that is no JSON object, has a declared
    field whose value does not fit its type, or spells a field in two ways. Other fields get
    the type that holds all their values, string if none does. Spellings of one name that
    differ in case are one column; where a file mixes them, the spelling that sorts first
    names it.
    """
    rows = _with_values(_records(spark, path), declared)
    misfit = F.col(_RECORD).isNull() | _twice()
    kept = []
    for i, field in enumerate(declared):
        value, wrong = _value(field, i)
        misfit |= wrong
        # What a VARIANT cannot hold, such as a field that comes twice, is tried as it was.
        again = F.from_json(_LINE, declared).getField(field.name)
        value = F.when(F.col(_RECORD).isNull(), again).otherwise(value)
        kept.append(value.alias(f"json__{i}"))
    text = F.when(misfit, F.col(_LINE)).alias(_LINE)
    parsed = rows.select(*kept, text, F.col(_RECORD))
    seen = Observation()
    watched = parsed.observe(
        seen,
        F.expr(f"schema_of_variant_agg({_RECORD})").alias("schema"),
        F.count(_LINE).alias("kept"),
    )
    staged = scratch_path(spark, "records")
    watched.write.parquet(staged)
    found = observed(seen)
    stored = spark.read.schema(parsed.schema).parquet(staged)

    columns = [F.col(f"json__{i}").alias(field.name) for i, field in enumerate(declared)]
    if found.get("kept"):
        columns.append(F.col(_LINE).alias(CORRUPT))
    taken = {field.name.lower() for field in declared} | {CORRUPT}
    for name, kind, spellings in _others(found.get("schema"), taken):
        own = [_field(spelling, kind) for spelling in spellings]
        columns.append(F.coalesce(*own).alias(name))
    return stored.select(*columns)


def _records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A row for each object: its line, and the line as VARIANT, NULL if it is no object.

    A line may hold an array of objects, and blank lines are no rows, as Spark has it.
    """
    lines = spark.read.text(path).select(F.ltrim(F.col("value"), F.lit(_MARK)).alias(_LINE))
    lines = lines.where(F.trim(F.regexp_replace(_LINE, r"\s", " ")) != "")
    parsed = F.try_parse_json(_LINE)
    several = F.expr(f"try_variant_get({_RECORD}, '$', 'array<variant>')")
    first = F.substring(F.ltrim(_LINE), 1, 1)
    one = F.when(first != "[", F.array(F.col(_RECORD)))
    each = lines.withColumn(_RECORD, parsed).withColumn(
        _RECORD, F.explode_outer(F.coalesce(one, several))
    )
    is_object = F.schema_of_variant(_RECORD).startswith("OBJECT")
    return each.withColumn(_RECORD, F.when(is_object, F.col(_RECORD)))


def _with_values(records: DataFrame, declared: StructType) -> DataFrame:
    """The value of each declared field, still a VARIANT, and the names of all fields."""
    entries = F.expr(
        f"transform(map_entries(try_cast({_RECORD} AS map<string, variant>)), entry -> "
        "struct(lower(entry.key) AS folded, entry.key AS name, entry.value AS value))"
    )
    found = {f"json__found{i}": _found(field.name) for i, field in enumerate(declared)}
    return records.withColumn(_ENTRIES, entries).withColumns(found)


def _found(field: str) -> Column:
    """The entry of a field: the exact spelling first, then others in their order, null
    values last."""
    name = _literal(field)
    own = f"filter({_ENTRIES}, entry -> entry.folded = lower({name}))"
    return F.expr(
        f"get(if(size({own}) < 2, {own}, array_sort({own}, "
        "(a, b) -> CASE WHEN is_variant_null(a.value) <> is_variant_null(b.value) "
        "THEN if(is_variant_null(a.value), 1, -1) "
        f"WHEN a.name = {name} THEN -1 WHEN b.name = {name} THEN 1 "
        "WHEN a.name < b.name THEN -1 ELSE 1 END)), 0).value"
    )


def _twice() -> Column:
    """Whether a record spells some name in more than one way."""
    return F.expr(f"size(array_distinct({_ENTRIES}.folded)) < size({_ENTRIES})")


def _value(field: StructField, number: int) -> tuple[Column, Column]:
    """A declared field's value, and whether there is one that does not fit.

    What is left to Spark's cast: numbers from strings, strings from anything. A truth value
    is no number, and a number with a fraction is not whole.
    """
    found = F.col(f"json__found{number}")
    value = F.try_variant_get(found, "$", field.dataType.simpleString())
    if isinstance(field.dataType, NumericType):
        fits = F.schema_of_variant(found) != "BOOLEAN"
        if isinstance(field.dataType, IntegralType):
            number = F.try_variant_get(found, "$", "double")
            fits &= number == F.floor(number)
        value = F.when(fits, value)
    there = found.isNotNull() & ~F.is_variant_null(found)
    return value, F.coalesce(there & value.isNull(), F.lit(False))


def _others(schema: str | None, taken: set[str]) -> list[tuple[str, DataType, list[str]]]:
    """Name, type and spellings of the fields that are not declared."""
    if schema is None or not schema.startswith("OBJECT<"):
        return []
    found = DataType.fromDDL(_as_struct(schema))
    spelled: dict[str, list[StructField]] = {}
    for field in found:
        spelled.setdefault(field.name.lower(), []).append(field)
    out = []
    for folded, fields in spelled.items():
        if folded in taken:
            continue
        kinds = {_settled(field.dataType).simpleString() for field in fields}
        kind = _settled(fields[0].dataType) if len(kinds) == 1 else StringType()
        out.append((fields[0].name, kind, [field.name for field in fields]))
    return out


def _as_struct(schema: str) -> str:
    """The type of a VARIANT in Spark's own terms; quoted names are left alone."""
    parts = schema.split("`")
    return "`".join(
        part.replace("OBJECT<", "STRUCT<") if i % 2 == 0 else part for i, part in enumerate(parts)
    )


def _settled(kind: DataType) -> DataType:
    """The type of a column for the merged type of its values, as JSON inference has it:
    fractions are doubles; what is always null, or of unlike kinds, is a string."""
    if isinstance(kind, DecimalType) and kind.scale > 0:
        return DoubleType()
    if isinstance(kind, (NullType, VariantType)):
        return StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(_settled(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(kind.keyType, _settled(kind.valueType))
    if isinstance(kind, StructType):
        if not kind.fields:
            return StringType()
        return StructType([StructField(f.name, _settled(f.dataType)) for f in kind])
    return kind


def _field(name: str, kind: DataType) -> Column:
    """A field of a stored record by its exact name, whatever signs that has."""
    record = f"try_cast({_RECORD} AS map<string, variant>)"
    if not set(name) & set("'\"\\[]`\n"):
        return F.expr(
            f"try_variant_get({_RECORD}, {_literal(f"$['{name}']")}, {_literal(kind.simpleString())})"
        )
    value = F.expr(f"try_element_at({record}, {_literal(name)})")
    return F.try_variant_get(value, "$", kind.simpleString())


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
