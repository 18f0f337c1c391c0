"""Parse raw text and separate what cannot be parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

CORRUPT = "_corrupt"
# Markers a snapshot run writes around its rows; they carry no data.
SNAPSHOT_MARKERS = ["bootstrap-start", "bootstrap-complete"]


def drop_tombstones(df: DataFrame, value: str = "value") -> DataFrame:
    """A null value in a keyed topic is a deletion, not a row."""
    return df.where(F.col(value).isNotNull())


def as_text(kind: T.DataType) -> T.DataType:
    """The type with text for every number in it: JSON writes them either way."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_text(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, as_text(kind.valueType))
    return T.StringType() if isinstance(kind, T.NumericType) else kind


def with_types(c: Column, kind: T.DataType) -> Column:
    """A value parsed with ``as_text(kind)`` as ``kind``; what is no number becomes null."""
    if as_text(kind) == kind:
        return c
    if isinstance(kind, T.StructType):
        fields = F.struct(*[with_types(c.getField(f.name), f.dataType).alias(f.name) for f in kind])
        return F.when(c.isNotNull(), fields)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: with_types(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, x: with_types(x, kind.valueType))
    return c.try_cast(kind)


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add ``record`` (parsed) and keep the text; malformed text leaves ``record._corrupt`` set.

    Numbers may be written as text; only JSON of another shape counts as malformed."""
    with_corrupt = T.StructType(as_text(schema).fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.withColumn("record", F.from_json(value, with_corrupt, options))


def _is_dirty() -> Column:
    return F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()


def clean_logs(df: DataFrame, schema: T.StructType, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(clean records, dirty text).  Two narrow filters over one parsed frame, no shuffle."""
    parsed = parse_json(drop_tombstones(df, value), schema, value)
    clean = parsed.where(~_is_dirty()).select(
        *[with_types(F.col("record")[f.name], f.dataType).alias(f.name) for f in schema])
    dirty = parsed.where(_is_dirty()).select(F.col(value).alias("value"))
    return clean, dirty


def clean_changes(df: DataFrame, schema: T.StructType, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """As ``clean_logs`` for change records: a record without ``type`` is dirty too, and the
    markers around a snapshot are dropped from both outputs."""
    parsed = parse_json(drop_tombstones(df, value), schema, value)
    kind = F.col("record.type")
    dirty_row = _is_dirty() | kind.isNull()
    clean = parsed.where(~dirty_row & ~kind.isin(SNAPSHOT_MARKERS)).select(
        *[with_types(F.col("record")[f.name], f.dataType).alias(f.name) for f in schema]
    )
    dirty = parsed.where(dirty_row).select(F.col(value).alias("value"))
    return clean, dirty
