"""Names and types of files that spell and type their columns differently.

A column is known by its name without regard to case, as Spark resolves it. Columns of the service's layout get
the layout's spelling and type. Other columns are typed by what they hold: each file's values place its column in the
lattice ``nothing < whole < number < text`` or ``nothing < time < text``, and several files' columns meet at the least
type that holds them all.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.functions.text import parse_timestamp, real_number, whole_number

NOTHING, WHOLE, NUMBER, TIME, TEXT = "nothing", "whole", "number", "time", "text"

#: Types from narrow to wide; a value of one is kept by each that follows it.
_WIDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()]


def canonical_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` with the columns that ``names`` has in another case renamed to that spelling.

    Two columns of one name are an error.
    """
    own = [c.lower() for c in df.columns]
    twice = sorted({c for c in own if own.count(c) > 1})
    if twice:
        raise ValueError(f"columns that differ in case only: {twice}")
    spelling = {n.lower(): n for n in names}
    return df.toDF(*[spelling.get(c.lower(), c) for c in df.columns])


def _fits(value: Column) -> dict[str, Column]:
    """For each kind above nothing, whether a text is a value of it."""
    return {
        WHOLE: F.rlike(value, F.lit(r"^\s*[+-]?\d{1,18}\s*$")),
        NUMBER: real_number(value).isNotNull(),
        TIME: parse_timestamp(value).isNotNull() & real_number(value).isNull(),
    }


def column_kinds(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The least kind of each text column, by one aggregate over all its values."""
    if not columns:
        return {}
    checks = {}
    for i, name in enumerate(columns):
        value = F.nullif(F.trim(F.col(f"`{name}`")), F.lit(""))
        checks[f"some{i}"] = F.count(value)
        for kind, fits in _fits(value).items():
            checks[f"{kind}{i}"] = F.count(F.when(fits, 1))
    row = df.agg(*[c.alias(n) for n, c in checks.items()]).first()
    found = {}
    for i, name in enumerate(columns):
        some = row[f"some{i}"]
        full = [kind for kind in (WHOLE, NUMBER, TIME) if row[f"{kind}{i}"] == some]
        found[name] = NOTHING if not some else full[0] if full else TEXT
    return found


def wider_kind(one: str, two: str) -> str:
    """The least kind that holds both."""
    if one == two or two == NOTHING:
        return one
    if one == NOTHING:
        return two
    return NUMBER if {one, two} == {WHOLE, NUMBER} else TEXT


def merge_kinds(files: Iterable[dict[str, str]]) -> dict[str, str]:
    """Kinds that hold the columns of all files; names are one whatever their case, spelled as first seen."""
    found: dict[str, tuple[str, str]] = {}
    for kinds in files:
        for name, kind in kinds.items():
            spelled, before = found.get(name.lower(), (name, NOTHING))
            found[name.lower()] = (spelled, wider_kind(before, kind))
    return dict(found.values())


def typed(value: Column, kind: str) -> Column:
    """A text as a value of the kind; blank texts of other kinds than text are null."""
    if kind == WHOLE:
        return whole_number(F.trim(value))
    if kind == TIME:
        return parse_timestamp(F.trim(value))
    if kind == NUMBER:
        return real_number(F.trim(value))
    return value.cast("string")


def wider_type(one: T.DataType, two: T.DataType) -> T.DataType | None:
    """The least type that keeps the values of both, or None. A column of nulls takes the other's type."""
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if {type(one), type(two)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if {type(one), type(two)} <= {T.TimestampType, T.TimestampNTZType, T.DateType}:
        return T.TimestampNTZType() if T.TimestampType not in {type(one), type(two)} else T.TimestampType()
    if one in _WIDER and two in _WIDER:
        return _WIDER[max(_WIDER.index(one), _WIDER.index(two))]
    return None


def fit_to(df: DataFrame, stored: T.StructType) -> tuple[DataFrame, T.StructType]:
    """``df`` as rows of a table with the schema ``stored``, and the table's schema with the columns that are new.

    Stored columns come first, in their spelling and type; those that ``df`` lacks are null. A column whose values
    the stored type might not hold is an error: stored files are not written anew.
    """
    df = canonical_names(df, stored.names)
    own = {f.name: f for f in df.schema}
    narrowed = []
    for field in stored:
        new = own.get(field.name)
        if new is not None and wider_type(field.dataType, new.dataType) != field.dataType:
            narrowed.append(f"{field.name}: {field.dataType.simpleString()} <- {new.dataType.simpleString()}")
    if narrowed:
        raise ValueError("the table's types are too narrow: " + ", ".join(narrowed))
    added = [T.StructField(f.name, f.dataType) for f in df.schema if f.name not in stored.names]
    old = [
        (F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in stored
    ]
    return df.select(*old, *[F.col(f"`{f.name}`") for f in added]), T.StructType([*stored.fields, *added])


def merge_frames(frames: list[DataFrame]) -> DataFrame:
    """All rows, matched by name without regard to case, in types that hold every frame's values."""
    types: dict[str, tuple[str, T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            name, before = types.get(field.name.lower(), (field.name, T.NullType()))
            # What no common type holds is kept as text.
            types[field.name.lower()] = (name, wider_type(before, field.dataType) or T.StringType())
    whole = None
    for frame in frames:
        named = canonical_names(frame, [name for name, _ in types.values()])
        columns = [
            (F.col(f"`{name}`") if name in named.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in types.values()
        ]
        whole = named.select(*columns) if whole is None else whole.unionByName(named.select(*columns))
    return whole
