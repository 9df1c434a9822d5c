"""Models (typed columns with a table name) and row validation with rejects."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.scalars import truthy


@dataclass(frozen=True)
class Field:
    name: str
    data_type: T.DataType
    required: bool = True
    default: object = None


def int_field(name: str, required: bool = True, default: object = None) -> Field:
    return Field(name, T.LongType(), required, default)


def string_field(name: str, required: bool = True, default: object = None) -> Field:
    return Field(name, T.StringType(), required, default)


def bool_field(name: str, required: bool = True, default: object = None) -> Field:
    return Field(name, T.BooleanType(), required, default)


def float_field(name: str, required: bool = True, default: object = None) -> Field:
    return Field(name, T.DoubleType(), required, default)


def datetime_field(name: str, required: bool = True, default: object = None) -> Field:
    return Field(name, T.TimestampNTZType(), required, default)


class Model:
    """A table name and its ordered fields. Bases give their fields first; own fields override in place."""

    def __init__(self, table_name: str, fields: list[Field], bases: tuple["Model", ...] = ()):
        if not table_name:
            raise ValueError("a model needs a table name")
        merged: dict[str, Field] = {}
        # with several bases the last one stands first, and the first one wins a clash
        for layer in [*(b.fields for b in reversed(bases)), fields]:
            merged.update({f.name: f for f in layer})
        self.table_name = table_name
        self.fields = tuple(merged.values())

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type, True) for f in self.fields])

    def extend(self, table_name: str, fields: list[Field]) -> "Model":
        return Model(table_name, fields, (self,))

    def optional(self, *names: str) -> "Model":
        """The same model with these fields allowed to be null."""
        return Model(
            self.table_name, [replace(f, required=False) if f.name in names else f for f in self.fields]
        )

    def bind(self, df: DataFrame) -> DataFrame:
        """Name the columns by position; the count must agree."""
        if len(df.columns) != len(self.fields):
            raise ValueError(f"{self.table_name} has {len(self.fields)} columns, got {len(df.columns)}")
        return df.toDF(*self.names)

    def check_names(self, names) -> None:
        unknown = [n for n in names if n not in self.names]
        if unknown:
            raise AttributeError(f"{self.table_name} has no column {', '.join(unknown)}")


PERSON = Model(
    "Users", [int_field("id"), string_field("name"), bool_field("sex"), float_field("height")]
)
MAN = PERSON.extend("Man", [int_field("age")])
USER = Model(
    "User",
    [
        int_field("id"),
        string_field("email"),
        string_field("password"),
        string_field("name"),
        datetime_field("created_date"),
        datetime_field("last_login_date"),
    ],
)
TOKEN = Model(
    "Token",
    [string_field("token"), int_field("user_id"), datetime_field("expire_date"), int_field("id")],
)
CRAWLER_STATS = Model(
    "CrawlerStats",
    [
        string_field("domain"),
        int_field("author_id"),
        datetime_field("time"),
        int_field("pages_count"),
    ],
)


class Validated(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


_ACCEPTED = {
    T.LongType: (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    T.DoubleType: (T.FloatType, T.DoubleType),
    T.StringType: (T.StringType,),
    T.TimestampNTZType: (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def _judged(
    field: Field, given: T.DataType | None, strict: bool, text_input: bool
) -> tuple[Column, Column]:
    """The converted value of a field and the reason to reject it (null when it is fine)."""
    if given is None:
        source, given = F.lit(None).cast(field.data_type), field.data_type
    else:
        source = F.col(field.name)
    missing = F.when(source.isNull(), F.lit("null in a required field")) if strict and field.required \
        else F.lit(None).cast("string")

    if isinstance(field.data_type, T.BooleanType):
        value = truthy(source, given)
        if strict and field.required:
            value = F.coalesce(value, F.lit(False))
        return value, F.lit(None).cast("string")

    name = field.data_type.simpleString()
    if isinstance(given, _ACCEPTED[type(field.data_type)]):
        return source.cast(field.data_type), missing
    if text_input and isinstance(given, T.StringType):
        value = source.try_cast(field.data_type)
        return value, F.when(source.isNotNull() & value.isNull(), F.lit(f"not a {name}")).otherwise(missing)
    value = F.lit(None).cast(field.data_type)
    return value, F.when(source.isNotNull(), F.lit(f"not a {name}")).otherwise(missing)


def validate(
    df: DataFrame,
    model: Model,
    strict: bool = True,
    text_input: bool = False,
    keep: tuple[str, ...] = (),
    row_id: str | None = None,
    fail_fast: bool = False,
) -> Validated:
    """Split rows into valid ones, converted to the model's types, and rejects with reasons.

    ``strict`` refuses nulls in required fields; otherwise null always passes. A value is judged by
    the type of its column, without conversion, except that ``text_input`` reads values out of text
    columns and a boolean field takes the truth of any value. ``keep`` names further columns that
    go along unchanged. ``rejects`` holds one row per bad field: (row, field, reason), where
    ``row`` is the ``row_id`` column or the whole row as JSON. ``fail_fast`` raises instead.
    """
    known = set(model.names) | set(keep) | ({row_id} if row_id else set())
    unknown = [c for c in df.columns if c not in known]
    if unknown:
        raise AttributeError(f"{model.table_name} has no column {', '.join(unknown)}")
    types = {f.name: f.dataType for f in df.schema.fields}
    judged = {f.name: _judged(f, types.get(f.name), strict, text_input) for f in model.fields}
    problems = F.filter(
        F.array(*[
            F.when(reason.isNotNull(), F.struct(F.lit(name).alias("field"), reason.alias("reason")))
            for name, (_, reason) in judged.items()
        ]),
        lambda p: p.isNotNull(),
    )
    bad = reduce(lambda a, b: a | b, [reason.isNotNull() for _, reason in judged.values()])
    out = [value.alias(name) for name, (value, _) in judged.items()]
    out += [F.col(k) for k in keep if k not in judged]
    if fail_fast:
        checked = F.when(bad, F.raise_error(F.concat(F.lit("rejected: "), F.to_json(problems))))
        return Validated(df.filter(F.coalesce(checked.cast("boolean"), F.lit(True))).select(*out), None)
    row = F.col(row_id) if row_id else F.to_json(F.struct("*"))
    rejects = (
        df.filter(bad)
        .select(row.alias("row"), F.explode(problems).alias("p"))
        .select("row", "p.field", "p.reason")
    )
    return Validated(df.filter(~bad).select(*out), rejects)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Put the store's default where a column is null (a null column is left out of an insert)."""
    types = dict(df.dtypes)
    return df.withColumns(
        {n: F.coalesce(F.col(n), F.lit(v).cast(types[n])) for n, v in defaults.items()}
    )


def text_times(df: DataFrame, model: Model) -> DataFrame:
    """Datetime fields as text, for output only."""
    from linkloom.functions.scalars import format_time

    times = [f.name for f in model.fields if isinstance(f.data_type, T.TimestampNTZType)]
    return df.withColumns({n: format_time(F.col(n)) for n in times if n in df.columns})
