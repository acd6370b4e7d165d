"""Typed access to the semi-structured payload column.

The payload is parsed once per row into a struct that holds just the fields a
view asks for; every accessor then reads that struct.  Casts give NULL instead of
failing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .values import whole

HOLDER = "_payload"


class Payload:
    """A DataFrame with its payload parsed, and accessors for the fields."""

    def __init__(self, df: DataFrame, fields: Sequence[str], column: str, once: bool = False) -> None:
        names = sorted(set(fields))
        if isinstance(df.schema[column].dataType, T.VariantType):
            parsed = F.struct(
                *[F.try_variant_get(F.col(column), f"$['{n}']", "string").alias(n) for n in names]
            )
        else:
            schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
            parsed = F.from_json(F.col(column), schema)
        if once:
            # the optimizer moves filters below a projection, which would parse again; it leaves them above a generator
            self.df = df.select("*", F.inline_outer(F.array(F.struct(parsed.alias(HOLDER)))))
        else:
            self.df = df.withColumn(HOLDER, parsed)

    def text(self, field: str) -> Column:
        return F.col(f"{HOLDER}.{field}")

    def whole(self, field: str) -> Column:
        """Number rounded to scale 0; NULL when it is not a number."""
        return whole(self.text(field))

    def real(self, field: str) -> Column:
        return self.text(field).try_cast("double")

    def flag(self, field: str) -> Column:
        return self.text(field).try_cast("boolean")


def payload_of(df: DataFrame, *fields: str, column: str = "feature_json", once: bool = False) -> Payload:
    """``once`` is for views that also filter by payload fields."""
    return Payload(df, fields, column, once)
