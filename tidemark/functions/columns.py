"""Column expressions shared by the layers (all built-in, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import OP_VERBS


def op_verb(code: Column) -> Column:
    """Change op code -> verb; an unknown code gives NULL."""
    expr = None
    for k, v in OP_VERBS.items():
        expr = F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v))
    return expr


def op_code(verb: Column) -> Column:
    """Verb -> op code (inverse of :func:`op_verb`)."""
    expr = None
    for k, v in OP_VERBS.items():
        expr = F.when(verb == v, F.lit(k)) if expr is None else expr.when(verb == v, F.lit(k))
    return expr


def topic_table(topic: Column) -> Column:
    """``prefix.schema.table`` -> ``table``."""
    return F.element_at(F.split(topic, r"\."), -1)


def millis_to_ts(ms: Column) -> Column:
    """Epoch milliseconds -> timestamp, exact to the millisecond."""
    return F.timestamp_millis(ms)


def ts_to_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast(T.TimestampType()))


def decode_date(text: Column) -> Column:
    """A DATE from a change image: epoch days (connect mode) or ISO text."""
    return (F.when(text.rlike(r"^-?[0-9]+$"), F.date_from_unix_date(text.cast(T.IntegerType())))
            .otherwise(F.to_date(text)))


def encode_date(d: Column) -> Column:
    """DATE -> epoch days, the form a connector in connect mode emits."""
    return F.unix_date(d)


def encode_ts(ts: Column) -> Column:
    """Timestamp -> zoned ISO-8601 text in UTC."""
    return F.date_format(ts.cast(T.TimestampType()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def money_out(c: Column) -> Column:
    """Decimal money -> double at the output edge."""
    return c.cast(T.DoubleType())


def ratio(num: Column, den: Column) -> Column:
    """Exact decimal/integer sums divided as doubles; NULL when the base is 0."""
    return num.cast(T.DoubleType()) / F.nullif(den, F.lit(0)).cast(T.DoubleType())


def is_live(deleted: Column) -> Column:
    """``_is_deleted = false``: NULL is not live."""
    return deleted == F.lit(False)


def evaluate_once(df, expr: Column, name: str, keep: list[str]):
    """Project ``keep`` plus ``expr`` as ``name`` so that later filters on ``name``
    cannot be pushed below it and re-evaluate ``expr``.

    Catalyst inlines aliases when it pushes a filter through a projection; for an
    expensive expression (JSON parsing) that means evaluating it twice.  A one-row
    ``explode`` is a Generate node, and filters on generator output stay above it.
    """
    return df.select(*keep, F.explode(F.array(expr)).alias(name))
