"""Ingest: text lines -> the common event schema, with a quarantine.

A line is parsed, each field converted to its target type, and the line is
either *valid* (routed to ``partition`` ``T`` or ``Q``) or *quarantined*
(``partition`` ``B``, sentinel values, raw text in ``line``). All of it is one
projection of column expressions over a ``DataFrame[value: string]``: no Python
worker, and the stage is a plain map with no shuffle.

Rules kept from the source pipeline (see README for the full list):

* CSV: split on ``,`` with no quoting; the kind is field 3, compared before
  trimming (``'Q '`` is invalid); a quote has 11 fields, a trade 9.
* JSON: one object per line, the kind in ``event_type``; extra keys ignored.
  Values must have the right JSON type: a price accepts a fractional number or
  a numeric string but not an integer; an int accepts an integer, a boolean or
  a numeric string but not a fraction; dates, times and strings need strings;
  an explicit null is rejected.
* A present field that does not convert rejects the line; so does an absent
  required field. An empty CSV numeric field rejects the line; an empty string
  field is valid.
* Trade ``size`` is not part of the schema and is dropped unread.

Changed on purpose: lines that crashed the source job (fewer than three CSV
fields, a blank line, a JSON value that is not an object or has no
``event_type``, numbers out of range) are quarantined instead; JSON decimals are
read from their exact text; a time with no date is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.json import json_field, json_object, json_type
from ..functions.text import convert_text, strip_ws

# Input key names that feed each common column (the rename map, inverted).
_SOURCE_KEYS: dict[str, tuple[str, ...]] = {}
for _f in S.DATA_FIELDS:
    _src = tuple(k for k, v in S.RENAMES.items() if v == _f.name)
    _SOURCE_KEYS[_f.name] = _src + (_f.name,) if _src else (_f.name,)

# The parse is a chain of projections, each naming its results, so no
# expression (split, JSON parse, regex guard) is built twice and the generated
# code of each step stays small.


def _conform(df: DataFrame, line: str, schema: T.StructType = S.COMMON_SCHEMA) -> DataFrame:
    """Final step: ``__c_<col>`` holds each converted value, ``__ok_<col>`` its
    check, ``__kind`` the routing tag. Valid rows keep the values, the rest
    become the quarantine record."""
    data = [f for f in schema.fields if f.name not in ("partition", "line")]
    oks = [F.col(f"__ok_{f.name}") for f in data] + [F.col("__known")]
    valid_df = df.select("*", F.coalesce(_all(oks), F.lit(False)).alias("__valid"))
    valid = F.col("__valid")
    cols = []
    for f in schema.fields:
        if f.name == "partition":
            cols.append(F.when(valid, F.col("__kind")).otherwise(F.lit(S.BAD)).alias(f.name))
        elif f.name == "line":
            cols.append(F.when(~valid, F.col(line)).cast(T.StringType()).alias(f.name))
        else:
            v = F.col(f"__c_{f.name}").cast(f.dataType)
            cols.append(F.when(valid, v)
                        .otherwise(S.sentinel_column(f.dataType))
                        .alias(f.name))
    # The one-row generator is an optimizer boundary: a later filter on these
    # columns (``partition = 'T'``) stays above it instead of being pushed
    # down with every alias expanded in place, which would copy the whole parse
    # into the filter many times over.
    return valid_df.select(F.inline(F.array(F.struct(*cols))))


def _all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _checked(name: str, present: Column, conv: Column, nullable: bool,
             extra_ok: Column | None = None) -> list[Column]:
    """Converted value and its check: a present value must convert; an absent
    one is fine only for a nullable column."""
    if nullable:
        ok = ~present | conv.isNotNull()
        if extra_ok is not None:
            ok = ok | extra_ok
    else:
        ok = present & conv.isNotNull()
    return [conv.alias(f"__c_{name}"), F.coalesce(ok, F.lit(False)).alias(f"__ok_{name}")]


def _field(parts: Column, pos) -> Column:
    return F.lit(None).cast("string") if pos is None else F.try_element_at(parts, F.lit(pos + 1))


def parse_csv(lines: DataFrame, line_col: str = "value",
              schema: T.StructType = S.COMMON_SCHEMA) -> DataFrame:
    """CSV lines -> common rows (valid or quarantined). I1, I3-I8."""
    step1 = lines.select(F.col(line_col).alias("__line"),
                         F.split(F.col(line_col), ",", -1).alias("__parts"))
    parts = F.col("__parts")
    n = F.size(parts)
    kind = F.try_element_at(parts, F.lit(S.KIND_POSITION + 1))
    step2 = step1.select(
        "__line", "__parts", kind.alias("__kind"),
        F.coalesce((kind == S.QUOTE) & (n == len(S.QUOTE_LAYOUT)), F.lit(False)).alias("__is_q"),
        F.coalesce((kind == S.TRADE) & (n == len(S.TRADE_LAYOUT)), F.lit(False)).alias("__is_t"))
    is_q, is_t = F.col("__is_q"), F.col("__is_t")

    q_pos = {S.RENAMES.get(c, c): i for i, c in enumerate(S.QUOTE_LAYOUT)}
    t_pos = {S.RENAMES.get(c, c): i for i, c in enumerate(S.TRADE_LAYOUT)}
    # Raw text of each column for this line's layout (NULL = not in it).
    raw = {}
    for f in schema.fields:
        if f.name in ("partition", "line", "rec_type"):
            continue
        if f.name in q_pos or f.name in t_pos:
            raw[f.name] = (F.when(is_q, _field(parts, q_pos.get(f.name)))
                            .when(is_t, _field(parts, t_pos.get(f.name))))
    step3 = step2.select("__line", "__kind", (is_q | is_t).alias("__known"),
                         *[r.alias(f"__r_{k}") for k, r in raw.items()])
    step3 = step3.select("__line", "__kind", "__known",
                         *[strip_ws(F.col(f"__r_{k}")).alias(f"__r_{k}") for k in raw])
    out = []
    for f in schema.fields:
        if f.name in ("partition", "line"):
            continue
        if f.name == "rec_type":
            out += [F.col("__kind").alias("__c_rec_type"), F.lit(True).alias("__ok_rec_type")]
        elif f.name in raw:
            r = F.col(f"__r_{f.name}")
            out += _checked(f.name, r.isNotNull(), convert_text(r, f.dataType, stripped=True),
                            f.nullable)
        else:
            out += [F.lit(None).alias(f"__c_{f.name}"), F.lit(f.nullable).alias(f"__ok_{f.name}")]
    step4 = step3.select("__line", "__kind", "__known", *out)
    return _conform(step4, "__line", schema)


_INTEGRAL = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def _json_value(name: str, dtype: T.DataType, strict: bool) -> Column:
    """Convert one JSON value to ``dtype`` under the JSON type rules, from the
    columns ``__j_<name>`` (VARIANT), ``__t_<name>`` (its type name) and
    ``__x_<name>`` (its trimmed text when it is a JSON string)."""
    v, t, text = F.col(f"__j_{name}"), F.col(f"__t_{name}"), F.col(f"__x_{name}")
    if isinstance(dtype, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return convert_text(text, dtype, stripped=True)  # NULL unless a JSON string
    if isinstance(dtype, T.IntegerType):
        integral = t.isin(*_INTEGRAL, "BOOLEAN")
        return (F.when(integral, F.try_variant_get(v, "$", "int"))
                 .otherwise(convert_text(text, dtype, stripped=True)))
    if isinstance(dtype, T.DecimalType):
        fractional = t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT")
        if not strict:
            fractional = fractional | t.isin(*_INTEGRAL)
        return (F.when(fractional, F.try_variant_get(v, "$", dtype.simpleString()))
                 .otherwise(convert_text(text, dtype, stripped=True)))
    raise TypeError(f"unsupported target type {dtype}")


def parse_json(lines: DataFrame, line_col: str = "value", strict_json_types: bool = True,
               schema: T.StructType = S.COMMON_SCHEMA) -> DataFrame:
    """JSON lines -> common rows (valid or quarantined). I2-I8, X7, X8.

    ``strict_json_types=False`` also accepts integer prices and an explicit
    null in a nullable field.
    """
    step1 = lines.select(F.col(line_col).alias("__line"),
                         json_object(F.col(line_col)).alias("__obj"))
    obj = F.col("__obj")
    data = [f for f in schema.fields if f.name not in ("partition", "line", "rec_type")]
    step2 = step1.select("__line", json_field(obj, "event_type").alias("__kind_v"),
                         *[json_field(obj, *_SOURCE_KEYS[f.name]).alias(f"__j_{f.name}")
                           for f in data])
    # Type name of each value, and its text when it is a JSON string.
    step3 = step2.select("__line", "__kind_v", *[F.col(f"__j_{f.name}") for f in data],
                         *[json_type(F.col(f"__j_{f.name}")).alias(f"__t_{f.name}") for f in data])
    kind_v = F.col("__kind_v")
    kind = F.when(json_type(kind_v) == "STRING", F.try_variant_get(kind_v, "$", "string"))
    step4 = step3.select(
        "__line", kind.alias("__kind"),
        *[F.col(f"__j_{f.name}") for f in data], *[F.col(f"__t_{f.name}") for f in data],
        *[strip_ws(F.when(F.col(f"__t_{f.name}") == "STRING",
                          F.try_variant_get(F.col(f"__j_{f.name}"), "$", "string"))).alias(f"__x_{f.name}")
          for f in data])
    out = [F.col("__kind").alias("__c_rec_type"), F.lit(True).alias("__ok_rec_type")]
    for f in data:
        present = F.col(f"__j_{f.name}").isNotNull()
        extra = None if strict_json_types else (F.col(f"__t_{f.name}") == "VOID")
        out += _checked(f.name, present, _json_value(f.name, f.dataType, strict_json_types),
                        f.nullable, extra)
    step5 = step4.select("__line", "__kind",
                         F.coalesce(F.col("__kind").isin(S.QUOTE, S.TRADE), F.lit(False)).alias("__known"),
                         *out)
    return _conform(step5, "__line", schema)


def parse_lines(lines: DataFrame, fmt: str, line_col: str = "value", **kw) -> DataFrame:
    if fmt == "csv":
        return parse_csv(lines, line_col)
    if fmt == "json":
        return parse_json(lines, line_col, **kw)
    raise ValueError(f"unknown line format {fmt!r}")


def empty_common(spark, schema: T.StructType = S.COMMON_SCHEMA) -> DataFrame:
    """Empty typed table (S6): the result when there is no input at all."""
    return spark.createDataFrame([], schema)


def valid_rows(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("partition") != S.BAD)


def quarantined(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("partition") == S.BAD)
