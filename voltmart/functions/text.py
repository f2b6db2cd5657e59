"""Text forms: database CSV spelling, JSON responses, deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmart.functions.time import col
from voltmart.schemas import START_RESPONSE


def utc_text(ts: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS[.ffffff]+00``, trailing zeros of the fraction cut."""
    full = F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(full, r"\.?0{1,6}$", ""), F.lit("+00"))


def bool_text(flag: Column | str) -> Column:
    return F.when(col(flag), F.lit("t")).when(~col(flag), F.lit("f"))


def csv_columns(df: DataFrame) -> list[Column]:
    """One text column per field, spelled the way the warehouse exports it; NULL stays NULL."""
    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            text = utc_text(field.name)
        elif isinstance(field.dataType, T.BooleanType):
            text = bool_text(field.name)
        else:
            text = F.col(field.name).cast("string")
        out.append(text.alias(field.name))
    return out


def start_response_json(**fields: Column) -> Column:
    """The stored start response; fields with NULL are kept."""
    parts = [fields[f.name].cast(f.dataType).alias(f.name) for f in START_RESPONSE.fields]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def parse_start_response(json_text: Column | str) -> Column:
    return F.from_json(col(json_text), START_RESPONSE)


def derived_id(kind: str, key: Column | str) -> Column:
    """A repeatable id for a generated row, so a rerun produces the same row."""
    return F.sha2(F.concat(F.lit(f"{kind}:"), col(key)), 256)
