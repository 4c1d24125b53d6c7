"""Column-name cleaning, for schema names in Python and for name columns as an expression."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: replacement of characters in names, in this order
NAME_MAP = (
    (" ", "_"), ("(", ""), (")", ""), ("/", "_"), ("%", "_pct"), ("$", "_dollar"), ("#", "_num"), ("@", "_at"),
    ("&", "_and"), ("+", "_plus"), ("=", "_eq"), (".", "_"), (",", "_"), (":", "_"), (";", "_"),
)
MAX_NAME = 64
UNNAMED = "unnamed_feature"


def clean_name(name: str) -> str:
    for old, new in NAME_MAP:
        name = name.replace(old, new)
    name = re.sub(r"_+", "_", re.sub(r"[^a-zA-Z0-9_]", "_", name)).strip("_")
    return name[:MAX_NAME].rstrip("_") or UNNAMED


def clean_name_expr(name: Column) -> Column:
    for old, new in NAME_MAP:
        name = F.replace(name, F.lit(old), F.lit(new))
    name = F.regexp_replace(name, "[^a-zA-Z0-9_]", "_")
    name = F.regexp_replace(F.regexp_replace(name, "_+", "_"), "^_+|_+$", "")
    name = F.regexp_replace(F.substring(name, 1, MAX_NAME), "_+$", "")
    return F.when(name == "", UNNAMED).otherwise(name)


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    """Column by its literal name, whatever characters that name holds."""
    return F.col(quoted(name))
