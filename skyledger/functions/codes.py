"""Categorical codes and header normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.schemas import STOPS_ORDINAL


def encode_stops(c="stops") -> Column:
    """Stopover text -> 0/1/2; unknown text -> null."""
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for text, code in STOPS_ORDINAL.items():
        expr = (F.when(c == text, F.lit(code)) if expr is None
                else expr.when(c == text, F.lit(code)))
    return expr.cast("int")


def to_snake_case(name: str) -> str:
    """'Tax & Surcharge (BDT)' -> 'tax_and_surcharge_bdt'."""
    s = name.strip().replace("&", " and ")
    s = re.sub(r"[()]", " ", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s)
    return s.strip("_").lower()
