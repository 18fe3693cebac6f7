"""Arrow-batched Python helpers for the few per-row steps Spark has no
built-in for: strict JSON parsing of model replies (SC14), URL resolution
(SC13) and a user-supplied detector (UDF1).  Each runs as a pandas_udf on
Arrow batches inside the Spark task that owns the rows."""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _strict_one(raw):
    if raw is None:
        return []
    start = raw.find("{")
    end = raw.rfind("}") + 1
    if start == -1:
        return []
    try:
        obj = json.loads(raw[start:end])
        vals = obj.get("programming_languages", [])
        if not isinstance(vals, list) or not all(isinstance(v, str) for v in vals):
            return []
        return sorted(set(vals))
    except Exception:
        return []


@F.pandas_udf(T.ArrayType(T.StringType()))
def _strict_udf(raw: pd.Series) -> pd.Series:
    return raw.map(_strict_one)


def parse_languages_strict(raw) -> Column:
    """SC14 exactly as a strict JSON parser sees it: slice first ``{`` .. last
    ``}``, parse, read ``programming_languages``; anything unexpected -> []."""
    return _strict_udf(F.col(raw) if isinstance(raw, str) else raw)


@F.pandas_udf(T.StringType())
def _urljoin_udf(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else urljoin(b or "", h) for b, h in zip(base, href)])


def resolve_url(base, href) -> Column:
    """SC13: relative link resolution (``urllib.parse.urljoin``)."""
    b = F.col(base) if isinstance(base, str) else base
    h = F.col(href) if isinstance(href, str) else href
    return _urljoin_udf(b, h)


def detector_udf(fn: Callable[[str], list[str]]):
    """UDF1: wrap a user callable text -> list of names as an Arrow UDF.
    A failing call yields [] for that row, never fails the job."""
    def safe(t):
        if t is None:
            return []
        try:
            out = fn(t)
            return [str(x) for x in out] if out else []
        except Exception:
            return []

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(text: pd.Series) -> pd.Series:
        return text.map(safe)

    return run
