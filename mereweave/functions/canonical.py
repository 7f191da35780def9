"""Canonical JSON (RFC 8785): one byte form for equal values, whatever their spacing, key order or way of writing numbers.

Keys are ordered by UTF-16 code units, numbers are written as ECMAScript writes doubles (the shortest digits that read back), strings escape
only what must be escaped. What has no canonical form gives null: text that is no JSON, numbers beyond a double, lone surrogates. Of keys
that come twice the last counts. A null text stays null.
"""

from __future__ import annotations

import hashlib
import json
import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def number(x: float) -> str:
    """A double in ECMAScript's form."""
    if not math.isfinite(x):
        raise ValueError("no number of JSON")
    if x == 0:
        return "0"
    digits, _, power = repr(abs(x)).partition("e")
    whole, _, part = digits.partition(".")
    part = part if part != "0" else ""
    point = len(whole) + int(power or 0)
    figures = (whole + part).lstrip("0")
    point -= len(whole + part) - len(figures)
    figures = figures.rstrip("0")
    n = len(figures)
    if n <= point <= 21:
        out = figures + "0" * (point - n)
    elif 0 < point <= 21:
        out = f"{figures[:point]}.{figures[point:]}"
    elif -6 < point <= 0:
        out = f"0.{'0' * -point}{figures}"
    else:
        e = point - 1
        out = figures[0] + (f".{figures[1:]}" if n > 1 else "") + f"e{'+' if e > 0 else '-'}{abs(e)}"
    return f"-{out}" if x < 0 else out


def canonical(value) -> str:
    """The canonical text of a value made of dicts, lists, strings, numbers, booleans and None."""
    if value is None or isinstance(value, bool):
        return {None: "null", True: "true", False: "false"}[value]
    if isinstance(value, (int, float)):
        return number(float(value))
    if isinstance(value, str):
        value.encode()  # a lone surrogate raises
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, list):
        return f"[{','.join(map(canonical, value))}]"
    keys = sorted(value, key=lambda k: k.encode("utf-16-be"))
    return f"{{{','.join(f'{canonical(k)}:{canonical(value[k])}' for k in keys)}}}"


def canonical_text(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        return canonical(json.loads(text, parse_constant=lambda _: math.nan))
    except (ValueError, OverflowError, RecursionError):
        return None


def sorted_text(text: str | None) -> str | None:
    """The older form: sorted keys, a space after commas and colons, escapes outside ASCII."""
    try:
        return None if text is None else json.dumps(json.loads(text), sort_keys=True)
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(StringType())
def canonical_json(texts: pd.Series) -> pd.Series:
    return pd.Series([canonical_text(t) for t in texts], dtype=object)


@F.pandas_udf(StructType([StructField("spaced", StringType()), StructField("canonical", StringType())]))
def content_hashes(texts: pd.Series) -> pd.DataFrame:
    """SHA-256 of both forms of a JSON object or array; of other texts both are that of the text itself."""
    out = {"spaced": [], "canonical": []}
    for text in texts:
        nested = text is not None and text.lstrip()[:1] in ("{", "[") and canonical_text(text) is not None
        for name, form in (("spaced", sorted_text), ("canonical", canonical_text)):
            own = form(text) if nested else text
            out[name].append(None if own is None else hashlib.sha256(own.encode()).hexdigest())
    return pd.DataFrame(out, dtype=object)
