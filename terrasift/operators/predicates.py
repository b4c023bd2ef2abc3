"""Filters compiled to Column expressions: style conditions, tag selectors, attribute lists."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


_COND = re.compile(r"^\s*([A-Za-z_][A-Za-z0-9_:]*)\s*(>=|<=|==|!=|=|>|<|~)\s*(.+?)\s*$")
_COMPARE = {">=": "__ge__", "<=": "__le__", ">": "__gt__", "<": "__lt__", "==": "__eq__", "=": "__eq__", "!=": "__ne__"}


def condition(text: str, field: Callable[[str], Column | None]) -> Column:
    """F16: ``a >= 3 and b = x``: numbers if both sides are, else text for =, ==, != only; a missing field or a bad condition is false."""
    out = F.lit(True)
    for part in re.split(r"\s+and\s+", text, flags=re.I):
        m = _COND.match(part)
        col = field(m[1]) if m else None
        if col is None:
            return F.lit(False)
        op, value, s = m[2], m[3].strip("'\""), col.cast("string")
        if op == "~":
            ok = s.rlike(f"(?i){value}")
        else:
            word = getattr(F.lower(s), _COMPARE[op])(value.lower()) if op in ("=", "==", "!=") else F.lit(False)
            try:
                number = s.try_cast("double")
                ok = F.when(number.isNotNull(), getattr(number, _COMPARE[op])(float(value))).otherwise(word)
            except ValueError:
                ok = word
        out = out & F.coalesce(ok, F.lit(False))
    return out


#: What units of tags multiply a number by. ``m`` is a metre, so lengths come out in metres; powers and voltages in W and V.
TAG_UNITS = {"k": 1e3, "kv": 1e3, "kw": 1e3, "mv": 1e6, "mw": 1e6, "mwh": 1e6, "g": 1e9, "gw": 1e9, "m": 1.0, "ft": 0.3048}


def tag_number(tag: Column) -> Column:
    """the largest of a tag's numbers (``115000;34500``, ``345 kV``, ``100 ft``), each in its unit; parts stand between ; , or /. Unknown units count as none; null without a number."""
    units = F.create_map(*(F.lit(x) for kv in TAG_UNITS.items() for x in kv))

    def part(p: Column) -> Column:
        number = F.regexp_extract(p, r"^\s*(-?[0-9]+(?:\.[0-9]+)?)", 1)
        unit = F.regexp_extract(p, r"^\s*-?[0-9]+(?:\.[0-9]+)?\s*([a-z]*)", 1)
        return F.nullif(number, F.lit("")).try_cast("double") * F.coalesce(F.try_element_at(units, unit), F.lit(1.0))

    return F.array_max(F.transform(F.split(F.lower(tag), "[;,/]"), part))


def selector(text: str, tags: Column) -> Column:
    """``power=line;voltage>=100000;name;access!=private;ref~^A``, all clauses hold. A missing tag fails, but passes ``!=``."""
    out = F.lit(True)
    for clause in filter(None, map(str.strip, text.split(";"))):
        m = re.match(r"^([^=!~<>]+?)\s*(?:(>=|<=|!=|=|~|>|<)\s*(.*))?$", clause)
        tag = tags[m[1]]
        if not m[2]:
            ok = tag.isNotNull()
        elif m[2] == "=":
            ok = tag == m[3]
        elif m[2] == "!=":
            ok = tag.isNull() | (tag != m[3])
        elif m[2] == "~":
            ok = tag.rlike(m[3])
        else:
            ok = getattr(tag_number(tag), _COMPARE[m[2]])(float(m[3]))
        out = out & F.coalesce(ok, F.lit(False))
    return out


def any_selector(texts: list[str], tags: Column) -> Column:
    out = F.lit(False)
    for t in texts:
        out = out | selector(t, tags)
    return out


def in_values(col: Column | None, values: list[str]) -> Column:
    """trimmed, without case; no values is no filter, an absent column keeps nothing."""
    wanted = [v.strip().upper() for v in values]
    return F.lit(True) if not wanted else F.lit(False) if col is None else F.coalesce(F.upper(F.trim(col.cast("string"))).isin(*wanted), F.lit(False))


def at_least_or_unknown(col: Column, least: float) -> Column:
    """unknown is not small."""
    return col.isNull() | (col >= least)
