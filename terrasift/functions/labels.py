"""Names, popups and labels of features and counties."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_HOLE = re.compile(r"\{([^{}]+)\}")


def headline(rows: list[tuple[str, Column]]) -> Column:
    """Array of struct(label, value) without the empty ones, in this order."""
    return F.filter(F.array(*(F.struct(F.lit(n).alias("label"), F.nullif(F.trim(c.cast("string")), F.lit("")).alias("value")) for n, c in rows)), lambda r: r.value.isNotNull())


def name_template(template: str, fields: dict[str, Column]) -> Column:
    """Pieces between `` - ``, ``, `` and `` / `` go when a field of theirs is empty, bracketed groups likewise; then spaces are squeezed.

    The template is cut into pieces once, here; rows see only a concat_ws of optional texts.
    """
    value = lambda k: F.nullif(F.trim(fields[k].cast("string")), F.lit("")) if k in fields else F.lit(None).cast("string")

    def filled(text: str) -> Column:
        """Null if any of its fields is empty."""
        parts, at = [], 0
        for m in _HOLE.finditer(text):
            parts += [F.lit(text[at : m.start()]), value(m[1])]
            at = m.end()
        return F.concat(*parts, F.lit(text[at:]))

    def piece(text: str) -> Column:
        groups = re.split(r"(\s*[\(\[][^\)\]]*[\)\]])", text)
        own = filled(groups[0])
        for g in groups[1:]:
            own = F.concat(own, F.coalesce(filled(g), F.lit("")) if _HOLE.search(g) else F.lit(g))
        return own

    out: Column = F.lit("")
    marks = re.split(r"( - |, | / )", template)
    for i in range(0, len(marks), 2):
        p = piece(marks[i])
        mark = marks[i - 1] if i else ""
        out = F.when(p.isNull() | (F.trim(p) == ""), out).when(F.trim(out) == "", p).otherwise(F.concat(out, F.lit(mark), p))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def feature_name(template: Column | None, name: Column, capacity_mw: Column, voltage_kv: Column, first: Column) -> Column:
    """P10: the template's text, else the name with its capacity or voltage, else the first headline's value, else empty."""
    own = F.nullif(F.trim(name), F.lit(""))
    with_mw = F.concat(own, F.lit(" ("), F.format_number(capacity_mw, 1), F.lit(" MW)"))
    with_kv = F.concat(own, F.lit(" ("), F.regexp_replace(F.format_number(voltage_kv, 1), r"\.0$", ""), F.lit(" kV)"))
    made = F.nullif(template, F.lit("")) if template is not None else F.lit(None).cast("string")
    return F.coalesce(made, with_mw, with_kv, own, first, F.lit(""))


def geoid(geoid5: Column, state: Column, county: Column) -> Column:
    """a five-digit code as it is, else state and county filled with zeros, else null."""
    g = F.trim(geoid5.cast("string"))
    s, c = F.trim(state.cast("string")), F.trim(county.cast("string"))
    made = F.concat(F.lpad(s, 2, "0"), F.lpad(c, 3, "0"))
    return F.when(g.rlike(r"^\d{5}$"), g).when(s.rlike(r"^\d{1,2}$") & c.rlike(r"^\d{1,3}$"), made)


def county_label(namelsad: Column, name: Column, basename: Column) -> Column:
    """P38."""
    t = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(t(namelsad), t(name), F.concat(t(basename), F.lit(" County")), F.lit("Unknown"))


def vintage(millis: Column, text: Column) -> Column:
    """The year of an epoch in milliseconds, else the first year in a text."""
    return F.coalesce(F.year(F.timestamp_millis(millis)), F.nullif(F.regexp_extract(text, r"((?:19|20)\d{2})", 1), F.lit("")).try_cast("int"))


def in_state(own: Column, counties: Column, state: str, coverage: bool) -> Column:
    """a station's state, or any of the counties that it covers."""
    mine = F.coalesce(F.upper(F.trim(own)) == state, F.lit(False))
    return mine | F.coalesce(F.exists(counties, lambda c: F.upper(F.trim(c.st)) == state), F.lit(False)) if coverage else mine


def square_miles(metres: Column) -> Column:
    """To one place."""
    return F.round(metres / 2589988.110336, 1)


def shared_suffix(names: list[str]) -> str:
    """The longest run of last words that all of two or more distinct names share, never a whole name; names of one service's layers are few."""
    words = [n.split() for n in sorted(set(names))]
    if len(words) < 2:
        return ""
    n = 0
    while all(len(w) > n + 1 for w in words) and len({w[-1 - n] for w in words}) == 1:
        n += 1
    return " ".join(words[0][len(words[0]) - n :]) if n else ""


def split_at_antimeridian(points: list[tuple[float, float]], pad: float = 0.02) -> list[tuple[float, float, float, float]]:
    """The box of points, or two if it would span more than half the globe; padded, within the globe."""
    spans = [points]
    if points and max(x for x, _ in points) - min(x for x, _ in points) > 180:
        spans = [[p for p in points if p[0] >= 0], [p for p in points if p[0] < 0]]
    clamp = lambda v, m: max(-m, min(m, v))
    return [(clamp(min(x for x, _ in s) - pad, 180), clamp(min(y for _, y in s) - pad, 90), clamp(max(x for x, _ in s) + pad, 180), clamp(max(y for _, y in s) + pad, 90)) for s in spans if s]
