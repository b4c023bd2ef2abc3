"""Whether sources answer: probes, their alternates, a report, and reports of schemas."""

from __future__ import annotations

import textwrap
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.catalog import Aoi, alternate
from terrasift.functions.scalar import squash_name
from terrasift.operators.inventory import missing_fields
from terrasift.sources.fetch import Refused

STATUSES = ("ok", "warn", "auth", "dead", "skip")
#: A probe: (specification, area) -> (columns or None, number of rows or None). It raises what fetching raises.
Probe = Callable[[dict, Aoi], tuple[list[str] | None, int | None]]


@dataclass
class Health:
    id: str
    status: str
    detail: str = ""
    count: int | None = None
    url: str = ""
    alternate: str | None = None
    tried: list[str] = field(default_factory=list)

    @property
    def recovered(self) -> bool:
        return self.alternate is not None


def _cell(text: object) -> str:
    """A text that fits a cell of the report's table: one line without the mark between columns."""
    return textwrap.shorten(str(text).translate({ord("|"): "/"}), 150, placeholder=" ...")


def probe(spec: dict, aoi: Aoi, probes: dict[str, Probe], tries: int = 1) -> Health:
    """One source. A probe never raises: what it ran into is its status. Only being too slow is worth another try."""
    h = Health(spec.get("id", spec.get("layer", "")), "skip", url=aoi.render(str(spec.get("url", ""))))
    if spec.get("driver") not in probes:
        h.detail = f"no probe for {spec.get('driver')}"
        return h
    for k in range(tries):
        try:
            columns, h.count = probes[spec["driver"]](spec, aoi)
        except TimeoutError as e:
            h.status, h.detail = "dead", _cell(e)
            if k + 1 < tries:
                continue
        except Refused as e:
            h.status, h.detail = ("auth" if e.status in (401, 403, 499) else "dead"), _cell(e)
        except Exception as e:  # noqa: BLE001
            h.status, h.detail = "dead", _cell(f"{type(e).__name__}: {e}")
        else:
            lost = missing_fields(columns, spec.get("fields") or {}) if columns is not None else []
            h.status = "warn" if lost or h.count == 0 else "ok"
            h.detail = _cell("; ".join([*(f"no column for {m}" for m in lost), *(["no rows"] if h.count == 0 else [])]))
        break
    return h


def doctor(sources: list[dict], aoi: Aoi, probes: dict[str, Probe], tries: int = 1) -> list[Health]:
    """All sources; for a dead one the first alternate that answers."""
    out = []
    for spec in sources:
        h = probe(spec, aoi, probes, tries)
        if h.status == "dead":
            for k, other in enumerate(spec.get("alternates") or [], 1):
                a = probe(alternate(spec, other), aoi, probes, tries)
                h.tried.append(f"alternate {k}: {a.status}")
                if a.status in ("ok", "warn"):
                    h.alternate = a.url or f"alternate {k}"
                    break
        out.append(h)
    return out


def as_rows(spark: SparkSession, found: list[Health]) -> DataFrame:
    return spark.createDataFrame([(h.id, h.status, h.detail, h.count, h.url, h.alternate, h.recovered) for h in found], "id string, status string, detail string, count long, url string, alternate string, recovered boolean")


def unhealthy(found: list[Health]) -> bool:
    """Whether a scheduled check is to fail: something is dead and no alternate stands in."""
    return any(h.status == "dead" and not h.recovered for h in found)


def doctor_report(found: list[Health], area: str) -> str:
    """The report as Markdown: counts, a table, what needs attention and what to do."""
    n = {s: sum(h.status == s for h in found) for s in STATUSES}
    lines = [f"# Sources for {area}", "", ", ".join(f"{s} {n[s]}" for s in STATUSES) + f"; {sum(h.recovered for h in found)} of the dead have an alternate that answers.", "", "| source | status | rows | detail |", "|---|---|---|---|"]
    lines += [f"| {h.id} | {h.status} | {'' if h.count is None else f'{h.count:,}'} | {h.detail} |" for h in found]
    for h in found:
        if h.status in ("dead", "auth"):
            help_ = f"the alternate at {h.alternate} answers and is used" if h.recovered else "a key is needed" if h.status == "auth" else "nothing stands in: give it another address, or switch it off"
            lines += ["", f"## {h.id}", "", f"- address: {h.url or 'none'}", f"- {h.detail}", f"- {help_}"]
    return "\n".join([*lines, ""])


def schema_report(df: DataFrame, wanted: dict[str, list[str]], generic: tuple[str, ...] = ("id", "name", "type", "objectid", "fid", "shape")) -> DataFrame:
    """For each wanted key the column that serves it, how full that is, and whether its name is too general to be a key by; one pass over the rows."""
    by = {squash_name(c): c for c in df.columns}
    found = {k: next((by[squash_name(c.lstrip("!").split("@")[0])] for c in cs if squash_name(c.lstrip("!").split("@")[0]) in by), None) for k, cs in wanted.items()}
    full = [F.count(F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))).alias(k) for k, c in found.items() if c]
    one = df.agg(F.count("*").alias("_rows"), *full)
    rows = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(c).cast("string").alias("column"), (F.col(k) if c else F.lit(None).cast("long")).alias("n"), F.col("_rows").alias("n_rows"), F.lit(c is not None and squash_name(c) in generic).alias("generic")) for k, c in found.items()))
    return one.select(F.explode(rows).alias("r")).select("r.*")
