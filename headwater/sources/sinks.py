"""Sinks: versions of a table, envelopes and reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.sources import versions


def publish(df: DataFrame, base: str, version: str, accept: bool = True) -> str | None:
    """Write a version and accept it; without acceptance the last good version stays current. The current version."""
    return (versions.publish(df, base, version) if accept else versions.publish_health(df.sparkSession, base))["version"]


def current(spark, base: str) -> str | None:
    known = versions.last_marker(spark, base)
    return known["version"] if known else None


def envelope(df: DataFrame, generated_at: str) -> DataFrame:
    """One JSON string per item with the envelope's time, for line-wise files of any size."""
    return df.select(F.to_json(F.struct(F.lit(generated_at).alias("generated_at"), F.struct(*df.columns).alias("item"))).alias("value"))


def script_safe(value) -> str:
    """JSON that may stand within an HTML script element."""
    text = json.dumps(value, ensure_ascii=False)
    for c in "<>&  ":
        text = text.replace(c, f"\\u{ord(c):04x}")
    return text


def summary_markdown(title: str, counts: dict) -> str:
    return "\n".join([f"# {title}", "", "| measure | value |", "|---|---|", *[f"| {k} | {v} |" for k, v in counts.items()], ""])


#: What the summary of a refreshed source and that of its triggers tell, line by line.
SOURCE_LINES = {
    "Baseline item count": "baseline_total", "Proposed item count": "proposed_total", "Source fetch failed": "source_fetch_failed", "Added": "added_count", "Removed": "removed_count", "Changed": "changed_count",
    "Unchanged": "unchanged_count", "Valid item count": "valid_item_count", "Invalid item count": "invalid_item_count", "Duplicate count": "duplicate_count", "Missing date count": "missing_date_count",
    "Missing organization count": "missing_organization_count", "Invalid date count": "invalid_date_count", "Invalid organization count": "invalid_organization_count",
    "Date completeness": "date_completeness_percent", "Minimum date completeness": "minimum_date_completeness_percent", "Official provenance completeness": "provenance_completeness_percent",
    "Valid official link": "valid_link_percent", "Production unchanged": "production_unchanged",
}
TRIGGER_LINES = {
    "New official trigger count": "new_trigger_count", "Removed official trigger count": "removed_trigger_count", "Trigger classification changes": "classification_change_count", "Timing changes": "timing_change_count",
    "Evidence changes": "evidence_change_count", "Production semantic changes": "production_change_count",
}


def _lines(summary: dict, names: dict[str, str]) -> list[str]:
    said = lambda v: str(v).lower() if isinstance(v, bool) else str(v)
    return [f"- {label}: {said(summary[key])}{'%' if key.endswith('_percent') else ''}" for label, key in names.items() if key in summary]


def source_markdown(status: str, summary: dict, health: dict, fetched: list[str], excluded: list[str], warnings: list[str], errors: list[str]) -> str:
    """The summary of a proposed refresh, from one row of counts; what is proposed has not been accepted."""
    listed = lambda values: ", ".join(values) or "NONE"
    said = lambda values: [f"- {v}" for v in values] or ["- None"]
    head = [
        f"- Source: {health.get('source_code') or 'UNKNOWN'}", f"- Source status: {health.get('status') or 'UNKNOWN'}", f"- Source fetched: {listed(fetched)}", f"- Rejected source excluded: {listed(excluded)}",
        f"- Live fetch status: {health.get('fetch_status') or 'UNKNOWN'}", f"- TLS trust mode: {health.get('tls_trust_mode') or 'NODE_BUNDLED_CA'}", f"- Acceptance recommendation: **{status}**",
    ]
    return "\n".join(["# Source refresh", "", "> A proposal; nothing is accepted without a person.", "", *head, *_lines(summary, SOURCE_LINES), "", "## Warnings", "", *said(warnings), "", "## Errors", "", *said(errors), ""])


def trigger_markdown(status: str, summary: dict) -> str:
    """The summary of the triggers that a proposed refresh changes; triggers in use may not change by it."""
    gate = "PASS" if not summary.get("production_change_count") else "FAIL"
    return "\n".join(["# Trigger changes", "", "> A proposal; the triggers in use stay as they are.", "", f"- Acceptance recommendation: **{status}**", *_lines(summary, TRIGGER_LINES), f"- Production gate: {gate}", ""])


def check_target(path: str, protected: list[str], allow: bool = False) -> str:
    """The path, unless it is a protected output or lies below one."""
    flat = path.rstrip("/")
    if not allow and any(flat == p.rstrip("/") or flat.startswith(p.rstrip("/") + "/") for p in protected):
        raise PermissionError(f"{path} is a protected output")
    return path


def report_html(title: str, model: dict) -> str:
    """A page that carries its model as JSON within a script element."""
    import html

    head = f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head>"
    return f"{head}<body><h1>{html.escape(title)}</h1><script type='application/json' id='model'>{script_safe(model)}</script></body></html>"


def export_rows(df: DataFrame, path: str, form: str = "csv") -> str:
    """Rows as CSV with a header, or as JSON lines, one file per partition."""
    writer = df.write.mode("overwrite")
    if form == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif form == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown form {form}")
    return path
