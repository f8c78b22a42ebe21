"""Reports of a build, from its counters."""

from __future__ import annotations

import html
import json
import os

# The counters of the reports, whose files are named in write_reports.
QUALITY = ("accepted_documents", "rejected_documents", "too_short", "spam", "non_turkish")
COPIES = ("exact_duplicates", "near_duplicates")


def write_reports(out: str, stats: dict) -> None:
    """reports/: dataset, quality and duplicate JSON, a log and an HTML table; and README_DATASET.md."""
    at = os.path.join(out, "reports")
    os.makedirs(at, exist_ok=True)
    for name, keys in (("dataset_report", stats), ("quality_report", QUALITY), ("duplicate_report", COPIES)):
        with open(os.path.join(at, f"{name}.json"), "w", encoding="utf-8") as f:
            json.dump({k: stats.get(k, 0) for k in keys}, f, indent=2, ensure_ascii=False)
    rows = "".join(f"<tr><td>{html.escape(k)}</td><td>{html.escape(str(v))}</td></tr>" for k, v in stats.items())
    with open(os.path.join(at, "dataset_report.html"), "w", encoding="utf-8") as f:
        f.write(f"<!DOCTYPE html><meta charset='utf-8'><title>Dataset report</title><table>{rows}</table>\n")
    with open(os.path.join(at, "processing_log.txt"), "w", encoding="utf-8") as f:
        f.write(f"status: {stats.get('status')}\nprocessed: {stats.get('processed_documents')}\n")
    with open(os.path.join(out, "README_DATASET.md"), "w", encoding="utf-8") as f:
        f.write("# Dataset\n\n" + "".join(f"- {k}: {v}\n" for k, v in stats.items()) + "\nDigests are in manifest/.\n")
