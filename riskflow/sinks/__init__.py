"""Where results go."""

from riskflow.sinks.files import write_clean, write_report_text, write_table
from riskflow.sinks.runs import compact_runs, drop_logged, log_run, model_report, read_runs, report_lines, run_rows
from riskflow.sinks.versions import drop_old_versions, publish, read_version, versions

__all__ = [
    "compact_runs",
    "drop_logged",
    "drop_old_versions",
    "log_run",
    "model_report",
    "publish",
    "read_runs",
    "read_version",
    "report_lines",
    "run_rows",
    "versions",
    "write_clean",
    "write_report_text",
    "write_table",
]
