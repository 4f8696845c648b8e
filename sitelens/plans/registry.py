"""All named reports, gathered from the report modules."""

from __future__ import annotations


def all_reports() -> dict:
    # importing a report module registers its reports into reports.REPORTS
    from . import command_reports, io_reports, quarantine_reports  # noqa: F401
    from . import reports
    return dict(reports.REPORTS)
