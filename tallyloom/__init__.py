"""Period-matrix sales reporting on Spark DataFrames.

Every public function takes DataFrames and returns a DataFrame; nothing is
written unless a function from :mod:`tallyloom.sources.sinks` is called.
"""

from tallyloom.plans.backorders import combine_backorders
from tallyloom.plans.combined import report_combined
from tallyloom.plans.daily import daily_refresh, refresh_from_loads
from tallyloom.plans.distributor import report_distributor
from tallyloom.plans.ingest import ingest_checks, ingest_month, reload_history
from tallyloom.plans.targets import report_targets
from tallyloom.plans.titles import report_titles

__all__ = [
    "combine_backorders",
    "daily_refresh",
    "ingest_checks",
    "ingest_month",
    "refresh_from_loads",
    "reload_history",
    "report_combined",
    "report_distributor",
    "report_targets",
    "report_titles",
]
