"""Operators put together: the whole preparation from one normalised table, and as a job with files."""

from leadmill.plans.job import JobTables, run_job
from leadmill.plans.prepare import PreparedLeads, clean_from_merged, prepare_all
from leadmill.plans.run_folder import RunFolder, published
from leadmill.plans.staging import Staging

__all__ = ["JobTables", "PreparedLeads", "RunFolder", "Staging", "clean_from_merged", "prepare_all", "published", "run_job"]
