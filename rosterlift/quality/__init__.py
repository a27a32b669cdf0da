"""Rule-driven data quality: contracts, checks, the suite, samples and integrity jobs."""

from .contracts import CONTRACTS, GLOBAL_RULES, load_rules, matching_contract
from .suite import WrittenChecks, evaluate, run_suite, violation_samples

__all__ = ["CONTRACTS", "GLOBAL_RULES", "WrittenChecks", "evaluate", "load_rules", "matching_contract", "run_suite",
           "violation_samples"]
