"""DataFrame operators (DataFrame -> DataFrame), parameterised by column names."""

from .audit import bbox_filter, revision_audit
from .dedupe import latest_per_key
from .quality import Check, QualityGateError, enforce, run_checks, violations
from .ranking import rank_within, top_k, with_topk_persistence
from .rollup import mean, weighted_index
from .windows import baseline_columns, prior_columns, with_baseline, with_prior

__all__ = [
    "Check", "QualityGateError", "baseline_columns", "bbox_filter", "enforce",
    "latest_per_key", "mean", "prior_columns", "rank_within", "revision_audit", "run_checks", "top_k",
    "violations", "weighted_index", "with_baseline", "with_prior", "with_topk_persistence",
]
