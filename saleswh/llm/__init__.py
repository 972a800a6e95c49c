"""Operators of a training-data pipeline, each with a named query."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with their code: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from saleswh.llm import bpe, cap_filters, centroids, crf_quality, exact_dedup, line_runs, pareto_mix, parity_join, prefix_trie, quality_rules, quotes, suffix_dedup, warc  # noqa: E402, F401
from saleswh.llm.registry import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES"]
