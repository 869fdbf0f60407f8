"""Reusable DataFrame -> DataFrame operators (usable with ``DataFrame.transform``)."""

from .clean import (NULL_TOKENS, NULL_TOKENS_STRICT, conform_dates, dedupe, dedupe_sparse, fill_defaults,
                    fill_numeric, normalize_nulls, require)
from .combine import merge_join, spread_join
from .metrics import count_where, ratio, sum_where, top_k, top_k_late

__all__ = [
    "NULL_TOKENS", "NULL_TOKENS_STRICT", "normalize_nulls", "dedupe", "dedupe_sparse", "fill_defaults",
    "fill_numeric", "require", "conform_dates", "merge_join", "spread_join", "count_where", "sum_where",
    "ratio", "top_k", "top_k_late",
]
