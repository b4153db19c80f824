"""Reusable relational operators built from DataFrame primitives."""

from tillhouse.operators.dedup import latest_by_key  # noqa: F401
from tillhouse.operators.spine import date_spine  # noqa: F401
from tillhouse.operators.topk import top_k_per, top_k, last_n_distinct  # noqa: F401
from tillhouse.operators.reshape import densify, series, pivot_wide  # noqa: F401
from tillhouse.operators.aggregates import share_of_total, member_flag, exact_quantiles  # noqa: F401
