from .payload import Payload, payload_of
from .time import between, bound, is_day, since, span, ts_diff
from .values import day_of, like_prefix, n_distinct, opt, pct, stable_id, steady_round, trunc_ts, whole

__all__ = [
    "Payload", "payload_of", "between", "bound", "is_day", "since", "span", "ts_diff", "day_of", "like_prefix",
    "n_distinct", "opt", "pct", "stable_id", "steady_round", "trunc_ts", "whole",
]
