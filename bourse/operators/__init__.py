"""DataFrame operators: projections, filters, nulls, keys, series, joins, forecast."""

from bourse.operators.filters import (delete_like, delete_where, drop_all_nan,
                                      drop_nan, filter_in, lookback, quarantine,
                                      scan_history, split_tagged, tag)
from bourse.operators.folds import Fold, longest_rise, per_key_fold
from bourse.operators.forecast import (feature_frame, fit_linear, forecast_linear,
                                       forecast_report, forecast_ridge, mse,
                                       per_key_apply)
from bourse.operators.joins import enrich_bars, enrich_listing
from bourse.operators.keys import (KeyViolation, assert_key, distinct_keys,
                                   distinct_rows, keep_first, key_violations,
                                   union_all)
from bourse.operators.nulls import fill_const, normalize_nan
from bourse.operators.projection import (drop_col_at, drop_cols, rename_positional,
                                         select_cols, with_key, with_row_index)
from bourse.operators.series import (SeriesPass, drop_last, ffill, ffill_pct_change, latest,
                                     next_value, pct_change, sort_desc, zscore)

__all__ = [
    "delete_like", "delete_where", "drop_all_nan", "drop_nan", "filter_in",
    "lookback", "quarantine", "scan_history", "split_tagged", "tag", "feature_frame", "fit_linear", "forecast_linear",
    "forecast_report", "forecast_ridge", "mse", "per_key_apply", "Fold", "longest_rise", "per_key_fold",
    "enrich_bars", "enrich_listing", "KeyViolation",
    "assert_key", "distinct_keys", "distinct_rows", "keep_first",
    "key_violations", "union_all", "fill_const", "normalize_nan", "drop_col_at",
    "drop_cols", "rename_positional", "select_cols", "with_key",
    "with_row_index", "SeriesPass", "drop_last", "ffill", "latest",
    "next_value", "pct_change", "ffill_pct_change", "sort_desc", "zscore",
]
