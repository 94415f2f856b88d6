from pitlake.functions.scalar import (canonical_params_json, date_param, date_text,
                                      feature_text, label_na, landing_path, nan_to_null, pct,
                                      return_bps, target_text, task_id, ticker_of)

__all__ = ["return_bps", "label_na", "feature_text", "target_text", "date_text", "task_id",
           "canonical_params_json", "landing_path", "date_param", "pct", "ticker_of",
           "nan_to_null"]
