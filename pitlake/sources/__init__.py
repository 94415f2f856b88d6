from pitlake.sources.files import (read_calendar, read_prices, read_universe, read_window,
                                   window_bounds)
from pitlake.sources.registry import registry
from pitlake.sources.sinks import (write_gold, write_jsonl, write_raw, write_silver,
                                   write_stats, write_txt)

__all__ = ["read_prices", "read_universe", "read_calendar", "read_window", "window_bounds",
           "registry", "write_raw", "write_silver", "write_gold", "write_stats", "write_jsonl",
           "write_txt"]
