from .expressions import (  # noqa: F401
    category_of, day_period, duration_hours, is_closed, literal_map, num_text,
    pct_text, resolution_bucket, round_opt, safe_pct, translate,
    weekday_index, weekday_name,
)
from .quantiles import ValueCounts, grouped_quantiles  # noqa: F401
