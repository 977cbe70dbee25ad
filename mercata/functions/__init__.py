"""Pure Column -> Column helpers; everything stays in whole-stage codegen, no Python UDF."""

from .dates import (  # noqa: F401
    combine_date_time, day_micros, epoch_micros, month_start, parse_mixed_date, parse_time, textual_date, tenure_days, time_part_columns,
)
from .flags import (  # noqa: F401
    delivery_tier, geo_bounds_flag, is_completed, mismatch_null_counts, mismatch_null_ignored, present,
)
from .numbers import (  # noqa: F401
    as_money, average, change_pct2, coerce_decimal, coerce_numeric, coerce_whole, distance_km, is_close, out_of_range, pct2, ratio, ratio2,
    round2,
)
from .text import clean_label, normalize_city, title_case  # noqa: F401
