from quarry.functions.address import (  # noqa: F401
    block_number,
    direction,
    street_name,
    street_type,
    with_block_features,
)
from quarry.functions.calendar import (  # noqa: F401
    derive_calendar,
    derive_time_features,
    geo_grid,
    is_weekend,
    seconds_between,
    weekend_label,
    year_range_filter,
)
from quarry.functions.formatting import format_percent, ratio  # noqa: F401
