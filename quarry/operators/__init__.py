from quarry.operators.agg import (  # noqa: F401
    conditional_counts,
    distinct_counts,
    duplicate_rows,
    global_aggregate,
    group_count,
    group_mean,
    group_mode,
    heatmap_pivot,
    long_values,
    null_counts,
    null_percent,
)
from quarry.operators.joins import (  # noqa: F401
    attach_scalar,
    bounded_broadcast,
    lookup_join,
    semi_join_top,
)
from quarry.operators.windows import (  # noqa: F401
    cumulative_sum,
    moving_average,
    rank_prefix,
    sequence_within_groups,
    share_of_partition,
    top_per_group,
    topk,
)
