from tidemark.operators.core import (  # noqa: F401
    conform,
    daily_event_counts,
    date_spine,
    densify,
    duplicate_key_groups,
    latest_by_key,
    orphan_rows,
    rank_within,
    running_and_rolling,
    sorted_lists,
    spine_gap_groups,
    top_k_per_group,
    union_by_declared_schema,
)
