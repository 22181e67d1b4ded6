"""DataFrame operators the tags are composed of."""

from .gaps import last_gap
from .grouped import GroupTag, group_tag, group_tags, one_per_key
from .ranking import (
    best_value,
    latest_rows,
    longest_text,
    metric_mean,
    top_items,
    top_value,
    value_counts,
)

__all__ = [
    "GroupTag",
    "best_value",
    "group_tag",
    "group_tags",
    "last_gap",
    "latest_rows",
    "longest_text",
    "metric_mean",
    "one_per_key",
    "top_items",
    "top_value",
    "value_counts",
]
