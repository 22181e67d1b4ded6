"""Reading the shop tables, and writing tags and profiles."""

from .checkpoints import checkpointed, shared_folder
from .profiles import (
    preview,
    promote_tag,
    promote_tags,
    read_profile,
    read_profile_ranges,
    read_staged_tag,
    stage_tag,
    stage_tags,
    upsert_tag,
    upsert_tags,
    write_profile,
    write_profile_ranges,
)
from .tables import load_goods, load_logs, load_orders, load_table, load_unified, load_users

__all__ = [
    "checkpointed",
    "load_goods",
    "load_logs",
    "load_orders",
    "load_table",
    "load_unified",
    "load_users",
    "preview",
    "promote_tag",
    "promote_tags",
    "read_profile",
    "read_profile_ranges",
    "read_staged_tag",
    "shared_folder",
    "stage_tag",
    "stage_tags",
    "upsert_tag",
    "upsert_tags",
    "write_profile",
    "write_profile_ranges",
]
