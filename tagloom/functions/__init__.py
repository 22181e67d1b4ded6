"""Column expressions: tolerant casts, labels, URL parts and identity rules."""

from .casting import (
    calendar_date,
    epoch_seconds,
    number_value,
    timestamp_value,
    whole_amount,
    whole_number,
)
from .identity import member_tail_user, member_user, within
from .labels import any_like, band, code_label, first_like, first_max, range_score
from .urls import last_path_segment, product_id_from_url

__all__ = [
    "any_like",
    "band",
    "calendar_date",
    "code_label",
    "epoch_seconds",
    "first_like",
    "first_max",
    "last_path_segment",
    "member_tail_user",
    "member_user",
    "number_value",
    "product_id_from_url",
    "range_score",
    "timestamp_value",
    "whole_amount",
    "whole_number",
    "within",
]
