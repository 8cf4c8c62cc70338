"""DataFrame -> DataFrame operators."""

from renewlens.operators.ordered import neighbour_in_order, running_in_order
from renewlens.operators.ranking import earliest_by, first_k_pivot, latest_by, top1_by, top_k_by
from renewlens.operators.semijoin import exclude, exists_flag, membership_flag
from renewlens.operators.skew import left_join

__all__ = [
    "earliest_by", "exclude", "exists_flag", "first_k_pivot", "left_join", "latest_by",
    "membership_flag", "neighbour_in_order", "running_in_order", "top1_by", "top_k_by",
]
