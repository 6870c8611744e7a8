from footfall.functions.numbers import bucket_count, ratio, round_half_up
from footfall.functions.text import as_list, flow_pairs, joined_set, present, split_ids

__all__ = ["as_list", "bucket_count", "flow_pairs", "joined_set", "present", "ratio", "round_half_up",
           "split_ids"]
