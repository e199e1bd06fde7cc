"""Batch operators (the exact form of every operator; streams are checked
against them)."""

from flowlab.operators.prefix import running, row_number
from flowlab.operators.rolling import (group_sum, rolling_count, rolling_sum, rolling_min, rolling_max,
                                       rolling_min_by, rolling_max_by, rolling_reduce, rolling_avg,
                                       final_aggregates)
from flowlab.operators.transforms import (prefix_filter, pair_one, tag_field, conditional_step, ratio,
                                          split_by, parity_split, tag_branches)
from flowlab.operators.joins import equi_join, exclude, checked_broadcast
from flowlab.operators.windows import tumbling, sliding, sliding_panes, sessions, sessions_native
from flowlab.operators.counting import count_window, count_window_list, count_trigger, batched, batched_rows
from flowlab.operators.eventtime import with_event_time, delayed_arrival, late_report
from flowlab.operators.iterate import iterate, IterationLimitExceeded
