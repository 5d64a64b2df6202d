from entiprof.operators.aggregates import (
    conditional_span,
    conditional_span_joined,
    group_maxes,
    joined_max,
    repeat_entities,
    set_concat,
    sorted_set_text,
    sum_count,
)
from entiprof.operators.latest import (
    LatestTarget,
    first_match,
    group_argmax_row,
    last_id,
    latest_preferred,
    latest_preferred_since,
    latest_rows,
)
from entiprof.operators.lookups import (
    JoinStep,
    attribute_lookup,
    attribute_values,
    join_chain,
    lookup_fallback,
    repeat_join,
    repeat_rows,
    rows_per_key,
)
from entiprof.operators.ranks import joined_max_by_number, ordered_numbers
from entiprof.operators.skew import Skew, heavy_values

__all__ = [
    "JoinStep", "LatestTarget", "Skew", "attribute_lookup", "attribute_values", "conditional_span", "conditional_span_joined", "first_match", "group_argmax_row", "group_maxes", "heavy_values",
    "join_chain", "joined_max", "joined_max_by_number", "last_id", "latest_preferred", "latest_preferred_since", "latest_rows",
    "lookup_fallback", "ordered_numbers", "repeat_entities", "repeat_join", "repeat_rows", "rows_per_key", "set_concat", "sorted_set_text", "sum_count",
]
