from entiprof.functions.classify import (
    SourceInputs,
    apply_source,
    cem_folder,
    event_apply_source,
    event_source_name,
    source_name,
    widget_type_key,
)
from entiprof.functions.predicates import (
    epoch_seconds,
    first_non_blank,
    is_ntz,
    is_present,
    json_equals,
    json_flag,
    literal_map,
    map_lookup,
    source_lead_predicate,
    span_seconds,
    valid_name_flag,
    when_flag,
)

__all__ = [
    "SourceInputs", "apply_source", "cem_folder", "epoch_seconds", "event_apply_source", "event_source_name",
    "first_non_blank", "is_ntz", "is_present", "json_equals", "json_flag", "literal_map", "map_lookup", "source_lead_predicate",
    "source_name", "span_seconds", "valid_name_flag", "when_flag", "widget_type_key",
]
