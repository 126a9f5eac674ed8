from tandem.functions.coerce import (
    as_long, java_trim, json_float, json_int, member_names, member_count,
)
from tandem.functions.alerts import fire_alert
from tandem.functions.labels import join_type_label

__all__ = [
    "as_long", "java_trim", "json_float", "json_int", "member_names",
    "member_count", "fire_alert", "join_type_label",
]
