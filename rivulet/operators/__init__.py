from .cdc import apply_changes, changes_to_sql, merge_change_images, settle_changes
from .cells import (
    kt_check_and_put,
    kt_contains,
    kt_get,
    kt_get_and_put_if_absent,
    kt_get_by_filter,
    kt_last_cell_by_filter,
    kt_put,
    kt_put_if_absent,
    kt_remove,
    kt_remove_all,
    scan_cells,
    scan_cells_per_record,
)
from .lookup import attach_lookup, attach_lookups, enrich, sql_to_lookup
from .lookup_each import enrich_each
from .routing import failing, route_counts, split_routes, with_route
from .shape import (
    attributes_to_json,
    columns_to_json,
    content_to_column,
    json_to_columns,
    json_to_csv,
    positional_rename,
    promote,
    update_columns,
)
from .state import assign_sequence, check_state, hold, hold_release, release
from .xml import validate_xml, xml_extract, xml_to_columns
