from .scalars import (
    apply_case,
    convert_type,
    csv_quote,
    decode_content,
    encode_content,
    map_column_name,
    map_column_name_expr,
    override_schema,
    sql_literal,
    strip_qualifier,
    strip_qualifier_expr,
    to_text,
)
from .template import constants, render_template, rerender
