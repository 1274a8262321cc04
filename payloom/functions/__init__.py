from payloom.functions.text import audit_key, id_part, snake_case, snake_case_column, split_table_name
from payloom.functions.variant import (
    as_list, get, is_array, is_object, non_empty_object, present, quote_name, scalar_text, struct_ddl,
    text_node, unwrap_or_self, vpath,
)
