from docvault.functions.json import (doc_id, drop_null_fields, has_weights_all, index_name,
                                     is_id_index, prepare_options)

__all__ = ["doc_id", "drop_null_fields", "has_weights_all", "index_name", "is_id_index",
           "prepare_options"]
