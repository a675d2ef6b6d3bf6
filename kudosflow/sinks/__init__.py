from kudosflow.sinks.writers import (
    overwrite,
    overwrite_bucketed,
    overwrite_merging_schema,
    overwrite_partitioned,
    replace_external_table,
    with_columns_of,
)

__all__ = [
    "overwrite",
    "overwrite_bucketed",
    "overwrite_merging_schema",
    "overwrite_partitioned",
    "replace_external_table",
    "with_columns_of",
]
