from kudosflow.sources.readers import read_json_lines, read_table

__all__ = ["read_json_lines", "read_table"]
