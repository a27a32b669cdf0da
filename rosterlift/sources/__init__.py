from .sinks import FileRange, Outputs, current_path, file_ranges, is_clustered, overwrite_table, read_range
from .tables import (SEEDS, SourceMap, TableReader, common_type, constant_row, empty_relation, literal_relation, read_seed,
                     read_shards, reconcile, union_shards)

__all__ = ["FileRange", "Outputs", "SEEDS", "SourceMap", "TableReader", "common_type", "constant_row", "current_path", "empty_relation",
           "file_ranges", "is_clustered", "literal_relation", "overwrite_table", "read_range", "read_seed", "read_shards", "reconcile",
           "union_shards"]
