from .fasta import read_fasta
from .tables import (
    index_file_path,
    read_index_map,
    read_index_map_folder,
    read_items,
    read_log,
    read_sequences_csv,
    read_shard,
    read_shards,
)

__all__ = [
    "index_file_path",
    "read_fasta",
    "read_index_map",
    "read_index_map_folder",
    "read_items",
    "read_log",
    "read_sequences_csv",
    "read_shard",
    "read_shards",
]
