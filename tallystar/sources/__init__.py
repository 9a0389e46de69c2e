"""Where data comes from and goes to: CSV folders, JDBC and Parquet or catalog tables."""
from tallystar.sources.csv_folder import read_raw_csv, read_split_csv
from tallystar.sources.jdbc import (
    HexSplit,
    JdbcTarget,
    QuantileSplit,
    RangeSplit,
    read_jdbc,
    write_jdbc,
)
from tallystar.sources.stores import (
    CatalogStore,
    FolderStore,
    JdbcStore,
    PublishedStore,
    create_namespace,
    in_storage_order,
)

__all__ = [
    "CatalogStore", "FolderStore", "HexSplit", "JdbcStore", "JdbcTarget", "PublishedStore", "QuantileSplit",
    "RangeSplit",
    "create_namespace", "in_storage_order", "read_jdbc", "read_raw_csv", "read_split_csv", "write_jdbc",
]
