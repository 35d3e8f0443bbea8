from silverline.sources.evolving import evolving_schema, merge_schemas
from silverline.sources.partitioned import partition_filter, read_partitioned
from silverline.sources.partitions import day_range, resolve_partitions

__all__ = ["day_range", "evolving_schema", "merge_schemas", "partition_filter", "read_partitioned", "resolve_partitions"]
