"""A current-state table in Spark's own catalog, bucketed and sorted by key, so that silver never crosses the network."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from silverline.functions.columns import cols, empty_frame, require_keys, resolve, split_names
from silverline.operators.upsert import align, require_unique_keys, upsert
from silverline.session import materialise

PROPERTY = "silverline.bucketed"


class BucketedTable:
    """Parquet tables written by `bucketBy(...).sortBy(...)`, the newest of which a view names.

    Merges and checks by the table's keys take its buckets as they are: only the other side is dealt out, into as many tasks
    as there are buckets. A merge writes the next table beside the current one and then points the view to it, which is one
    statement of the catalog; the table before stays for readers that are still at it, older ones are dropped.

    Every merge rewrites the table, without a shuffle of its rows: made for merges whose keys are spread over the whole table.
    One writer at a time. With `spark.sql.shuffle.partitions` equal to `buckets`, a source that a per-key operator has
    dealt out already is not dealt out again.
    """

    holds_keys_once = True

    def __init__(self, spark: SparkSession, name: Sequence[str], path: str | None = None):
        """`name` as parts, for example (database, table); `path`: a folder for files outside the warehouse."""
        self.spark, self.parts, self.path = spark, tuple(name), path
        self.name = _quoted(self.parts)

    # -- life cycle ---------------------------------------------------------

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def ensure(
        self,
        like: DataFrame,
        keys: str | Sequence[str],
        *,
        partitions: str | Sequence[str] | None = None,
        buckets: int | None = None,
        recreate: bool = False,
    ) -> BucketedTable:
        """Create the table empty with the columns of `like`, unless it exists.

        Other keys or buckets than its own are an error. `buckets` is the session's number of shuffle partitions unless given.
        """
        names = require_keys(like, keys)
        if split_names(partitions):
            raise ValueError("a bucketed table has no partition columns")
        if self.exists() and not recreate:
            own = self._state()
            if resolve(self.spark, [*own["keys"], *names], names, "keys") != own["keys"]:
                raise ValueError(f"table is keyed by {own['keys']}, not {names}")
            if buckets and buckets != own["buckets"]:
                raise ValueError(f"table has {own['buckets']} buckets, not {buckets}")
            return self
        number = self._state()["number"] + 1 if self.exists() else 1
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self._publish(empty_frame(self.spark, like.schema), {"keys": names, "buckets": buckets, "number": number})
        return self

    # -- reading ------------------------------------------------------------

    @property
    def keys(self) -> list[str]:
        return self._state()["keys"]

    @property
    def buckets(self) -> int:
        return self._state()["buckets"]

    def current(self) -> DataFrame:
        return self.spark.table(self.name)

    # -- writing ------------------------------------------------------------

    def merge(
        self,
        source: DataFrame,
        keys: str | Sequence[str] | None = None,
        *,
        guard: str | Sequence[str] = (),
        fill_missing: bool = False,
        source_unique: bool = False,
    ) -> None:
        """Merge `source` by the rules of `operators.upsert`. Only the source is shuffled."""
        state = self._state()
        held = self.current()
        if keys and require_keys(held, keys) != state["keys"]:
            raise ValueError(f"table is keyed by {state['keys']}, not {split_names(keys)}")
        ages = resolve(self.spark, held.columns, split_names(guard), "guard columns")
        incoming = align(source, held.schema, fill_missing=fill_missing, required=[*state["keys"], *ages])
        if not source_unique:
            incoming = require_unique_keys(materialise(incoming, "merge-source"), state["keys"])
        if not source_unique or int(self.spark.conf.get("spark.sql.shuffle.partitions")) != state["buckets"]:
            incoming = incoming.repartition(state["buckets"], *cols(state["keys"]))
        merged = upsert(held, incoming, state["keys"], guard=ages, source_unique=True, strategy="window")
        self._publish(merged, state | {"number": state["number"] + 1})

    # -- the catalog --------------------------------------------------------

    def _table(self, number: int) -> str:
        return _quoted((*self.parts[:-1], f"{self.parts[-1]}__{number}"))

    def _state(self) -> dict:
        if not self.exists():
            raise ValueError(f"no table {self.name}")
        properties = {r[0]: r[1] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        if PROPERTY not in properties:
            raise ValueError(f"{self.name} is not a bucketed table")
        return json.loads(properties[PROPERTY])

    def _publish(self, rows: DataFrame, state: dict) -> None:
        table = self._table(state["number"])
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # left by a run that did not get to the view
        writer = rows.write.format("parquet").mode("overwrite")
        if self.path:
            writer = writer.option("path", f"{self.path.rstrip('/')}/{state['number']}")
        first, *others = state["keys"]
        writer.bucketBy(state["buckets"], first, *others).sortBy(first, *others).saveAsTable(table)
        text = json.dumps(state).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('{PROPERTY}' = '{text}') AS SELECT * FROM {table}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(state['number'] - 2)}")


def _quoted(parts: Sequence[str]) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)
