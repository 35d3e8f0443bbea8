"""The columns of a table over time: the first schema and the changes since."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T

from silverline.functions.columns import typed_null

CHANGE = "schema_id int, op string, column_name string, column_type string, column_comment string"
ADD, DROP = "add", "drop"


@dataclass(frozen=True)
class SchemaHistory:
    """Schema 0 is `first`; change `n` leads from schema `n - 1` to schema `n`."""

    first: T.StructType
    changes: Sequence[Row]

    @property
    def latest_id(self) -> int:
        return self.changes[-1].schema_id if self.changes else 0

    @property
    def latest(self) -> T.StructType:
        return self.at(self.latest_id)

    def at(self, schema_id: int) -> T.StructType:
        fields = list(self.first.fields)
        for change in self._between(0, schema_id):
            if change.op == ADD:
                fields.append(_added(change))
            else:
                fields = [f for f in fields if f.name != change.column_name]
        return T.StructType(fields)

    def replay(self, df: DataFrame, written_with: int, read_as: int) -> DataFrame:
        """Bring rows written under an older schema to a later one.

        Changes apply in order, so a name dropped and added again reads NULL.
        """
        for change in self._between(written_with, read_as):
            if change.op == ADD:
                df = df.withColumn(change.column_name, typed_null(_type_of(change)))
            else:
                df = df.drop(change.column_name)
        return df

    def _between(self, after: int, upto: int) -> list[Row]:
        return [c for c in self.changes if after < c.schema_id <= upto]


def _type_of(change: Row) -> T.DataType:
    return T.StructType.fromJson(json.loads(change.column_type))["c"].dataType


def _added(change: Row) -> T.StructField:
    metadata = {"comment": change.column_comment} if change.column_comment else {}
    return T.StructField(change.column_name, _type_of(change), True, metadata)
