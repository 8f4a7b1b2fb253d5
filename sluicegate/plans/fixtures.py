"""Frames made from ordinary tables, as a producer would send them."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binary import u16_be_bytes, utf8_bytes
from ..functions.field_types import SPARK_TYPES
from ..operators.barrier import filterable
from ..operators.decode import RECORD, REGISTER
from ..operators.registry import Field
from ..schemas import FRAMES
from ..session import local_rows


def fields_of(schema: T.StructType, required: bool = True) -> list[Field]:
    """Fields that declare a table's own columns."""
    names = {data_type: name for name, data_type in SPARK_TYPES.items()}
    return [Field(f.name, names[f.dataType], required) for f in schema.fields]


def payload_of(table: DataFrame, leave_out: Sequence[str] = ()) -> Column:
    """A row as JSON text. Times go as text, because JSON output would cut them to milliseconds."""
    columns = []
    for f in table.schema.fields:
        if f.name in leave_out:
            continue
        column = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            column = F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
        elif isinstance(f.dataType, (T.TimestampNTZType, T.DateType)):
            column = column.cast("string")
        elif isinstance(f.dataType, T.BinaryType):
            column = F.hex(column)
        columns.append(column.alias(f.name))
    return F.to_json(F.struct(*columns))


def body_of(name: Column, payload: Column) -> Column:
    return F.concat(u16_be_bytes(F.octet_length(name)), utf8_bytes(name), utf8_bytes(payload))


def frame_of(kind: str, body: Column) -> Column:
    return F.concat(F.unhex(F.lit(kind)), body)


def record_frames(table: DataFrame, name: str, seq: str, arrival: str | None = None, payload: Column | None = None) -> DataFrame:
    """Every row of a table as one record frame."""
    body = body_of(F.lit(name), payload_of(table) if payload is None else payload)
    arrived = F.lit(None) if arrival is None else F.col(arrival)
    return frames_from(table, F.col(seq), arrived, frame_of(RECORD, body))


def spread(table: DataFrame) -> DataFrame:
    """A table kept in fewer files than there are cores, over all cores; any larger table as it is."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if len(table.inputFiles()) < cores else table


def frames_from(table: DataFrame, seq: Column, arrival: Column, frame: Column) -> DataFrame:
    """Frames computed from a table. Like stored frames, they are not computed again for each use."""
    rows = spread(table).select(
        seq.cast("bigint").alias("seq"), arrival.cast("timestamp").alias("arrival_ts"), frame.alias("_frame")
    )
    return filterable(rows, "_frame", "frame")


def registration_json(table: str, namespace: Sequence[str], fields: Sequence[Field]) -> str:
    declared = [{"name": f.name, "type": f.type, "required": f.required} for f in fields]
    return json.dumps({"table": table, "namespace": list(namespace), "fields": declared}, ensure_ascii=False)


def registration_frames(spark: SparkSession, messages: Sequence[tuple[int, str]]) -> DataFrame:
    """Registration JSON texts at given ``seq`` values, as frames."""
    arrived = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(seq, arrived, bytes.fromhex(REGISTER) + text.encode()) for seq, text in messages]
    return local_rows(spark, rows, FRAMES)
