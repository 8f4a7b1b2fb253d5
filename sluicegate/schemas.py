"""Schemas of the tables this package reads and writes itself."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, data_type) for name, data_type in columns.items()])


_TEXT, _LONG, _INT, _BYTES, _FLAG = T.StringType(), T.LongType(), T.IntegerType(), T.BinaryType(), T.BooleanType()

FRAMES = _struct(seq=_LONG, arrival_ts=T.TimestampType(), frame=_BYTES)
GENERATIONS = _struct(seq=_LONG, arrival_ts=T.TimestampType(), frame=_BYTES, gen=_LONG)

REGISTRY_PARTS = _struct(
    table=_TEXT,
    first_seq=_LONG,
    last_seq=_LONG,
    schema_id=_INT,
    namespace=T.ArrayType(_TEXT),
    fields=T.ArrayType(_struct(name=_TEXT, type=_TEXT, required=_FLAG)),
    gen=_LONG,
)

STAGED = T.StructType(
    [
        *FRAMES.fields[:2],
        *_struct(kind=_TEXT, table=_TEXT, payload=_TEXT, frame=_BYTES, msg=_TEXT).fields,
        T.StructField("class", _TEXT),
        T.StructField("bucket", _INT),
    ]
)

REJECTS = _struct(seq=_LONG, table=_TEXT, payload=_TEXT, frame=_BYTES, reason=_TEXT)
STORED_REJECTS = T.StructType([*REJECTS.fields, *_struct(gen=_LONG, part=_TEXT).fields])

LEDGER = _struct(gen=_LONG, table=_TEXT, rows=_LONG, committed=_FLAG)
# A place is a folder or a catalog name; ``folded`` is the name as the catalog tells names apart.
PLACES = _struct(gen=_LONG, table=_TEXT, folded=_TEXT, place=_TEXT, layout=_TEXT)
WARNINGS = _struct(gen=_LONG, table=_TEXT, last_seq=_LONG, name=_TEXT, declared_type=_TEXT, resolved_type=_TEXT)
