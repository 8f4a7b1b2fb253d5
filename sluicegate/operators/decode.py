"""Frames to records: size guard, kind, header, admission and the outcome of each frame.

Frame layout: kind byte, then for a record two bytes of name length (big-endian), the table name and the
payload; for a registration its JSON; for a flush request nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binary import byte_hex, u16_be, utf8_text
from .lookup import lookup
from .registry import document_is_valid, registration_document

# Message kinds, size limit and outcome texts.
REGISTER = "01"
RECORD = "02"
FLUSH = "03"
MAX_FRAME_BYTES = 128 * 1024 * 1024
TOO_LARGE = "payload too large"
SHORT_HEADER = "invalid ingest record payload"
SHORT_NAME = "payload too short for declared table name length"
BAD_NAME = "invalid utf-8 in table name"
FLUSH_DISABLED = "manual flush is disabled on this server"
BAD_REGISTRATION = "invalid schema registration"


def unknown_table(table: Column) -> Column:
    return F.concat(F.lit("unknown table '"), table, F.lit("' — send REGISTER_SCHEMA first"))


def decode(
    frames: DataFrame, enable_manual_flush: bool = False, max_frame_bytes: int = MAX_FRAME_BYTES
) -> DataFrame:
    """One row per non-empty frame: ``seq, arrival_ts, kind, table, payload, frame, msg``.

    ``payload`` is the text after the header (for a registration, its JSON) and null when it is not
    UTF-8. ``msg`` is the refusal, if any; admission is a separate step.
    """
    frame = F.col("frame")
    sized = frames.select("seq", "arrival_ts", "frame", F.octet_length(frame).alias("size")).where(
        F.col("size") > 0
    )
    headed = sized.select(
        "*",
        byte_hex(frame, 1).alias("kind"),
        F.when(byte_hex(frame, 1) == RECORD, u16_be(frame, 2)).alias("name_len"),
    )
    kind, size, name_len = F.col("kind"), F.col("size"), F.col("name_len")
    fits = size <= max_frame_bytes
    whole = fits & (kind == RECORD) & (size >= 3) & (size >= 3 + name_len)
    parsed = headed.select(
        "seq",
        "arrival_ts",
        "frame",
        "kind",
        "size",
        "name_len",
        F.when(whole, utf8_text(F.substr(frame, F.lit(4), name_len))).alias("table"),
        F.when(whole, utf8_text(F.substr(frame, name_len + 4)))
        .when(fits & (kind == REGISTER), utf8_text(F.substr(frame, F.lit(2))))
        .alias("payload"),
    )
    msg = (
        F.when(size > max_frame_bytes, TOO_LARGE)
        .when(kind == REGISTER, F.lit(None))
        .when(kind == FLUSH, F.lit(None) if enable_manual_flush else F.lit(FLUSH_DISABLED))
        .when(kind != RECORD, F.concat(F.lit("unknown message type 0x"), kind))
        .when(size < 3, SHORT_HEADER)
        .when(size < 3 + name_len, SHORT_NAME)
        .when(F.col("table").isNull(), BAD_NAME)
    )
    return parsed.select("seq", "arrival_ts", "kind", "table", "payload", "frame", msg.alias("msg"))


def admit(decoded: DataFrame, registry: DataFrame, by_order: bool = True, **limits: int) -> DataFrame:
    """Refuse records whose table was not registered before they arrived.

    Registrations are never taken back, so the first one per table decides. ``by_order=False`` is for
    sources without ``seq``: the registry then counts as complete before the batch.
    """
    first = registry.select("table", F.col("first_seq").alias("_first_seq"), F.lit(True).alias("_known"))
    spread = F.coalesce(F.col("seq"), F.xxhash64("frame"))
    joined = lookup(decoded, first, "table", spread, **limits)
    late = F.col("_known").isNull()
    if by_order:
        late = late | F.coalesce(F.col("_first_seq") >= F.col("seq"), F.lit(True))
    refusal = F.when((F.col("kind") == RECORD) & late, unknown_table(F.col("table")))
    return joined.select(
        *[c for c in decoded.columns if c != "msg"], F.coalesce(F.col("msg"), refusal).alias("msg")
    )


def outcomes(admitted: DataFrame) -> DataFrame:
    """The answer to each frame: ``seq, kind, table, status, msg``."""
    registers = F.col("kind") == REGISTER
    parsed = admitted.select(
        "seq", "kind", "table", "msg", F.when(registers, registration_document(F.col("payload"))).alias("doc")
    )
    broken = F.when(registers & ~document_is_valid(F.col("doc")), BAD_REGISTRATION)
    answered = parsed.select("seq", "kind", "table", F.coalesce("msg", broken).alias("msg"))
    status = F.when(F.col("msg").isNull(), "ok").otherwise("error")
    return answered.select("seq", "kind", "table", status.alias("status"), "msg")


def answers(outcome_rows: DataFrame) -> DataFrame:
    """Outcomes as the JSON a producer reads; ``msg`` is left out when there is none."""
    return outcome_rows.select("seq", F.to_json(F.struct("status", "msg")).alias("answer"))


def records_of(admitted: DataFrame, table: str) -> DataFrame:
    """Accepted records of one table."""
    return admitted.where((F.col("kind") == RECORD) & F.col("msg").isNull() & (F.col("table") == table))
