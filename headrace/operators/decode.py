"""Envelope decoding with a complete failure taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame

from headrace import schemas as S
from headrace.functions import codec
from headrace.functions.once import with_once

_HEAD = ["sequence_number", "partition_key", "approximate_arrival_timestamp"]
_ENVELOPE = tuple(S.columns(S.ENVELOPE))


def decode(envelopes: DataFrame, keep_data: bool = False) -> DataFrame:
    """Classify every envelope; one row in, one row out, no shuffle.

    ``reason`` is NULL for a decoded record and names the failure otherwise, with
    ``raw`` holding a preview of what was received. With ``keep_data`` the whole of it
    follows in ``data`` for failed records. Columns beyond the envelope pass through.
    """
    kept = _HEAD + [c for c in envelopes.columns if c not in _ENVELOPE]
    # Each step names a value the next one uses several times, so that the costly
    # calls (base64, JSON parse) appear once in the plan.
    parsed = (
        envelopes.selectExpr(*kept, "data", f"{codec.base64_direct('data')} AS _direct")
        .selectExpr(*kept, "data", f"{codec.base64_bytes('data', '_direct')} AS _bytes")
        .selectExpr(*kept, "data", "_bytes", f"{codec.utf8_text('_bytes')} AS _text")
        .selectExpr(*kept, "data", "_bytes", "_text", f"{codec.framed_json('_text')} AS _framed")
    )
    reason = f"""CASE
        WHEN coalesce(data, '') = '' THEN '{S.REASON_MISSING}'
        WHEN _bytes IS NULL THEN '{S.REASON_BASE64}: malformed text'
        WHEN _text IS NULL THEN '{S.REASON_JSON}: not valid UTF-8'
        WHEN NOT {codec.frame_is_whole('_framed', '_text')}
            THEN '{S.REASON_JSON}: not one JSON document'
        WHEN NOT {codec.starts_object('_text')} THEN '{S.REASON_NOT_OBJECT}' END"""
    judged = with_once(
        parsed, {"reason": reason, "_document": codec.framed_document("_framed")}
    )
    raw = f"""CASE {reason_class('reason')}
        WHEN '{S.REASON_MISSING}' THEN ''
        WHEN '{S.REASON_BASE64}' THEN data
        WHEN '{S.REASON_JSON}' THEN {codec.utf8_preview('_bytes', S.RAW_PREVIEW)}
        WHEN '{S.REASON_NOT_OBJECT}'
            THEN substr(coalesce(try_variant_get(_document, '$', 'string'), 'null'),
                        1, {S.RAW_PREVIEW}) END"""
    return judged.selectExpr(
        *_HEAD,
        "CASE WHEN reason IS NULL THEN _document END AS payload",
        "reason",
        f"{raw} AS raw",
        *(["CASE WHEN reason IS NOT NULL THEN data END AS data"] if keep_data else []),
        *kept[len(_HEAD):],
    )


def reason_class(reason: str) -> str:
    """The failure class, without its detail."""
    return f"substring_index({reason}, ':', 1)"


def decoded(classified: DataFrame) -> DataFrame:
    """The records that decoded; absent sequence numbers and keys become empty."""
    filled = ("sequence_number", "partition_key")
    return classified.where("reason IS NULL").selectExpr(
        *(
            f"coalesce({c}, '') AS {c}" if c in filled else c
            for c in classified.columns
            if c not in ("reason", "raw", "data")
        )
    )


def failures(classified: DataFrame, schema: str = S.FAILED) -> DataFrame:
    """The records that did not decode, those without a sequence number included."""
    return classified.where("reason IS NOT NULL").select(*S.columns(schema))
