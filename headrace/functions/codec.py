"""Base64 and strict JSON as SQL expressions."""

from __future__ import annotations


def base64_direct(text: str) -> str:
    """Bytes of a well-formed base64 text; the first step of ``base64_bytes``."""
    return f"try_to_binary({text}, 'base64')"


def base64_bytes(text: str, direct: str) -> str:
    """Bytes of a base64 text, NULL when it is malformed.

    Characters outside the alphabet are skipped, reading stops where padding
    completes a group of four, missing padding is an error and so is any
    non-ASCII character. A pad character inside a group that is followed by more
    data is an error.

    ``direct`` holds ``base64_direct`` of the text. Nearly every text is canonical,
    which encoding those bytes again proves; only the others pay for the cleaning.
    """
    return f"CASE WHEN base64({direct}) = {text} THEN {direct} ELSE {_lenient_base64(text)} END"


def _lenient_base64(text: str) -> str:
    kept = (
        f"CASE WHEN octet_length({text}) = char_length({text}) "
        f"THEN regexp_replace({text}, '[^A-Za-z0-9+/=]', '') END"
    )
    # The lambda names the text and its part before the first pad.
    only_pads = "char_length(rtrim('=', t.kept)) = char_length(t.head)"
    rest = "substr(t.kept, char_length(t.head) + 1, 2)"
    over = "char_length(t.head) % 4"
    return f"""element_at(transform(
        transform(array({kept}),
                  x -> named_struct('kept', x, 'head', substring_index(x, '=', 1))),
        t -> CASE
            WHEN {over} = 0 AND {only_pads} THEN try_to_binary(t.head, 'base64')
            WHEN {over} = 2 AND {rest} = '==' THEN try_to_binary(t.head || '==', 'base64')
            WHEN {over} = 3 AND startswith({rest}, '=') THEN try_to_binary(t.head || '=', 'base64')
        END), 1)"""


def utf8_text(data: str) -> str:
    """Text of UTF-8 bytes, NULL when they are not valid UTF-8."""
    return f"CASE WHEN is_valid_utf8({data}) THEN CAST({data} AS STRING) END"


def utf8_preview(data: str, size: int) -> str:
    """The first ``size`` bytes as text, invalid bytes replaced."""
    return f"make_valid_utf8(CAST(substring({data}, 1, {size}) AS STRING))"


def framed_json(text: str) -> str:
    """Parse ``text`` as the first of two array items, the second a fingerprint of it.

    The JSON functions ignore whatever follows the first complete value. Inside the
    frame such a rest either breaks the parse or hides the fingerprint, so one
    parse both reads the document and proves that nothing follows it.
    """
    return f"""try_parse_json('[' || {text} || ',"' || xxhash64({text}) || '"]')"""


def frame_is_whole(framed: str, text: str) -> str:
    """Whether the framed text was exactly one JSON document (never NULL)."""
    return (
        f"coalesce(try_variant_get({framed}, '$[1]', 'string') = CAST(xxhash64({text}) AS STRING) "
        f"AND variant_get({framed}, '$[2]', 'variant') IS NULL, false)"
    )


def framed_document(framed: str) -> str:
    return f"variant_get({framed}, '$[0]', 'variant')"


def starts_object(text: str) -> str:
    """Whether a valid JSON text holds an object; looks at one character."""
    return rf"startswith(ltrim(' \t\r\n', {text}), '{{')"
