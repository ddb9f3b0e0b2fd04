"""Reading fields of an open-schema payload with the source's null rules."""

from __future__ import annotations

_SPACES = r"' \t\n\r\u000B\u000C'"
_DIGITS = "'-','0','1','2','3','4','5','6','7','8','9'"


def field(payload: str, name: str) -> str:
    """The field as a Variant: SQL NULL when absent, a Variant null when JSON null."""
    return f"variant_get({payload}, '$.{name}', 'variant')"


def text(payload: str, name: str) -> str:
    """The field as text: NULL when absent or JSON null."""
    return f"try_variant_get({payload}, '$.{name}', 'string')"


def members(payload: str, texts: tuple[str, ...] = (), values: tuple[str, ...] = ()) -> str:
    """Several fields as one struct: the ``text`` of some, the ``field`` of others.

    A path searches the payload's keys for its name, once for every path; the struct is read in
    one pass over them. Put it in a column of its own and take the members from there.
    """
    kinds = ", ".join([*(f"{n}: string" for n in texts), *(f"{n}: variant" for n in values)])
    return f"try_variant_get({payload}, '$', 'struct<{kinds}>')"


def value_text(value: str) -> str:
    """A field's Variant as text, as ``text`` gives it."""
    return f"try_variant_get({value}, '$', 'string')"


def _json_number(json: str) -> str:
    return f"CASE WHEN substr({json}, 1, 1) IN ({_DIGITS}) THEN try_cast({json} AS DOUBLE) END"


def truthy(value: str) -> str:
    """False for absent, null, false, zero, "", [] and {}; never NULL."""
    json = f"to_json({value})"
    return (
        f"""coalesce({json} NOT IN ('null', 'false', '""', '[]', '{{}}') """
        f"AND NOT coalesce({_json_number(json)} = 0, false), false)"
    )


def truthy_text(payload: str, name: str) -> str:
    """The field as text when truthy, else NULL; chain with ``coalesce``."""
    return f"CASE WHEN {truthy(field(payload, name))} THEN {text(payload, name)} END"


def truthy_value(value: str) -> str:
    """A field's Variant as text when truthy, else NULL."""
    return f"CASE WHEN {truthy(value)} THEN {value_text(value)} END"


def number_text(value: str) -> str:
    """A number written as text, NULL when it is not one.

    Surrounding white space, single underscores between digits, and signed
    inf/infinity/nan in any case are accepted; type suffixes are not.
    """
    trimmed = f"lower(btrim({value}, {_SPACES}))"
    plain = f"replace({trimmed}, '_', '')"
    return f"""CASE
        WHEN ltrim('+', {trimmed}) IN ('inf', 'infinity') AND NOT startswith({trimmed}, '++')
            THEN DOUBLE('Infinity')
        WHEN {trimmed} IN ('-inf', '-infinity') THEN DOUBLE('-Infinity')
        WHEN {trimmed} IN ('nan', '+nan', '-nan') THEN DOUBLE('NaN')
        WHEN NOT {trimmed} RLIKE '(^|[^0-9])_|_([^0-9]|$)'
            AND {plain} RLIKE '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)(e[+-]?[0-9]+)?$'
            THEN try_cast({plain} AS DOUBLE)
        END"""


def number(payload: str, name: str) -> str:
    """The field as a double: 0 when falsy, NULL when it cannot be a number."""
    value = field(payload, name)
    json = f"to_json({value})"
    return f"""CASE
        WHEN NOT {truthy(value)} THEN 0D
        WHEN {json} = 'true' THEN 1D
        WHEN startswith({json}, '"') THEN {number_text(text(payload, name))}
        ELSE {_json_number(json)} END"""


def has_field(payload: str, name: str) -> str:
    """Whether the key is present, JSON null included."""
    return f"({field(payload, name)} IS NOT NULL)"


def iso_timestamp(value: str) -> str:
    """Wall-clock time of an ISO date or date-time; an offset is dropped."""
    return (
        f"CASE WHEN {value} RLIKE '^ *[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ]|$)' "
        f"THEN try_cast({value} AS TIMESTAMP_NTZ) END"
    )


def flag(value: str) -> str:
    """A field's Variant as a boolean, NULL when absent or not a truth value."""
    word = f"lower(btrim({value_text(value)}, {_SPACES}))"
    return (
        f"CASE {word} WHEN 'on' THEN true WHEN 'off' THEN false "
        f"ELSE try_variant_get({value}, '$', 'boolean') END"
    )


def epoch_to_ntz(seconds: str) -> str:
    """UTC wall-clock time of epoch seconds, independent of the session time zone."""
    return (
        f"timestampadd(MICROSECOND, CAST(round({seconds} * 1000000) AS BIGINT), "
        "TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    )


def ntz(moment) -> str:
    """A literal run time, given as a datetime or an ISO text."""
    return f"TIMESTAMP_NTZ'{moment}'"
