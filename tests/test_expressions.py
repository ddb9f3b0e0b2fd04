"""Expression helpers against the host language's own parsers."""

from __future__ import annotations

import base64
import json
import math
import random

import pytest

from headrace.functions import codec, fields


BYTES = codec.base64_bytes("v", codec.base64_direct("v"))


def evaluate(spark, expression: str, values: list, schema: str = "v string") -> list:
    """The expression over column ``v``, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    rows = df.selectExpr("i", f"{expression} AS out").collect()
    return [r.out for r in sorted(rows, key=lambda r: r.i)]


def host_base64(text: str):
    try:
        return base64.b64decode(text)
    except ValueError:
        return None


BASE64_CASES = [
    "QUJD", "QUJD!", "!!!!", "QQ==", "QQ", "Q", "QUI=", "QUI", "QQ=", "QUJDé", "QU JD\n", "=",
    "QQ===", "QUI=QUI=", "QQ==QQ==", "QUJD=", "QR==", "-_-_", "QUJDQ", "QQ=\n=", "A===", "====",
    "", " QQ== ", "QQ==!QUJD", "Q UJD",
]


def test_base64_cases(spark):
    got = evaluate(spark, BYTES, BASE64_CASES)
    for text, value in zip(BASE64_CASES, got):
        assert (None if value is None else bytes(value)) == host_base64(text), text


def test_base64_random(spark):
    rng = random.Random(7)
    cases = []
    for _ in range(2000):
        text = base64.b64encode(rng.randbytes(rng.randrange(0, 40))).decode()
        if rng.random() < 0.6 and text:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", "!", "\n", " ", "-", "é", "AA"]) + text[at + 1 :]
        # A pad inside a group that is followed by more data is the documented difference.
        body = "".join(c for c in text if c.isascii() and (c.isalnum() or c in "+/="))
        head = body.split("=")[0]
        if not ("=" in body and body.rstrip("=") != head and len(head) % 4 != 3):
            cases.append(text)
    got = evaluate(spark, BYTES, cases)
    for text, value in zip(cases, got):
        assert (None if value is None else bytes(value)) == host_base64(text), text


def test_long_base64_and_json(spark):
    text = base64.b64encode(b"x" * 3_000_000).decode()
    got = evaluate(spark, f"length({BYTES})", [text, text + "\n"])
    assert got == [3_000_000, 3_000_000]


JSON_CASES = [
    '{"a":1}', '{"a":1} x', '{"a":1}] x', '{"a":1}} x', '{"a":1,"a":2}', "[1]", "null", "3", '"s"',
    "", "  {}  ", "1,2", '{"a":1},{"b":2}', "tru", "{a:1}", "{'a':1}", '{"a":1}\n', '{"a":01}',
    "﻿{}", '{"a":"\t"}', '{"a":1}//c', "/**/{}", "[1", "{", "}", "]", "1]", "[1],[2]", '1,"x"',
    '{"a":[1,{"b":null}]}', "-", "+1", ".5", "1.", "1e5", "1e", '"\\x"', '"\\u00e9"', "é",
    "123456789012345678901234567890", "true false", "#", " {}",
]


def test_json_strictness(spark):
    framed = codec.framed_json("v")
    got = evaluate(spark, codec.frame_is_whole(framed, "v"), JSON_CASES)
    document = f"to_json({codec.framed_document(framed)})"
    values = evaluate(spark, document, JSON_CASES)
    for text, valid, value in zip(JSON_CASES, got, values):
        try:
            host = json.loads(text)
        except ValueError:
            assert valid is False, text
        else:
            assert valid is True, text
            assert json.loads(value) == host, text


def test_repeated_key_keeps_the_last(spark):
    out = codec.framed_document(codec.framed_json("v"))
    assert evaluate(spark, f"to_json({out})", ['{"a":1,"a":2}']) == ['{"a":2}']


NUMBER_CASES = [
    "1500", " 1500 ", "1_500", "1__500", "_1", "1_", "1500d", "1500f", "1e3", "1E3", "1_0e1_0",
    "1._5", "1_.5", ".5", "5.", ".", "", "+5", "-5", "+-5", "inf", "-inf", "+Infinity", "++inf",
    "NaN", "-nan", "nano", "0x10", "abc", "1 500", "1,500", "\t7\n", "1e400", "true", "e5", "1e",
    "9" * 5000,
]


def test_number_text(spark):
    got = evaluate(spark, fields.number_text("v"), NUMBER_CASES)
    for text, value in zip(NUMBER_CASES, got):
        try:
            host = float(text)
        except ValueError:
            assert value is None, text
        else:
            assert value == host or (math.isnan(value) and math.isnan(host)), text


TRUTH_CASES = [
    0, 0.0, -0.0, 1, 0.5, "", "0", "a", False, True, None, [], {}, [0], {"a": None}, 1e-300, "false",
]


def test_truthiness(spark):
    texts = [json.dumps({"x": v}) for v in TRUTH_CASES] + ["{}"]
    got = evaluate(spark, fields.truthy(fields.field("parse_json(v)", "x")), texts)
    assert got == [bool(v) for v in TRUTH_CASES] + [False]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-15T10:23:45Z", "2024-01-15 10:23:45"),
        ("2024-01-15T10:23:45.123456+02:00", "2024-01-15 10:23:45.123456"),
        ("2024-01-15 10:23:45", "2024-01-15 10:23:45"),
        ("2024-01-15", "2024-01-15 00:00:00"),
        ("2024", None),
        ("1700000000", None),
        ("not-a-time", None),
        ("2024-13-01T00:00:00", None),
        ("", None),
    ],
)
def test_iso_timestamp(spark, text, expected):
    (got,) = evaluate(spark, f"CAST({fields.iso_timestamp('v')} AS STRING)", [text])
    assert got == expected


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    zone = "spark.sql.session.timeZone"
    try:
        spark.conf.set(zone, "America/New_York")
        got = evaluate(
            spark, f"CAST({fields.epoch_to_ntz('CAST(v AS DOUBLE)')} AS STRING)", ["1700000000.25"]
        )
    finally:
        spark.conf.set(zone, "UTC")
    assert got == ["2023-11-14 22:13:20.25"]


def test_stages_too_long_to_be_compiled_are_not_fused(spark):
    """The JVM interprets a method of more than 8,000 bytes of code for good."""
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_members_read_what_single_paths_read(spark):
    """Both ways agree on every kind of value, and on what is no object."""
    docs = [
        '{"a":"x","b":1,"c":null,"A":"up"}', '{"a":{"z":1},"b":[1,2],"c":true,"d":1.50}', '{}', '[1]', '"a"', "null",
        '{"b":12345678901234567890123,"a":1e400}', '{"a":"","b":false,"c":0}', '{"a":"é\\n\\"q","c":-0.0}', None,
    ]
    names = ("a", "b", "c", "d")
    rows = spark.createDataFrame([(d,) for d in docs], "t string").selectExpr("try_parse_json(t) AS p")
    both = rows.selectExpr(
        "p", f"{fields.members('p', texts=names)} AS texts", f"{fields.members('p', values=names)} AS fields"
    )
    same = " AND ".join(
        f"texts.{n} <=> {fields.text('p', n)} AND {fields.value_text(f'fields.{n}')} <=> {fields.text('p', n)} "
        f"AND to_json(fields.{n}) <=> to_json({fields.field('p', n)})"
        for n in names
    )
    assert both.where(same).count() == len(docs)
