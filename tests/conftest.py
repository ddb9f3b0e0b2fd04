from __future__ import annotations

import base64
import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from headrace import schemas as S  # noqa: E402
from headrace import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session.build(
        "local[8]", "headrace-tests", **{"spark.ui.showConsoleProgress": "false",
                                         "spark.driver.memory": "8g"}
    )


@pytest.fixture
def envelopes(spark):
    """Build envelopes from payloads: dicts, raw bytes, or (sequence, payload) pairs."""

    def build(*payloads, arrival: float = 1700000000.0):
        rows = []
        for i, payload in enumerate(payloads):
            seq = f"seq-{i}"
            if isinstance(payload, tuple):
                seq, payload = payload
            if isinstance(payload, bytes):
                data = base64.b64encode(payload).decode()
            elif payload is None or isinstance(payload, str):
                data = payload
            else:
                data = base64.b64encode(
                    json.dumps(payload, separators=(",", ":")).encode()
                ).decode()
            rows.append((seq, "key", data, arrival + i))
        return spark.createDataFrame(rows, S.ENVELOPE)

    return build


@pytest.fixture
def users(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), S.USERS)

    return build
