from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from ledgerlens.session import get_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "ledgerlens-tests",
        master="local[8]",
        shuffle_partitions=4,
        log_level="ERROR",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tx(spark):
    from ledgerlens.sources.events import transactions

    return transactions(spark, SF_DIR).persist()
