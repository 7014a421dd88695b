import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from spokeframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g",
        spark__ui__enabled="false", spark__log__level="ERROR",
        spark__sql__maxMetadataStringLength="2000",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path):
    """A path for one writer; Spark wants it absent."""
    return str(tmp_path / "out")
