import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cairnfield.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = build_session("tests", "local[4]", spark__sql__shuffle__partitions="2", spark__default__parallelism="2", spark__sql__codegen__wholeStage="false", spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
