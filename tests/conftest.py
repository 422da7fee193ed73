import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="6g",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("stage")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as dicts, ordered by the given columns."""

    def read(df, *order):
        out = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(out, key=lambda r: tuple((r[o] is not None, r[o]) for o in order)) if order else out

    return read
