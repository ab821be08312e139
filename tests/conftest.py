import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tempora.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame("a int, b string", rows): timestamps may be written as text."""

    def build(schema, rows):
        import datetime as dt

        fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
        stamp = [i for i, (_, t) in enumerate(fields) if t == "timestamp_ntz"]
        fixed = [
            tuple(dt.datetime.fromisoformat(v) if i in stamp and isinstance(v, str) else v for i, v in enumerate(r))
            for r in rows
        ]
        return spark.createDataFrame(fixed, schema)

    return build
