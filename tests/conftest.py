import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from cadenza.session import build_session, prepare  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            # Tiny inputs: compiling each plan costs more than running it. The registered queries
            # run with code generation.
            "spark.sql.codegen.wholeStage": "false",
            "spark.default.parallelism": "2",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


def at(text: str | None) -> datetime | None:
    """'10-13 08:00:00.123' in 2026."""
    return None if text is None else datetime.fromisoformat(f"2026-{text}")


def dec(value) -> Decimal | None:
    return None if value is None else Decimal(value)


def rows(df, *columns):
    """Rows as a sorted list of tuples; missing values last."""
    picked = df.select(*columns) if columns else df
    found = [tuple(r) for r in picked.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))
