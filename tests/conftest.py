from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from devfold.schemas import table_schema  # noqa: E402
from devfold.session import get_session  # noqa: E402

BIG = -7297178577997113203

# The hand-checked fixture.
ROWS = {
    "gender_age_train": [(BIG, "F", 25, "F24-26"), (2, "M", 30, "M29-31"), (3, "F", 50, "F43+")],
    "gender_age_test": [(4,)],
    "phone_brand_device_model": [
        (BIG, "A", "a1"), (2, "A", "a2"), (2, "A", "a2"), (3, "B", "b1"), (4, "A", "a1"),
    ],
    "events": [
        (1, BIG, "2016-05-01 00:00:00", 0.0, 0.0),
        (2, BIG, "2016-05-02 00:09:59", 1.5, 2.5),
        (3, BIG, "2016-05-01 00:10:00", 0.0, 7.0),
        (4, 2, "2016-05-01 23:59:59", 0.0, 0.0),
        (5, 2, None, 1.0, 1.0),
    ],
    "app_events": [(1, 10, 1, 1), (2, 10, 1, 0), (2, 11, 1, 0), (4, 12, 1, 1)],
    "app_labels": [(10, 7), (11, 7), (11, 1021), (12, 42)],
    "label_categories": [(7, "Games"), (42, "Finance"), (42, "Property")],
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def csv_dir(tmp_path_factory):
    """The fixture as one headed CSV file per table."""
    folder = tmp_path_factory.mktemp("input")
    for name, rows in ROWS.items():
        header = ",".join(f.name for f in table_schema(name).fields)
        header = header.replace("grp", "group").replace("ts,", "timestamp,")
        lines = [",".join("" if v is None else str(v) for v in row) for row in rows]
        (folder / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


@pytest.fixture(scope="session")
def tables(spark, csv_dir):
    from devfold.sources import read_table

    return {name: read_table(spark, f"{csv_dir}/{name}.csv", name) for name in ROWS}


def rows(df) -> set[tuple]:
    return {tuple(r) for r in df.collect()}
