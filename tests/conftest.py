from __future__ import annotations

import contextlib
import io
from datetime import datetime, timezone

import pytest

from sluicegate import Run, build_session
from sluicegate.plans import PRODUCTS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Compiling a stage takes longer than running it on a handful of rows.
            "spark.sql.codegen.wholeStage": "false",
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run() -> Run:
    return Run("test-run", "2024-03-01", datetime(2024, 3, 1, 12, tzinfo=timezone.utc))


GOOD = {
    "_id": "i1",
    "code": "c1",
    "product_name": "Bar",
    "brands": "Acme",
    "categories": "sweets",
    "countries": "Nowhere",
    "ingredients_text": "sugar",
    "allergens": "",
    "nutrition_grades": "A",
    "last_modified_t": 1_000,
    "nutriments": {
        "energy-kcal_100g": 500.0,
        "fat_100g": 10.0,
        "proteins_100g": 5.0,
        "salt_100g": 1.0,
        "sugars_100g": 50.0,
    },
}


def record(**changes) -> dict:
    """A good raw record with changes; nutrient names change the nested struct."""
    nutrients = dict(GOOD["nutriments"])
    plain = {}
    for name, value in changes.items():
        target = nutrients if name.endswith("_100g") else plain
        target["energy-kcal_100g" if name == "energy_kcal_100g" else name] = value
    return {**GOOD, "nutriments": nutrients, **plain}


@pytest.fixture
def bronze(spark):
    """Build a raw frame from records."""

    def build(*records: dict):
        return spark.createDataFrame(list(records), PRODUCTS.bronze)

    return build


def plan_of(frame) -> str:
    """The physical plan as text."""
    with contextlib.redirect_stdout(io.StringIO()) as out:
        frame.explain()
    return out.getvalue()
