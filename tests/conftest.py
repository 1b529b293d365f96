import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tidemark-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def customers(spark):
    """The three raw customer rows every cleaning expectation is stated for."""
    names = (
        "customer_id gender senior_citizen partner dependents tenure phone_service multiple_lines internet_service "
        "online_security online_backup device_protection tech_support streaming_tv streaming_movies contract "
        "paperless_billing payment_method monthly_charges total_charges churn"
    ).split()
    none = "No internet service"
    rows = [
        ("C001", "Male", 0, "Yes", "No", 12.0, "Yes", "No", "DSL", "No", "Yes", "No", "No", "No", "No",
         "Month-to-month", "Yes", "Electronic check", 29.85, "358.5", "No"),
        ("C002", "Female", 1, "No", "No", None, "Yes", "Yes", "Fiber optic", "Yes", "No", "Yes", "No", "Yes", "Yes",
         "One year", "No", "Mailed check", 56.95, " ", "No"),
        ("C003", "Male", 0, "Yes", "Yes", 5.0, "No", "No phone service", "No", none, none, none, none, none, none,
         "Two year", "Yes", "Bank transfer (automatic)", None, "42.3", "Yes"),
    ]
    types = {"senior_citizen": "long", "tenure": "double", "monthly_charges": "double"}
    return spark.createDataFrame(rows, ", ".join(f"{n} {types.get(n, 'string')}" for n in names))
