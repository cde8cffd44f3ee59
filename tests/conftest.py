from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskspark.session import local_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Tiny inputs spend most of their time compiling; interpreted operators are quicker here.
    session = local_session(
        8,
        4,
        spark__driver__memory="4g",
        spark__sql__codegen__wholeStage="false",
        spark__sql__codegen__factoryMode="NO_CODEGEN",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(TESTDATA):
        pytest.skip("driver tables not present")
    return TESTDATA


def scores(spark, y, p):
    rows = [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "id int, y_true int, y_prob double")


def customer(i: int, **changes) -> dict:
    """A valid customer; rules by index as in a generated batch of any size."""
    net = "No" if i % 5 == 0 else ("DSL" if i % 2 else "Fiber optic")
    extra = "No internet service" if net == "No" else ("Yes" if i % 3 else "No")
    row = {
        "customerID": f"CUST-{i:04d}",
        "gender": "Female" if i % 2 else "Male",
        "SeniorCitizen": i % 2,
        "Partner": "Yes" if i % 3 else "No",
        "Dependents": "No",
        "tenure": i % 72,
        "PhoneService": "Yes",
        "MultipleLines": "No",
        "InternetService": net,
        **{
            c: extra
            for c in (
                "OnlineSecurity",
                "OnlineBackup",
                "DeviceProtection",
                "TechSupport",
                "StreamingTV",
                "StreamingMovies",
            )
        },
        "Contract": ("Month-to-month", "One year", "Two year")[i % 3],
        "PaperlessBilling": "Yes" if i % 2 else "No",
        "PaymentMethod": "Electronic check" if i % 2 else "Mailed check",
        "MonthlyCharges": 20.0 + (i * 7) % 90,
        "TotalCharges": str((20.0 + (i * 7) % 90) * (i % 72)),
        "Churn": "Yes" if i % 4 == 0 else "No",
    }
    row.update(changes)
    return row


SCHEMA = (
    "customerID string, gender string, SeniorCitizen int, Partner string, Dependents string, tenure int, "
    "PhoneService string, MultipleLines string, InternetService string, OnlineSecurity string, OnlineBackup string, "
    "DeviceProtection string, TechSupport string, StreamingTV string, StreamingMovies string, Contract string, "
    "PaperlessBilling string, PaymentMethod string, MonthlyCharges double, TotalCharges string, Churn string"
)


def customers(spark, rows):
    names = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)
