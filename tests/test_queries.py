"""Every query against its SQL on the small tables; of those that fit models the ones that share a search and a model."""

import os

import pytest

import __spark_entry__ as entry
import check_oracle

FOLDER = "/root/testdata/sf0.001"
#: Fits of their own, which check_oracle.py runs.
FITTING = {"train_families", "training_job", "topk_importance"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in FITTING])
def test_query(spark, con, name):
    assert check_oracle.compare(spark, con, FOLDER, name) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
