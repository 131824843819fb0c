"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tools.compare import compare, duck
from treadle.retail import jobs

FOLDER = os.environ.get("TREADLE_SF_DIR", "/root/testdata/sf0.001")

XML_VIEWS = ("v_additional_contact_info", "v_person_demographics", "v_job_candidate", "v_job_candidate_employment",
             "v_job_candidate_education", "v_product_model_catalog", "v_product_model_instructions", "v_store_with_demographics")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(jobs.QUERIES))
def test_query(spark, con, name):
    assert name in entry.oracle_sql()
    assert compare(spark, con, name, FOLDER, entry.oracle_sql()[name]).startswith("ok")


def test_every_column_of_the_xml_views_has_values(spark):
    """A column that is NULL throughout would hide a wrong element name."""
    for name in XML_VIEWS:
        df = entry.queries()[name](spark, FOLDER)
        held = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
        assert all(held.values()), (name, [c for c, n in held.items() if not n])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
