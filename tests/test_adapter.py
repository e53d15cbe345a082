"""The adapter views carry the declared schemas (nothing inferred)."""

import os

import pytest

from fieldreports import schemas
from fieldreports.sources import adapter as A

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="shared test data not present")


def names_types(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


@pytest.mark.parametrize("view,schema", [
    (A.raw_messages, schemas.RAW_MESSAGE),
    (A.messages, schemas.MESSAGE),
    (A.landed_roster, schemas.ROSTER_LANDED),
    (A.roster, schemas.ROSTER),
    (A.landed_crosswalk, schemas.CROSSWALK_LANDED),
    (A.crosswalk, schemas.CROSSWALK),
    (A.status_events, schemas.EVENT),
    (A.survey_responses, schemas.SURVEY_RESPONSE),
    (A.legacy_messages, schemas.LEGACY_MESSAGE),
    (A.old_queue, schemas.QUEUE),
    (A.existing_directory, schemas.DIRECTORY),
])
def test_view_schema(spark, view, schema):
    assert names_types(view(spark, SF).schema) == names_types(schema)


def test_views_grow_with_the_data(spark):
    small = A.raw_messages(spark, SF).count()
    assert small == spark.read.parquet(f"{SF}/events.parquet").count()
    assert A.roster(spark, SF).count() > 0 and A.survey_responses(spark, SF).count() > 0
