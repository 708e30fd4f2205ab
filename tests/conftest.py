import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from denialscope.session import get_spark  # noqa: E402
from denialscope.sources.schema import CLAIMS_SCHEMA  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

# A plain approved claim; tests change one column at a time.
DEFAULT_CLAIM = {
    "claim_id": "T-1", "member_id": "M-77", "provider_npi": "5550001112",
    "claim_type": "medical", "place_of_service": "11", "diagnosis_codes": "M54.5|E11.65",
    "procedure_codes": "99213", "billed_amount": 360.0, "allowed_amount": 240.0,
    "service_date": dt.date(2024, 3, 9), "submission_date": dt.date(2024, 3, 21),
    "drug_ndc": "", "days_supply": 0, "member_age": 47, "member_gender": "M",
    "provider_specialty": "cardiology", "is_denied": 0,
}


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=4)
    yield s


def claim_rows(spark, *overrides):
    """Claims frame: one row per override dict applied to the defaults."""
    rows = []
    for i, o in enumerate(overrides or ({},)):
        r = dict(DEFAULT_CLAIM)
        r["claim_id"] = f"T-{i}"
        r.update(o)
        rows.append(tuple(r[f.name] for f in CLAIMS_SCHEMA.fields))
    return spark.createDataFrame(rows, CLAIMS_SCHEMA)


@pytest.fixture
def claims_of(spark):
    return lambda *o: claim_rows(spark, *o)
