"""The code tables, pinned: the oracles are rendered from the same Python
values, so a wrong constant would pass there."""

from denialscope.sources import codes


def test_sizes_and_members():
    assert len(codes.CPT_TO_CATEGORY) == 71 and len(codes.HIGH_COST_PROCEDURES) == 10
    assert set(codes.HIGH_COST_PROCEDURES) <= set(codes.CPT_TO_CATEGORY) | set(codes.HIGH_COST_PROCEDURES)
    assert {k: codes.CPT_TO_CATEGORY[k] for k in ("99213", "27447", "71046", "85025", "90834")} == {
        "99213": "evaluation_management", "27447": "surgery", "71046": "radiology", "85025": "pathology", "90834": "medicine"}
    assert "27447" in codes.HIGH_COST_PROCEDURES and "99213" not in codes.HIGH_COST_PROCEDURES


def test_places_of_service():
    assert set(codes.EMERGENCY_POS_CODES) == {"23"} and "21" in codes.INPATIENT_POS_CODES


def test_chronic_prefixes():
    assert {"E11", "I10", "J44", "N18"} <= set(codes.CHRONIC_CONDITION_PREFIXES)
