import hashlib

import pytest

from holdfast.operators import privacy


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        ("Ann", "a@b.org", None, "call (555) 123-4567 or a.b+c@d-e.co, 123-45-6789", None),
        ("Bob", None, "1234", "nothing here 123-456-7890", "Contact: (212)555-0000"),
        (None, "c@d.net", None, None, "x"),
    ]
    return spark.createDataFrame(rows, "first_name string, email string, ssn_last4 string, notes string, address_line2 string")


def test_findings(people):
    got = {r["info_type"]: r["findings"] for r in privacy.findings(people).collect()}
    assert got == {
        "PERSON_NAME": 2, "EMAIL_ADDRESS": 2, "US_SOCIAL_SECURITY_NUMBER": 1,
        "US_SOCIAL_SECURITY_NUMBER_in_notes": 1, "PHONE_NUMBER_in_notes": 1, "EMAIL_ADDRESS_in_notes": 1,
        "PHONE_NUMBER_in_address_line2": 1,
    }


def test_density_counts_a_cell_per_pattern(people):
    row = privacy.text_density(people).first()
    assert (row["text_findings"], row["text_cells"], row["density"], row["blocked"]) == (4, 4, 1.0, True)
    none = privacy.text_density(people.where("first_name = 'Zed'")).first()
    assert none["density"] == 0.0 and not none["blocked"]


def test_gate_is_strict(people):
    with pytest.raises(ValueError):
        privacy.scan(people, 0.99)
    redacted, _, _ = privacy.scan(people, 1.0)
    assert redacted.where("first_name = '[PERSON_NAME]'").count() == 2


def test_text_redaction(people):
    notes = [r["notes"] for r in privacy.redact_text(people).collect()]
    assert notes == [
        "call [PHONE_NUMBER] or [EMAIL_ADDRESS], [US_SOCIAL_SECURITY_NUMBER]", "nothing here 123-456-7890", None
    ]


def test_modes(people):
    hashed = privacy.redact_columns(people, "hash").first()
    assert hashed["first_name"] == hashlib.sha256(b"Ann").hexdigest()[:16] and hashed["ssn_last4"] is None
    assert privacy.redact_columns(people, "drop").columns == ["notes", "address_line2"]
    with pytest.raises(ValueError):
        privacy.redact_columns(people, "mask")
