"""Every rule of the rule queries finds a row of the driver's tables."""

import pytest

from ledgerlake.plans.bank_queries import QUERIES
from tests.conftest import SF001


@pytest.mark.parametrize("name", ["required_fields", "id_pattern", "loan_rules", "payment_rules", "allowed_values", "landing_rule_checks", "type_check"])
def test_every_rule_bites(spark, name):
    assert [r["rule"] for r in QUERIES[name](spark, SF001).collect() if not r["n_bad"]] == []


def test_every_relation_has_orphans(spark):
    assert [r["relation"] for r in QUERIES["fk_orphans"](spark, SF001).collect() if not r["n_orphans"]] == []


def test_ranges_and_signs_bite(spark):
    assert all(r["n_bad"] for r in QUERIES["amount_range"](spark, SF001).collect())
    assert sum(bool(r["n_bad"]) for r in QUERIES["amount_sign"](spark, SF001).collect()) >= 4
    rows = QUERIES["balance_range"](spark, SF001).collect()
    assert all(r["n_out_of_range"] for r in rows if not r["n_unknown_segment"]) and sum(bool(r["n_unknown_segment"]) for r in rows) == 1


def test_document_faults_are_found(spark):
    """Each required field is absent and each field of another type in some document."""
    from ledgerlake import schemas as S
    got = {r["rule"] for r in QUERIES["document_checks"](spark, SF001).collect() if r["n_bad"]}
    assert got == ({f"transactions.required:{f}" for f in S.REQUIRED_FIELDS["transactions"]}
                   | {f"transactions.type:{f}" for f in S.DOCUMENTS["transactions"].names})
