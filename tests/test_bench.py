"""The bench's yardstick gives the contact table."""

from bench import one_join_per_metric
from clientele.plans.contact_job import build_contacts
from clientele.sources.fixtures import FIXTURE_AS_OF


def test_yardstick_equals_the_contact_table(stored):
    a, b = one_join_per_metric(stored), build_contacts(stored, FIXTURE_AS_OF)
    assert a.columns == b.columns and b.count() == 175
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
