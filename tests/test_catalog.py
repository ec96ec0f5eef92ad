"""What the registered queries build."""

import pytest

from polylex import catalog, fixtures
from polylex.operators import key_index, ontology

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["coarse_types", "bench1_summary"])
def test_no_lists_of_neighbors_where_memberships_do(spark, monkeypatch, name):
    real = ontology.concept_slice

    def slim(*args):
        assert args[6] is False, "all neighbors of all concepts are joined"
        return real(*args)

    monkeypatch.setattr(ontology, "concept_slice", slim)
    fixtures.Linked.forget(spark)
    assert catalog.queries()[name](spark, SMALL).count()


def test_parts_stay_few():
    """Each part is a job, so a dictionary of many keys in small parts must not have one for every few keys."""
    assert key_index.part_count(12, 6) == 3
    assert key_index.part_count(400_000, 6) == 257
    assert key_index.part_count(1 << 30, 1 << 20) == 1025


def test_the_pool_forms_no_lists_of_neighbors(spark, monkeypatch):
    monkeypatch.setattr(ontology, "concept_slice", None)
    fixtures.Linked.forget(spark)
    assert "chebi_id" in catalog.queries()["hard_negative_pool"](spark, SMALL).columns
