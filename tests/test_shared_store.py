from pathlib import Path

import pytest

from cohortloom.plans import demo
from cohortloom.plans.assessment import Assessment
from cohortloom.plans.queries import Context
from cohortloom.session import tune

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")
def test_assessments_share_a_store_without_overwriting(spark):
    context = Context(tune(spark), FOLDER)
    one, two, half = (
        Assessment(demo.algorithm(spark), context.sources, demo.GROUPS, sample_ratio=r, store=context.store)
        for r in (None, None, 0.5)
    )
    before = one.control_candidates.count()
    assert two.control_candidates is one.control_candidates
    assert half.control_candidates.count() < before
    assert one.control_candidates.count() == before > 0
