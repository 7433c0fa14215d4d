"""Every registered query gives the rows of its SQL twin."""

import compare
import pytest

from govmill import registry
from govmill.oracles import load_oracles

ORACLES = load_oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duck(sf_dir)


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", list(registry.QUERIES))
def test_same_rows(key, inputs, con):
    assert compare.differences(registry.plain(registry.QUERIES[key](inputs)), con, ORACLES[key]) is None
