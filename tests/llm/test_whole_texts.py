"""Operators of ``llm`` see the whole of a text."""

import pytest


def test_capitals_of_the_whole_text():
    from commlens.llm.quality_gam import FEATURES, features_of

    at = FEATURES.index("capitals")
    assert features_of(b"low " * 200 + b"Title " * 600)[at] == pytest.approx(0.75)
    assert features_of(b"Title " * 200 + b"low " * 200)[at] == pytest.approx(0.5)
    assert features_of(b"")[at] == 0.0
