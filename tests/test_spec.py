from __future__ import annotations

import datetime as dt

import pytest

from tallygrid import ControlSpec, DateSpan, Rule
from tallygrid.spec import checked


def one_cell(control="c", **changes):
    fields = {"control": control, "source": "t", "date": "d", "rules": [Rule("m", "x")], "grid": [("m", "x")]}
    return ControlSpec(**{**fields, **changes})


def test_same_cell_twice_is_rejected():
    with pytest.raises(ValueError, match="same cell twice"):
        one_cell(grid=[("m", "x"), ("m", "y"), ("m", "x")])


@pytest.mark.parametrize("rule", [Rule("other", "x"), Rule("m", "other")])
def test_rule_outside_the_grid_is_rejected(rule):
    with pytest.raises(ValueError, match="no expected cell"):
        one_cell(rules=[rule])


def test_control_without_rules_is_rejected():
    with pytest.raises(ValueError, match="at least one rule"):
        one_cell(rules=[])


def test_control_defined_twice_is_rejected():
    with pytest.raises(ValueError, match="defined twice"):
        checked([one_cell(), one_cell()])
    assert len(checked([one_cell("a"), one_cell("b")])) == 2
    with pytest.raises(ValueError, match="no control"):
        checked([])


def test_span_excludes_as_of():
    span = DateSpan.before(dt.date(2024, 3, 3), 5)
    assert (span.first, span.last) == (dt.date(2024, 2, 27), dt.date(2024, 3, 2))


@pytest.mark.parametrize("days", [0, -1])
def test_span_needs_a_day(days):
    with pytest.raises(ValueError):
        DateSpan.before(dt.date(2024, 3, 3), days)


def test_backward_span_is_rejected():
    with pytest.raises(ValueError):
        DateSpan(dt.date(2024, 3, 3), dt.date(2024, 3, 2))
