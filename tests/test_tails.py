"""Reference values from published tables of the t, normal and chi-square distributions."""

from __future__ import annotations

import math

import pytest

from tidemark.functions import tails


@pytest.mark.parametrize("q, df, value", [(0.975, 1, 12.7062047), (0.975, 10, 2.2281389), (0.95, 30, 1.6972609), (0.975, 1000, 1.9623391)])
def test_t_quantile(q, df, value):
    assert tails.t_quantile(q, df) == pytest.approx(value, abs=1e-6)


@pytest.mark.parametrize("q, df", [(0.6, 3.7), (0.975, 58.2), (0.999, 250.0)])
def test_t_quantile_inverts_the_tail(q, df):
    assert 1 - tails.t_two_sided(tails.t_quantile(q, df), df) / 2 == pytest.approx(q, abs=1e-12)


def test_t_matches_closed_forms():
    # one degree of freedom is Cauchy, two have an algebraic form
    assert tails.t_two_sided(1.0, 1) == pytest.approx(0.5, abs=1e-12)
    assert tails.t_two_sided(3.0, 2) == pytest.approx(1 - 3 / math.sqrt(11), abs=1e-12)


@pytest.mark.parametrize("x, k, p", [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05)])
def test_chi_square_tail(x, k, p):
    assert tails.upper_gamma(k / 2, x / 2) == pytest.approx(p, abs=1e-10)


def test_limits():
    assert tails.upper_gamma(0.5, 0.0) == 1.0
    assert tails.upper_gamma(0.5, math.inf) == 0.0
    assert tails.t_two_sided(math.inf, 5) == 0.0
    assert tails.incomplete_beta(2, 3, 0) == 0.0 and tails.incomplete_beta(2, 3, 1) == 1.0
