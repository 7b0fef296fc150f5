"""Tail probabilities against published table values and identities."""

import math

import numpy as np
import pytest

from tidewatch.functions import tails


@pytest.mark.parametrize("t,df,p,tol", [(2.0, 10, 0.0733880347707, 1e-8), (2.228138851986, 10, 0.05, 1e-8),
                                        (1.959963984540, 1e9, 0.05, 1e-6), (0.0, 5, 1.0, 1e-12)])
def test_t_two_sided(t, df, p, tol):
    assert tails.t_two_sided(t, df) == pytest.approx(p, rel=tol, abs=1e-12)


@pytest.mark.parametrize("x,k,p", [(3.841458820694124, 1, 0.05), (11.070497693516351, 5, 0.05),
                                   (9.487729036781154, 4, 0.05), (0.0, 3, 1.0), (5.0, 0, 1.0)])
def test_chi2_upper(x, k, p):
    assert tails.chi2_upper(x, k) == pytest.approx(p, rel=1e-9)


def test_f_upper_matches_t_squared():
    # F(1, d) = t(d)^2
    for t, d in [(1.3, 7), (2.5, 30), (0.4, 200)]:
        assert tails.f_upper(t * t, 1, d) == pytest.approx(tails.t_two_sided(t, d), rel=1e-10)


def test_f_upper_known():
    assert tails.f_upper(4.35124348, 1, 20) == pytest.approx(0.05, rel=1e-6)


def test_kolmogorov_both_forms_agree():
    for lam in (0.9, 0.95, 1.0, 1.05):
        series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 200))
        assert tails.kolmogorov_sf(lam) == pytest.approx(series, rel=1e-10)
    assert tails.kolmogorov_sf(1.3580986393225505) == pytest.approx(0.05, rel=1e-9)


def test_ks_exact_small():
    # all 5 of one sample below all 5 of the other: 2 of C(10,5) paths reach D = 1
    assert tails.ks_exact_two_sided(1.0, 5, 5) == pytest.approx(2 / 252, rel=1e-12)
    assert tails.ks_exact_two_sided(0.6, 5, 5) == pytest.approx(0.35714285714, rel=1e-9)
    assert tails.ks_two_sample_p(0.0, 10, 10) == 1.0


def test_ks_exact_monotone_in_d():
    ps = [tails.ks_exact_two_sided(d, 40, 60) for d in (0.1, 0.2, 0.3, 0.4)]
    assert all(a >= b for a, b in zip(ps, ps[1:]))


def finite_ks(n, d):
    """P(D_n < d) for one sample, by powers of Durbin's matrix."""
    k = int(n * d) + 1
    h, m = k - n * d, 2 * k - 1
    a = np.tril(np.ones((m, m)), 1)
    for i in range(m):
        a[i, 0] -= h ** (i + 1)
        a[m - 1, i] -= h ** (m - i)
    a[m - 1, 0] += (2 * h - 1) ** m if 2 * h > 1 else 0
    for i in range(m):
        for j in range(m):
            if i - j + 1 > 0:
                a[i, j] /= math.factorial(i - j + 1)
    q = np.linalg.matrix_power(a, n)[k - 1, k - 1]
    return q * math.factorial(n) / n ** n


@pytest.mark.parametrize(("n", "z"), [(60, 0.7), (60, 1.2), (100, 0.9), (100, 1.36), (140, 1.5)])
def test_large_sample_ks_follows_the_finite_law(n, z):
    d = z / math.sqrt(n)
    exact = 1 - finite_ks(n, d)
    assert tails.ks_large_p(d, n) == pytest.approx(exact, rel=4e-3)
    assert abs(tails.ks_large_p(d, n) - exact) < abs(tails.kolmogorov_sf(z) - exact) / 5
