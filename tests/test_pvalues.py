import math

from quarry.functions import pvalues


def test_chi2_tabulated():
    assert abs(pvalues.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(pvalues.chi2_sf(5.991464547107979, 2) - 0.05) < 1e-9
    assert abs(pvalues.chi2_sf(6.634896601021214, 1) - 0.01) < 1e-9


def test_t_tabulated():
    assert abs(pvalues.t_two_sided(2.228138851986274, 10) - 0.05) < 1e-9
    assert abs(pvalues.t_two_sided(1.959963984540054, 1e7) - 0.05) < 1e-5


def test_f_tabulated():
    assert abs(pvalues.f_sf(4.964602743730712, 1, 10) - 0.05) < 1e-9
    assert abs(pvalues.f_sf(3.3541308285291136, 2, 27) - 0.05) < 1e-8


def test_degenerate():
    assert math.isnan(pvalues.chi2_sf(1.0, 0))
    assert pvalues.chi2_sf(0.0, 3) == 1.0


def test_t_quantile():
    assert abs(pvalues.t_quantile(0.975, 10) - 2.228138851986274) < 1e-9
    assert abs(pvalues.t_quantile(0.025, 30) + 2.042272456301238) < 1e-9


def test_binomial_helpers():
    from math import comb
    lo, hi = pvalues.binom_ci(7, 10)
    # Clopper-Pearson ends: P(X >= 7 | lo) = 0.025 and P(X <= 7 | hi) = 0.025.
    assert abs(sum(comb(10, k) * lo ** k * (1 - lo) ** (10 - k) for k in range(7, 11)) - 0.025) < 1e-12
    assert abs(sum(comb(10, k) * hi ** k * (1 - hi) ** (10 - k) for k in range(0, 8)) - 0.025) < 1e-12
    assert abs(lo - 0.3475471499) < 1e-8
    assert abs(pvalues.binom_upper_tail(8, 10, 0.5) - 56 / 1024) < 1e-12
