import math

import pytest

from quarry.functions.distributions import betainc_reg, chi2_upper_p, gammainc_upper_reg, t_two_sided_p


def simpson(f, a, b, n=20_000):
    h = (b - a) / n
    return h / 3 * (f(a) + f(b) + sum((4 if k % 2 else 2) * f(a + k * h) for k in range(1, n)))


def t_by_integral(t, df):
    c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    return 1 - 2 * simpson(lambda u: c * math.exp(-(df + 1) / 2 * math.log1p(u * u / df)), 0, abs(t))


@pytest.mark.parametrize("df", [1, 2, 3.7, 10, 99, 500, 9_999, 10_001, 50_000])
@pytest.mark.parametrize("t", [0.01, 0.7, 1.96, 3.1])
def test_t_against_its_density(t, df):
    # the integral's own constant is a difference of logarithms, good to about df * 1e-13
    assert t_two_sided_p(t, df) == pytest.approx(t_by_integral(t, df), rel=max(1e-9, 2e-12 * df))
    assert t_two_sided_p(-t, df) == t_two_sided_p(t, df)


@pytest.mark.parametrize("df", [1e6, 1e8, 1e10, 1e12, 1e13, 1e14])
@pytest.mark.parametrize("t", [0.5, 2.0, 5.0, 10.0])
def test_t_normal_limit(t, df):
    normal = math.erfc(t / math.sqrt(2))
    first = (t**3 + t) / (4 * df) * 2 * math.exp(-t * t / 2) / math.sqrt(2 * math.pi)  # the known 1/df term
    assert t_two_sided_p(t, df) == pytest.approx(normal + first, rel=1e-9)


def test_t_closed_forms_and_far_tails():
    for t in (0.3, 1.0, 20.0, 1e4, 1e8):
        assert t_two_sided_p(t, 1) == pytest.approx(2 / math.pi * math.atan(1 / t), rel=1e-12)
        assert t_two_sided_p(t, 2) == pytest.approx(2 / (math.hypot(t, math.sqrt(2)) * (math.hypot(t, math.sqrt(2)) + t)), rel=1e-12)


@pytest.mark.parametrize("dof", [1e6, 1e8, 1e9, 1e10, 1e12])
def test_chi_square_at_the_mean(dof):
    a = dof / 2
    assert chi2_upper_p(dof, dof) == pytest.approx(0.5 - 1 / (3 * math.sqrt(2 * math.pi * a)), abs=1e-6)


def test_chi_square_closed_forms():
    for x in (0.1, 1.0, 5.0, 60.0, 700.0):
        assert chi2_upper_p(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-11)
        assert chi2_upper_p(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-10)
        poisson = math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(5))
        assert chi2_upper_p(x, 10) == pytest.approx(poisson, rel=1e-10)


@pytest.mark.parametrize("z", [-3.0, -1.0, 0.0, 0.5, 2.0, 4.0])
def test_both_gamma_paths_agree(z):
    from quarry.functions import distributions as d

    s = 9_000.0
    x = s + z * math.sqrt(s)
    assert gammainc_upper_reg(s, x) == pytest.approx(d._gamma_uniform(s, x), rel=1e-8)


def test_undefined_and_limits():
    assert t_two_sided_p(None, 3) is None and t_two_sided_p(1.0, 0) is None and chi2_upper_p(math.nan, 1) is None
    assert chi2_upper_p(1.0, 0) is None and chi2_upper_p(0.0, 5) == 1.0 and chi2_upper_p(math.inf, 5) == 0.0
    assert t_two_sided_p(0.0, 5) == 1.0 and t_two_sided_p(math.inf, 5) == 0.0
    assert betainc_reg(2, 3, 0) == 0.0 and betainc_reg(2, 3, 1) == 1.0
