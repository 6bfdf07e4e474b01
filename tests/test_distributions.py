"""Scalar distribution functions against commons-math3 on Spark's classpath."""

import pytest

from quarry.functions import distributions as D


@pytest.fixture(scope="module")
def jvm(spark):
    return spark.sparkContext._jvm.org.apache.commons.math3.distribution


@pytest.mark.parametrize("t,df", [(2.0, 5.0), (0.3, 30.0), (-4.1, 12.5), (1.96, 1000.0)])
def test_t(jvm, t, df):
    want = 2 * (1 - jvm.TDistribution(df).cumulativeProbability(abs(t)))
    assert abs(D.t_sf_two_sided(t, df) - want) < 1e-10


@pytest.mark.parametrize("f,d1,d2", [(3.2, 4.0, 20.0), (0.5, 2.0, 7.0), (12.0, 24.0, 1975.0)])
def test_f(jvm, f, d1, d2):
    want = 1 - jvm.FDistribution(d1, d2).cumulativeProbability(f)
    assert abs(D.f_sf(f, d1, d2) - want) < 1e-10


@pytest.mark.parametrize("x,k", [(3.0, 4.0), (50.0, 60.0), (0.2, 1.0)])
def test_chi2(jvm, x, k):
    assert abs(D.chi2_cdf(x, k) - jvm.ChiSquaredDistribution(k).cumulativeProbability(x)) < 1e-10
    p = D.chi2_cdf(x, k)
    assert abs(D.chi2_ppf(p, k) - x) < 1e-6


def test_normal_ppf():
    assert abs(D.normal_ppf(0.975) - 1.959963984540054) < 1e-9


def test_poisson_cdf(jvm):
    assert abs(D.poisson_cdf(3, 2.5) - jvm.PoissonDistribution(2.5).cumulativeProbability(3)) < 1e-12


@pytest.mark.parametrize("q,k,df,p", [(3.773, 3, 12, 0.95), (3.399, 3, 60, 0.95), (4.232, 5, 20, 0.95), (3.314, 3, 1e9, 0.95)])
def test_studentized_range_table(q, k, df, p):
    # published critical values of the studentised range at alpha = 0.05
    assert abs(D.ptukey(q, k, df) - p) < 2e-3
