"""Every registered query against its SQL; ordered operators also with all groups cut into runs."""

import pytest

import __spark_entry__ as entry
import oracle
from conftest import SF
from sensorlake.operators import runs

QUERIES, SQL = entry.queries(), entry.oracle_sql()

# One query for each way of working on runs.
ORDERED = """b07_window_functions b14_sessions c31_take_positions c39_asof_tolerance c39_asof_without_keys c40_asof_forward c40_asof_nearest
c41_ordered_merge c55_quantiles c55_quantile_interpolation c63_describe_numbers c64_spearman c69_cumulative c70_shift c72_rank c74_fill
c76_rolling_rows c77_rolling_time c78_rolling_forward c79_expanding c79_expanding_shape c79_expanding_pairs c81_exponential_mean
c81_exponential_recurrence c81_exponential_covariance c89_duplicated c114_winsorize c120_resample_filled c122_interpolate c128_rolling_apply""".split()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        problem, n = oracle.compare(df, duck, SQL[name])
        assert problem is None
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", ORDERED)
def test_query_cut_into_runs(spark, duck, name, monkeypatch):
    monkeypatch.setattr(runs, "ROWS_PER_RUN", 12)
    problem, _ = oracle.compare(QUERIES[name](spark, SF), duck, SQL[name])
    assert problem is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) > 150
