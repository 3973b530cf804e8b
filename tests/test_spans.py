"""Symbols of any span: no bound on days or on the length of a grid leaves one out."""

from datetime import datetime

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tickloom.operators.densify import dense_symbols, densify, symbol_gates

NONE = {"max_span_days": None, "max_points": None}
#: Queries that leave out no symbol for its span.
QUERIES = ["bridge_basic", "bridge_midpoint", "bridge_simple", "bridge_spread", "candle_breakdown", "densify_duplicates", "densify_offgrid", "hourly_density", "is_interpolated_split", "resample_15min", "resample_5min"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Events of a symbol over an hour, and of one over 75 days: 108,001 minutes."""
    path = str(tmp_path_factory.mktemp("events"))
    minutes = "case when id % 2 = 0 then 9000 * id // 2 + 7 * (id % 3) * (id % 24 // 23) else 5 * (id // 2) end"
    duckdb.sql(f"""copy (select id as event_id, timestamp '2024-01-01' + to_minutes(({minutes})::int) + to_seconds(id % 5 * 7) as ts, id % 9 as user_id,
      case when id % 2 = 0 then 'long' else 'short' end as event_type, (1 + id % 13)::double as value, '{{"k": ' || id || '}}' as props from range(26) t(id)) to '{path}/events.parquet'""")
    return path


def rows(df):
    df = df[sorted(df.columns)]
    for c in df.columns:
        df[c] = [round(v, 7) if isinstance(v, float) and v == v else None if v is None or v is pd.NaT or v != v else pd.Timestamp(v) if isinstance(v, datetime) else v for v in df[c].astype(object)]
    return sorted(map(tuple, df.astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", QUERIES)
def test_long_symbols_are_whole(spark, folder, name):
    """As the SQL, which has the long symbol too."""
    df = entry.queries()[name](spark, folder)
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{folder}/events.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    got, want = (rows(pd.DataFrame(data, columns=columns)) for data, columns in ((map(tuple, df.collect()), df.columns), (want.fetchall(), want.columns)))
    assert {v for r in got for v in r if v in ("long", "short")} == {"long", "short"}
    assert len(got) == len(want) and got == want


def test_a_gap_of_years(spark):
    points = [("s", datetime(1990, 1, 1), 0.0), ("s", datetime(2010, 1, 1), 10_519_200.0)]
    df = spark.createDataFrame(points, "symbol string, date timestamp_ntz, iv double")
    dense = densify(df, min_points=2, **NONE)
    minute = "timestampdiff(minute, timestamp_ntz'1990-01-01', date)"
    found = dense.selectExpr("count(*) n", f"sum({minute}) total", f"sum({minute} % 1009) spread", "sum(cast(is_interpolated as int)) made", f"max(abs(iv - {minute})) off").first()
    n = 10_519_201
    assert (found.n, found.total, found.spread, found.made) == (n, n * (n - 1) // 2, sum(k % 1009 for k in range(n)), n - 2)
    assert found.off < 1e-6


def test_a_span_of_more_minutes_than_an_int_holds(spark):
    df = spark.createDataFrame([("s", datetime(1, 1, 1), 0.0), ("s", datetime(9999, 1, 1), 1.0)], "symbol string, date timestamp_ntz, iv double")
    assert [r.gate for r in symbol_gates(df, 2, **NONE).collect()] == [None]
    assert [r.symbol for r in dense_symbols(df, min_points=2, **NONE).collect()] == ["s"]
    assert [r.gate for r in symbol_gates(df, 2, None).collect()] == ["grid too long"]
