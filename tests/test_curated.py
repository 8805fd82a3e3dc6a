"""Rules of curated tables on literals."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tidewell.operators import curated
from tidewell.sources import ingest


def raw(spark, source, *rows):
    return spark.createDataFrame(list(rows), ingest.SOURCES[source].schema)


def known(df):
    return [r.available_time for r in df.collect()]


def test_available_times(spark):
    d = date(2024, 1, 5)  # a Friday in winter
    day = datetime(2024, 1, 5)
    assert known(curated.prices(raw(spark, "prices", ("A", d, 1.0, 2.0, 0.5, 1.0, 1.0, 5, None, 0.0)))) == [datetime(2024, 1, 5, 21, 15)]
    assert known(curated.factors(raw(spark, "factors", (d, *[0.1] * 7)))) == [datetime(2024, 1, 8, 14, 30)]
    m = raw(spark, "macro", ("GDP", d, 1.0, d, d)).withColumn("extracted_at", F.lit("2024-02-01").cast("timestamp"))
    assert known(curated.macro(m)) == [datetime(2024, 1, 5, 18)]
    assert known(curated.short_interest(raw(spark, "short_interest", ("A", d, 5, 10)))) == [datetime(2024, 1, 19)]
    assert known(curated.etf_flows(raw(spark, "etf_flows", ("A", d, 1.0, 10.0)))) == [datetime(2024, 1, 6)]
    assert known(curated.positions(raw(spark, "cot", ("X", d, 5, 3, 10)))) == [datetime(2024, 1, 8, 19, 30)]
    rows = [("A", d, 1.0, 2.0, t) for t in ("bmo", "amc", None)]
    assert sorted(known(curated.earnings(raw(spark, "earnings", *rows)))) == [datetime(2024, 1, 5, 14, 30), datetime(2024, 1, 5, 21), datetime(2024, 1, 5, 21, 15)]
    t = raw(spark, "contract_trades", ("m", "1", day, 0.5, 10.0, "BUY"), ("m", "2", day, -1.0, 10.0, "x"))
    got = curated.contract_trades(t).orderBy("trade_id").collect()
    assert [r.data_quality_flag for r in got] == ["ok", "invalid_price"] and got[0].available_time == datetime(2024, 1, 5, 0, 2) and got[0].side == "buy"


def test_values(spark):
    d = [date(2024, 1, i) for i in (2, 3, 4)]
    bars = raw(spark, "prices", ("A", d[0], 100.0, 101.0, 99.0, 100.0, 100.0, 10, None, 0.0), ("A", d[1], 50.0, 51.0, 49.0, 50.0, 50.0, 20, "2:1", 0.0), ("A", d[2], 50.0, 51.0, 49.0, 49.0, 49.0, 20, None, 1.0))
    actions = curated.corporate_actions(bars)
    assert sorted((r.kind, r.amount) for r in actions.collect()) == [("dividend", 1.0), ("split", 2.0)]
    adjusted = [round(r.adj_close, 6) for r in curated.adjusted(curated.prices(bars), actions).orderBy("date").collect()]
    assert adjusted == [100.0, 100.0, 100.0]
    p = raw(spark, "contract_prices", ("m", datetime(2024, 1, 1), "Yes", 65.0), ("m", datetime(2024, 1, 1), "No", None))
    assert sorted((r.price_normalized or 0, r.data_quality_flag) for r in curated.contract_prices(p).collect()) == [(0, "missing_price"), (0.65, "ok")]
    c = raw(spark, "contracts", ("v", "1", "t", ["Yes", "No"], "open", datetime(2024, 1, 1)), ("v", "2", "t", ["A", "B"], "open", datetime(2024, 1, 1)))
    got = curated.contracts(c, F.current_timestamp())
    assert [r.outcome_type for r in got.orderBy("venue_market_id").collect()] == ["binary", "multi"]
    spread = curated.contract_days(got.withColumn("resolved", F.lit("2024-01-03").cast("timestamp")), F.current_timestamp())
    assert spread.count() == 6
    h = raw(spark, "holdings", ("f", d[0], "c1", 5, 75.0, d[2]), ("f", d[0], "c2", 5, 25.0, d[2]))
    assert [r.portfolio_weight for r in curated.holdings(h, spark.createDataFrame([("c1", "A")], "cusip string, ticker string")).collect()] == [0.75]
    f = raw(spark, "fundamentals", ("A", "eps", d[0], "10-Q", "1", 1.0, d[1], False, 1), ("A", "eps", d[0], "10-Q/A", "2", 2.0, d[2], True, 2))
    assert [r.metric_value for r in curated.fundamentals(f).collect()] == [2.0]
