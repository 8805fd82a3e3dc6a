"""Operators on literals: known values, nulls, invariants."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewell.functions import scalars
from tidewell.functions import windows as W
from tidewell.operators import asof, checks, evaluate, rules, statistics
from tidewell.operators import indicators as ind
from tidewell.sources import ingest
from tidewell.streaming import jobs


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_sma_and_guard(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(1, 6)], "symbol string, ts int, close double")
    got = [r.s for r in df.withColumn("s", W.sma(F.col("close"), ind.DEFAULT, 3)).orderBy("ts").collect()]
    assert got == [None, None, 2.0, 3.0, 4.0]


def test_split_ratio_strings(spark):
    texts = ["4:1", "3:2", "0", "bad", "0:0", "2", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.r for r in df.select("i", scalars.split_ratio(F.col("t")).alias("r")).orderBy("i").collect()]
    assert got == [4.0, 1.5, 1.0, 1.0, 1.0, 2.0, 1.0]


def test_back_adjustment_of_split_and_dividend(spark):
    rows = [("a", 1, 100.0, 10.0, 1.0, 0.0), ("a", 2, 100.0, 10.0, 1.0, 0.0), ("a", 3, 50.0, 20.0, 2.0, 0.0), ("a", 4, 50.0, 20.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "symbol string, ts int, close double, volume double, split double, dividend double")
    assert [r.adj_close for r in ind.adjusted_backward(df).orderBy("ts").collect()] == pytest.approx([50] * 4)
    rows = [("a", i, 100.0, 1.0, 1.0, 2.0 if i == 2 else 0.0) for i in (1, 2, 3)]
    df = spark.createDataFrame(rows, "symbol string, ts int, close double, volume double, split double, dividend double")
    assert ind.adjusted_backward(df).orderBy("ts").first().adj_close == pytest.approx(98)


def test_scalars(spark):
    d = F.lit("2024-03-29").cast("date")
    r = one(spark, nb=scalars.next_business_day(d), utc=scalars.local_to_utc(d), cal=F.struct(*[c.alias(n) for n, c in scalars.calendar(d).items()]), tick=scalars.tickers(F.lit("Buy $AAPL and MSFT, A CEO of ibm TSLA MSFT")), code=scalars.coded(F.lit("P")), odd=scalars.coded(F.lit("Q")), nano=scalars.nano_timestamp(F.lit("2024-01-01T00:00:00.123456789Z")), s=scalars.sliced_impact_cost(F.lit(100.0), F.lit(10.0), F.lit(1e4), F.lit(0.02), 1), q=scalars.quality_score(F.lit(3.0), F.lit(1.0), F.lit(True), F.lit(True)))
    assert r.nb == date(2024, 4, 1) and r.utc == datetime(2024, 3, 29, 20)
    assert (r.cal.dow, r.cal.month_end, r.cal.quarter_end, r.cal.year_start) == (4, False, False, False)
    assert r.tick == ["AAPL", "MSFT", "TSLA"] and (r.code, r.odd) == ("purchase", "Q")
    assert r.nano.microsecond == 123456 and r.q == 70
    assert r.s == pytest.approx(100 * 10 * 0.02 * 0.1 * 0.1)


def test_book(spark):
    df = spark.sql("SELECT array(array(0.4D, 10D), array(0.3D, 5D), array(0.2D)) AS b, array(array(0.5D, 5D)) AS a, CAST(NULL AS array<array<double>>) AS n")
    r = df.select(*[c.alias(n) for n, c in scalars.book_summary(F.col("b"), F.col("a")).items()]).first()
    assert (r.best_bid, r.best_ask, r.bid_depth) == (0.4, 0.5, 15) and r.spread == pytest.approx(0.1) and r.imbalance_3 == pytest.approx(0.5)
    assert df.select(scalars.book_summary(F.col("b"), F.col("n"))["spread"].alias("s")).first().s is None


def test_hit_rate_and_probabilities(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.7), (0, 0.1)], "y int, p double")
    r = evaluate.classification(df).first()
    assert r.brier == pytest.approx(0.0375) and r.hit_rate == 1.0


def test_asof_never_looks_ahead_and_ignores_later_facts(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    facts = spark.createDataFrame([("c", t(1), t(1), 0.5), ("c", t(2), t(2), 0.6), ("c", t(3), t(9), 0.9), (None, t(1), t(1), 1.0)], "k string, ts timestamp_ntz, available_time timestamp_ntz, price double")
    cells = spark.createDataFrame([("c", t(0)), ("c", t(2)), ("c", t(5)), ("d", t(5))], "k string, asof_ts timestamp_ntz")
    read = lambda f: {(r.k, r.asof_ts.hour): r.price for r in asof.latest(cells, f, "k", ["ts"], ["price"]).collect()}
    want = {("c", 0): None, ("c", 2): 0.6, ("c", 5): 0.6, ("d", 5): None}
    assert read(facts) == want
    late = facts.unionByName(spark.createDataFrame([("c", t(1), t(8), 9.9)], facts.schema))
    assert read(late) == want


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "k int, v string")
    once = asof.upsert(old, new, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, asof.upsert(once, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_flags_and_gate(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.5, 1.5, 1), (-1.0, 2.0, 0.5, 1.5, 1), (1.0, 0.4, 0.5, 1.5, 1), (1.0, 2.0, 0.5, 1.5, -1), (1.0, 2.0, 0.5, 1.5, 0), (1.0, 2.0, 0.5, None, 1)], "open double, high double, low double, close double, volume int")
    got = [r.f for r in df.select(checks.ohlcv_flag(*map(F.col, df.columns)).alias("f")).collect()]
    assert got == ["ok", "negative_price", "ohlc_error", "negative_volume", "zero_volume", "invalid_price"]
    good, bad = checks.split_valid(df.withColumn("ticker", F.lit("x")), checks.price_rules())
    assert good.count() == 2 and bad.count() == 4
    alerts = spark.sql("SELECT 'a' check_name, 't' table_name, 'critical' severity, 'm' message")
    checks.gate(alerts.where("false"))
    with pytest.raises(ValueError):
        checks.gate(alerts)


def test_edge_positions_close_and_reopen(spark):
    df = spark.createDataFrame([("a", i, 0.4, 0.6 if i in (0, 4, 5) else 0.4) for i in range(10)], "c string, d int, price double, model double")
    got = [r.position for r in evaluate.edge_positions(df, "c", "d", "price", "model", hold=3).orderBy("d").collect()]
    assert got == [100, 100, 100, 0, 100, 100, 100, 0, 0, 0]


def test_load_with_corrupt_files(spark, tmp_path):
    rows = spark.createDataFrame([("AAA", date(2024, 1, 2), 1.0), (None, date(2024, 1, 2), 2.0), ("AAA", date(2024, 1, 2), 3.0)], "ticker string, date date, close double")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in/prices")
    (tmp_path / "in" / "broken.parquet").write_bytes(b"PAR1 nothing")
    good, bad = ingest.load(spark, "prices", f"file://{tmp_path}/in", now="2024-01-03 00:00:00")
    assert [(r.ticker, r.close) for r in good.collect()] == [("AAA", 3.0)]
    assert [r.error_message for r in bad.collect()] == ["Missing required fields: ticker"]
    read = ingest.read_files(spark, f"file://{tmp_path}/in", ingest.SOURCES["prices"].schema)
    assert [r.file.split("/")[-1] for r in ingest.unreadable_files(spark, f"file://{tmp_path}/in", read).collect()] == ["broken.parquet"]


def test_flatteners(spark):
    frame = lambda **c: spark.createDataFrame([tuple(c.values())], list(c))
    r = ingest.observations_from_json(frame(series_code="GDP", payload='{"observations":[{"date":"2024-01-01","value":"100.5","realtime_start":"2024-02-01","realtime_end":"9999-12-31"},{"date":"2024-02-01","value":"."}]}')).collect()
    assert [x.value for x in r] == [100.5, None]
    chain = '[{"expirationDate":1704067200,"calls":[{"strike":10.0,"openInterest":5,"impliedVolatility":0.2}],"puts":[{"strike":9.0,"volume":3}]}]'
    r = ingest.options_from_json(frame(ticker="X", quote_date="2023-12-01", payload=chain)).collect()
    assert [(x.option_type, x.strike, x.volume, x.open_interest) for x in r] == [("call", 10.0, 0, 5), ("put", 9.0, 3, 0)] and r[0].expiration == date(2024, 1, 1)
    facts = '{"Revenue":{"units":{"USD":[{"end":"2023-12-31","val":5.0,"accn":"a","form":"10-K/A","filed":"2024-02-01"},{"end":"2023-12-31","val":1.0,"form":"8-K","filed":"2024-02-01"}]}}}'
    r = ingest.fundamentals_from_json(frame(ticker="X", payload=facts)).collect()
    assert [(x.metric_name, x.metric_value, x.is_amendment) for x in r] == [("Revenue", 5.0, True)]
    xml = "<o><nonDerivativeTable><nonDerivativeTransaction><transactionDate><value>2024-01-02</value></transactionDate><transactionCoding><transactionCode>S</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>10</value></transactionShares><transactionPricePerShare><value>1.5</value></transactionPricePerShare></transactionAmounts></nonDerivativeTransaction></nonDerivativeTable></o>"
    r = ingest.insider_from_xml(frame(ticker="X", payload=xml)).collect()
    assert [(x.transaction_type, x.shares, x.price) for x in r] == [("sale", 10.0, 1.5)]
    xml = "<n:i xmlns:n='u'><n:infoTable><n:nameOfIssuer>A</n:nameOfIssuer><n:cusip>1</n:cusip><n:value>7</n:value><n:shrsOrPrnAmt><n:sshPrnamt>3</n:sshPrnamt></n:shrsOrPrnAmt></n:infoTable></n:i>"
    assert [(x.market_value, x.shares) for x in ingest.holdings_from_xml(frame(filer="F", payload=xml)).collect()] == [(7000, 3)]
    bars = '{"timestamp":[1704067200,1704153600],"open":[1.0,null],"high":[2.0,2.0],"low":[0.5,0.5],"close":[1.5,1.5],"volume":[10,20]}'
    assert [(x.close, x.adj_close) for x in ingest.bars_from_arrays(frame(ticker="X", payload=bars)).collect()] == [(1.5, 1.5)]


def test_text_readers(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Some title\n,Mkt-RF,SMB\n20240102, 1.0, -0.5\n20240103,2.0,\nAnnual\n2024,1,1\n")
    assert [tuple(r) for r in ingest.factors_from_text(spark, f"{tmp_path}/f.csv", ["mkt_rf", "smb"]).collect()] == [(date(2024, 1, 2), 0.01, -0.005)]
    (tmp_path / "c.csv").write_text(" Code , Date ,Long\n067651 ,2024-01-02,5\n067651,2024-01-09,x\n999,2024-01-02,1\n")
    got = ingest.positions_from_csv(spark, f"{tmp_path}/c.csv", {"Code": "commodity_code", "Date": "report_date", "Long": "long_positions"}, ["067651"], "2024-01-01", "2024-12-31")
    assert sorted(r.long_positions or 0 for r in got.collect()) == [0, 5]
    (tmp_path / "e.tsv").write_text("1\t20240102\t20240102\tx\t1.5\tbad\t2\n")
    r = ingest.events_from_tsv(spark, f"{tmp_path}/e.tsv", ["event_id", "sql_date", "date_added", "event_type", "tone", "lat", "lon"]).first()
    assert r.event_date == date(2024, 1, 2) and r.lat is None and r.date_added == datetime(2024, 1, 2)


def test_streams_match_batch(spark, tmp_path):
    t = lambda m: datetime(2024, 1, 1, m // 60, m % 60)
    fills = [("a", t(1), 10.0, 5.0), ("a", t(2), 10.0, 7.0), ("a", t(3), -15.0, 8.0), ("a", t(4), -10.0, 9.0), ("b", t(1), -1.0, 2.0)]
    schema = "symbol string, ts timestamp, quantity double, price double"
    for i, part in enumerate((fills[:2], fills[2:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/fills/{i}")
    batch = jobs.inventory(spark.createDataFrame(fills, schema))
    assert {tuple(r) for r in batch.collect()} == {("a", -5.0, 9.0, 10 * 0 + 15 * 2.0 + 5 * 3.0), ("b", -1.0, 2.0, 0.0)}
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/fills")
    jobs.run_available(jobs.inventory_stream(stream), f"{tmp_path}/cp1", "inv", "update")
    last = {r.symbol: tuple(r) for r in spark.table("inv").collect()}
    assert set(last.values()) == {tuple(r) for r in batch.collect()}
    keyed = stream.select("symbol", "ts", "price")
    jobs.run_available(keyed, f"{tmp_path}/cp2", each=jobs.upsert_into(f"{tmp_path}/table", ["symbol"]))
    assert jobs.upserted(spark, f"{tmp_path}/table").count() == 2


def test_stream_windows_and_dedup(spark, tmp_path):
    t = lambda m: datetime(2024, 1, 1, m // 60, m % 60)
    rows = [(1, 1, t(5), 1.0, 2.0), (1, 1, t(5), 1.0, 2.0), (1, 2, t(50), 3.0, 1.0), (1, 3, t(70), 2.0, 1.0), (1, 4, t(600), 9.0, 1.0)]
    schema = "contract_id int, trade_id int, ts timestamp, price double, size double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/t")
    stream = jobs.parquet_stream(spark, f"{tmp_path}/t", schema)
    jobs.run_available(jobs.first_by_id(stream), f"{tmp_path}/a", "dedup")
    assert spark.table("dedup").count() == 4
    jobs.run_available(jobs.liquidity(stream), f"{tmp_path}/b", "liq")
    assert {(r.start.hour, r.n, r.volume) for r in spark.table("liq").collect()} == {(0, 3, 5.0), (1, 1, 1.0)}
    jobs.run_available(jobs.bursts(stream), f"{tmp_path}/c", "burst")
    assert [r.n for r in spark.table("burst").collect()] == [4]
    ticks = spark.createDataFrame([("x", t(1), "quote", None, 1.0, 3.0), ("x", t(2), "trade", 5.0, None, None), ("x", t(3), "quote", None, 2.0, 4.0)], "symbol string, ts timestamp, kind string, price double, bid double, ask double")
    ticks.coalesce(1).write.parquet(f"{tmp_path}/q")
    jobs.run_available(jobs.latest_quotes(jobs.parquet_stream(spark, f"{tmp_path}/q", ticks.schema)), f"{tmp_path}/d", "quotes", "update")
    r = spark.table("quotes").first()
    assert (r.price, r.bid, r.ask, r.high, r.low) == (5.0, 2.0, 4.0, 5.0, 5.0)


def test_time_exit_on_a_late_bar(spark):
    bar = lambda s, m, d, low=9.0: (s, date(2024, m, d), 10.0, low, 10.0, 5.0)
    rows = [bar("a", 1, 2), bar("a", 2, 20), bar("a", 2, 21, 1.0), bar("b", 1, 2), bar("b", 1, 21), bar("b", 1, 22, 1.0), bar("c", 1, 2), bar("d", 3, 1, 1.0)]
    bars = spark.createDataFrame(rows, "symbol string, ts date, high double, low double, close double, atr double")
    p = spark.createDataFrame([(s, s, date(2024, 1, 1), 10.0, 5.0, 15.0) for s in "abcd"], "id string, symbol string, entry_date date, entry double, stop double, target double")
    got = {r.id: (r.exit_date, r.reason) for r in rules.exits(p, bars, atr_multiple=1.0).collect()}
    assert got == {"a": (date(2024, 2, 20), "time"), "b": (date(2024, 1, 21), "time"), "c": (None, None), "d": (date(2024, 3, 1), "stop")}


def test_kruskal_p_of_many_groups(spark):
    limits = [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (9.487729, 4, 0.05), (11.070498, 5, 0.05), (124.342113, 100, 0.05), (1999.3333, 2000, 0.5), (0.0, 4, 1.0), (None, 4, None), (1.0, 0, None)]
    got = spark.createDataFrame(limits, "x double, df int, want double").withColumn("p", statistics.chi2_tail(F.col("x"), F.col("df"))).collect()
    assert all(r.p == pytest.approx(r.want, abs=1e-5) for r in got)
    rows = spark.createDataFrame([(f"g{i % 5}", float(i)) for i in range(25)], "g string, x double")
    r = statistics.kruskal(rows, "g", "x").first()
    # rank sums 55, 60, 65, 70, 75
    h = 12 / (25 * 26) * sum(s * s / 5 for s in (55, 60, 65, 70, 75)) - 3 * 26
    assert r.groups == 5 and r.h == pytest.approx(h) and r.p == pytest.approx(2.718281828 ** (-h / 2) * (1 + h / 2), abs=1e-6)
