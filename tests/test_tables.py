"""Upserts, constraints, ledger, pipeline and streams."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.operators import ledger as L
from tickloom.operators import reports as R
from tickloom.plans import pipeline
from tickloom.plans.pipeline import batch_store, run_pipeline, synthetic_candles
from tickloom.sources import schemas
from tickloom.sources import tables as S
from tickloom.sources.schemas import TICKERS
from tickloom.sources.store import Store
from tickloom.streaming.candles import read_upserted, stream_candles, upsert_stream

T0 = datetime(2023, 3, 20)


def kv(spark, rows):
    return spark.createDataFrame(rows, "k int, a int, b string")


def test_upsert_policies(spark):
    old, new = kv(spark, [(1, 1, "x"), (2, 2, "y")]), kv(spark, [(2, 9, None), (3, 3, "z")])
    out = lambda df: sorted(map(tuple, df.collect()))
    assert out(S.upsert(old, new, ["k"])) == [(1, 1, "x"), (2, 9, None), (3, 3, "z")]
    assert out(S.upsert(old, new, ["k"], "ignore")) == [(1, 1, "x"), (2, 2, "y"), (3, 3, "z")]
    assert out(S.upsert(old, new, ["k"], update_cols=["a"])) == [(1, 1, "x"), (2, 9, "y"), (3, 3, "z")]
    assert out(S.upsert(S.upsert(old, new, ["k"]), new, ["k"])) == out(S.upsert(old, new, ["k"]))
    assert out(S.upsert(old, new.limit(0), ["k"])) == out(old)
    with pytest.raises(ValueError):
        S.upsert(old, new, ["k"], "merge")


def test_last_of_equal_keys(spark):
    df = kv(spark, [(1, 1, "x"), (1, 3, None), (1, 2, "z"), (2, 5, "w")])
    assert sorted(map(str, map(tuple, S.dedupe_last(df, ["k"], ["a"]).collect()))) == ["(1, 3, None)", "(2, 5, 'w')"]


def test_constraints(spark):
    schema = "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume double"
    good = ("s", T0, 1.0, 2.0, 0.5, 1.5, 1.0)
    bad = [
        (None, T0, 1.0, 2.0, 0.5, 1.5, 1.0), ("s", T0, 1.0, 0.4, 0.5, 1.5, 1.0), ("s", T0, 1.0, 1.2, 0.5, 1.5, 1.0), ("s", T0, 1.0, 2.0, 1.2, 1.5, 1.0), ("s", T0, 1.0, 2.0, 0.5, 1.5, -1.0),
        ("s", T0, 1e14, 2e14, 0.5, 1.5, 1.0), ("s", T0, float("nan"), 2.0, 0.5, 1.5, 1.0),
    ]
    valid, rejected = S.enforce(spark.createDataFrame([good, *bad, good], schema), schemas.SPECS["minute"])
    assert [r.open for r in valid.collect()] == [Decimal("1.0000")]
    assert valid.schema.simpleString() == schemas.MINUTE.simpleString()
    assert sorted(r.reason for r in rejected.collect()) == sorted(
        ["symbol is null", "high below low", "high below open or close", "low above open or close", "negative volume", "open is null", "open is null", "duplicate key"]
    )


def test_decimals_round_half_up(spark):
    df = spark.createDataFrame([(0.12345,), (1.00005,)], "open double")
    assert [r.open for r in S.conform(df, schemas.MINUTE).select("open").collect()] == [Decimal("0.1235"), Decimal("1.0001")]


def sparse(spark, symbols=("a", "b"), n=30, step=7):
    rows = [(s, T0 + timedelta(minutes=step * i), 0.5 + i / 100, 100.0 + i, 0.3, 100.0, "c", 0.01, 5.0, 100.0 + i, 3.0, 9.0, str(i)) for s in symbols for i in range(n)]
    return spark.createDataFrame([*rows, ("few", T0, 1.0, 1.0, 1.0, 1.0, "p", 0.0, 1.0, 1.0, 1.0, 1.0, "x")], "symbol string, date timestamp_ntz, iv double, underlying_price double, time_to_maturity double, strike double, callput string, interest_rate double, mark_price double, index_price double, volume double, quote_volume double, record_time string")


def test_pipeline_and_tables(spark, tmp_path):
    root = f"file://{tmp_path}/root"
    out = run_pipeline(spark, sparse(spark), root, 3)
    assert {r.symbol: (r.status, r.input_rows, r.output_rows) for r in out["interpolation"].collect()} == {"a": ("success", 30, 204), "b": ("success", 30, 204), "few": ("skipped", 1, 0)}
    assert {r.symbol: r.output_rows for r in out["bridge"].collect()} == {"a": 204, "b": 204}
    assert {r.symbol: (r.status, r.output_rows) for r in out["candles"].collect()} == {"a": ("success", 40), "b": ("success", 40)}
    dense = S.read_interpolated(spark, f"{root}/dense", 3)
    assert dense.count() == 408 and S.read_interpolated(spark, f"{root}/dense", 4).isEmpty()
    # one batch's files only, and of one symbol the files of one bucket
    assert all("/dense/batch_id=3/" in f for f in dense.inputFiles())
    store = batch_store(spark, root, "dense", 3)
    of_a = store.read_group("a")
    assert of_a.count() == 204 and {f.split("__bucket=")[1].split("/")[0] for f in of_a.inputFiles()} < {f.split("__bucket=")[1].split("/")[0] for f in store.read().inputFiles()} | {"-"}
    # a second batch of one symbol: its rows are the newer ones
    run_pipeline(spark, sparse(spark, ("a",)), root, 4)
    newest = S.latest_rows(S.read_interpolated(spark, f"{root}/dense"))
    assert {(r.symbol, r.batch_id) for r in newest.select("symbol", "batch_id").distinct().collect()} == {("a", 4), ("b", 3)}


TABLES = ("dense", "minute", "candles")


def all_rows(spark, root, batch):
    return {t: sorted(map(str, batch_store(spark, root, t, batch).read().collect())) for t in TABLES}


def test_a_run_that_was_stopped_goes_on(spark, tmp_path, monkeypatch):
    rows = sparse(spark, ("a", "b", "c"))
    run_pipeline(spark, rows, f"file://{tmp_path}/whole", 3)
    want = all_rows(spark, f"file://{tmp_path}/whole", 3)

    class Stopped(Exception):
        pass

    def stopping(f, when):
        def run(*args, **kw):
            if when == "before":
                raise Stopped
            f(*args, **kw)
            raise Stopped

        return run

    # each run ends at another place: before or after a stage's rows, or a ledger's closing
    root = f"file://{tmp_path}/root"
    for name, when in [("append_interpolated", "after"), ("closing_rows", "after"), ("bridge", "before"), ("_put", "after"), ("candle_outcomes", "after")]:
        with monkeypatch.context() as m:
            m.setattr(pipeline, name, stopping(getattr(pipeline, name), when))
            with pytest.raises(Stopped):
                run_pipeline(spark, rows, root, 3)
    for _ in range(2):
        out = run_pipeline(spark, rows, root, 3)
        assert all_rows(spark, root, 3) == want
    assert {(r.symbol, r.status, r.output_rows) for r in out["interpolation"].collect()} == {("a", "success", 204), ("b", "success", 204), ("c", "success", 204), ("few", "skipped", 0)}
    # a complete batch is not computed again
    with monkeypatch.context() as m:
        for name in ("densify", "bridge", "resample_candles"):
            m.setattr(pipeline, name, stopping(getattr(pipeline, name), "before"))
        assert set(run_pipeline(spark, rows, root, 3)) == {"interpolation", "bridge", "candles"}
    # nothing that a stopped run wrote is left
    for t in TABLES:
        s = batch_store(spark, root, t, 3)
        live = {c for v in s.versions() for commits in s._load(v)["buckets"].values() for c in commits}
        assert {p.name for p in (tmp_path / "root" / t / "batch_id=3" / "data").iterdir()} <= live


def test_symbols_that_failed_or_are_new_run_again(spark, tmp_path, monkeypatch):
    root, gate = f"file://{tmp_path}/root", pipeline.quality_gate
    with monkeypatch.context() as m:
        m.setattr(pipeline, "quality_gate", lambda c: gate(c).withColumns({"valid": F.col("symbol") != "b", "reason": F.when(F.col("symbol") == "b", "bad day")}))
        out = run_pipeline(spark, sparse(spark), root, 3)
    assert {r.symbol: (r.status, r.reason) for r in out["bridge"].collect()} == {"a": ("success", None), "b": ("error", "bad day")}
    assert {r.symbol for r in out["candles"].collect()} == {"a"}
    out = run_pipeline(spark, sparse(spark, ("a", "b", "c")), root, 3)
    assert {r.symbol: r.status for r in out["candles"].collect()} == {"a": "success", "b": "success", "c": "success"}
    run_pipeline(spark, sparse(spark, ("a", "b", "c")), f"file://{tmp_path}/whole", 3)
    assert all_rows(spark, root, 3) == all_rows(spark, f"file://{tmp_path}/whole", 3)


def test_a_bucket_is_one_file_of_a_stage(spark, tmp_path):
    """However many tasks a shuffle has: with a file for each task and symbol they grow as the product of both."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_pipeline(spark, sparse(spark, tuple("abcdefgh")), root := f"file://{tmp_path}/root", 3)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for t in TABLES:
        store = batch_store(spark, root, t, 3)
        files = [f.split("__bucket=")[1].split("/")[0] for f in store.read().inputFiles()]
        assert len(files) == len(set(files)) <= store.buckets, t


def test_a_run_computes_its_tickers_once(spark, tmp_path):
    """A view that counts its rows: stages and outcomes read what was kept."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = sparse(spark).coalesce(1)
    n = rows.count()
    out = run_pipeline(spark, rows.mapInArrow(count, rows.schema), f"file://{tmp_path}/root", 3)
    assert {r.symbol: r.output_rows for r in out["bridge"].collect()} == {"a": 204, "b": 204}
    assert seen.value == n


def test_constraints_of_dealt_rows(spark):
    """The same rows are taken and rejected, without a join."""
    schema = "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume double"
    nan = float("nan")
    some = [(s, T0 + timedelta(minutes=i % 3), 1.0, 2.0, 0.5, 1.0 + i / 10, v) for s in ("a", "b") for i, v in enumerate((1.0, -1.0, nan, 2.0, 1.0, -2.0, 3.0))]
    rows = spark.createDataFrame([*some, (None, T0, 1.0, 2.0, 0.5, 1.0, 1.0), some[0]], schema)
    spec, told = schemas.SPECS["minute"], lambda df: sorted(map(str, df.collect()))
    plain, dealt = S.enforce(rows, spec), S.enforce(rows.repartition("symbol"), spec, dealt=True)
    plan = dealt[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert [told(df) for df in dealt] == [told(df) for df in plain] and all(told(df) for df in dealt)


def test_pipeline_stops_without_a_success(spark, tmp_path):
    out = run_pipeline(spark, sparse(spark, ()), f"file://{tmp_path}/none", 1)
    assert list(out) == ["interpolation"]


def test_ledger_life(spark):
    symbols = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "symbol string")
    empty = spark.createDataFrame([], schemas.LEDGER)
    opened = L.open_batch(empty, symbols, 1)
    assert {r.symbol: r.status for r in opened.collect()} == {"a": "pending", "b": "pending", "c": "pending"}
    outcomes = spark.createDataFrame([("a", "success", None, 10, 100), ("b", "error", "failed", 10, 0)], "symbol string, status string, reason string, input_rows long, output_rows long")
    closed = L.close_batch(opened, outcomes, 1)
    assert {r.symbol: (r.status, r.error_message) for r in closed.collect()} == {"a": ("completed", None), "b": ("error", "failed"), "c": ("pending", None)}
    assert {r.symbol for r in L.resume_symbols(closed, 1).collect()} == {"b", "c"}
    assert {r.symbol for r in L.failed_symbols(closed, 1).collect()} == {"b"}
    assert L.latest_batch(closed).first().batch_id == 1
    total = {r.status: (r.n_symbols, r.output_rows, r.percent) for r in L.progress_summary(closed, 1).collect()}
    assert total["total"] == (3, 100, 100.0) and total["completed"] == (1, 100, 33.33)
    again = L.open_batch(closed, symbols, 2)
    assert {(r.status, r.error_message, r.batch_id) for r in again.collect()} == {("pending", None, 2)}


def test_outcomes_of_candles(spark):
    minute = spark.createDataFrame([("few", T0), *[("gap", T0 + timedelta(minutes=3 * i)) for i in range(6)]], "symbol string, timestamp timestamp_ntz")
    none = minute.limit(0)
    got = {r.symbol: (r.status, r.reason) for r in L.candle_outcomes(minute, none, 5).collect()}
    assert got == {"few": ("skipped", "too few rows"), "gap": ("error", "no complete group")}
    assert L.stage_totals(L.candle_outcomes(minute, none, 5)).first().n_error == 1


def test_throughput_of_the_first_snapshot_is_unknown(spark):
    rows = [(1, T0, 1, 9, 1000), (1, T0 + timedelta(seconds=10), 3, 7, 1500), (1, T0 + timedelta(seconds=10), 3, 7, 1500)]
    got = L.throughput(spark.createDataFrame(rows, "batch_id int, taken_at timestamp_ntz, done_symbols long, pending_symbols long, output_rows long")).orderBy("taken_at", "rows_per_second").collect()
    assert got[0].rows_per_second is None and got[0].alert is None
    assert got[-1].rows_per_second == 50.0 and got[-1].alert == "low throughput" and got[-1].symbols_per_minute == 12.0


@pytest.mark.parametrize(("n", "size"), [(999, "small"), (1000, "medium"), (10_000, "large"), (50_000, "xlarge")])
def test_size_classes(spark, n, size):
    assert spark.range(1).select(R.size_class(F.lit(n))).first()[0] == size


def test_reports_of_empty_tables(spark):
    empty = sparse(spark).limit(0)
    assert R.volume_summary(empty).first().rows_per_symbol is None
    assert R.pipeline_status({"t": empty}).first().n_rows == 0
    assert R.symbol_profile(empty).isEmpty() and R.symbol_breakdown(empty).isEmpty()


def test_tables_are_made_once(spark, tmp_path):
    root = f"file://{tmp_path}/tables"
    assert {r.created for r in S.init_tables(spark, root).collect()} == {True}
    assert {r.created for r in S.init_tables(spark, root).collect()} == {False}
    assert {r.created for r in S.init_tables(spark, root, reset=True).collect()} == {True}


def test_synthetic_walk(spark):
    df = synthetic_candles(spark, ["x", "y"], hours=2)
    assert df.count() == 240
    assert df.where("high < low or high < open or low > close or volume < 0").isEmpty()
    rows = df.where("symbol = 'x'").orderBy("timestamp").collect()
    assert all(a.close == b.open for a, b in zip(rows, rows[1:]))


def test_walk_in_blocks_is_the_walk_in_one(spark):
    names = spark.createDataFrame([("x",), ("y",), ("x",)], "symbol string")
    walk = lambda block: sorted(map(str, synthetic_candles(spark, names, hours=5, block=block).collect()))
    whole = walk(10_000)
    assert len(whole) == 600 and walk(7) == whole and walk(300) == whole


def test_stream_of_candles_drops_late_rows(spark, tmp_path):
    schema = "symbol string, timestamp timestamp, open double, high double, low double, close double, volume double"
    row = lambda m: ("s", T0 + timedelta(minutes=m), 1.0 + m, 2.0 + m, 0.5 + m, 1.0 + m, 1.0)
    source = f"{tmp_path}/in"
    for i, ms in enumerate([range(4), [4, 30], [2], [60]]):
        spark.createDataFrame([row(m) for m in ms], schema).coalesce(1).write.parquet(f"{source}/{i}")
        q = (
            stream_candles(spark.readStream.schema(schema).parquet(f"{source}/*"))
            .writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        )
        q.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.open, r.close, r.volume) for r in got] == [(1.0, 5.0, 5.0)]


def test_stream_upsert(spark, tmp_path):
    source = f"{tmp_path}/in"
    versions = []
    for i, rows in enumerate([[(1, 1, "x"), (1, 2, "y")], [(1, 3, "z"), (2, 1, "w")]]):
        kv(spark, rows).coalesce(1).write.parquet(f"{source}/{i}")
        q = upsert_stream(spark.readStream.schema("k int, a int, b string").parquet(f"{source}/*"), f"file://{tmp_path}/root", ["k"], ["a"])
        q.awaitTermination()
        versions.append(sorted(map(tuple, read_upserted(spark, f"file://{tmp_path}/root").collect())))
    assert versions == [[(1, 2, "y")], [(1, 3, "z"), (2, 1, "w")]]


def test_stream_upsert_writes_touched_buckets_only(spark, tmp_path):
    source, root = f"{tmp_path}/in", tmp_path / "root"
    for i, rows in enumerate([[(k, 1, "a") for k in range(40)], [(1, 2, "b")], [(1, 3, "c")], [(1, 4, "d"), (90, 1, "e")]]):
        kv(spark, rows).coalesce(1).write.parquet(f"{source}/{i}")
        upsert_stream(spark.readStream.schema("k int, a int, b string").parquet(f"{source}/*"), f"file://{root}", ["k"], ["a"], buckets=8).awaitTermination()
    got = {r.k: (r.a, r.b) for r in read_upserted(spark, f"file://{root}").collect()}
    assert got == {k: (4, "d") if k == 1 else (1, "a") for k in range(40)} | {90: (1, "e")}
    store = Store(spark, f"file://{root}")
    before, last = (store._load(v)["buckets"] for v in store.versions()[-2:])
    assert len(last) == 8 and sum(before.get(b) != c for b, c in last.items()) <= 2
    # nothing is left but the table of two commits
    names = {c for m in (before, last) for commits in m.values() for c in commits}
    assert {p.name for p in (root / "data").iterdir()} == names


def store(spark, tmp_path, name="t", **kw):
    return Store(spark, f"file://{tmp_path}/{name}", kv(spark, []).schema, ("k",), buckets=4, **kw)


def content(table, version=None):
    return sorted(map(tuple, table.read(version).collect()))


def test_readers_see_whole_commits_only(spark, tmp_path, monkeypatch):
    table = store(spark, tmp_path)
    table.upsert(kv(spark, [(k, 0, "a") for k in range(20)]))
    seen, put = [], Store._put

    def watched(self, manifest):
        seen.append(content(Store(spark, table.root)))  # all files of the commit stand there
        return put(self, manifest)

    monkeypatch.setattr(Store, "_put", watched)
    reader = table.read()
    table.upsert(kv(spark, [(k, 1, "b") for k in range(10, 30)]))
    monkeypatch.undo()
    assert seen == [[(k, 0, "a") for k in range(20)]]
    assert content(table) == [(k, 0, "a") for k in range(10)] + [(k, 1, "b") for k in range(10, 30)]
    assert sorted(map(tuple, reader.collect())) == seen[0]  # a read that began before


def test_a_writer_that_stops_leaves_the_table_and_then_nothing(spark, tmp_path, monkeypatch):
    table = store(spark, tmp_path)
    table.upsert(kv(spark, [(1, 1, "a"), (2, 1, "a")]), writer=("w", 1))

    def stop(self, manifest):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(Store, "_put", stop)
        with pytest.raises(RuntimeError):
            table.upsert(kv(spark, [(1, 2, "b")]), writer=("w", 2))
    assert content(table) == [(1, 1, "a"), (2, 1, "a")]
    assert table.upsert(kv(spark, [(1, 2, "b")]), writer=("w", 2))
    assert not table.upsert(kv(spark, [(1, 9, "z")]), writer=("w", 2))  # taken already
    assert content(table) == [(1, 2, "b"), (2, 1, "a")]
    live = {c for v in table.versions() for commits in table._load(v)["buckets"].values() for c in commits}
    assert {p.name for p in (tmp_path / "t" / "data").iterdir()} == live


def test_of_two_writers_one_begins_again(spark, tmp_path, monkeypatch):
    table, put, other = store(spark, tmp_path), Store._put, []

    def raced(self, manifest):
        if not other:
            other.append(1)
            store(spark, tmp_path).upsert(kv(spark, [(1, 5, "first"), (2, 5, "first")]))
        return put(self, manifest)

    monkeypatch.setattr(Store, "_put", raced)
    table.upsert(kv(spark, [(1, 6, "second")]))
    assert content(table) == [(1, 6, "second"), (2, 5, "first")]


def test_groups_are_replaced_as_a_whole(spark, tmp_path):
    table = store(spark, tmp_path)
    table.replace(kv(spark, [(k, i, "a") for k in range(8) for i in range(3)]))
    table.replace(kv(spark, [(1, 9, "b")]), kv(spark, [(1, 0, ""), (2, 0, ""), (77, 0, "")]))
    want = sorted([(k, i, "a") for k in (0, *range(3, 8)) for i in range(3)] + [(1, 9, "b")])
    assert content(table) == want
    table.replace(kv(spark, [(1, 9, "b")]))
    assert content(table) == want
    for i in range(40):  # parts of a bucket are joined now and then
        table.replace(kv(spark, [(100 + i, i, "c")]))
    assert content(table) == sorted(want + [(100 + i, i, "c") for i in range(40)])
    assert max(len(c) for c in table._newest()["buckets"].values()) <= 17
    assert [tuple(r) for r in table.read_group(105).collect()] == [(105, 5, "c")]
    table.replace(kv(spark, []), kv(spark, [(k, 0, "") for k in range(200)]))
    assert content(table) == []
    with pytest.raises(ValueError):
        Store(spark, f"file://{tmp_path}/none")


def test_tickers_from_a_database(spark, tmp_path):
    """Derby comes with Spark; the scan is split by the range of a column and sends the columns of tickers only."""
    rows = sparse(spark)
    assert rows.count() > 1
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    (n,) = rows.select(F.count("*")).first()
    out = S.conform(rows, TICKERS).withColumns({"number": F.monotonically_increasing_id(), "callput": F.col("callput").cast("string"), "date": F.col("date").cast("timestamp")})
    out.write.jdbc(url, "tickers", properties={"driver": driver, "createTableColumnTypes": "symbol VARCHAR(64), callput VARCHAR(8), record_time VARCHAR(64)"})
    back = S.read_tickers_jdbc(spark, url, "tickers", "number", "0", "10", 2, driver=driver)
    assert back.columns == TICKERS.names and back.count() == n and back.rdd.getNumPartitions() == 2


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace as Fake

    from tickloom.cluster import shared_dir

    def session(master, folder):
        conf = Fake(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" and folder else default)
        return Fake(sparkContext=Fake(master=master, getConf=lambda: conf), conf=Fake(get=lambda key, default=None: default, set=lambda key, value: None))

    assert shared_dir(session("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    assert shared_dir(session("local[4]", None)).startswith("file://")
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(session("spark://host:7077", None))


def test_scratch_tables_go_with_their_block(spark):
    from tickloom.cluster import has_files, saved, scratch

    with scratch(spark) as save:
        inner = save(kv(spark, [(1, 2, "x")]), "inner")
        outer = saved(inner, "outer")
        (file, *_) = inner.inputFiles()
        assert has_files(spark, file)
    assert not has_files(spark, file)
    assert [tuple(r) for r in outer.collect()] == [(1, 2, "x")]
