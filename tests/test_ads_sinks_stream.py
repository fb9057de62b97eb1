import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from clickflow.operators import ads
from clickflow.session import scratch_dir
from clickflow.sinks.batch_log import BatchLog
from clickflow.streaming import ad_stream as ast
from clickflow.streaming import replay as rp
from click_util import SF_SMALL, rows


def _ms(s):
    return int((dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_parse_ad_log(spark):
    lines = spark.createDataFrame([(f"{_ms(61)} MIDDLE-EAST NATION_4 7 3",), ("x P C y 1",)], "value string")
    r = ads.parse_ad_log(lines).collect()
    assert (r[0].ts.replace(tzinfo=None), r[0].date, r[0].province, r[0].city, r[0].user_id, r[0].ad_id) == \
        (dt.datetime(2024, 1, 1, 0, 1, 1), dt.date(2024, 1, 1), "MIDDLE-EAST", "NATION_4", 7, 3)
    assert (r[1].ts, r[1].user_id, r[1].ad_id) == (None, None, 1)


def test_sliding_counts_match_window_function(spark):
    log = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, m, 0), m % 2) for m in range(0, 59, 7)],
                                "ts timestamp_ntz, ad_id long")
    mine = rows(ads.sliding_counts(log, 30, 10).select(
        F.col("window_start").cast("string"), F.col("window_end").cast("string"), "ad_id", "click_count"))
    ref = rows(log.groupBy(F.window(F.col("ts").cast("timestamp"), "30 minutes", "10 minutes"), "ad_id").count()
               .select(F.col("window.start").cast("timestamp_ntz").cast("string"),
                       F.col("window.end").cast("timestamp_ntz").cast("string"), "ad_id", "count"))
    assert mine == ref


def test_batch_log_upserts(spark):
    root = scratch_dir(spark, "t-upsert")
    log = BatchLog(spark, root, "k string, v bigint")
    assert log.read().count() == 0
    b0 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v bigint")
    b1 = spark.createDataFrame([("b", 5), ("c", 1)], "k string, v bigint")
    log.write(b0, 0)
    log.write(b1, 1)
    log.write(b1, 1)  # replayed batch: unchanged
    assert rows(log.latest(["k"], "v")) == [("a", 1), ("b", 5), ("c", 1)]
    assert rows(log.increments(["k"], "v")) == [("a", 1), ("b", 7), ("c", 1)]
    keys = spark.createDataFrame([("b",), ("z",)], "k string")
    assert rows(log.lookup(keys, ["k"], "v")) == [("b", 7)]


def test_replace_group(spark):
    log = BatchLog(spark, scratch_dir(spark, "t-group"), "g string, ad bigint, n bigint")
    log.write(spark.createDataFrame([("p1", 1, 5), ("p1", 2, 4), ("p2", 1, 1)], "g string, ad bigint, n bigint"), 0)
    log.write(spark.createDataFrame([("p1", 3, 9)], "g string, ad bigint, n bigint"), 1)
    assert rows(log.replace_group(["g"])) == [("p1", 3, 9), ("p2", 1, 1)]


def test_blacklist_takes_effect_next_batch(spark, monkeypatch):
    root = scratch_dir(spark, "t-stream")
    src = f"{root}/source"
    b1 = [f"{_ms(i)} P C 1 5" for i in range(3)] + [f"{_ms(10)} P C 2 5"]
    b2 = [f"{_ms(100 + i)} P C 1 5" for i in range(4)] + [f"{_ms(200)} P C 2 5"]
    for i, batch in enumerate((b1, b2)):
        spark.createDataFrame([(x,) for x in batch], "value string").coalesce(1).write.text(f"{src}/{i:06d}")
    stats = ast.AdClickStats(spark, f"{root}/out", threshold=3)
    # totals, lists and rankings are state: no batch reads a store
    with monkeypatch.context() as m:
        m.setattr(BatchLog, "read", lambda *a, **k: pytest.fail("a batch read a store"))
        q = stats.start(ast.text_source(spark, f"{src}/*", 1), f"{root}/ckpt", {"availableNow": True})
        q.awaitTermination()
    # user 1 reached 3 in batch 0: counted there, filtered from batch 1
    assert rows(stats.blacklist_view()) == [(1,)]
    assert rows(stats.user_click_view()) == [(dt.date(2024, 1, 1), 1, 5, 3), (dt.date(2024, 1, 1), 2, 5, 2)]
    assert rows(stats.stat_view()) == [(dt.date(2024, 1, 1), "P", "C", 5, 5)]
    assert rows(stats.province_top_view().select("date", "province", "ad_id", "click_count")) == \
        [(dt.date(2024, 1, 1), "P", 5, 5)]
    assert sum(r.click_count for r in stats.trend_view().collect()) == 5
    # minutes 0 and 3 hold clicks; the trailing 2 minutes end at minute 3
    assert sum(r.click_count for r in stats.trend_view(last_minutes=2).collect()) == 1


def test_stream_equals_batch_simulation(spark):
    """Replay of sf0.001 in 5-day batches equals a batch-by-batch simulation."""
    root = scratch_dir(spark, "t-replay")
    inp = rp.ad_log_replay_lines(spark, SF_SMALL, 5)
    rp.stage(inp.lines, f"{root}/staging")
    stats = ast.AdClickStats(spark, f"{root}/out", threshold=2)
    lines = ast.text_source(spark, f"{root}/source/*")
    rp.replay(spark, f"{root}/staging", f"{root}/source", inp.n_batches,
              [lambda: stats.run_available(lines, f"{root}/ckpt")])
    # simulation: blacklist grows after each batch
    listed = set()
    kept = []
    allrows = sorted(((r.replay_batch, r.value) for r in inp.lines.collect()))
    for b in range(inp.n_batches):
        batch = [v for bb, v in allrows if bb == b]
        batch = [v for v in batch if int(v.split(" ")[3]) not in listed]
        kept.extend(batch)
        counts = {}
        for v in batch:
            p = v.split(" ")
            day = dt.datetime.fromtimestamp(int(p[0]) / 1000, dt.timezone.utc).date()
            counts[(day, int(p[3]), int(p[4]))] = counts.get((day, int(p[3]), int(p[4])), 0) + 1
        listed |= {u for (_, u, _), c in counts.items() if c >= 2}
    assert sorted(r.user_id for r in stats.blacklist_view().collect()) == sorted(listed)
    assert sum(r.click_count for r in stats.stat_view().collect()) == len(kept)


def test_replay_writes_batches_in_parallel(spark):
    """Each producer batch lands in its own source folder, written by several
    tasks (no single-file funnel), and every line arrives exactly once."""
    root = scratch_dir(spark, "t-replay-files")
    inp = rp.ad_log_replay_lines(spark, SF_SMALL, 5)
    rp.stage(inp.lines.repartition(4), f"{root}/staging")
    rp.replay(spark, f"{root}/staging", f"{root}/source", inp.n_batches, [])
    got = spark.read.text(f"{root}/source/*").select("value", F.input_file_name().alias("f"))
    per_batch = got.select(F.regexp_extract("f", r"/source/(\d+)/", 1).cast("int").alias("b"), "value")
    want = inp.lines.select(F.col("replay_batch").alias("b"), "value")
    assert rows(per_batch) == rows(want)
    files = got.select("f").distinct().collect()
    assert len(files) > inp.n_batches


def test_filtered_stream_rereads_list(spark):
    """A list appended between batches applies from the next batch on."""
    root = scratch_dir(spark, "t-filter")
    spark.createDataFrame([(1,)], "user_id bigint").write.parquet(f"{root}/list")
    flt = ast.FilteredClicks(spark, f"{root}/list", f"{root}/out")
    lines = ast.text_source(spark, f"{root}/source/*")
    b1 = [f"{_ms(i)} P C {u} 5" for i, u in enumerate((1, 2, 3))]
    b2 = [f"{_ms(100 + i)} P C {u} 5" for i, u in enumerate((1, 2, 3))]
    spark.createDataFrame([(x,) for x in b1], "value string").write.text(f"{root}/source/000000")
    flt.run_available(lines, f"{root}/ckpt")
    spark.createDataFrame([(2,)], "user_id bigint").write.mode("append").parquet(f"{root}/list")
    spark.createDataFrame([(x,) for x in b2], "value string").write.text(f"{root}/source/000001")
    flt.run_available(lines, f"{root}/ckpt")
    assert sorted(r.user_id for r in flt.view().collect()) == [2, 3, 3]


def _duck_rows(sql, sf_dir):
    import duckdb
    from clickflow.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return sorted(tuple(r) for r in con.sql(sql).fetchall())


def test_stream_with_generations_equals_oracle(spark):
    """Stores that start a new generation every 2 batches (6 batches: three
    generations, each read touches one) give the oracle's answers, and a
    replayed batch after compaction changes nothing."""
    from clickflow.plans.oracle import SQL
    from clickflow.plans.present import present
    root = scratch_dir(spark, "t-gen")
    inp = rp.ad_log_replay_lines(spark, SF_SMALL, 5)
    assert inp.n_batches >= 5
    rp.stage(inp.lines, f"{root}/staging")
    stats = ast.AdClickStats(spark, f"{root}/out", threshold=2, batches_per_generation=2)
    lines = ast.text_source(spark, f"{root}/source/*")
    rp.replay(spark, f"{root}/staging", f"{root}/source", inp.n_batches,
              [lambda: stats.run_available(lines, f"{root}/ckpt")])
    assert stats.stat.current_generation() == (inp.n_batches - 1) // 2
    views = {
        "ad_stream_user_clicks": stats.user_click_view(),
        "ad_stream_blacklist": stats.blacklist_view(),
        "ad_stream_stat": stats.stat_view(),
        "ad_stream_province_top3": stats.province_top_view().select("date", "province", "ad_id", "click_count"),
    }
    for name, df in views.items():
        got = sorted(tuple(r) for r in present(df).select(*sorted(df.columns)).collect())
        sql = f"SELECT {', '.join(sorted(df.columns))} FROM ({SQL[name]})"
        assert got == _duck_rows(sql, SF_SMALL), name
    # the last batch runs again, as after a crash between its writes and its commit: every view stays
    def all_views():
        return [rows(v()) for v in (stats.user_click_view, stats.blacklist_view, stats.stat_view, stats.province_top_view, stats.trend_view)]

    before = all_views()
    uncommit_last_batch(f"{root}/ckpt")
    stats.run_available(lines, f"{root}/ckpt")
    assert all_views() == before


def uncommit_last_batch(ckpt):
    last = stats_last_batch_id(ckpt)
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")


def stats_last_batch_id(ckpt):
    """The id of the last committed micro-batch in a checkpoint folder."""
    return max(int(f) for f in os.listdir(f"{ckpt}/commits") if f.isdigit())


def test_sliding_counts_seconds_slide_match_window_function(spark):
    data = [(dt.datetime(2024, 1, 1, 0, m, s), (m + s) % 2) for m in (0, 1, 5) for s in (0, 7, 59)]
    log = spark.createDataFrame(data, "ts timestamp_ntz, ad_id long")
    mine = rows(ads.sliding_counts(log, 2, slide_seconds=10).select(
        F.col("window_start").cast("string"), F.col("window_end").cast("string"), "ad_id", "click_count"))
    ref = rows(log.groupBy(F.window(F.col("ts").cast("timestamp"), "2 minutes", "10 seconds"), "ad_id").count()
               .select(F.col("window.start").cast("timestamp_ntz").cast("string"),
                       F.col("window.end").cast("timestamp_ntz").cast("string"), "ad_id", "count"))
    assert mine == ref


def test_stream_survives_failed_batch_and_restart(spark):
    """A branch fails in the middle of batch 2 (after other branches wrote
    their folders): the query stops, is started again from its checkpoint,
    re-runs batch 2 and ends with the oracle's answers."""
    from clickflow.plans.oracle import SQL
    from clickflow.plans.present import present
    root = scratch_dir(spark, "t-fail")
    inp = rp.ad_log_replay_lines(spark, SF_SMALL, 5)
    rp.stage(inp.lines, f"{root}/staging")
    stats = ast.AdClickStats(spark, f"{root}/out", threshold=2, batches_per_generation=2)
    lines = ast.text_source(spark, f"{root}/source/*")
    real_write = stats.province_top.write
    state = {"failed": False}

    def flaky_write(df, batch_id, owner=None):
        if batch_id == 2 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("simulated executor loss")
        real_write(df, batch_id, owner)

    stats.province_top.write = flaky_write

    def trigger():
        try:
            stats.run_available(lines, f"{root}/ckpt")
        except Exception:  # noqa: BLE001 - the failed batch; restart once from the checkpoint
            stats.run_available(lines, f"{root}/ckpt")

    rp.replay(spark, f"{root}/staging", f"{root}/source", inp.n_batches, [trigger])
    assert state["failed"]
    views = {
        "ad_stream_user_clicks": stats.user_click_view(),
        "ad_stream_blacklist": stats.blacklist_view(),
        "ad_stream_stat": stats.stat_view(),
        "ad_stream_province_top3": stats.province_top_view().select("date", "province", "ad_id", "click_count"),
    }
    for name, df in views.items():
        got = sorted(tuple(r) for r in present(df).select(*sorted(df.columns)).collect())
        sql = f"SELECT {', '.join(sorted(df.columns))} FROM ({SQL[name]})"
        assert got == _duck_rows(sql, SF_SMALL), name


def test_store_writes_carry_no_state_and_batches_are_forgotten(spark):
    """The tasks of the store writes would send every metric of the state they carry: their plans only scan the kept batch, which goes afterwards."""
    root = scratch_dir(spark, "t-carry")
    stats = ast.AdClickStats(spark, f"{root}/out", threshold=2)
    plans, real = [], stats.stat.write

    def seen(df, batch_id, owner=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        real(df, batch_id, owner)

    stats.stat.write = seen
    spark.createDataFrame([(f"{_ms(i)} P C {i % 2} 5",) for i in range(6)], "value string").write.text(f"{root}/source/000000")
    stats.run_available(ast.text_source(spark, f"{root}/source/*"), f"{root}/ckpt")
    assert len(plans) == 1 and "FileScan parquet" in plans[0] and "TransformWithState" not in plans[0]
    assert sum(r.click_count for r in stats.stat_view().collect()) == 6
    assert os.listdir(f"{root}/out/batch_rows") == []


def test_state_partitions_follow_the_largest_batch(spark):
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(key, "200")
    try:
        for lines, want in ((0, "4"), (3000, "4"), (100_001, "5"), (10**9, "200")):
            with rp.state_partitions(spark, lines):
                assert spark.conf.get(key) == want
        assert spark.conf.get(key) == "200"
    finally:
        spark.conf.set(key, before)


def test_kafka_source_names_the_missing_connector(spark):
    with pytest.raises(RuntimeError, match="Kafka connector"):
        ast.kafka_source(spark, "localhost:9092", "ad_log")


def test_batch_log_generations_layout_and_views(spark):
    """E = 2: generation g holds batches 2g, 2g+1 and starts with a base of what
    generation g-1 wrote; every view equals that of a log
    without generations, and a replayed first batch of a generation changes
    nothing."""
    schema = "k string, v bigint"
    plain = BatchLog(spark, scratch_dir(spark, "t-plain"), schema)
    gens = BatchLog(spark, scratch_dir(spark, "t-gens"), schema, (),
                    lambda lg, df: lg.increments(["k"], "v", df), 2)
    batches = [[("a", 1), ("b", 2)], [("b", 5)], [("c", 1), ("a", 2)], [("a", 1)], [("d", 4), ("b", 1)]]
    for i, b in enumerate(batches):
        df = spark.createDataFrame(b, schema)
        plain.write(df, i)
        gens.write(df, i)
    gens.write(spark.createDataFrame(batches[4], schema), 4)  # replay of a generation's first batch
    assert gens.current_generation() == 2
    layout = {g: sorted(int(d.split("=")[1]) for d in os.listdir(f"{gens.path}/batches/gen={g}") if d.startswith("batch_id="))
              for g in (0, 1, 2)}
    assert layout == {0: [0, 1], 1: [2, 3], 2: [4]} and sorted(os.listdir(f"{gens.path}/bases")) == ["gen=1", "gen=2"]
    assert rows(gens.increments(["k"], "v")) == rows(plain.increments(["k"], "v")) == \
        [("a", 4), ("b", 8), ("c", 1), ("d", 4)]
    assert rows(gens.read(1).where("batch_id = 1").select("k", "v")) == [("a", 1), ("b", 7)]


def test_stores_are_never_read_in_part(spark):
    """A missing marker, a lost folder and a foreign owner are errors; only a store before its first batch is empty."""
    import shutil

    schema = "k string, v bigint"
    log = BatchLog(spark, scratch_dir(spark, "t-safe"), schema, (), lambda lg, df: lg.increments(["k"], "v", df), 2)
    assert log.current_generation() is None and log.read().count() == 0
    for i in range(5):
        log.write(spark.createDataFrame([("a", 1)], schema), i, "query-1")
    assert rows(log.increments(["k"], "v")) == [("a", 5)]
    assert sorted(n for n in os.listdir(f"{log.path}/_generations") if n.isdigit()) == ["0", "1", "2"]
    with pytest.raises(RuntimeError, match="belongs to"):
        log.write(spark.createDataFrame([("a", 1)], schema), 0, "query-2")
    shutil.move(f"{log.path}/_generations", f"{log.path}/_gone")
    with pytest.raises(RuntimeError, match="no marker"):
        log.read()
    shutil.move(f"{log.path}/_gone", f"{log.path}/_generations")
    shutil.move(f"{log.path}/batches/gen=2", f"{log.path}/_lost")
    with pytest.raises(Exception, match="(?i)path"):
        log.read().count()


def test_state_forms_count_late_clicks_and_rejects_are_kept(spark):
    """Clicks of the 13th, then one of the 10th: no form may drop it; lines without a time are kept as rejects."""
    day = 24 * 3600
    root = scratch_dir(spark, "t-late")
    batches = [[f"{_ms(9 * day)} P C 1 5"], [f"{_ms(12 * day)} P C 2 5", "x P C 3 5"], [f"{_ms(12 * day + 61)} P C 4 5"], [f"{_ms(9 * day + 5)} P C 6 5"]]
    stat = BatchLog(spark, f"{root}/stat", ast.STAT_SCHEMA)
    trend = BatchLog(spark, f"{root}/trend", ast.TREND_SCHEMA)
    stats = ast.AdClickStats(spark, f"{root}/out", threshold=100)
    lines = ast.text_source(spark, f"{root}/source/*")
    for i, batch in enumerate(batches):
        spark.createDataFrame([(x,) for x in batch], "value string").coalesce(1).write.text(f"{root}/source/{i:06d}")
        stats.run_available(lines, f"{root}/ckpt")
        with ast.rocksdb_state(spark):
            for query, log, name in ((ast.stateful_ad_stat, stat, "s"), (ast.windowed_trend, trend, "t")):
                (query(ads.parse_ad_log(lines).where("date is not null")).writeStream.outputMode("update")
                 .foreachBatch(lambda df, b, log=log: log.write(df, b)).option("checkpointLocation", f"{root}/ckpt-{name}")
                 .trigger(availableNow=True).start().awaitTermination())
    want = [(dt.date(2024, 1, 10), "P", "C", 5, 2), (dt.date(2024, 1, 13), "P", "C", 5, 2)]
    assert rows(stat.latest(ast.STAT_KEYS, "click_count")) == want == rows(stats.stat_view())
    assert sum(r.click_count for r in trend.latest(["minute", "ad_id"], "click_count").collect()) == 4
    assert rows(stats.reject_view()) == [("x P C 3 5",)]
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_totals_in_state_survive_a_restart_and_a_late_batch(spark):
    """Batches of the 13th, the 10th and the 13th again; each is run twice, as after a crash before its commit."""
    day = 24 * 3600
    root = scratch_dir(spark, "t-state")
    stats = ast.AdClickStats(spark, f"{root}/out", threshold=3, top_n=2)
    lines = ast.text_source(spark, f"{root}/source/*")
    batches = [
        [(12, "P", 1, 5), (12, "P", 2, 5), (12, "P", 2, 6), (12, "Q", 2, 7), (12, None, 3, None)],
        [(9, "P", 1, 8), (9, "P", 1, 8), (9, "P", 1, 8), (9, "P", 1, 9)],  # late; lists user 1
        [(12, "P", 1, 6), (12, "P", 4, 6), (12, "P", 4, 6), (12, "P", 4, 7), (12, "P", 5, 7)],  # user 1 is dropped
    ]
    for i, batch in enumerate(batches):
        text = [f"{_ms(d * day + 60 * k)} {p or ''} C {u} {'x' if a is None else a}" for k, (d, p, u, a) in enumerate(batch)]
        spark.createDataFrame([(x,) for x in text], "value string").coalesce(1).write.text(f"{root}/source/{i:06d}")
        stats.run_available(lines, f"{root}/ckpt")
        uncommit_last_batch(f"{root}/ckpt")
        stats.run_available(lines, f"{root}/ckpt")
    late, main = dt.date(2024, 1, 10), dt.date(2024, 1, 13)
    assert rows(stats.blacklist_view()) == [(1,)]
    assert rows(stats.user_click_view()) == sorted([(late, 1, 8, 3), (late, 1, 9, 1), (main, 1, 5, 1), (main, 2, 5, 1), (main, 2, 6, 1), (main, 2, 7, 1),
                                                    (main, 3, None, 1), (main, 4, 6, 2), (main, 4, 7, 1), (main, 5, 7, 1)], key=str)
    top = [(x.date, x.province, x.ad_id, x.click_count) for x in stats.province_top_view().collect()]
    assert sorted(top, key=str) == sorted([(late, "P", 8, 3), (late, "P", 9, 1), (main, "P", 6, 3), (main, "P", 5, 2), (main, "Q", 7, 1), (main, "", None, 1)], key=str)


def test_upkeep_touches_the_dates_of_the_last_generation_only(spark):
    """A base is rewritten for the dates that were touched since the last one, and a read of a day lists that day's base alone, however old the store is."""
    schema = "k string, v bigint, date date"
    log = BatchLog(spark, scratch_dir(spark, "t-dates"), schema, ("date",), lambda lg, df: lg.increments(["date", "k"], "v", df), 2)
    plain = BatchLog(spark, scratch_dir(spark, "t-dates-plain"), schema, ("date",))
    for i in range(12):
        day = dt.date(2024, 1, 1 + i // 2)
        batch = [("a", i, day), ("b", 1, day)] + ([("late", 1, dt.date(2024, 1, 1))] if i == 9 else []) + ([("none", 1, None)] if i in (2, 7) else [])
        for store in (log, plain):
            store.write(spark.createDataFrame(batch, schema), i)
    assert rows(log.increments(["date", "k"], "v")) == rows(plain.increments(["date", "k"], "v"))
    rewritten = {g: sorted(n for n in os.listdir(f"{log.path}/bases/gen={g}") if n.startswith("date=")) for g in range(1, 6)}
    assert {g: len(n) for g, n in rewritten.items()} == {1: 1, 2: 2, 3: 1, 4: 2, 5: 2}
    assert rewritten[5] == ["date=2024-01-01", "date=2024-01-05"]  # the late row's day, and no other old one
    for days, bases in ((["2024-01-03"], ["gen=3/date=2024-01-03"]), (["2024-01-01"], ["gen=5/date=2024-01-01"]), (["2024-01-06"], [])):
        assert log._base_folders(5, days) == bases
        part = log.read(days=days)
        assert rows(log.increments(["date", "k"], "v", part)) == rows(plain.increments(["date", "k"], "v", plain.read(days=days)))
        assert len(part.inputFiles()) <= 2 + 24  # its base and the batches of the current generation
    log.write(spark.createDataFrame([("a", 10, dt.date(2024, 1, 6)), ("b", 1, dt.date(2024, 1, 6))], schema), 10)  # replay of a generation's first batch
    assert rows(log.increments(["date", "k"], "v")) == rows(plain.increments(["date", "k"], "v"))


def test_a_retried_batch_sees_the_list_of_its_first_attempt(spark):
    root = scratch_dir(spark, "t-pin")
    spark.createDataFrame([(1,)], "user_id bigint").write.parquet(f"{root}/list")
    lines = spark.createDataFrame([(f"{_ms(u)} P C {u} 5",) for u in (1, 2, 3)], "value string")
    flt = ast.FilteredClicks(spark, f"{root}/list", f"{root}/out")
    write, state = flt.out.write, {"failed": False}

    def flaky(df, batch_id, owner=None):
        if not state["failed"]:
            state["failed"] = True
            raise RuntimeError("simulated executor loss")
        write(df, batch_id, owner)

    flt.out.write = flaky
    with pytest.raises(RuntimeError):
        flt.process_batch(lines, 0)
    spark.createDataFrame([(2,)], "user_id bigint").write.mode("append").parquet(f"{root}/list")
    flt.process_batch(lines, 0)
    assert sorted(r.user_id for r in flt.view().collect()) == [2, 3]
    flt.process_batch(lines, 1)  # the next batch sees the longer list
    assert sorted(r.user_id for r in flt.view().collect()) == [2, 3, 3]
