"""How the plans run: buckets, runtime filters, observed counts, statistics, contracts, reuse."""

import os
import re
import subprocess
import sys
import textwrap

import pytest
from conftest import ROOT
from helpers import bag, executed, plan
from pyspark.sql import functions as F

from tallygrid.checks import graphs
from tallygrid.checks.registry import Tables
from tallygrid.operators.bitmaps import bitmaps, counts_by_level, with_numbers
from tallygrid.operators.horizons import month_horizon, trailing_horizon
from tallygrid.operators.profiles import AVERAGED, CHARGE, SEGMENT, segment_profile
from tallygrid.operators.ranking import latest_by_maxima, latest_in_buckets
from tallygrid.operators.skew import fits_buckets
from tallygrid.plans import accounts, accruals, billing, contracts, results, run as runs
from tallygrid.session import Staging, fit_partitions, fresh_path, inline, prepare
from tallygrid.sinks import tables
from tallygrid.sinks.observed import Watch, is_missing, is_outside
from tallygrid.sinks.runlog import RunLog
from tallygrid.sources.tables import BillingSources, schema_of
from tallygrid.sources.testtables import TEST_RUN, billing_sources, table

SHUFFLED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def conf(spark):
    kept = {}

    def put(**values):
        for key, value in values.items():
            kept.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield lambda values: put(**values)
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def src(spark, small):
    return billing_sources(spark, small)


@pytest.fixture(scope="module")
def staged(spark, src):
    stage = Staging(spark, fresh_path(spark, "stage"))
    lines = runs.staged_lines(src, TEST_RUN, stage)
    return lines, runs.staged_core(src, lines, stage)


def above_table(text: str, table: str) -> list[str]:
    """Operators between each scan of ``table`` and the root, by the plan's indentation."""
    lines, found = text.splitlines(), []
    for i, line in enumerate(lines):
        if "FileScan" in line and table in line:
            depth = re.search(r"[A-Za-z]", line).start()
            for above in reversed(lines[:i]):
                at = re.search(r"[*A-Za-z]", above)
                if at and at.start() < depth:
                    depth = at.start()
                    found.append(above.strip(" :+-*"))
    return found


def physical(frame) -> str:
    return frame._jdf.queryExecution().sparkPlan().toString() + frame._jdf.queryExecution().executedPlan().toString()


def table_of(frame) -> str:
    return re.search(r"stage_[0-9a-f]{32}", plan(frame)).group()


# buckets


def test_buckets_need_no_exchange(spark, src, staged, conf):
    conf(SHUFFLED)  # even the joins that small tables would broadcast
    lines, core = staged
    assert lines.buckets == 8
    latest = latest_in_buckets(core, "seq_product_item_id", "bill_sdt", "bill_edt")
    back = core.join(core.groupBy("seq_product_item_id").agg(F.max("bill_edt").alias("last")), "seq_product_item_id")
    ids = lines.posted.select("seq_product_item_id")
    unbilled = accounts.never_billed_accounts(lines.accounts, ids)
    for frame in (latest, back, unbilled):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text.replace("never_billed", ""), text
    assert bag(latest) == bag(latest_by_maxima(core, "seq_product_item_id", "bill_sdt", "bill_edt"))


def test_lines_are_dealt_once_by_account(src, staged, conf):
    conf(SHUFFLED)
    lines, _ = staged
    text = billing.posted_lines(src, lines.accounts, TEST_RUN, 8)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(seq_product_item_id#\d+L?, 8\)", text)) == 1
    assert not [a for a in above_table(text, table_of(lines.accounts)) if a.startswith("Exchange")]


def test_charges_need_no_exchange_by_account(src, staged):
    lines, _ = staged
    charged = billing._unique(billing._sparse(billing.charge_rows(billing.bill_lines(src, lines.posted))))
    text = charged._jdf.queryExecution().executedPlan().toString()
    assert not [a for a in above_table(text, table_of(lines.posted)) if a.startswith("Exchange")]


def test_each_bucket_is_one_or_two_files(staged):
    lines, core = staged
    assert len(lines.posted.inputFiles()) <= 8 and len(core.inputFiles()) <= 16  # charges and discounts


def test_a_hot_account_stays_out_of_buckets(spark, src, small):
    hot = spark.range(3000).select(F.when(F.col("id") < 1000, 1).otherwise(F.col("id")).alias("k"))
    assert fits_buckets(hot, "k", 1000) and not fits_buckets(hot, "k", 999)
    kept = runs.fits_buckets
    runs.fits_buckets = lambda lines, key: False
    try:
        with Staging(spark, fresh_path(spark, "stage")) as stage:
            plain = runs.accrual_run(src, TEST_RUN, stage)
            assert not stage.tables
            want = bag(plain.detail)
    finally:
        runs.fits_buckets = kept
    with Staging(spark, fresh_path(spark, "stage")) as stage:
        bucketed = runs.accrual_run(src, TEST_RUN, stage)
        assert len(stage.tables) == 3 and bag(bucketed.detail) == want
        names = list(stage.tables)
    assert not [t for t in names if spark.catalog.tableExists(t)]


# one pass for the profile


def test_profile_reads_the_core_once(src, staged):
    _, core = staged
    profile = accruals.seasonal_profile(core, trailing_horizon(src.dim_date, TEST_RUN), TEST_RUN)
    text = executed(profile)
    final = text.split("== Initial Plan ==")[0]
    assert final.count(f"FileScan parquet spark_catalog.default.{table_of(core)}") == 1
    assert [a for a in above_table(final, table_of(core)) if a.startswith("Exchange")][0].startswith("Exchange hashpartitioning(fuel_type")


def test_profile_counts_equal_distinct_counts(spark):
    rows = spark.range(6000).select(
        *[F.concat(F.lit("x"), (F.col("id") % 2).cast("string")).alias(c) for c in SEGMENT],
        (F.col("id") % 3).cast("int").alias("mth_no"),
        *[F.concat(F.lit(c), (F.col("id") % 5 if c == "trans_description" else F.lit(0)).cast("string")).alias(c) for c in CHARGE],
        F.when(F.col("id") % 11 > 0, F.xxhash64(F.col("id") % 97)).alias("seq_product_item_id"),
        *[F.when(F.col("id") % 4 > 0, (F.col("id") % 1013) / 7).cast("decimal(28,15)").alias(c) for c in AVERAGED],
    )
    fine = rows.groupBy(*SEGMENT, *CHARGE, "mth_no").agg(
        F.countDistinct("seq_product_item_id").alias("a"), *[F.round(F.avg(c), 5).cast("decimal(20,5)").alias(f"m_{c}") for c in AVERAGED]
    )
    coarse = rows.groupBy(*SEGMENT, "mth_no").agg(F.countDistinct("seq_product_item_id").alias("r"))
    want = bag(fine.join(coarse, [*SEGMENT, "mth_no"]), [*SEGMENT, *CHARGE, "mth_no", "a", "r", *[f"m_{c}" for c in AVERAGED]])
    got = segment_profile(rows).withColumnsRenamed({"account_number_count": "a", "record_count": "r"} | {f"avg_{c}": f"m_{c}" for c in AVERAGED})
    assert bag(got, [*SEGMENT, *CHARGE, "mth_no", "a", "r", *[f"m_{c}" for c in AVERAGED]]) == want


# partitions by month


def test_horizons_prune_months_at_run_time(spark, src, staged):
    lines, core = staged
    stage = Staging(spark, fresh_path(spark, "stage"))
    monthly = stage(accruals.monthly_core(core, TEST_RUN), "monthly_core", parts="mth_sdt")
    season, horizon = trailing_horizon(src.dim_date, TEST_RUN), month_horizon(src.dim_date, TEST_RUN)
    profile, actual = accruals.monthly_profile(monthly, season), accruals.monthly_actuals(monthly, horizon)
    crossing = monthly.filter("trunc(bill_sdt, 'MM') < mth_sdt AND trunc(bill_edt, 'MM') > mth_sdt")
    assert not crossing.isEmpty()  # bills that reach over a whole month
    for frame, months in ((profile, 24), (actual, 12)):
        assert "dynamicpruning" in frame._jdf.queryExecution().optimizedPlan().toString()
        assert partitions_read(frame) <= months < monthly.select("mth_sdt").distinct().count() + 1
    assert partitions_read(actual) < monthly.select("mth_sdt").distinct().count()
    assert bag(profile) == bag(accruals.seasonal_profile(core, season, TEST_RUN))
    assert bag(actual) == bag(accruals.actuals(core, horizon, TEST_RUN))


def partitions_read(frame) -> int:
    """Partitions of the stored frame that an executed plan has read."""
    return max(metric_values(frame, "numPartitions"))


def metric_values(frame, name: str) -> list[int]:
    """Values of a metric over all operators of an executed frame."""
    frame.collect()

    def values(node) -> list[int]:
        children, own = node.children(), []
        if node.metrics().contains(name):
            own.append(node.metrics().apply(name).value())
        inner = [children.apply(i) for i in range(children.size())]
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            inner = [node.executedPlan()]
        elif kind.endswith("QueryStageExec"):
            inner = [node.plan()]
        return own + [v for child in inner for v in values(child)]

    return values(frame._jdf.queryExecution().executedPlan())


# bitmaps


def test_bitmaps_equal_distinct_counts(spark):
    odd = F.when(F.col("id") % 50 > 0, (F.col("id") * 7919 % 977 - 400) * 10_000_000_000_003)  # sparse, negative and missing numbers
    rows = spark.range(5000).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 5 < 4, F.col("id") % 5).alias("b"), odd.alias("n"))
    got = bag(counts_by_level(bitmaps(rows, "n", "a", "b"), ["a", "b"], [["a", "b"], ["b"], []]))
    parts = [rows.groupBy("a", "b"), rows.withColumn("a", F.lit(None)).groupBy("a", "b"), rows.withColumns({"a": F.lit(None), "b": F.lit(None)}).groupBy("a", "b")]
    want = sum((bag(p.agg(F.countDistinct("n").alias("n_distinct")).select(F.lit(i).alias("level"), "a", "b", "n_distinct")) for i, p in enumerate(parts)), start=type(got)())
    assert got == want


def test_bitmaps_of_texts_read_the_rows_once(spark):
    rows = spark.range(2000).select((F.col("id") % 4).alias("k"), F.md5((F.col("id") % 300).cast("string")).alias("t"))
    stage = Staging(spark, fresh_path(spark, "numbers"))
    counts = counts_by_level(bitmaps(with_numbers(rows, "t", stage), "number", "k"), ["k"], [["k"], []])
    assert sorted((r.level, r.k if r.k is not None else -1, r.n_distinct) for r in counts.collect()) == [*((0, k, 75) for k in range(4)), (1, -1, 300)]


# runtime filters


def exchange_rows(frame) -> int:
    """Rows written to all exchanges of an executed frame."""
    return sum(metric_values(frame, "shuffleRecordsWritten"))


def test_bloom_filters_reach_the_line_scan(spark, src, tmp_path, conf):
    for name in BillingSources.names():
        frame = getattr(src, name)
        frame.select(*[F.col(f.name).cast(f.dataType) for f in schema_of(name)]).write.parquet(f"{tmp_path}/{name}")
    files = BillingSources.from_files(spark, str(tmp_path))
    with Staging(spark, fresh_path(spark, "stage")) as stage:
        few = stage(accounts.active_accounts(files, TEST_RUN).filter("account_id % 10 = 3").repartition(8, "account_id"), "few", "account_id")
        conf(SHUFFLED)
        plain = exchange_rows(billing.posted_lines(files, few, TEST_RUN, 8))
        conf({"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"})
        filtered = billing.posted_lines(files, few, TEST_RUN, 8)
        text = filtered._jdf.queryExecution().optimizedPlan().toString()
        tests = [line for line in text.splitlines() if "might_contain" in line]
        assert tests and any("account_id" in line or "seq_product_item_id" in line for line in tests) and any("invoice_id" in line for line in tests)
        assert all(line.strip(" :+-").startswith("Filter") for line in tests)
        assert exchange_rows(filtered) < plain / 2
        want = bag(filtered)
        conf({"spark.sql.optimizer.runtime.bloomFilter.enabled": "false"})
        assert bag(billing.posted_lines(files, few, TEST_RUN, 8)) == want


# writes


def test_a_failed_write_leaves_the_old_run(spark, tmp_path):
    rows = spark.createDataFrame([(25, "a"), (25, "b"), (26, "c")], "request_id int, v string")
    one, other = rows.filter("request_id = 25"), rows.filter("request_id = 26")
    path = f"{tmp_path}/r"
    for run_id, frame in ((25, one), (26, other)):
        tables.replace_run(frame, path, "request_id", run_id)
    broken = spark.range(0, 20_000, numPartitions=4).select(
        F.lit(25).alias("request_id"), F.when(F.col("id") > 19_000, F.raise_error(F.lit("midway"))).otherwise("x").alias("v")
    )
    with pytest.raises(Exception, match="midway"):
        tables.replace_run(broken, path, "request_id", 25)
    stored = spark.read.schema("v string, request_id int").parquet(path)
    assert bag(stored) == bag(rows)
    with pytest.raises(Exception, match="another run"):
        tables.replace_run(rows, path, "request_id", 25)
    assert bag(spark.read.schema("v string, request_id int").parquet(path)) == bag(rows)
    assert bag(tables.replace_run(one.filter("false"), path, "request_id", 25)) == bag(other)


def test_a_run_id_may_need_escaping(spark, tmp_path):
    rows = spark.createDataFrame([("a/b:c", 1)], "run string, v int")
    tables.replace_run(rows, f"{tmp_path}/r", "run", "a/b:c")
    assert tables.replace_run(rows.filter("false"), f"{tmp_path}/r", "run", "a/b:c").count() == 0


def test_counts_come_from_the_write(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z"), (4, None)], "id int, kind string")
    watch = Watch({"missing_id": is_missing("id"), "strange_kind": is_outside("kind", ["x", "y"])})
    with pytest.raises(RuntimeError):
        watch.counts
    watch(rows).write.parquet(f"{tmp_path}/w")
    assert watch.counts == {"n_rows": 4, "missing_id": 1, "strange_kind": 1} and watch.broken == {"missing_id": 1, "strange_kind": 1}
    watch(rows.filter("false")).write.parquet(f"{tmp_path}/e")
    assert watch.counts == {"n_rows": 0, "missing_id": 0, "strange_kind": 0}


def test_a_repeated_task_counts_once(tmp_path):
    """In a session of its own, whose tasks may fail: each task of the write fails at its first attempt."""
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        from tallygrid.sinks.observed import Watch, is_missing
        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {str(tmp_path / "w")!r}).getOrCreate()
        def once(frames):
            for frame in frames:
                yield frame
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("first attempt")
        rows = spark.range(0, 1000, numPartitions=4).selectExpr("nullif(id % 10, 0) AS id").mapInPandas(once, "id double")
        watch = Watch({{"missing": is_missing("id")}})
        watch(rows).write.parquet({str(tmp_path / "out")!r})
        print("counts", watch.counts["n_rows"], spark.read.parquet({str(tmp_path / "out")!r}).count())
    """)
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert "counts 1000 1000" in out.stdout, out.stderr[-2000:]


def test_the_log_has_figures_and_errors(spark, tmp_path):
    log, watch = RunLog(spark, f"{tmp_path}/log", "run-1"), Watch()
    rows = spark.range(7)
    log.around("m", lambda: watch(rows).write.parquet(f"{tmp_path}/m") or rows, watch)
    assert [tuple(r) for r in log.counts().collect()] == [("run-1", "m", "n_rows", 7)]
    with pytest.raises(ValueError):
        log.around("broken", lambda: (_ for _ in ()).throw(ValueError()))
    assert {(r.model, r.state) for r in log.rows().collect()} == {("m", "start"), ("m", "end"), ("broken", "start"), ("broken", "error")}


def test_a_view_other_sessions_read(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 0.5), (2, "b", 1.5)], "id int, v string, w double")
    tables.overwrite_table(rows, "viewed", path=f"{tmp_path}/viewed")
    tables.catalog_view(spark, "seen", "viewed", ["id", "v"], "w > 1")
    assert [tuple(r) for r in spark.newSession().table("seen").collect()] == [(2, "b")]
    tables.catalog_view(spark, "seen", "viewed")
    assert bag(spark.newSession().table("seen")) == bag(rows)


def test_the_stored_extract(spark, src, tmp_path):
    run = runs.accrual_run(src, TEST_RUN, inline)
    log = RunLog(spark, f"{tmp_path}/log", "test")
    stored = results.stored_extract(results.accrual_summary(run.detail, TEST_RUN), log, "extract", "extract_view", f"{tmp_path}/x")
    assert stored.counted == stored.view.count() == spark.newSession().table("extract_view").count() <= 500
    assert [(r.model, r.state, r.time) for r in log.rows().collect()] == [("extract", "end", None)]


# statistics


def test_a_stored_run_has_tables_with_statistics(spark, src, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS results")
    names = ("results.detail", "results.summary")
    log = RunLog(spark, f"{tmp_path}/log", TEST_RUN.run_id)
    for _ in range(2):
        stage = Staging(spark, fresh_path(spark, "stage"))
        stored = runs.stored_run(src, TEST_RUN, stage, log, f"{tmp_path}/detail", f"{tmp_path}/summary", names)
    for name, frame in zip(names, (stored.detail, stored.summary), strict=True):
        told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} measure_code").collect()}
        assert bag(spark.table(name)) == bag(frame)
        exact = frame.select("measure_code").distinct().count()
        assert abs(int(told["distinct_count"]) - exact) < 0.1 * exact and told["num_nulls"] == "0"  # distinct values are estimated
    assert log.counts().filter("measure LIKE 'missing%' AND value > 0").count() == 0


def test_statistics_change_the_join_order(spark, tmp_path, conf):
    sizes = {"lines_s": 20_000, "wide_s": 5_000, "few_s": 10}
    keys = {"lines_s": "id % 50 AS w, id % 1000 AS f, id AS line", "wide_s": "id % 50 AS w, id AS wide", "few_s": "id AS f, id AS few"}
    for name, n in sizes.items():
        tables.overwrite_table(spark.range(n).selectExpr(*keys[name].split(", ")), name, path=f"{tmp_path}/{name}")
    conf({**SHUFFLED, "spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true"})
    query = "SELECT * FROM lines_s JOIN wide_s USING (w) JOIN few_s USING (f)"

    def order():
        return re.findall(r"Relation spark_catalog\.default\.(\w+)", spark.sql(query)._jdf.queryExecution().optimizedPlan().toString())

    before = order()
    for name in sizes:
        tables.analyze_columns(spark, name)
    after = order()
    assert before[:2] == ["lines_s", "wide_s"] and set(after[:2]) == {"lines_s", "few_s"} or set(after[1:]) == {"lines_s", "few_s"}


def test_a_strict_run_keeps_the_stored_one(spark, src, tmp_path, monkeypatch):
    log, paths = RunLog(spark, f"{tmp_path}/log", TEST_RUN.run_id), (f"{tmp_path}/detail", f"{tmp_path}/summary")
    make = lambda strict: runs.stored_run(src, TEST_RUN, Staging(spark, fresh_path(spark, "stage")), log, *paths, strict=strict)
    stored = bag(make(True).detail)
    whole = results.accrual_detail
    holes = F.when(F.col("service_id") % 50 > 0, F.col("service_id"))
    monkeypatch.setattr(results, "accrual_detail", lambda parts, params: whole(parts, params).withColumn("service_id", holes))
    with pytest.raises(Exception, match="service_id is missing"):
        make(True)
    assert bag(spark.read.schema(contracts.schema_of_model("detail")).parquet(paths[0])) == stored
    assert ("detail", "error") in {(r.model, r.state) for r in log.rows().collect()}
    make(False)
    assert log.counts().filter("measure = 'missing_service_id' AND value > 0").count() == 1


# declared types


def test_model_types(spark, src):
    run, horizon = runs.accrual_run(src, TEST_RUN, inline), month_horizon(src.dim_date, TEST_RUN)
    registry = billing.registry(src, billing.bill_lines(src, run.posted))
    models = {
        "active_accounts": run.accounts,
        "accrual_horizon": horizon,
        "seasonality_horizon": trailing_horizon(src.dim_date, TEST_RUN),
        "registry": registry,
        "invoice_volume": billing.invoice_volume(registry),
        "invoice_revenue": billing.invoice_revenue(registry),
        "discounts": billing.adjustment_discounts(src, run.posted),
        "invoice_core": billing.ranked_bills(run.core),
        "seasonal_profile": run.profile,
        "never_billed_accounts": run.never_billed,
        "never_billed_months": accounts.never_billed_months(run.never_billed, horizon, TEST_RUN),
        "actuals": run.actual,
        "accrual_existing": run.existing,
        "accrual_never_billed": run.imputed,
        "detail": run.detail,
        "summary": results.accrual_summary(run.detail, TEST_RUN),
    }
    assert set(models) == set(contracts.MODELS)
    for name, frame in models.items():
        declared = [(f.name, f.dataType.simpleString()) for f in contracts.schema_of_model(name)]
        assert [(f.name, f.dataType.simpleString()) for f in frame.schema] == declared, name


def test_drift_is_told_before_the_write(spark):
    schema = spark.createDataFrame([], "id bigint, price decimal(12,2), name string").schema
    fine = spark.createDataFrame([(1, 2, "x")], "id int, n int, name string").selectExpr("name", "id", "CAST(n AS decimal(8,2)) AS price")
    got = contracts.conformed(fine, schema)
    assert got.columns == schema.names and [f.dataType for f in got.schema] == [f.dataType for f in schema]
    for drifted in (fine.drop("price"), fine.withColumn("more", F.lit(1)), fine.withColumn("price", F.lit(1.5)), fine.withColumn("id", F.lit("1")), fine.withColumn("price", F.col("price").cast("decimal(12,4)"))):
        with pytest.raises(contracts.Drift):
            contracts.conformed(drifted, schema)


# graphs


def test_the_graph_works_out_shared_parts_once(spark, small):
    models = graphs.whole_graph(Tables(spark, small))
    assert models.select("model").distinct().count() == 32
    assert "ReusedExchange" in executed(models)


def test_a_union_keeps_its_branches_apart(spark, conf):
    """Lined up, a task reads a partition of every branch, so nested unions read many at once."""
    conf({"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    branches = [spark.range(100).select(F.col("id") + i).distinct() for i in range(3)]
    assert branches[0].union(branches[1]).union(branches[2]).rdd.getNumPartitions() == 24


def test_discounts_are_dealt_once(src, staged, conf):
    """Groups and distinct discounts of an invoice meet where its lines are; sums and wide rows don't travel."""
    conf(SHUFFLED)
    shown = plan(billing.adjustment_discounts(src, staged[0].posted))
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", shown)
    assert any(keys.startswith("invoice_id#") for keys in dealt)
    assert not any("measure_name#" in keys or "due_date#" in keys for keys in dealt)


def test_partitions_follow_the_tables(spark, small, conf, tmp_path):
    conf({"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB"})
    prepare(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(16 << 20)
    lines = table(spark, small, "lineitem")
    size = os.path.getsize(f"{small}/lineitem.parquet")
    assert fit_partitions(spark, lines) == 8
    assert fit_partitions(spark, lines, lines, part=1000) == -(-2 * size // 1000) == Staging(spark, str(tmp_path)).buckets
    conf({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"})
    prepare(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8k"
