"""What larger tables cost: tasks that sort nothing, merges that keep no state beside their open rows."""

from pyspark.sql import functions as F

from sluice.session import scratch_dir
from sluice.sources.sinks import FileSink


def last_plan(spark) -> str:
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return runs.apply(runs.size() - 1).physicalPlanDescription()


def test_topics_are_written_without_a_sort(spark):
    sink = FileSink(scratch_dir(spark, "unsorted"))
    topics = F.concat(F.lit("t"), (F.col("id") % 6).cast("string"))
    rows = spark.range(600).select(topics.alias("topic"), F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value"))
    sink.write(rows, "r", 0)
    plan = last_plan(spark)
    assert "WriteFiles" in plan and "Sort" not in plan
    assert {r["topic"]: r["count"] for r in sink.read(spark).groupBy("topic").count().collect()} == {f"t{i}": 100 for i in range(6)}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_order_merges_keep_no_state_store_and_only_open_rows(spark, records):
    """Two batches days apart: what no later record can meet is not carried on, what can is, and is met in the next batch."""
    from sluice.sources.topics import ReplayTopic
    from sluice.streaming import derived, jobs, wide

    day = 86_400
    for start, found in (
        (derived.start_order_wide, lambda at: spark.read.parquet(at)),
        (wide.start_order_merge, lambda at: wide.merged(spark, at).filter("kind = 'matched'")),
    ):
        root = scratch_dir(spark, "open")
        sides = [ReplayTopic(f"{root}/{n}", n) for n in ("orders", "details")]
        steps = [
            (['{"id":1}', '{"id":2}'], ['{"id":10,"order_id":1}', '{"id":11,"order_id":1}'], [0, 9 * day]),
            (['{"id":3}', '{"id":4}'], ['{"id":20,"order_id":2}', '{"id":30,"order_id":3}'], [9 * day, 9 * day]),
        ]
        for n, (orders, details, times) in enumerate(steps):
            for topic, values in zip(sides, (orders, details)):
                at = F.timestamp_seconds(F.when(F.col("offset") % 2 == 0, 1000 + times[0]).otherwise(1000 + times[1]))
                topic.append(records(values, topic.topic, 0, 2 * n).withColumn("timestamp", at))
            query = start(spark, *sides, f"{root}/out", f"{root}/cp", trigger=jobs.ONCE, partitions=2)
            query.awaitTermination()
            assert not any(p.stateOperators for p in query.recentProgress)
        assert sorted((r["order_id"], r["detail_id"]) for r in found(f"{root}/out").collect()) == [(1, 10), (2, 20), (3, 30)]
        left = spark.read.parquet(f"{root}/cp/open/rows-0")
        assert sorted((r["side"], r["_key"]) for r in left.collect()) == [("detail", 1), ("order", 2)]


def test_half_of_the_pages_is_told_without_decoding_the_log(spark):
    from sluice.plans import catalog, envelopes

    sf, seen = "/root/testdata/sf0.001", spark._jsparkSession.sharedState().statusStore().executionsList().size()
    pages = catalog._page_messages(spark, sf)
    halves, _ = catalog._halves(pages, envelopes.app_log(spark, sf))
    assert spark._jsparkSession.sharedState().statusStore().executionsList().size() > seen
    assert "from_json" not in last_plan(spark) and "to_json" not in last_plan(spark)
    assert halves[0].count() + halves[1].count() == pages.count()


def plans_since(spark, seen: int) -> list[str]:
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [runs.apply(i).physicalPlanDescription() for i in range(seen, runs.size())]


def test_dealt_records_are_made_once_and_come_part_by_part(spark, records):
    from sluice.sources.topics import ReplayTopic

    topic = ReplayTopic(f"{scratch_dir(spark, 'dealt')}/topic", "t")
    made = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            made.add(1)
            yield r

    few = records([str(i) for i in range(9)], "t").repartition(2)
    few = spark.createDataFrame(few.rdd.mapPartitions(counted), few.schema)
    add = topic.dealt(few, F.when(F.col("offset") < 8, F.col("offset") % 2))
    held = []
    for part in (0, 1, 2):
        add(part)
        held.append(sorted(r["value"] for r in topic.batch(spark).collect()))
    # A row of no part is never added, nor is anything by a part that has no rows.
    assert held == [list("0246"), list("01234567"), list("01234567")]
    assert made.value == 9


def test_change_queries_make_their_input_once_and_cache_nothing(spark):
    from sluice.plans import catalog

    for query in (catalog.cdc_counts_stream, catalog.control_refresh, catalog.cdc_split_stream):
        seen = spark._jsparkSession.sharedState().statusStore().executionsList().size()
        assert query(spark, "/root/testdata/sf0.001").count()
        plans = plans_since(spark, seen)
        assert len([p for p in plans if "lineitem" in p]) == 1, query.__name__
        assert not [p for p in plans if "InMemoryTableScan" in p], query.__name__


def test_what_a_change_batch_keeps_goes_with_it(spark, records):
    import os

    from sluice.schemas import CONTROL
    from sluice.sources.keyed_table import KeyedTable
    from sluice.sources.topics import ReplayTopic
    from sluice.streaming import jobs

    root = scratch_dir(spark, "kept")
    topic, sink, dims = ReplayTopic(f"{root}/topic", "t"), FileSink(f"{root}/out"), KeyedTable(spark, f"{root}/dims")
    rules = spark.createDataFrame([("fact", "a"), ("dim", "b")], CONTROL)
    rows = ['{"type":"insert","table":"a","data":{"id":1}}', '{"type":"insert","table":"b","data":{"id":2}}', "{"]
    for first, values in ((0, rows), (3, ['{"type":"insert","table":"c","data":{"id":3}}'])):
        topic.append(records(values, "t", 0, first))
        jobs.start_change_split(spark, topic, lambda: rules, sink, dims, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
        assert not os.listdir(f"{root}/cp/kept")
    assert sorted(r["topic"] for r in sink.read(spark).collect()) == ["DWD_A_I_1018", "QUARANTINE_DB_1018"]
    assert [r["id"] for r in dims.current().collect()] == ["2"]


def test_order_merges_deal_each_side_out_once_to_as_many_tasks_as_the_rows_need(spark, records, monkeypatch):
    """Also without an order to spread, when nothing but the key tells rows apart."""
    from sluice.streaming import wide

    monkeypatch.setattr(wide, "TASK_ROWS", 10)
    orders, details = (['{"id":%d}' % i for i in range(60)], ['{"id":%d,"order_id":%d}' % (100 + i, i) for i in range(90)])
    rows = wide.two_sides(records(orders), records(details), strict=True)
    at, new, met = F.lit(1_000_000).cast("long").alias("_at"), F.lit(True).alias("new"), F.lit(False).alias("met")
    kept = f"{scratch_dir(spark, 'rows')}/kept"
    rows.select("side", "_key", at, "_info", "_detail").write.parquet(kept)
    live = spark.read.parquet(kept).select("*", new, met)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for full, found in ((False, 60), (True, 90)):
            out, _ = wide.merge_batch(live, 150, 10**9, 1, 4, full)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(_did") == 1 and plan.count("Exchange hashpartitioning(_oid") == 1, plan
            assert plan.count(", 15)") >= 2 and ", 8)" not in plan, plan
            assert out.count() == found
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_an_order_merge_holds_its_batch_in_no_memory(spark, records):
    """A batch is written once beside the open rows, in small row groups, and goes when it has been merged."""
    import os

    from sluice.sources.topics import ReplayTopic
    from sluice.streaming import derived, jobs, wide

    for start in (derived.start_order_wide, wide.start_order_merge):
        root, seen = scratch_dir(spark, "held"), spark._jsparkSession.sharedState().statusStore().executionsList().size()
        sides = [ReplayTopic(f"{root}/{n}", n) for n in ("orders", "details")]
        for topic, values in zip(sides, (['{"id":1}', "{"], ['{"id":10,"order_id":1}'])):
            topic.append(records(values, topic.topic).withColumn("timestamp", F.timestamp_seconds(F.lit(1000))))
        start(spark, *sides, f"{root}/out", f"{root}/cp", trigger=jobs.ONCE, partitions=2).awaitTermination()
        plans = plans_since(spark, seen)
        assert plans and not [p for p in plans if "InMemoryTableScan" in p or "InMemoryRelation" in p]
        assert os.listdir(f"{root}/cp/kept") == []
    assert wide.merged(spark, f"{root}/out").filter("kind = 'matched'").count() == 1
    assert [r["reason"] for r in wide.left_out(spark, f"{root}/out").collect()] == ["unreadable"]


def test_topics_and_what_batches_keep_are_written_compactly(spark, records):
    import glob

    import pyarrow.parquet as pq

    from sluice.schemas import CONTROL
    from sluice.sources.files import Files
    from sluice.sources.keyed_table import KeyedTable
    from sluice.sources.topics import ReplayTopic
    from sluice.streaming import jobs

    root = scratch_dir(spark, "compact")
    topic, dealt, sink = ReplayTopic(f"{root}/topic", "t"), ReplayTopic(f"{root}/other", "t"), FileSink(f"{root}/out")
    rules = spark.createDataFrame([("fact", "a"), ("dim", "b")], CONTROL)
    rows = records(['{"type":"insert","table":"a","data":{"id":1}}', '{"type":"insert","table":"b","data":{"id":2}}', "{"], "t")
    topic.append(rows)
    dealt.dealt(rows, F.lit(0))(0)
    kept, delete = [], Files.delete

    def seen(self, name):
        if name.startswith("kept/"):
            kept.extend(spark.read.parquet(f"{self.path}/{name}").collect())
            kept.extend(glob.glob(f"{self.path}/{name}/*.parquet"))
            codecs.update(codec(f) for f in kept if isinstance(f, str))
        delete(self, name)

    def codec(file):
        found = pq.read_metadata(file)
        return found.row_group(0).column(0).compression if found.num_row_groups else "ZSTD"

    codecs = set()
    Files.delete = seen
    try:
        jobs.start_change_split(
            spark, topic, lambda: rules, sink, KeyedTable(spark, f"{root}/dims"), f"{root}/cp", trigger=jobs.ONCE
        ).awaitTermination()
    finally:
        Files.delete = delete
    files = [f for at in ("topic", "other", "out") for f in glob.glob(f"{root}/{at}/**/*.parquet", recursive=True)]
    assert codecs == {"ZSTD"} and {codec(f) for f in files} == {"ZSTD"}
    # A fact tells no position in what is kept; what a dimension row or a record set aside tells is whole.
    assert sorted((r["offset"] is None, r["table_name"]) for r in kept if not isinstance(r, str) and r["table_name"]) == [(False, "b"), (True, "a")]
    aside = [r["value"] for r in sink.read(spark).collect() if r["topic"].startswith("QUARANTINE")]
    assert len(aside) == 1 and '"offset":2' in aside[0] and '"topic":"t"' in aside[0]
