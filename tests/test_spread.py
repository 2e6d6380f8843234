"""Tables of one split are parsed and written as texts by more than one task."""

from datetime import datetime

from skylag.plans import queries_sources, views


def test_boards_of_one_split_are_made_by_many_tasks(spark, path):
    rows = [(n, n, "O", 1.0, datetime(2024, 1, 1), "5-LOW") for n in range(200)]
    kinds = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{path}/orders.parquet")
    boards = views.boards(spark, path)
    sizes = boards.rdd.glom().map(len).collect()
    assert sum(size > 0 for size in sizes) > spark.sparkContext.defaultParallelism
    assert sorted(r.o_orderkey for r in boards.collect()) == list(range(200))


def test_event_logs_of_one_split_are_many_files_of_each_kind(spark, path):
    rows = [(n, datetime(2024, 1, 1), n, "view", 1.0, '{"k": 60}') for n in range(600)]
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{path}/events.parquet")
    log = queries_sources._event_log(spark, path)
    files = log.inputFiles()
    assert all(sum(f.endswith(end) for f in files) > spark.sparkContext.defaultParallelism for end in (".txt", ".gz", ".bz2"))
    assert sorted(int(r.GLOBALEVENTID) for r in log.collect()) == list(range(600))
