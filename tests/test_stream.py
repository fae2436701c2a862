import datetime as dt
import json

from adlake import specs
from adlake.operators.tables import Target, upsert
from adlake.plans.pulls import fact_rows
from adlake.streaming.revisions import LANDED_SCHEMA, StreamReport, stream_revisions

TS = dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc)
RUN = dt.date(2024, 1, 20)


def body(*rows):
    return json.dumps([{"AD_ID": a, "DATE": d, "SPEND_IN_DOLLAR": s} for a, d, s in rows])


def land(spark, folder, *pulls):
    rows = [("acct", "2024-01-06", number, text) for number, text in pulls]
    spark.createDataFrame(rows, LANDED_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def content(spark, target):
    rows = target.read(spark, specs.AD_FACT).collect()
    return sorted((r["ad_id"], str(r["stat_date"]), r["spend"]) for r in rows)


def test_stream_of_revisions(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), Target(path=str(tmp_path / "table"))
    report = StreamReport()

    def run():
        query = stream_revisions(spark, landing, target, specs.AD_FACT, checkpoint=str(tmp_path / "check"),
                                 run_date=RUN, run_ts=TS, max_files=1, report=report)
        query.awaitTermination()

    land(spark, landing, (1, body(("a", "2024-01-06", 1.0), ("a", "2024-01-05", 9.0), ("b", "2024-01-10", 2.0))),
         (2, body(("a", "2024-01-06", 1.5))))
    run()
    first = [("a", "2024-01-06", 1.5), ("b", "2024-01-10", 2.0)]
    assert content(spark, target) == first  # later pull wins, the day before the window is late
    assert (report.batches, report.rows, report.late) == (1, 2, 1)
    run()
    assert content(spark, target) == first and report.batches == 1  # nothing new, nothing done
    land(spark, landing, (3, body(("b", "2024-01-10", 5.0), ("c", "2024-01-11", 7.0))))
    run()
    assert content(spark, target) == [first[0], ("b", "2024-01-10", 5.0), ("c", "2024-01-11", 7.0)]

    batch = Target(path=str(tmp_path / "batch"))
    for text in (body(("a", "2024-01-06", 1.5), ("b", "2024-01-10", 2.0)),
                 body(("b", "2024-01-10", 5.0), ("c", "2024-01-11", 7.0))):
        frame = spark.createDataFrame([("acct", "2024-01-06", 1, text)], LANDED_SCHEMA)
        upsert(fact_rows(frame, specs.AD_FACT, TS), batch, specs.AD_FACT)
    assert content(spark, batch) == content(spark, target)


def test_an_earlier_pull_that_comes_late_changes_nothing(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), Target(path=str(tmp_path / "table"))
    for number, spend in ((2, 200.0), (1, 100.0), (3, 300.0), (2, 250.0)):
        land(spark, landing, (number, body(("a", "2024-01-10", spend))))
        stream_revisions(spark, landing, target, specs.AD_FACT, checkpoint=str(tmp_path / "check"),
                         run_date=RUN, run_ts=TS).awaitTermination()
        want = {2: 200.0, 1: 200.0, 3: 300.0}[number] if spend != 250.0 else 300.0
        assert content(spark, target) == [("a", "2024-01-10", want)]
