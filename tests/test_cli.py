from __future__ import annotations

import json

from support import at

from millwright import cli, schemas
from millwright.sinks import tables


def message(second, **fields):
    return json.dumps({"event_id": f"e{second}", "timestamp": at(second).isoformat(), **fields})


def test_jobs_and_archive_queries_end_to_end(spark, tmp_path, capsys):
    lines = [
        message(
            s, line_id="LINE-A", event_type="CYCLE_COMPLETE", units_produced="10", units_rejected=1
        )
        for s in range(0, 600, 10)
    ]
    for topic in schemas.TOPICS:
        (tmp_path / "in" / topic).mkdir(parents=True)
    (tmp_path / "in" / "line-events" / "part-0.json").write_text("\n".join([*lines, "broken"]))
    common = ["--folder", f"{tmp_path}/in", "--once"]
    root, metrics = f"{tmp_path}/archive", f"{tmp_path}/metrics"
    cli.main(["job", "oee", *common, "--out", metrics, "--checkpoint", f"{tmp_path}/c1"])
    cli.main(["job", "archive", *common, "--out", root, "--checkpoint", f"{tmp_path}/c2"])
    # 590 s is the newest event, so windows up to 540 s are closed
    table = tables.read_table(spark, metrics, schemas.OEE_METRICS)
    assert table.count() == 9 and {r.total_units for r in table.collect()} == {60}

    options = cli.parser().parse_args(["archive", root, "--oee"])
    (row,) = cli.archive_query(spark, options).collect()
    assert (row.line_id, row.batches, row.total_units, row.quality) == ("LINE-A", 60, 600, 0.9)

    def run(*arguments):
        capsys.readouterr()
        cli.main(["archive", root, *arguments])
        return capsys.readouterr().out

    assert "line_events" in run()
    assert "append" in run("--table", "line_events", "--time-travel")
    shown = run("--table", "line_events", "--as-of-snapshot", "0", "--limit", "3")
    assert "total rows: 60" in shown and shown.count("CYCLE_COMPLETE") == 3


def test_scheduled_commands_and_panels(spark, tmp_path, capsys):
    metrics, hourly = f"{tmp_path}/metrics", f"{tmp_path}/hourly"
    layout = (
        "time timestamp, line_id string, availability double, performance double, quality double, "
        "oee double, total_units bigint, good_units bigint"
    )
    rows = [(at(h * 3600 + 60 * m), "LINE-A", 1.0, 1.0, 1.0, h / 10, 7, 7) for h in range(5) for m in (1, 2)]
    tables.upsert_oee_metrics(metrics, spark.createDataFrame(rows, layout), batch=0)
    cli.main(["refresh", "--metrics", metrics, "--hourly", hourly, "--as-of", "2024-03-15T12:30:00"])
    found = tables.read_hourly(spark, hourly).orderBy("bucket").collect()
    assert [(r.bucket.hour, r.avg_oee) for r in found] == [(10, 0.2), (11, 0.3)]
    capsys.readouterr()
    for panel, shown in (("current", 1), ("trend", 3), ("worst", 3), ("daily", 1)):
        cli.main(["dashboard", panel, "--metrics", metrics, "--hours", "1.5", "--as-of", "2024-03-15T12:01:00"])
        assert capsys.readouterr().out.count("LINE-A") == shown, panel
    cli.main(["retention", "--metrics", metrics, "--as-of", "2024-03-22T10:30:00"])
    assert capsys.readouterr().out.split() == ["2024-03-15-08", "2024-03-15-09"]


def test_rate_limits_reach_the_feed(monkeypatch):
    seen = {}
    monkeypatch.setattr(cli.feeds, "topic_feed", lambda spark, topic, servers, **options: seen.update(options))
    monkeypatch.setattr(cli.feeds, "decode", lambda messages, table: None)
    monkeypatch.setattr(cli.jobs, "run_archive", lambda *_, **__: None)
    monkeypatch.setattr(cli.archive, "ensure_tables", lambda *_: None)
    job = ["job", "archive", "--servers", "h:1", "--out", "o", "--checkpoint", "c", "--at-most", "500"]
    cli.start_job(None, cli.parser().parse_args(job))
    assert seen == {"maxOffsetsPerTrigger": "500"}
