from __future__ import annotations

import json
import os
import random

import pytest
from support import at

from millwright import cli, schemas
from millwright.sinks import tables
from millwright.sources import message_log
from millwright.streaming import jobs, progress


def add(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "ab") as file:
        file.write(text.encode())


@pytest.mark.parametrize("split", [1, 3, 7, 50, 10_000])
def test_spans_give_every_whole_line_once(tmp_path, split):
    rng = random.Random(split)
    want = ["".join(rng.choices("abé{}", k=rng.randrange(12))) for _ in range(60)]
    add(f"{tmp_path}/topic/p0", "\n".join(want) + "\nunfinished")
    reader = message_log.MessageLogReader({"path": f"file://{tmp_path}/topic", "split_bytes": str(split)})
    spans = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [row[0] for span in spans for row in reader.read(span)] == want


def test_the_last_line_feed_is_found_far_from_the_end(tmp_path, monkeypatch):
    monkeypatch.setattr(message_log, "_BLOCK", 4)
    add(f"{tmp_path}/p", "one\n" + "x" * 50)
    assert message_log.complete(f"{tmp_path}/p") == 4 and message_log.complete(f"{tmp_path}/p", 4) == 4
    add(f"{tmp_path}/q", "none")
    assert message_log.complete(f"{tmp_path}/q") == 0
    with pytest.raises(ValueError):
        message_log.MessageLogReader({"path": "x", "starting": "sometime"})


def test_offsets_survive_a_restart(spark, tmp_path):
    topic = f"{tmp_path}/topic"

    def run(**options):
        feed = message_log.message_feed(spark, topic, **options)
        label = options.get("starting", "earliest")
        write = lambda rows, run, n: rows.write.mode("overwrite").parquet(f"{tmp_path}/{label}/batch={n}")
        jobs.run(feed, write, f"{tmp_path}/checkpoint-{label}", once=True).awaitTermination()
        return sorted(r.payload for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/{label}").collect())

    add(f"{topic}/p0", "a\nb\nhalf")
    add(f"{topic}/_temporary/p9", "never\n")
    assert run() == ["a", "b"]
    add(f"{topic}/p0", " done\n")
    add(f"{topic}/sub/p1", "c\n")
    assert run() == ["a", "b", "c", "half done"]
    assert run() == ["a", "b", "c", "half done"]
    # a topic read from its end has only what comes later, new files included
    jobs.run(message_log.message_feed(spark, topic, starting="latest"), lambda *_: None, f"{tmp_path}/checkpoint-latest", once=True).awaitTermination()
    add(f"{topic}/p0", "late\n")
    add(f"{topic}/p2", "new\n")
    assert run(starting="latest") == ["late", "new"]


def test_a_job_over_growing_files(spark, tmp_path):
    def message(second, number):
        return json.dumps({
            "event_id": f"e{number}", "timestamp": at(second).isoformat(), "line_id": "LINE-A", "event_type": "CYCLE_COMPLETE",
            "units_produced": 10, "units_rejected": 0, "ideal_cycle_time_ms": 4800, "downtime_s": 0,
        }) + "\n"

    common = ["--folder", f"{tmp_path}/in", "--growing", "--distinct", "--once", "--progress", f"{tmp_path}/progress"]
    for lines in ([(0, 0), (5, 1), (5, 1)], [(5, 1), (10, 2)], [(600, 3)], [(601, 4)]):
        add(f"{tmp_path}/in/line-events/p0", "".join(message(*line) for line in lines))
        cli.main(["job", "oee", *common, "--out", f"{tmp_path}/oee", "--checkpoint", f"{tmp_path}/cp"])
    table = tables.read_table(spark, f"{tmp_path}/oee", schemas.OEE_METRICS).collect()
    assert [r.total_units for r in table] == [30]
    assert progress.progress_report(progress.read_progress(spark, f"{tmp_path}/progress")).first().rows_in == 7
