"""Machines that fall silent and return, by timers."""

import time
from datetime import datetime, timedelta, timezone

from machpulse.sources import streams
from machpulse.sources.messages import parse_messages
from machpulse.streaming.silence import watch_transitions
from tests.helpers import message


def deliver(folder, name, machine, age):
    folder.mkdir(exist_ok=True)
    at = datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(seconds=age)
    (folder / name).write_text(message(machine_id=machine, time=at.isoformat(timespec="milliseconds")) + "\n")


def test_silence_and_return_are_reported_once(spark, tmp_path):
    incoming, out = tmp_path / "incoming", str(tmp_path / "out")
    deliver(incoming, "a", 1, 0)
    deliver(incoming, "b", 2, 3600)

    def start():
        rows = parse_messages(streams.text_stream(spark, str(incoming))).filter("malformed_reason IS NULL")
        return watch_transitions(rows, out, str(tmp_path / "checkpoint"), every="1 second", threshold="10 seconds")

    def found():
        if not any((tmp_path / "out").glob("batch_id=*/_SUCCESS")):
            return []
        rows = spark.read.parquet(out).orderBy("constate_a").collect()
        return [(r.machine_id, r.etat) for r in rows]

    def wait_for(count, seconds=90):
        until = time.time() + seconds
        while len(found()) < count and time.time() < until:
            time.sleep(0.5)
        return sorted(found())

    query = start()
    try:
        # The old reading is silent at once, the new one when its time is over.
        assert wait_for(2) == [(1, "silence"), (2, "silence")]
    finally:
        query.stop()
    # After a restart nothing is reported again; a fresh reading brings its machine back, a late one does not.
    query = start()
    try:
        deliver(incoming, "c", 1, 0)
        deliver(incoming, "d", 2, 1800)
        assert wait_for(3) == [(1, "retour"), (1, "silence"), (2, "silence")]
        assert wait_for(4) == [(1, "retour"), (1, "silence"), (1, "silence"), (2, "silence")]
    finally:
        query.stop()
    rows = {(r.machine_id, r.etat): r for r in spark.read.parquet(out).collect()}
    assert rows[1, "silence"].constate_a - rows[1, "silence"].last_seen >= timedelta(seconds=10)
