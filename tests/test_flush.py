from threading import Event, Thread

import pytest

from builders import payload_text
from plateflow.sources.lake import read_events, read_written
from plateflow.sources.payloads import read_payloads
from plateflow.streaming import ingest as ingest_module
from plateflow.streaming.flush import SIZE, START, TIME, FlushLoop, FlushPolicy, flushed_ingest
from plateflow.streaming.ingest import IngestTarget


class Clock:
    now = 0.0

    def __call__(self):
        return self.now


def deliver(folder, name, size):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(b"x" * size)


@pytest.fixture
def watched(spark, tmp_path):
    """A loop over a folder whose flushes take note of the time."""
    clock, times = Clock(), []
    folder = tmp_path / "in"
    loop = FlushLoop(spark, str(folder), lambda: times.append(clock.now), FlushPolicy(1000, 60), clock)
    return loop, clock, times, folder


def test_a_slow_source_is_flushed_by_time(watched):
    loop, clock, times, folder = watched
    for second in range(0, 200, 10):
        clock.now = float(second)
        deliver(folder, f"f{second}", 50)
        loop.step()
    assert times == [0, 60, 120, 180] and loop.flushes == {START: 1, TIME: 3}


def test_a_fast_source_is_flushed_by_size(watched):
    loop, clock, times, folder = watched
    for second in range(20):
        clock.now = float(second)
        deliver(folder, f"f{second}", 300)
        loop.step()
    assert times == [0, 4, 8, 12, 16] and loop.flushes == {START: 1, SIZE: 4}


def test_a_burst_doesnt_move_the_next_limit_of_time(watched):
    loop, clock, times, folder = watched
    loop.step()
    for second, size in ((30, 5000), (31, 10), (89, 10), (90, 10)):
        clock.now = float(second)
        deliver(folder, f"f{second}", size)
        loop.step()
    assert times == [0, 30, 90]


def test_a_cleaned_folder_still_counts_and_waits_for_the_time_at_most(watched):
    loop, clock, times, folder = watched
    deliver(folder, "old", 5000)
    loop.step()
    (folder / "old").unlink()
    assert loop.due() is None
    deliver(folder, "new", 1000)
    assert loop.step() == SIZE
    deliver(folder, "late", 10)
    (folder / "new").unlink()
    clock.now = 60.0
    assert loop.step() == TIME


def test_an_absent_folder_is_empty(watched):
    loop, clock, times, folder = watched
    assert [loop.step(), loop.step()] == [START, None]


def target_in(tmp_path):
    return IngestTarget(*(str(tmp_path / name) for name in ("events", "rejects", "checkpoint")))


def write_payloads(folder, name, *ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(payload_text(event_id=one) + "\n" for one in ids))


def test_a_failed_flush_lands_once_by_the_next(spark, tmp_path, monkeypatch):
    folder, clock = tmp_path / "in", Clock()
    write_payloads(folder, "a", "e1", "e2")
    stream = read_payloads(spark, str(folder), streaming=True)
    loop = flushed_ingest(stream, str(folder), target_in(tmp_path), FlushPolicy(100, 60), clock)
    assert loop.step() == START
    write_payloads(folder, "b", "e3")
    plain = ingest_module.land_rejects

    def failing(*args):
        raise OSError("quarantine gone")

    monkeypatch.setattr(ingest_module, "land_rejects", failing)
    with pytest.raises(Exception, match="quarantine gone"):
        loop.step()
    monkeypatch.setattr(ingest_module, "land_rejects", plain)
    assert loop.step() == SIZE and loop.step() is None
    landed = read_written(spark, target_in(tmp_path).events).select("event_id", "batch_id").collect()
    assert sorted(map(tuple, landed)) == [("e1", "00000000"), ("e2", "00000000"), ("e3", "00000001")]


def test_a_stopped_loop_lands_what_is_left(spark, tmp_path):
    folder = tmp_path / "in"
    write_payloads(folder, "a", "e1")
    stream = read_payloads(spark, str(folder), streaming=True)
    loop = flushed_ingest(stream, str(folder), target_in(tmp_path), FlushPolicy(1 << 40, 3600, 0.05))
    stop = Event()
    running = Thread(target=loop.run, args=(stop,))
    running.start()
    while not loop.flushes and running.is_alive():
        stop.wait(0.05)
    write_payloads(folder, "b", "e2")
    stop.set()
    running.join()
    assert loop.flushes == {START: 1}
    assert sorted(r.event_id for r in read_events(spark, target_in(tmp_path).events).collect()) == ["e1", "e2"]
