from __future__ import annotations

import datetime
from collections import Counter

import pytest

from punctual.streaming import accounted

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
SCHEMA = "event_id long, event_timestamp timestamp, arr_del15 int"


def batch(spark, rows):
    """(id, hours after START, late flag) rows."""
    return spark.createDataFrame([(i, START + datetime.timedelta(hours=h), d) for i, h, d in rows], SCHEMA).coalesce(1)


def state(spark, root):
    return {(r.window_start, r.events, r.active_delays) for r in accounted.read_windows(spark, root).collect()}


def expected(rows):
    """Windows of an hour over (id, hours, flag) rows."""
    n, late = Counter(int(h) for _, h, _ in rows), Counter(int(h) for _, h, d in rows if d)
    naive = lambda h: (START + datetime.timedelta(hours=h)).replace(tzinfo=None)
    return {(naive(h), k, late[h]) for h, k in n.items()}


def test_only_days_that_changed_are_merged(spark, tmp_path, monkeypatch):
    """Twenty batches over ten days, most into one day: a merge reads that day, and old folders go."""
    root, rows, merged = str(tmp_path), [], []
    written = accounted._written
    monkeypatch.setattr(accounted, "_written", lambda sums, path, tasks=None: merged.append((tasks, set(made := written(sums, path, tasks)))) or made)
    for n in range(20):
        day = n // 2 if n < 10 else 9
        some = [(10 * n + k, 24 * day + k / 2, k % 2) for k in range(4)]
        rows += some
        accounted.add_batch(batch(spark, some), root, n, "1 hour", 365 * 86_400, merge_at=4)
    merges = [days for tasks, days in merged if tasks]
    assert merges and all(days == {"2024-01-10"} for days in merges) and {t for t, _ in merged if t} == {1}
    assert state(spark, root) == expected(rows)
    found = accounted.newest_pointer(spark, f"{root}/manifests")[1]["days"]
    assert len(found) == 6 and all(len(f) <= 4 for f in found.values())
    files = {p.parent.relative_to(root).as_posix() for p in tmp_path.glob("data/*/day=*/*.parquet")}
    assert {f for folders in found.values() for f in folders} <= files and len(files) < 20
    one_day = accounted.read_windows(spark, root, "2024-01-02", "2024-01-02")
    assert all("day=2024-01-02" in f for f in one_day.inputFiles()) and one_day.count() == 2


@pytest.mark.parametrize("stop_at", ["late", "sums", "manifest", "half a manifest"])
def test_a_replayed_batch_counts_once(spark, tmp_path, monkeypatch, stop_at):
    root, first, second = str(tmp_path), [(1, 0.5, 1), (2, 30.2, 0)], [(3, 0.7, 1), (4, 30.9, 1), (5, 31, 0)]
    accounted.add_batch(batch(spark, first), root, 0, "1 hour", 3600)
    before = state(spark, root)
    written, point = accounted._written, accounted.write_pointer

    def stops(*args):
        if stop_at == "late":
            raise KeyboardInterrupt
        written(*args)
        raise KeyboardInterrupt

    def breaks(spark, folder, number, content):
        if stop_at.startswith("half"):
            (tmp_path / "manifests" / f"{number:012d}.json").write_text('{"days": {')
        raise KeyboardInterrupt

    if stop_at in ("late", "sums"):
        monkeypatch.setattr(accounted, "_written", stops)
    else:
        monkeypatch.setattr(accounted, "write_pointer", breaks)
    with pytest.raises(KeyboardInterrupt):
        accounted.add_batch(batch(spark, second), root, 1, "1 hour", 3600)
    assert state(spark, root) == before
    assert accounted.read_late(spark, root).count() == 0
    monkeypatch.setattr(accounted, "_written", written)
    monkeypatch.setattr(accounted, "write_pointer", point)
    for _ in range(2):
        accounted.add_batch(batch(spark, second), root, 1, "1 hour", 3600)
    # the first event of the second batch lies more than an hour behind 30.2
    assert [r.event_id for r in accounted.read_late(spark, root).collect()] == [3]
    assert state(spark, root) == expected(first + second[1:])


def test_empty_batches(spark, tmp_path):
    root = str(tmp_path)
    assert accounted.read_windows(spark, root).count() == 0 and accounted.read_late(spark, root) is None
    for n in range(3):
        accounted.add_batch(batch(spark, []), root, n, "1 hour", 60, merge_at=2)
    assert accounted.read_windows(spark, root).count() == 0 and accounted.newest_event(spark, root) is None
    accounted.add_batch(batch(spark, [(1, 5, 1)]), root, 3, "1 hour", 60)
    assert state(spark, root) == expected([(1, 5, 1)])
    assert accounted.newest_event(spark, root) == START + datetime.timedelta(hours=5)
