"""Kept figures against the same figures counted at once, whatever the order and number of batches."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest

from plateflow import session
from plateflow.streaming import chain, ledger as ledgers, maintain as keep, state

CHANGES = "order_id long, status string, changed_at timestamp_ntz, customer_id long, total_amount decimal(10,2)"
FEED = "entry_id long, version int, restaurant_id long, rating int"
EVENTS = "event_id long, order_id long, status string, changed_at timestamp, cents long"
START = dt.datetime(2024, 1, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def batches(rows, seed, pieces=4):
    """The rows in pieces without order, some of them again in later pieces."""
    rng = random.Random(seed)
    rows = rows + rng.sample(rows, len(rows) // 3)
    rng.shuffle(rows)
    size = -(-len(rows) // pieces)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def deliveries(seed, orders=120):
    """Deliveries, some orders delivered twice at different times, some without customer or amount."""
    rng = random.Random(seed)
    out = []
    for order in range(orders):
        customer = None if order % 37 == 0 else 1 if order % 3 == 0 else rng.randrange(2, 12)
        for _ in range(rng.choice([1, 1, 1, 2, 3])):
            amount = None if rng.random() < 0.1 else Decimal(rng.randrange(100, 9999)) / 100
            out.append((order, "Delivered", at(rng.randrange(5000)), customer, amount))
        out.append((order, "Placed", at(0), customer, Decimal("1.00")))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_totals_follow_every_batch(spark, tmp_path, seed):
    ledger, path, taken = keep.totals_ledger("customer_id", "total_amount"), str(tmp_path / "l"), []
    for number, rows in enumerate(batches(deliveries(seed), seed)):
        taken += rows
        batch = keep.deliveries_of(spark.createDataFrame(rows, CHANGES), "customer_id", "total_amount")
        ledger.fold(batch, number, path)
        ledger.fold(batch, number, path)  # a batch that was committed already
        want = keep.batch_totals(spark.createDataFrame(taken, CHANGES), "customer_id", "total_amount")
        assert bag(keep.ledger_totals(spark, "customer_id", "total_amount", path)) == bag(want)


def test_the_latest_is_counted_again_where_its_entry_moved_back(spark, tmp_path):
    ledger, path = keep.totals_ledger("customer_id", "total_amount"), str(tmp_path / "l")

    def take(number, *rows):
        batch = keep.deliveries_of(spark.createDataFrame(rows, CHANGES), "customer_id", "total_amount")
        ledger.fold(batch, number, path)
        return {r.customer_id: (r.n, r["last"]) for r in keep.ledger_totals(spark, "customer_id", "total_amount", path).collect()}

    one = Decimal("1.00")
    assert take(0, (1, "Delivered", at(10), 7, one), (2, "Delivered", at(50), 7, one)) == {7: (2, at(50))}
    assert take(1, (2, "Delivered", at(5), 7, one)) == {7: (2, at(10))}
    # The order's earlier delivery names another customer: it leaves the first one.
    assert take(2, (1, "Delivered", at(1), 8, one)) == {7: (1, at(5)), 8: (1, at(1))}
    assert take(3, (2, "Delivered", at(2), 8, one)) == {8: (2, at(2))}


def test_reading_costs_the_keys_and_not_the_events(spark, tmp_path):
    ledger, sizes = keep.totals_ledger("customer_id", "total_amount"), {}
    for events in (200, 4000):
        path = str(tmp_path / f"l{events}")
        rows = [(i, "Delivered", at(i), i % 20, Decimal("1.00")) for i in range(events)]
        for number in range(2):
            batch = spark.createDataFrame(rows[number::2], CHANGES)
            ledger.fold(keep.deliveries_of(batch, "customer_id", "total_amount"), number, path)
        read = keep.ledger_totals(spark, "customer_id", "total_amount", path).inputFiles()
        assert read and all("/figures/" in f for f in read)
        fs, make = session.files(spark, path)
        sizes[events] = sum(fs.getFileStatus(make(f)).getLen() for f in read)
    assert sizes[4000] < 1.2 * sizes[200]


def test_a_batch_touches_its_own_buckets_only(spark, tmp_path):
    ledger, path = keep.totals_ledger("customer_id", "total_amount"), str(tmp_path / "l")
    first = [(i, "Delivered", at(i), i % 40, Decimal("1.00")) for i in range(400)]
    ledger.fold(keep.deliveries_of(spark.createDataFrame(first, CHANGES), "customer_id", "total_amount"), 0, path)
    before = ledger.store(spark, path).manifest()
    assert len(before.tables["entries"]) == len(before.tables["figures"]) == ledger.buckets
    again = [(1000, "Delivered", at(1), 3, Decimal("1.00")), first[5]]
    ledger.fold(keep.deliveries_of(spark.createDataFrame(again, CHANGES), "customer_id", "total_amount"), 1, path)
    after = ledger.store(spark, path).manifest()
    changed = {t: [b for b in after.tables[t] if after.tables[t][b] != before.tables[t][b]] for t in after.tables}
    assert len(changed["entries"]) == len(changed["figures"]) == 1
    # Nothing but repeats: a manifest, no files.
    ledger.fold(keep.deliveries_of(spark.createDataFrame(first[:9], CHANGES), "customer_id", "total_amount"), 2, path)
    assert ledger.store(spark, path).manifest().tables == after.tables


def test_a_failed_batch_is_run_again(spark, tmp_path, monkeypatch):
    ledger, path = keep.totals_ledger("customer_id", "total_amount"), str(tmp_path / "l")
    rows = deliveries(5, 40)
    parts = [keep.deliveries_of(spark.createDataFrame(rows[k::2], CHANGES), "customer_id", "total_amount") for k in range(2)]
    ledger.fold(parts[0], 0, path)
    before = bag(keep.ledger_totals(spark, "customer_id", "total_amount", path))
    with monkeypatch.context() as patch:
        def fail(*_):
            raise RuntimeError("lost")
        patch.setattr(state.Store, "commit", fail)
        with pytest.raises(RuntimeError, match="lost"):
            ledger.fold(parts[1], 1, path)
    assert bag(keep.ledger_totals(spark, "customer_id", "total_amount", path)) == before
    ledger.fold(parts[1], 1, path)
    want = keep.batch_totals(spark.createDataFrame(rows, CHANGES), "customer_id", "total_amount")
    assert bag(keep.ledger_totals(spark, "customer_id", "total_amount", path)) == bag(want)


def test_crowded_buckets_are_written_as_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledgers, "MOST_FILES", 1)
    monkeypatch.setattr(chain, "MOST_FILES", 1)
    ledger, path = keep.totals_ledger("customer_id", "total_amount"), str(tmp_path / "l")
    rows, events = deliveries(6, 60), status_rows(6, 150)
    for number, (some, more) in enumerate(zip(batches(rows, 6), batches(events, 6), strict=True)):
        ledger.fold(keep.deliveries_of(spark.createDataFrame(some, CHANGES), "customer_id", "total_amount"), number, path)
        chain.fold(spark.createDataFrame(more, EVENTS), number, str(tmp_path / "c"))
    assert all(len(b) <= 2 for b in ledger.store(spark, path).manifest().tables["entries"].values())
    want = keep.batch_totals(spark.createDataFrame(rows, CHANGES), "customer_id", "total_amount")
    assert bag(keep.ledger_totals(spark, "customer_id", "total_amount", path)) == bag(want)
    assert bag(chain.read_log(spark, str(tmp_path / "c"))) == bag(keep.audit_log(spark.createDataFrame(events, EVENTS)))


@pytest.mark.parametrize("seed", [3, 4])
def test_ratings_take_the_old_one_out(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(entry, version, None if entry % 17 == 0 else rng.randrange(4), None if rng.random() < 0.2 else rng.randrange(1, 6))
            for entry in range(80) for version in range(rng.randrange(1, 4))]
    ledger, path = keep.ratings_ledger("restaurant_id"), str(tmp_path / "r")
    for number, some in enumerate(batches(rows, seed)):
        ledger.fold(spark.createDataFrame(some, FEED), number, path)
    want = keep.ratings(spark.createDataFrame(rows, FEED), "restaurant_id")
    assert bag(keep.ledger_ratings(spark, "restaurant_id", path)) == bag(want)
    # One entry changes: one delta, so one bucket of each table.
    before = ledger.store(spark, path).manifest()
    ledger.fold(spark.createDataFrame([(3, 9, 2, 5)], FEED), 99, path)
    after = ledger.store(spark, path).manifest()
    assert sum(after.tables["entries"][b] != before.tables["entries"].get(b) for b in after.tables["entries"]) == 1


def status_rows(seed, n=240):
    """Events of a few orders, one of them with a third of all, with equal times and unchanged states."""
    rng = random.Random(seed)
    states = ["Placed", "Confirmed", "Preparing", "Delivered", "Cancelled"]
    return [(i, 0 if i % 3 == 0 else rng.randrange(1, 15), rng.choice(states), at(rng.randrange(60)), rng.randrange(500))
            for i in range(n)]


@pytest.mark.parametrize("seed", [7, 8])
def test_the_log_is_that_of_all_events(spark, tmp_path, seed):
    rows, path, taken = status_rows(seed), str(tmp_path / "c"), []
    for number, some in enumerate(batches(rows, seed)):
        taken += some
        chain.fold(spark.createDataFrame(some, EVENTS), number, path)
        once = spark.createDataFrame(sorted(set(taken)), EVENTS)
        assert bag(chain.read_log(spark, path)) == bag(keep.audit_log(once))


def test_a_late_event_changes_its_own_order_only(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [(i, i % 40, "Placed" if i < 40 else "Delivered", at(i), 1) for i in range(80)]
    chain.fold(spark.createDataFrame(rows, EVENTS), 0, path)
    before = bag(chain.read_log(spark, path))
    store = state.Store(spark, path, chain.BUCKETS)
    first = store.manifest()
    chain.fold(spark.createDataFrame([(500, 5, "Confirmed", at(6), 1), rows[3]], EVENTS), 1, path)
    after, second = bag(chain.read_log(spark, path)), store.manifest()
    assert before - after == Counter([(5, "Placed", "Delivered", at(45))])
    assert after - before == Counter([(5, "Placed", "Confirmed", at(6)), (5, "Confirmed", "Delivered", at(45))])
    assert sum(second.tables["log"][b] != first.tables["log"][b] for b in second.tables["log"]) == 1
    assert all("/log/" in f for f in chain.read_log(spark, path).inputFiles())


def test_the_monitor_counts_the_newest_state(spark, tmp_path):
    rows, path = status_rows(9), str(tmp_path / "m")
    for number, some in enumerate(batches(rows, 9)):
        keep.NEWEST.fold(spark.createDataFrame(some, EVENTS), number, path)
    want = keep.live_monitor(spark.createDataFrame(rows, EVENTS))
    assert bag(keep.ledger_monitor(spark, path).select(*want.columns)) == bag(want)


def test_late_events_are_counted_and_marked(spark, tmp_path):
    base = str(tmp_path)
    pieces = [[(1, 1, "Placed", at(5), 10), (2, 1, "Placed", at(50), 20)], [(3, 1, "Placed", at(200), 5)],
              [(4, 1, "Placed", at(20), 7), (1, 1, "Placed", at(5), 10)]]
    for rows in pieces:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{base}/in")
        demand = keep.Demand(times=2)
        demand.fold(keep.file_stream(spark, f"{base}/in", spark.createDataFrame([], EVENTS).schema), f"{base}/d", f"{base}/cp")
    got = {r.window_start: (r.events, r.cents, r.late, r.is_closed) for r in demand.windows(spark, f"{base}/d").collect()}
    assert got == {at(-60): (3, 37, 1, True), at(0): (3, 37, 1, True), at(120): (1, 5, 0, False), at(180): (1, 5, 0, False)}
    every = spark.createDataFrame([r for rows in pieces[:2] for r in rows] + pieces[2][:1], EVENTS)
    want = bag(keep.demand_windows(every, "2 hours", "1 hour"))
    assert bag(demand.windows(spark, f"{base}/d").select("window_start", "window_end", "events", "cents")) == want


def test_ledgers_without_events(spark, tmp_path):
    ledger, path = keep.totals_ledger("customer_id", "total_amount"), str(tmp_path / "l")
    assert keep.ledger_totals(spark, "customer_id", "total_amount", path).collect() == []
    empty = keep.deliveries_of(spark.createDataFrame([], CHANGES), "customer_id", "total_amount")
    ledger.fold(empty, 0, path)
    assert ledger.entries(spark, path).collect() == []
    assert keep.ledger_totals(spark, "customer_id", "total_amount", path).dtypes == keep.batch_totals(
        spark.createDataFrame([], CHANGES), "customer_id", "total_amount").dtypes
    chain.fold(spark.createDataFrame([], EVENTS), 0, str(tmp_path / "c"))
    assert chain.read_log(spark, str(tmp_path / "c")).collect() == []
    assert keep.Demand().windows(spark, str(tmp_path / "d")).collect() == []
