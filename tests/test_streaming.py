"""The event stream against the same events as a table: order, lateness, repeats, restarts."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest

from clientbook import Portfolio
from clientbook.config import EVENT_CONFIG as CFG
from clientbook.operators import daily
from clientbook.sources import events as source
from clientbook.streaming import activity_stream, cliff_stream
from clientbook.streaming.batch_table import BatchTable

START = dt.datetime(2024, 1, 10)


def made_up(n=600, users=12, seed=5):
    """(event_id, ts, user_id, event_type, value) over three weeks; one user sends a third of all."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        user = 1 if i % 3 == 0 else draw.randint(2, users)
        # Half of the users fall silent after two weeks.
        days = draw.random() * (13 if user % 2 else 20.9)
        value = None if i % 50 == 0 else round(draw.random() * 100, 2)
        rows.append((i, START + dt.timedelta(days=days), user, draw.choice(["click", "view", "error"]), value))
    return rows


def write_file(spark, rows, path):
    spark.createDataFrame(rows, source.COLUMNS).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def rows():
    return made_up()


@pytest.fixture(scope="module")
def batch_days(spark, rows):
    facts = source.transactions(spark.createDataFrame(rows, source.COLUMNS))
    return {r[:4]: r[4:] for r in map(tuple, daily.roll_up(facts).select(*daily.KEYS, *daily.AMOUNTS).collect())}


def run(spark, folder, updates_of, write, files_per_batch=1):
    updates = updates_of(activity_stream.open_events(spark, f"{folder}/feed", files_per_batch))
    return activity_stream.run_available(updates, write, f"{folder}/checkpoint")


def days_of(table):
    return {r[:4]: r[4:] for r in map(tuple, table.current().select(*daily.KEYS, *daily.AMOUNTS).collect())}


def daily_of(events):
    return activity_stream.daily_updates(events, "30 days")


@pytest.fixture(scope="module")
def schema(spark, tmp_path_factory):
    return activity_stream.daily_updates(spark.readStream.schema(source.COLUMNS).parquet(str(tmp_path_factory.mktemp("none"))), "1 day").schema


@pytest.mark.parametrize("order", ["as they come", "backwards", "one late file"])
def test_stream_equals_batch_in_any_order(spark, rows, batch_days, schema, tmp_path, order):
    by_time = sorted(rows, key=lambda r: r[1])
    parts = [by_time[k * 150 : (k + 1) * 150] for k in range(4)]
    if order == "backwards":
        parts.reverse()
    if order == "one late file":
        parts = parts[1:] + parts[:1]
    table = BatchTable(spark, f"{tmp_path}/days", schema, daily.KEYS)
    for part in parts:
        # Ten events of each file are delivered twice.
        write_file(spark, part + part[:10], f"{tmp_path}/feed")
    run(spark, tmp_path, daily_of, table.write)
    assert days_of(table) == batch_days


def test_a_resumed_stream_only_adds_what_is_new(spark, rows, batch_days, schema, tmp_path):
    table = BatchTable(spark, f"{tmp_path}/days", schema, daily.KEYS)
    write_file(spark, rows[:300], f"{tmp_path}/feed")
    run(spark, tmp_path, daily_of, table.write)
    before = days_of(table)
    assert before != batch_days
    run(spark, tmp_path, daily_of, table.write)
    assert days_of(table) == before
    write_file(spark, rows[300:] + rows[:50], f"{tmp_path}/feed")
    run(spark, tmp_path, daily_of, table.write)
    assert days_of(table) == batch_days


def test_events_beyond_the_lateness_are_counted(spark, schema, tmp_path):
    def event(i, day):
        return (i, START + dt.timedelta(days=day), 7, "click", 1.0)

    table = BatchTable(spark, f"{tmp_path}/days", schema, daily.KEYS)

    def updates_of(events):
        return activity_stream.daily_updates(events, "2 days")

    write_file(spark, [event(1, 0), event(2, 10)], f"{tmp_path}/feed")
    assert activity_stream.too_late(run(spark, tmp_path, updates_of, table.write)) == 0
    write_file(spark, [event(3, 1), event(4, 9)], f"{tmp_path}/feed")
    assert activity_stream.too_late(run(spark, tmp_path, updates_of, table.write)) == 1
    assert sum(amounts[0] for amounts in days_of(table).values()) == 3


def facts(spark, rows):
    events = spark.createDataFrame(rows, source.COLUMNS)
    return source.customers(events), source.transactions(events)


def plain(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_a_batch_that_is_repeated_changes_nothing(spark, rows, tmp_path):
    people, transactions = facts(spark, rows)
    batch = Portfolio(people, transactions, CFG)
    for part in (rows[:200], rows[200:400], rows[400:]):
        write_file(spark, part, f"{tmp_path}/feed")
    updates = daily_of(activity_stream.open_events(spark, f"{tmp_path}/feed", 1))
    book = activity_stream.StreamedBook(people, f"{tmp_path}/store", CFG, updates)
    book.start()
    assert book.served().customer_360().count() == people.count()
    activity_stream.run_available(updates, book.write, f"{tmp_path}/checkpoint")
    served = plain(book.served().customer_360())
    assert served == plain(batch.customer_360())
    assert plain(book.served().executive_kpis()) == plain(batch.executive_kpis())
    # The last commits get lost: those batches run once more, under the same ids.
    commits = f"{tmp_path}/checkpoint/commits"
    last = sorted((int(n) for n in os.listdir(commits) if n.isdigit()))[-1]
    os.remove(f"{commits}/{last}")
    crc = f"{commits}/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    calls = []
    updates = daily_of(activity_stream.open_events(spark, f"{tmp_path}/feed", 1))
    activity_stream.run_available(updates, lambda df, i: (calls.append(i), book.write(df, i)), f"{tmp_path}/checkpoint")
    assert calls == [last]
    # So does any batch written by hand again.
    again = book.days.of_batch(1)
    book.write(spark.createDataFrame(again.collect(), again.schema), 1)
    assert plain(book.served().customer_360()) == served


@pytest.mark.parametrize("day", [dt.date(2024, 1, 22), dt.date(2024, 1, 26), dt.date(2024, 1, 30)])
def test_cliffs_fire_for_the_customers_of_the_batch_alert(spark, rows, cliffs, day):
    people, transactions = facts(spark, rows)
    cfg = CFG.at(day)
    batch = {
        (r.customer_id, r.txn_delta_pct)
        for r in Portfolio(people, transactions, cfg).profile.join(
            Portfolio(people, transactions, cfg).exceptions_of(cliff_stream.ALERT).select("customer_id"), "customer_id"
        ).collect()
    }
    fired = {(r.customer_id, r.txn_delta_pct) for r in cliffs if r.snapshot_date == day and r.fires}
    assert fired == batch
    if day != dt.date(2024, 1, 22):
        assert fired


@pytest.fixture(scope="module")
def cliffs(spark, rows, tmp_path_factory):
    """All windows of the stream, events in three files in no order of time."""
    folder = str(tmp_path_factory.mktemp("cliffs"))
    for k in range(3):
        write_file(spark, rows[k::3] + rows[:5], f"{folder}/feed")
    updates = cliff_stream.cliff_updates(activity_stream.open_events(spark, f"{folder}/feed", 1), CFG, "30 days")
    table = BatchTable(spark, f"{folder}/cliffs", updates.schema, cliff_stream.KEYS)
    activity_stream.run_available(updates, table.write, f"{folder}/checkpoint")
    return table.current().collect()


def test_an_alert_is_withdrawn_when_the_day_fills_up(spark, tmp_path):
    def events(first, days, n):
        return [(first + i, START + dt.timedelta(days=days, minutes=i), 1, "click", 50.0) for i in range(n)]

    def updates_of(stream):
        return cliff_stream.cliff_updates(stream, CFG, "30 days")

    updates = updates_of(spark.readStream.schema(source.COLUMNS).parquet(str(tmp_path)))
    table = BatchTable(spark, f"{tmp_path}/cliffs", updates.schema, cliff_stream.KEYS)

    def fires():
        day = (START + dt.timedelta(days=9)).date()
        return [r.fires for r in table.current().filter(f"snapshot_date = DATE'{day}'").collect()]

    write_file(spark, events(0, 1, 30) + events(100, 9, 12), f"{tmp_path}/feed")
    run(spark, tmp_path, updates_of, table.write)
    assert fires() == [True]
    write_file(spark, events(200, 9.1, 18), f"{tmp_path}/feed")
    run(spark, tmp_path, updates_of, table.write)
    assert fires() == [False]


def test_no_events_at_all(spark, schema, tmp_path):
    write_file(spark, [], f"{tmp_path}/feed")
    table = BatchTable(spark, f"{tmp_path}/days", schema, daily.KEYS)
    assert table.current().collect() == []
    run(spark, tmp_path, daily_of, table.write)
    assert days_of(table) == {}
