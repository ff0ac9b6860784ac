import json
import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest

from creditlake.operators.alerts import score_alerts
from creditlake.sources.io import append_jsonl, read_jsonl
from creditlake.sources.schemas import STREAM_ALERT, STREAM_EVENT
from creditlake.streaming.alerts import all_alerts, end_period, read_alerts, read_events, read_log, start_alerts
from creditlake.streaming.log import runs

COLUMNS = "event_id transaction_id customer_id event_time transaction_type amount channel merchant_category".split()
START = datetime(2024, 1, 1)


def events(n, seed, first=0):
    rng = random.Random(seed)
    kinds = ["cash_out", "CASH_OUT", "transfer", "cash_in"]
    amounts = ["150000", "149999.99", "80000.00", "79999", "100", "junk"]
    out = []
    for i in range(first, first + n):
        customer = "hot" if rng.random() < 0.4 else f"c{rng.randrange(8)}"
        out.append(
            (f"E{i:05d}", f"T{i}", customer, START + timedelta(seconds=i // 3), rng.choice(kinds), rng.choice(amounts), "app", "x")
        )
    return out


def sequential(rows, threshold, known=(), counts=None):
    """One event after the other: the definition of the alerts."""
    counts, known, out = dict(counts or {}), set(known), []
    for event_id, transaction, customer, _, kind, amount, *_ in rows:
        number = Decimal(amount) if amount != "junk" else Decimal(0)
        cash_out = kind.lower() == "cash_out"
        score = 20 + (45 if number >= 150000 else 25 if number >= 80000 else 0) + (15 if cash_out else 0)
        score = min(score + min(5 * counts.get(customer, 0), 20), 99)
        name = f"STREAM-{event_id}"
        if score >= threshold and name not in known:
            rule = "risky_cash_out" if cash_out and number >= 80000 else "high_value_transaction"
            counts[customer] = counts.get(customer, 0) + 1
            known.add(name)
            out.append((name, transaction, customer, rule, score, "OPEN"))
    return sorted(out)


def frame(spark, rows):
    schema = "event_id string, transaction_id string, customer_id string, event_time timestamp, transaction_type string, amount string, channel string, merchant_category string"
    return spark.createDataFrame(rows, schema).repartition(5)


def result(alerts):
    return sorted(tuple(r) for r in alerts.drop("alert_time").collect())


@pytest.mark.parametrize("threshold", [20, 45, 60, 75, 80, 85, 99, 100])
def test_alerts_match_a_sequential_pass(spark, threshold):
    rows = events(400, threshold)
    assert result(score_alerts(frame(spark, rows), threshold)) == sequential(rows, threshold)


def test_known_alerts_and_prior_counts(spark):
    rows = events(300, 5)
    known = [f"STREAM-E{i:05d}" for i in range(0, 300, 4)]
    counts = {"hot": 2, "c1": 9}
    found = score_alerts(
        frame(spark, rows),
        60,
        spark.createDataFrame([(k,) for k in known], "alert_id string"),
        spark.createDataFrame(list(counts.items()), "customer_id string, alerts int"),
    )
    assert result(found) == sequential(rows, 60, known, counts)


def test_memory_of_one_customer(spark):
    kinds = ["cash_out", "cash_out", "cash_out", "transfer"]
    rows = [(f"E{i}", f"T{i}", "c", START + timedelta(seconds=i), k, "80000", "a", "b") for i, k in enumerate(kinds)]
    assert [r[4] for r in result(score_alerts(frame(spark, rows), 60))] == [60, 65, 70, 60]


def test_repeated_event_ids_count_once(spark):
    rows = events(60, 9)
    assert result(score_alerts(frame(spark, rows + rows), 60)) == sequential(rows, 60)


def write_events(folder, rows, name):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w") as out:
        for row in rows:
            out.write(json.dumps({c: str(v) for c, v in zip(COLUMNS, row)}) + "\n\n")


def stream(spark, folder, threshold=60, files=1000, **options):
    """Run the job over what is in ``folder``/in, to its end."""
    events = read_events(spark, str(folder / "in"), files)
    options = {"delay": "10 seconds", "partitions": 2} | options
    job = start_alerts(events, str(folder / "out"), str(folder / "progress"), threshold, **options)
    job.awaitTermination()
    return job


def close(spark, folder, until, delay="10 seconds"):
    end_period(spark, str(folder / "in"), until.replace(tzinfo=timezone.utc), delay)


def streamed(spark, folder):
    return result(read_alerts(spark, str(folder / "out")))


def test_stream_equals_batch_and_restarts_without_repeats(spark, tmp_path):
    rows = events(240, 3)
    for day in range(2):
        write_events(tmp_path / "in", rows[day * 90 : day * 90 + 90], f"{day}.json")
        stream(spark, tmp_path)
    # What the watermark has not passed is still waiting.
    assert set(streamed(spark, tmp_path)) < set(sequential(rows[:180], 60))
    close(spark, tmp_path, START + timedelta(seconds=60))
    stream(spark, tmp_path)
    assert streamed(spark, tmp_path) == sequential(rows[:180], 60)
    stream(spark, tmp_path)
    assert streamed(spark, tmp_path) == sequential(rows[:180], 60)

    # Some events once more, too late, and then the rest.
    write_events(tmp_path / "in", rows[120:180], "again.json")
    stream(spark, tmp_path)
    write_events(tmp_path / "in", rows[180:], "rest.json")
    close(spark, tmp_path, START + timedelta(days=1))
    stream(spark, tmp_path)
    expected = sequential(rows[:180] + rows[120:], 60)
    assert streamed(spark, tmp_path) == expected

    log = read_log(spark, str(tmp_path / "out"))
    lines = log.collect()
    assert sum(r["events_processed"] for r in lines) == 300
    assert sum(r["alerts_emitted"] for r in lines) == len(expected)
    assert {r["threshold"] for r in lines} == {60}
    assert len({r["batch"] for r in lines}) == len(lines)
    # The run that found nothing has no batch and no line.
    assert [r["events_processed"] for r in runs(log).orderBy("first_batch").collect()] == [90, 90, 0, 60, 60]


@pytest.mark.parametrize("seed", range(3))
def test_files_in_any_order_give_the_alerts_of_the_batch(spark, tmp_path, seed):
    rows = events(240, 20 + seed)
    order = list(range(8))
    random.Random(seed).shuffle(order)
    for number, part in enumerate(order):
        write_events(tmp_path / "in", rows[part * 30 : part * 30 + 30], f"{number}.json")
    close(spark, tmp_path, START + timedelta(seconds=80), "2 minutes")
    stream(spark, tmp_path, files=3, delay="2 minutes")
    assert streamed(spark, tmp_path) == result(score_alerts(frame(spark, rows), 60)) == sequential(rows, 60)


def _last(folder):
    return max((p for p in folder.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))


@pytest.mark.parametrize("stored", [True, False])
def test_a_batch_that_was_killed_runs_again_without_repeats(spark, tmp_path, stored):
    """The driver was lost after the batch's output was stored, or before."""
    rows = events(200, 4)
    write_events(tmp_path / "in", rows[:100], "0.json")
    stream(spark, tmp_path)
    write_events(tmp_path / "in", rows[100:], "1.json")
    close(spark, tmp_path, START + timedelta(days=1))
    stream(spark, tmp_path)
    assert streamed(spark, tmp_path) == sequential(rows, 60)
    for lost in [tmp_path / "progress/commits"] + [tmp_path / "out/alerts/_spark_metadata"] * (not stored):
        last = _last(lost)
        last.unlink()
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    stream(spark, tmp_path)
    assert streamed(spark, tmp_path) == sequential(rows, 60)


def test_an_alert_is_remembered_for_good_and_late_events_are_scored(spark, tmp_path):
    """The same event forty days later, and one that comes after its time."""
    def at(name, day, kind="cash_out", amount="150000", customer="c"):
        return (name, f"T{name}{day}", customer, START + timedelta(days=day), kind, amount, "app", "x")

    first = [at("E1", 0), at("E2", 1), at("E3", 2, "transfer", "80000")]
    later = [at("E1", 40), at("E4", 41), at("E3", 42, "cash_out", "80000")]
    late = [at("E5", 3), at("E6", 2, customer="new")]
    for number, (rows, until) in enumerate(((first, 3), (later, 43), (late, 50))):
        write_events(tmp_path / "in", rows, f"{number}.json")
        close(spark, tmp_path, START + timedelta(days=until))
        stream(spark, tmp_path)
    expected = sequential(first + later + late, 60)
    assert streamed(spark, tmp_path) == expected and [r[0] for r in expected].count("STREAM-E1") == 1
    assert {"STREAM-E5", "STREAM-E6"} < {r[0] for r in expected}
    assert result(score_alerts(frame(spark, first + later), 60)) == sequential(first + later, 60)


def test_a_batch_touches_only_its_customers(spark, tmp_path):
    many = [(f"E{i}", f"T{i}", f"c{i}", START + timedelta(seconds=i), "cash_out", "150000", "app", "x") for i in range(300)]
    write_events(tmp_path / "in", many, "0.json")
    close(spark, tmp_path, START + timedelta(days=1))
    stream(spark, tmp_path)
    one = [("F1", "U1", "c7", START + timedelta(days=2), "cash_out", "150000", "app", "x")]
    write_events(tmp_path / "in", one, "1.json")
    close(spark, tmp_path, START + timedelta(days=3))
    progress = stream(spark, tmp_path).query.recentProgress
    assert sum(s["numRowsUpdated"] for p in progress for s in p["stateOperators"]) < 20
    assert streamed(spark, tmp_path)[-1][:5] == sequential(many + one, 60)[-1][:5]


def test_alerts_from_before_the_stream_are_known(spark, tmp_path):
    rows = events(120, 8)
    known = [f"E{i:05d}" for i in range(0, 120, 3)]
    write_events(tmp_path / "in", rows, "0.json")
    close(spark, tmp_path, START + timedelta(days=1))
    customers = {r[0]: r[2] for r in rows}
    stream(spark, tmp_path, known=spark.createDataFrame([(customers[k], k) for k in known], "customer_id string, event_id string"))
    assert streamed(spark, tmp_path) == sequential(rows, 60, [f"STREAM-{k}" for k in known])


def test_a_repeated_event_alerts_at_its_first_alerting_occurrence(spark, tmp_path):
    """Probe: A does not alert at first; X and Y raise the customer's state; then A does."""
    kinds = [("A", "transfer", "80000"), ("X", "cash_out", "150000"), ("Y", "cash_out", "150000"), ("A", "cash_out", "150000"), ("A", "cash_out", "150000")]
    rows = [(f"E{n}", f"T{i}", "c", START + timedelta(seconds=i), k, a, "app", "x") for i, (n, k, a) in enumerate(kinds)]
    expected = sequential(rows, 60)
    assert [r[4] for r in expected] == [90, 80, 85]
    assert result(score_alerts(frame(spark, rows), 60)) == expected
    for number, row in enumerate(rows):
        write_events(tmp_path / "in", [row], f"{number}.json")
    close(spark, tmp_path, START + timedelta(days=1))
    stream(spark, tmp_path)
    assert streamed(spark, tmp_path) == expected


def test_a_malformed_line_fails_the_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/0.json").write_text('{"event_id": "1"}\n{oops\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        stream(spark, tmp_path)


@pytest.mark.parametrize("seed", range(4))
def test_changed_repeats_match_a_sequential_pass(spark, seed):
    rng = random.Random(seed)
    rows = events(150, seed)
    later = [
        (r[0], f"{r[1]}b", r[2], START + timedelta(seconds=100 + i), rng.choice(["cash_out", "transfer"]), rng.choice(["150000", "80000", "100"]), "app", "x")
        for i, r in enumerate(rng.choices(rows, k=150))
    ]
    assert result(score_alerts(frame(spark, rows + later), 60)) == sequential(rows + later, 60)


def test_alerts_do_not_depend_on_exchange_reuse(spark):
    rows = events(300, 11)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert result(score_alerts(frame(spark, rows), 60)) == sequential(rows, 60)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_reading_before_the_first_batch(spark, tmp_path):
    assert read_alerts(spark, str(tmp_path / "none")).count() == 0


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    assert read_jsonl(spark, path, STREAM_ALERT).count() == 0
    alerts = score_alerts(frame(spark, events(50, 2)), 60)
    append_jsonl(alerts, path)
    append_jsonl(alerts, path)
    back = read_jsonl(spark, path, STREAM_ALERT)
    assert back.count() == 2 * alerts.count() > 0
    first = next(p for p in (tmp_path / "lines").glob("*.json") if p.stat().st_size).read_text().splitlines()[0]
    assert list(json.loads(first)) == sorted(json.loads(first))
    (tmp_path / "bad.json").write_text('{"event_id": "1"}\n\n{oops\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_jsonl(spark, str(tmp_path / "bad.json"), STREAM_EVENT).collect()


def test_batch_and_stream_alerts_share_a_schema(spark):
    batch = spark.createDataFrame([], "alert_id string, transaction_id string, customer_id string, alert_timestamp timestamp, rule_name string, risk_score int, alert_status string")
    stream = score_alerts(frame(spark, events(50, 2)), 60)
    assert all_alerts(batch, stream).count() == stream.count()


def test_all_events_move_the_watermark(spark, tmp_path):
    """Events that cannot alert are dropped after they have moved the watermark, not before."""
    idle = ("E9", "T9", "d", START + timedelta(seconds=500), "cash_in", "1", "app", "x")
    rows = events(30, 6)
    write_events(tmp_path / "in", [*rows, idle], "0.json")
    stream(spark, tmp_path)
    assert streamed(spark, tmp_path) == sequential(rows, 60)
