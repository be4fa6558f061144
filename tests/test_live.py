"""Running totals in the state store: equal to the batch query, over restarts and replays."""

import os

import pytest

from tallyhouse.sources.events import parse_events, read_events_stream
from tallyhouse.sources.metric_store import read_metric
from tallyhouse.streaming.live import LIVE_TABLE, read_live_totals, run_live_totals, totals_by_category
from test_stream import finish


def _add(folder, n, lines):
    part = folder / f"part-{n}.json"
    part.write_text("\n".join(lines))
    os.utime(part, (1_700_000_000 + n, 1_700_000_000 + n))


def _event(customer, gender, amount, place="north", age=30):
    return (
        f'{{"Customer ID": {customer}, "Gender": "{gender}", "Order ID": "o{customer}", "Age": {age}, '
        f'"Total Sales Amount": {amount}, "Quantity Sold": 2, "Location/Store": "{place}"}}'
    )


def _plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("compact_every", [100, 2])
def test_totals_survive_restarts(spark, tmp_path, compact_every):
    inbox, root, checkpoint = tmp_path / "in", str(tmp_path / "live"), str(tmp_path / "c")
    inbox.mkdir()

    def run():
        messages = read_events_stream(spark, "text", path=str(inbox), maxFilesPerTrigger="1")
        finish(run_live_totals(messages, root, checkpoint, available_now=True, compact_every=compact_every))

    def expected():
        return _plain(totals_by_category(parse_events(spark.read.text(str(inbox)))))

    _add(inbox, 0, [_event(1, "male", 10.25), _event(2, "female", 5), "{broken"])
    _add(inbox, 1, [_event(1, "male", 1), _event(3, "male", 0.1, "south", 70)])
    run()
    assert _plain(read_live_totals(spark, root)) == expected()
    _add(inbox, 2, [_event(4, "other", 2.5)])
    _add(inbox, 3, [_event(5, "female", 2.5)])
    run()
    run()
    assert _plain(read_live_totals(spark, root)) == expected()
    # Update mode: the batch of the newest file gave out only what it changed
    newest = read_metric(spark, root, LIVE_TABLE, latest=True)
    assert {r.value for r in newest.where("category = 'gender'").collect()} == {"female"}
    with pytest.raises(ValueError, match="one root per checkpoint"):
        run_live_totals(read_events_stream(spark, "text", path=str(inbox)), root, str(tmp_path / "d"))
