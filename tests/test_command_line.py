"""Loading bulk files and showing reports from the command line."""

import pytest

import changetide.__main__ as command
from changetide.__main__ import main
from changetide.sources import segment_messages, write_segments
from changetide.spec import MESSAGE_SCHEMA


def test_load_then_report(spark, tmp_path, capsys):
    data = tmp_path / "data"
    data.mkdir()
    (data / "orders.csv").write_text(
        "order_id,user_id,order_dow,order_hour_of_day\n"
        + "".join(f"{i},{i},{i % 7},{i % 24}\n" for i in range(30)))
    (data / "order_products__train.csv").write_text(
        "order_id,product_id,add_to_cart_order,reordered\n"
        + "".join(f"{i},{i % 3},1,0\n" for i in range(50)))
    base = str(tmp_path / "base")
    main(["load", "--base", base, "--data-dir", str(data), "--limit", "20"])
    shown = capsys.readouterr().out
    assert "|orders        |20" in shown and "|order_products|50" in shown
    main(["report", "--base", base, "--demo", "analytics"])
    shown = capsys.readouterr().out
    assert "analytics: top_products" in shown and "|0         |17 |" in shown
    assert "overview" not in shown
    main(["verify", "--base", base, "--data-dir", str(data), "--limit", "25"])
    shown = capsys.readouterr().out
    assert "|equal  |20" in shown and "|missing|5" in shown
    assert "|0       |0           |0            |true" in shown


def test_unknown_report_is_refused(spark):
    with pytest.raises(SystemExit):
        main(["report", "--base", "x", "--demo", "nothing"])


def test_ingest_shows_progress_until_it_is_stopped(spark, tmp_path, monkeypatch, capsys):
    base, shown = str(tmp_path / "base"), []

    def messages(session, servers, topic):
        folder = f"{tmp_path}/{topic}"
        rows = [(f'{{"order_id": {i}, "id": {i}, "product_id": {i}, "__op": "c", "__source_ts_ms": {i}}}', None, topic, 0, i) for i in range(5)]
        write_segments(session.createDataFrame(rows, MESSAGE_SCHEMA), folder)
        return segment_messages(session, folder)

    def latest(logs):
        found = reports_latest(logs)
        shown.append(sorted((r.table_name, r.batch_id, r.n_total) for r in found.collect()))
        if len(shown[-1]) == 3 or len(shown) > 60:
            raise KeyboardInterrupt
        return found

    reports_latest = command.reports.latest_batches
    monkeypatch.setattr(command, "kafka_messages", messages)
    monkeypatch.setattr(command.reports, "latest_batches", latest)
    main(["ingest", "--base", base, "--servers", "none", "--prefix", "p", "--database", "d", "--trigger", "1 second", "--progress", "1"])
    assert shown[-1] == [("order_products", 0, 5), ("orders", 0, 5), ("products", 0, 5)]
    assert not spark.streams.active
    monkeypatch.undo()
    main(["report", "--base", base, "--demo", "consistent"])
    assert "consistent: rows" in capsys.readouterr().out
