"""Files whose columns change, and a journal that is fed by files."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from stockledger.plans import lakehouse
from stockledger.sources import published
from stockledger.sources import tables as lake
from stockledger.streaming import drift, journal
from tests.rows import day, frame
from tests.test_published import JOURNAL


def drop(spark, folder, name, schema, rows):
    frame(spark, schema, rows).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, folder, **more):
    query = drift.start_drift_ingest(spark, f"{folder}/in", f"{folder}/out", f"{folder}/progress", **more)
    query.awaitTermination()


def table(spark, folder):
    rows = published.read(spark, f"{folder}/out")
    return rows.columns, sorted((tuple(r) for r in rows.collect()), key=str)


def rejected(spark, folder):
    rows = published.read(spark, f"{folder}/out", drift.REJECTED)
    return sorted((r.file.split("/in/")[1].split("/")[0], r.reason) for r in rows.collect()) if rows else []


def test_layouts_of_one_folder(spark, tmp_path):
    folder = str(tmp_path)
    there = f"{folder}/in"
    drop(spark, there, "a", "id long, qty long", [(1, 10), (2, None)])
    drop(spark, there, "b", "QTY int, note string, Id int", [(5, "x", 3)])
    run(spark, folder)
    assert table(spark, folder) == (["id", "qty", "note"], [(1, 10, None), (2, None, None), (3, 5, "x")])
    # a wider number, a text for a number, a name twice, no Parquet at all; and one more column
    drop(spark, there, "c", "id double, qty long", [(1.5, 1)])
    drop(spark, there, "d", "id string", [("x",)])
    (tmp_path / "in" / "e").mkdir()
    (tmp_path / "in" / "e" / "f.parquet").write_bytes(b"no parquet")
    drop(spark, there, "g", "note string, price double", [("y", 2.5)])
    for _ in range(2):
        run(spark, folder)
        assert table(spark, folder) == (
            ["id", "qty", "note", "price"],
            [(1, 10, None, None), (2, None, None, None), (3, 5, "x", None), (None, None, "y", 2.5)],
        )
        found = rejected(spark, folder)
        assert [name for name, _ in found] == ["c", "d", "e"]
        assert found[0][1] == "id: double for bigint" and found[1][1] == "id: string for bigint"
        assert found[2][1].startswith("not readable")


def test_only_files_that_do_not_fit(spark, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.parquet").write_bytes(b"nothing")
    run(spark, folder)
    assert published.read(spark, f"{folder}/out") is None
    assert len(published.read(spark, f"{folder}/out", drift.REJECTED).collect()) == 1
    drop(spark, f"{folder}/in", "a", "id long", [(1,)])
    run(spark, folder)
    assert table(spark, folder) == (["id"], [(1,)])


def test_columns_that_differ_by_case(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"id": [1], "ID": [2]}), tmp_path / "x.parquet")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        drift.take_files(spark, f"{tmp_path}/out", [f"{tmp_path}/x.parquet"], "b")
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert published.read(spark, f"{tmp_path}/out", drift.REJECTED).first().reason == "id: two columns of this name"


def test_a_batch_that_fails_is_taken_again_once(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    for k in range(3):
        drop(spark, f"{folder}/in", f"f{k}", "id long", [(k,)])
    real, calls = published.publish, []

    def dies(*args, **named):
        calls.append(1)
        version = real(*args, **named)
        if len(calls) == 2:  # applied, and the stream does not know
            raise RuntimeError("lost")
        return version

    monkeypatch.setattr(published, "publish", dies)
    with pytest.raises(StreamingQueryException):
        run(spark, folder, files_per_batch=1)
    run(spark, folder, files_per_batch=1)
    assert table(spark, folder) == (["id"], [(0,), (1,), (2,)])


def journal_lines(seed, n):
    r = random.Random(seed)
    return [(f"J{k}", day(f"2025-{r.randrange(1, 4):02d}-{r.randrange(1, 28):02d}") if k % 9 else None, r.choice("123")) for k in range(n)]


@pytest.mark.parametrize("lookback", [20, 400])
def test_stream_and_batches_give_one_journal(spark, tmp_path, lookback):
    stream, batch = f"{tmp_path}/stream", f"{tmp_path}/batch"
    lines = sorted(journal_lines(1, 60), key=lambda x: (x[1] or day("2025-02-01"), x[0]))
    parts = [lines[:20], lines[15:40], lines[38:50] + lines[2:5], lines[45:] + [("too late", day("2025-01-01"), "1")]]
    for root in (stream, batch):
        lake.write_table(
            frame(spark, "account_id string, account_name string, account_type string", [(a, "n", "Opex") for a in "12"]), root, "bronze", "gl_accounts"
        )
        lake.write_table(
            frame(spark, "cost_center_id string, cost_center_name string, org string, region_code string", [("C", "n", "o", "r")]), root, "bronze", "cost_centers"
        )
    schema = frame(spark, JOURNAL, []).schema
    so_far = {}
    for k, part in enumerate(parts):
        rows = [(j, d, a, "C", 1.0, "s", "r", "m") for j, d, a in part]
        frame(spark, JOURNAL, rows + rows[:2]).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        query = journal.start_journal(spark, stream, f"{tmp_path}/in/*", f"{tmp_path}/progress", schema, lookback)
        query.awaitTermination()
        so_far |= {row[0]: row for row in rows}
        lake.write_table(frame(spark, JOURNAL, list(so_far.values())), batch, "bronze", "gl_journal")
        lakehouse.append_journal(spark, batch, lookback)
    found = {}
    for root in (stream, batch):
        path = lake.table_path(root, "silver", "stg_gl_journal")
        found[root] = [
            sorted(map(str, published.read(spark, path, area).collect())) for area in (published.DATA, lakehouse.WAITING)
        ]
    assert found[stream] == found[batch] and all(found[stream])
    late = published.read(spark, lake.table_path(stream, "silver", "stg_gl_journal"), lakehouse.LATE)
    loaded = published.read(spark, lake.table_path(stream, "silver", "stg_gl_journal"))
    wait = published.read(spark, lake.table_path(stream, "silver", "stg_gl_journal"), lakehouse.WAITING)
    ids = [r.journal_id for df in (late, loaded, wait) for r in df.select("journal_id").collect()]
    # every line is in one place
    assert sorted(ids) == sorted(so_far)
    assert (late.where(F.col("journal_id") == "too late").count() == 1) is (lookback == 20)
