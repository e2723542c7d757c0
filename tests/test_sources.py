import datetime as dt
import os
import xml.etree.ElementTree as ET
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerflow.plans.review import with_attachment
from ledgerflow.plans.run import error_return
from ledgerflow.sources.attachments import scan_attachments
from ledgerflow.sources.rowset import empty_files, read_rowset, route, with_line_id
from ledgerflow.sources.sinks import append, append_batch, overwrite, write_error_files
from ledgerflow.streaming.intake import intake_stream, start_intake

HEAD = '<xml xmlns:rs="urn:schemas-microsoft-com:rowset" xmlns:z="#RowsetSchema"><rs:data>'
TAIL = "</rs:data></xml>"
COLUMNS = ("Action", "Comp_Serial", "BAN")


def rowset(path: Path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    body = "".join(
        "<z:row " + " ".join(f'{k}="{v}"' for k, v in r.items()) + "/>" for r in records
    )
    staged = path.with_suffix(".part")
    staged.write_text(HEAD + body + TAIL)
    staged.rename(path)


@pytest.fixture
def inbox(tmp_path):
    rowset(
        tmp_path / "in/02_Seeds/a.xml",
        [{"Action": " Seed ", "Comp_Serial": "S1", "BAN": "1 &amp; 2"}, {"Comp_Serial": "S2"}],
    )
    rowset(tmp_path / "in/04_Dispute-Actions/b.xml", [{"Action": "Close", "Comp_Serial": "S1", "Other": "x"}])
    return tmp_path / "in"


def test_read_and_route(spark, rows, inbox):
    df = read_rowset(spark, f"{inbox}/*", COLUMNS)
    assert rows(df, "Folder_Rank", "Folder_Name", "Comp_Serial", "BAN") == [
        (2, "02_Seeds", "S1", "1 & 2"),
        (2, "02_Seeds", "S2", None),
        (4, "04_Dispute-Actions", "S1", None),
    ]
    slices = route(df)
    assert list(slices)[0] == "01_BMI-PCI"
    assert {k: v.count() for k, v in slices.items()} == {
        "01_BMI-PCI": 0,
        "02_Seeds": 2,
        "03_Non-Seeds": 0,
        "04_Dispute-Actions": 1,
    }
    numbered = with_line_id(df)
    ids = [r[0] for r in numbered.select("Line_ID").collect()]
    assert len(set(ids)) == 3 and sorted(ids) == sorted(r[0] for r in numbered.select("Line_ID").collect())


def test_files_without_rows_are_reported(spark, inbox):
    (inbox / "02_Seeds/broken.xml").write_text(HEAD + '<z:row Action="x" ')
    df = read_rowset(spark, f"{inbox}/*", COLUMNS)
    found = [r[0] for r in empty_files(df, spark, str(inbox)).select("File_Path").collect()]
    assert [os.path.basename(f) for f in found] == ["broken.xml"]


def test_attachments_pick_the_newest_of_the_exact_source(spark, rows, tmp_path):
    stamps = {"BMI_12.pdf": 10, "BMI_12_new.txt": 30, "BMI_12-old.txt": 20, "BMI_123.pdf": 99, "note.txt": 99}
    for name, stamp in stamps.items():
        f = tmp_path / name
        f.write_text("x")
        os.utime(f, (1_700_000_000 + stamp, 1_700_000_000 + stamp))
    files = scan_attachments(spark, str(tmp_path))
    assert files.count() == 4 and "content" not in files.columns
    sub = spark.createDataFrame([("BMI", "12"), ("BMI", "1"), ("PCI", "12")], "Source_TBL string, Source_ID string")
    got = rows(with_attachment(sub, files), "Source_TBL", "Source_ID", "CSR_File_Name")
    assert got == [("BMI", "1", None), ("BMI", "12", "BMI_12_new.txt"), ("PCI", "12", None)]


def test_table_sinks(spark, rows, tmp_path):
    df = spark.createDataFrame([("b",), ("a",)], "k string")
    append(df, f"{tmp_path}/t", ["k"])
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "linenumber", "k") == [(0, "a"), (1, "b")]
    append(df, f"{tmp_path}/u")
    append(df, f"{tmp_path}/u")
    assert spark.read.parquet(f"{tmp_path}/u").count() == 4
    overwrite(df, f"{tmp_path}/u")
    assert spark.read.parquet(f"{tmp_path}/u").count() == 2
    append_batch(df, f"{tmp_path}/v", 1)
    append_batch(df, f"{tmp_path}/v", 2)
    append_batch(df, f"{tmp_path}/v", 2)
    assert spark.read.parquet(f"{tmp_path}/v").count() == 4


def test_error_files_hold_every_rejected_row(spark, tmp_path):
    schema = "Comp_Serial string, BAN string, State string, Error_Columns string, Error_Message string"
    data = [("S1", "1 < 2", None, "BAN", f"bad {i}") for i in range(50)]
    data += [("S2", "", "TX", "BAN", "bad"), ("S3", "ok", "TX", None, None)]
    df = spark.createDataFrame(data, schema)
    errors, counts = error_return({"02_Seeds": df, "03_Non-Seeds": df.limit(0)})
    assert {r["Comp_Serial"]: r["N_Error"] for r in counts.collect()} == {"S1": 50, "S2": 1}
    write_error_files(errors, str(tmp_path / "err"))
    records = {}
    for f in (tmp_path / "err").rglob("part-*"):
        root = ET.parse(f).getroot()
        assert root.tag == "records"
        for record in root:
            fields = {v.get("var_name"): v.text for v in record}
            assert f.parent.name == f"Comp_Serial={fields['Comp_Serial']}"
            records.setdefault(fields["Comp_Serial"], []).append(fields)
    assert len(records["S1"]) == 50 and records["S1"][0]["BAN"] == "1 < 2"
    assert records["S2"] == [
        {"Folder_Name": "02_Seeds", "State": "TX", "Error_Columns": "BAN", "Error_Message": "bad", "Comp_Serial": "S2"}
    ]
    assert "State" not in records["S1"][0] and "S3" not in records


def test_stream_serves_each_file_once_and_replays_cleanly(spark, inbox, tmp_path):
    seen = []

    def handler(batch, batch_id):
        counts = {r[0]: r[1] for r in batch.groupBy("Folder_Name").count().collect()}
        seen.append(counts)
        append_batch(batch, f"{tmp_path}/out", batch_id)

    def run():
        stream = intake_stream(spark, str(inbox), COLUMNS)
        query = start_intake(stream, f"{tmp_path}/ckpt", handler)
        assert query.awaitTermination(120)

    run()
    rowset(inbox / "02_Seeds/c.xml", [{"Action": "Seed", "Comp_Serial": "S9"}])
    run()
    run()
    assert seen == [{"02_Seeds": 2, "04_Dispute-Actions": 1}, {"02_Seeds": 1}]
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4


def test_stream_drops_copies_within_the_delay_when_asked(spark, tmp_path):
    stamp = dt.datetime(2024, 1, 1).isoformat(sep=" ")
    row = {"Action": "Seed", "Comp_Serial": "S1", "BAN": stamp}
    rowset(tmp_path / "in/02_Seeds/a.xml", [row, row, {**row, "Comp_Serial": "S2"}])
    stream = intake_stream(spark, f"{tmp_path}/in", COLUMNS, once_within=("BAN", "1 hour"))
    got = []
    query = start_intake(stream, f"{tmp_path}/ckpt", lambda b, i: got.extend(b.select("Comp_Serial").collect()))
    assert query.awaitTermination(120)
    assert sorted(r[0] for r in got) == ["S1", "S2"]


def test_child_elements_and_other_row_tags(spark, rows, tmp_path):
    (tmp_path / "a.xml").write_text(
        HEAD + '<z:item Action="Map"><BAN> 5 </BAN></z:item><z:item Comp_Serial="S1"/>' + TAIL
    )
    df = read_rowset(spark, f"{tmp_path}/a.xml", COLUMNS, row_tag="z:item")
    assert [tuple(r) for r in df.select(*COLUMNS).orderBy("Action").collect()] == [
        (None, "S1", None),
        ("Map", None, "5"),
    ]


def test_truncated_row_does_not_hide_good_ones(spark, inbox):
    good = read_rowset(spark, f"{inbox}/02_Seeds", COLUMNS)
    assert good.filter(F.col("Comp_Serial").isNotNull()).count() == 2
