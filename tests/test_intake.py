"""Open attributes, the file ledger, sized error files, refused copies and the kept attachment listing."""

import os
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F
from test_plans import NOW, frame, tables  # noqa: F401 - the fixture
from test_sources import HEAD, TAIL, rowset

from ledgerflow.config import JobConfig
from ledgerflow.operators.keys import _below, _remove, work_dir
from ledgerflow.plans.state import load_state, save_base
from ledgerflow.sources.attachments import extend_listing, kept_listing
from ledgerflow.sources.rowset import OTHER_VALUES, UNREAD, attribute_names, literal_path, read_open_rowset
from ledgerflow.sources.sinks import error_records, salted, write_error_files
from ledgerflow.streaming.intake import arrivals, refuse_copies, serve_batch, serve_files, start_intake


def records(folder):
    """The error records below a folder."""
    found = []
    for f in folder.rglob("part-*"):
        for record in ET.parse(f).getroot():
            found.append({v.get("var_name"): v.text for v in record})
    return found


def test_unlisted_attributes_are_kept_as_they_are(spark, tmp_path):
    path = tmp_path / "02_Seeds/a [1]+2 é.xml"
    rowset(path, [{"Comp_Serial": "007", "Odd": " 01.50 ", "odd2": "x &amp; y"}, {"comp_serial": "S1"}])
    assert attribute_names(spark, literal_path(str(path))) == ["Comp_Serial", "Odd", "comp_serial", "odd2"]
    got = read_open_rowset(spark, [literal_path(str(path))], ["Comp_Serial", "BAN"])
    rows = {r["Comp_Serial"]: r for r in got.collect()}
    assert rows["007"][OTHER_VALUES] == '{"Odd":" 01.50 ","odd2":"x & y"}' and rows["S1"][OTHER_VALUES] is None
    assert not rows["007"][UNREAD] and "Odd" not in got.columns and rows["S1"]["Folder_Name"] == "02_Seeds"
    (var,) = error_records(got.filter("Comp_Serial = '007'").select("Comp_Serial", "BAN", OTHER_VALUES)).collect()
    assert [(v["_var_name"], v["_VALUE"]) for v in var["var"]] == [("Comp_Serial", "007"), ("Odd", " 01.50 "), ("odd2", "x & y")]
    listed = read_open_rowset(spark, [literal_path(str(path))], ["Comp_Serial", "Odd", "ODD2"])
    assert {r[OTHER_VALUES] for r in listed.collect()} == {None}


def test_stream_of_files_with_a_ledger(spark, tables, tmp_path):  # noqa: F811
    """Good rows are served, a truncated and an empty file are reported, and a rejected row comes back whole."""
    inbox, out = tmp_path / "in", tmp_path / "out"
    rowset(inbox / "04_Dispute-Actions/good.xml", [
        {"Comp_Serial": "S1", "Action": "Escalate", "DSB_ID": "1", "Action_Reason": "r"},
        {"Comp_Serial": "S2", "Action": "Escalate", "DSB_ID": "77", "Odd_One": " 007 "}])
    (inbox / "04_Dispute-Actions/cut.xml").write_text(
        HEAD + '<z:row Comp_Serial="S2" Action="Escalate" DSB_ID="3"/><z:row Comp_Serial="S1" Action="Close" ')
    (inbox / "04_Dispute-Actions/bad.xml").write_text(
        HEAD + '<z:row Comp_Serial="S2" Action="Close" DSB_ID="99"/><z:row Comp_Serial="S1 ' + TAIL)
    (inbox / "04_Dispute-Actions/none.xml").write_text(HEAD + TAIL)
    rowset(inbox / "09_Other/o.xml", [{"Comp_Serial": "S2", "Action": "x"}])
    save_base(tables, str(out))
    columns = ("Comp_Serial", "Action", "DSB_ID", "Action_Reason")
    query = start_intake(
        arrivals(spark, str(inbox)), f"{tmp_path}/ckpt",
        lambda b, i: serve_files(b, i, columns, lambda n: load_state(spark, str(out), n), str(out), lambda: NOW),
    )
    assert query.awaitTermination(300)
    ledger = {os.path.basename(r["File_Path"]): r for r in spark.read.parquet(f"{out}/ledger").collect()}
    assert {k: (r["Outcome"], r["N_Rows"]) for k, r in ledger.items()} == {
        "good.xml": ("served", 2), "cut.xml": ("cut off", 1), "bad.xml": ("unreadable records", 1), "none.xml": ("no rows", 0), "o.xml": ("unknown folder", 1)}
    errors = {r.get("DSB_ID") or r.get("Action") or r["File_Path"].rpartition("/")[2]: r for r in records(out / "errors")}
    assert set(errors) == {"77", "99", "cut.xml", "bad.xml", "none.xml", "x"}
    assert errors["77"]["Odd_One"] == " 007 " and errors["77"]["Comp_Serial"] == "S2"
    assert errors["none.xml"]["Error_Message"] == "File holds no rows"
    assert errors["cut.xml"]["Error_Message"] == "File is cut off"
    assert "cannot be read" in errors["bad.xml"]["Error_Message"]
    assert sorted(r["DSB_ID"] for r in spark.read.parquet(f"{out}/appends/dispute_history").collect()) == [1, 3]


def test_error_files_are_sized_by_their_rows(spark, tmp_path):
    """One submitter has most of the errors; nobody has more files than rows ask for."""
    data = [("S1", f"bad {i}") for i in range(900)] + [("S2", "one")] + [(None, f"x{i}") for i in range(30)]
    errors = frame(spark, data, "Comp_Serial string, Error_Message string").withColumn("Error_Columns", F.lit("BAN"))
    salts = salted(error_records(errors), 100).groupBy("Comp_Serial").agg(F.countDistinct("_salt"), F.max("_salt"), F.count("*"))
    got = {r[0]: tuple(r)[1:] for r in salts.collect()}
    assert got == {"S1": (9, 8, 900), "S2": (1, 0, 1), None: (1, 0, 30)}
    write_error_files(errors, f"{tmp_path}/e", rows_per_file=100)
    assert len(records(tmp_path / "e")) == 931
    assert len(list((tmp_path / "e/Comp_Serial=S2").glob("part-*"))) == 1


def test_copies_are_flagged_by_their_values(spark):
    shape = "Line_ID long, Folder_Name string, File_Path string, Comp_Serial string, BAN string"
    rows = [(1, "a", "f1", "S1", "x"), (2, "a", "f2", "S1", "x"), (3, "b", "f1", "S1", "x"), (4, "a", "f1", None, "x"), (5, "a", "f1", "x", None)]
    first = refuse_copies(frame(spark, rows, shape), frame(spark, [], "_digest string"))
    got = {r["Line_ID"]: r["Error_Message"] for r in first.collect()}
    assert got == {1: None, 2: "This row was already given", 3: None, 4: None, 5: None}
    known = first.filter("Line_ID = 3").select("_digest")
    again = refuse_copies(frame(spark, rows, shape), known)
    assert {r["Line_ID"] for r in again.collect() if r["Error_Message"] == "This row was already served"} == {3}


def test_replayed_file_in_a_later_batch_opens_nothing(spark, tables, tmp_path):  # noqa: F811
    """With `copy_days` a copy is refused after a restart too, and served again once the days are over."""
    root = str(tmp_path)
    save_base(tables, root)
    shape = "Folder_Name string, Comp_Serial string, Cost_Type string, Cost_Type_Seed string"
    seed = frame(spark, [("02_Seeds", "S1", "MRC", "900"), ("02_Seeds", "S1", "MRC", "0")], shape).withColumn("Folder_Rank", F.lit(2))
    config = JobConfig(copy_days=30)
    for batch_id, now in ((0, NOW), (1, "2024-02-10 12:00:00"), (2, "2024-05-01 12:00:00")):
        serve_batch(seed, batch_id, lambda n: load_state(spark, root, n), root, lambda: now, config)  # noqa: B023
    opened = spark.read.parquet(f"{root}/appends/dispute_header").collect()
    assert sorted((r["batch_id"], r["DSB_ID"]) for r in opened) == [(0, 6), (2, 7)]
    refused = records(tmp_path / "errors/batch_id=1")
    # The row that was an error the first time was not served, so it is judged again.
    assert sorted(r["Error_Message"] for r in refused) == ["Cost_Type_Seed does not exist", "This row was already served"]


def test_attachment_listing_is_extended(spark, tmp_path):
    folder, root = tmp_path / "files", f"{tmp_path}/kept"
    folder.mkdir()

    def put(name, second):
        (folder / name).write_text("x")
        os.utime(folder / name, (1_700_000_000 + second,) * 2)

    put("BMI_1.pdf", 0)
    put("note.txt", 5)
    assert [r["File_Name"] for r in extend_listing(spark, root, str(folder), 0).collect()] == ["BMI_1.pdf"]
    put("BMI_1b.pdf", 0)  # in the same second
    put("PCI_2.pdf", 50)
    put("BMI_9.pdf", -5000)  # older than the listing: not looked at
    for _ in range(2):  # the second is a replay
        names = sorted(r["File_Name"] for r in extend_listing(spark, root, str(folder), 1).collect())
        assert names == ["BMI_1.pdf", "BMI_1b.pdf", "PCI_2.pdf"]
    assert kept_listing(spark, root, 1).count() == 1
    assert extend_listing(spark, root, str(folder), 2).count() == 3


def test_work_folder_is_the_checkpoint_folder_else_in_the_warehouse(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    place = _below(warehouse)
    assert place == _below(warehouse) and place.removeprefix("file://").startswith(warehouse.removeprefix("file:"))
    spark.range(3).write.parquet(f"{place}/a")
    assert os.path.isdir(place.removeprefix("file://"))
    _remove(place)
    assert not os.path.exists(place.removeprefix("file://"))


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_listing_bound_follows_the_session_zone(spark, tmp_path, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        (tmp_path / "BMI_1.pdf").write_text("x")
        os.utime(tmp_path / "BMI_1.pdf", (1_700_000_000,) * 2)
        from ledgerflow.sources.attachments import scan_attachments

        assert scan_attachments(spark, str(tmp_path), 1_699_999_998).count() == 1
        assert scan_attachments(spark, str(tmp_path), 1_700_000_002).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
