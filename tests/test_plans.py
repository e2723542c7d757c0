import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerflow.config import JobConfig
from ledgerflow.plans.review import dispute_job, map_job
from ledgerflow.plans.run import advance, review_folder, run_folder
from ledgerflow.plans.state import compact, load_state, save_base
from ledgerflow.plans.transitions import SPECS, direct_actions, transition
from ledgerflow.streaming.intake import intake_stream, serve_batch, start_intake

NOW = "2024-01-31 12:00:00"
DAY = dt.date(2024, 1, 1)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def tables(spark):
    """A small world: three employees, five disputes, a worklist, charges and masters."""
    current = frame(
        spark,
        [
            (1, "BMI", "11", "Open", "Denied - Pending", "STC", "GRT CNR", None, 10.0, "Ann", 101),
            (2, "BMI", "11", "Open", "Filed", "Email", "GRT CNR", 2, 20.0, "Bob", 102),
            (3, "BMI", "12", "Open", "Approved", "STC", "GRT CNR", 0, 30.0, "Ann", 103),
            (4, "PCI", "11", "Closed", "Paid", "Email", "GRT CNR", 0, 40.0, "Ann", 104),
            (5, "PCI", "13", "Open", "Filed", None, "Other", 0, 50.0, "Ann", 999),
        ],
        "DSB_ID long, Source_TBL string, Source_ID string, Status string, Display_Status string, "
        "Dispute_Type string, Dispute_Category string, `#_Of_Escalations` int, Dispute_Amount double, "
        "Disputer string, DH_ID long",
    ).withColumn("Date_Submitted", F.lit("2023-12-01 00:00:00").cast("timestamp_ntz"))
    history = frame(
        spark,
        [(100 + i, i, "GRT CNR", f"reason {i}", "no") for i in range(1, 5)],
        "DH_ID long, DSB_ID long, Dispute_Category string, Dispute_Reason string, Denied string",
    )
    work = frame(
        spark,
        [("BMI", "11", "unmapped"), ("BMI", "12", "zero"), ("PCI", "11", "zero")],
        "Source_TBL string, Source_ID string, TAG string",
    ).withColumns(
        {
            "Max_CNR_Date": F.lit(DAY),
            **{c: F.lit(c) for c in ("Vendor", "BAN", "BTN", "WTN", "Circuit_ID")},
            "MRC_Amount": F.lit(1.0),
            **{c: F.lit(None).cast("string") for c in ("Audit_Result", "Rep", "Comment")},
            "Edit_Date": F.lit(None).cast("timestamp_ntz"),
        }
    )
    charge = (
        "Vendor string, Platform string, BAN string, State string, Bill_Date date, Invoice_Date date, "
        "Amount double, USOC string, USOC_Description string, WTN string, Circuit_ID string, BTN string"
    )
    mrc = frame(
        spark,
        [
            ("V", "P", "B1", "TX", dt.date(2024, 1, 31), dt.date(2024, 1, 31), 7.5, "U", "UD", "", "C", "", 900, 12, "PT"),
            ("V", "P", "B1", "TX", dt.date(2024, 1, 31), dt.date(2024, 1, 31), 8.5, "U", "UD", "", "C", "", 901, 12, "PT"),
        ],
        charge + ", BDT_MRC_ID long, BMI_ID long, Product_Type string",
    )
    occ = frame(
        spark,
        [],
        charge + ", BDT_OCC_ID long, Activity_Type string, Phrase_Code string, SO string, PON string",
    )
    other = charge + ", Total_Amount double, Late_Payment_Charges double, Jurisdiction string, " + (
        "Jurisdiction_Phrase string, Usage_Rate string, Phrase_Code string, "
    )
    service = {"ll": "ORD_WTN", "brd": "ORD_BRD_ID", "ded": "CUS_DED_ID", "ld": "ORD_WTN", "tf": "ORD_POTS_ANI_BIL"}
    log = "Audit_Result string, Rep string, Comment string, Edit_Date timestamp_ntz"
    return {
        "employee": frame(spark, [("S1", "Ann", "AN"), ("S2", "Bob", "BO")], "Comp_Serial string, Full_Name string, Initials string"),
        "dispute_current": current,
        "dispute_history": history,
        "dispute_notes": frame(spark, [], "DN_ID long, DH_ID long, DSB_ID long, Edit_Date timestamp_ntz"),
        "dispute_header": frame(spark, [(5,)], "DSB_ID long"),
        "dispute_detail": frame(spark, [], "DS_ID long"),
        "worklist": work,
        "mrc": mrc,
        "mrc_cmp": frame(spark, [(900, dt.date(2024, 1, 31), "CP", 1)], "BDT_MRC_ID long, Invoice_Date date, CPID string, BANMasterID long"),
        "occ": occ,
        "tas": frame(spark, [], other + "BDT_TAS_ID long"),
        "usage": frame(spark, [], other + "BDT_USAGE_ID long"),
        "lpc": frame(spark, [], other + "BDT_INVOICE_ID long"),
        "adj": frame(spark, [], other + "BDT_PAD_ID long"),
        "paper_cost": frame(spark, [], charge + ", Seed long, PCI_ID long, MRC double, NRC double, FRAC double"),
        "limitations": frame(spark, [("B1", 60)], "BAN string, Dispute_Limit int"),
        "bmi": frame(spark, [(12, "V", "B1", "W", "C"), (11, "V", "B1", "X", "C")], "BMI_ID long, Vendor string, BAN string, WTN string, Circuit_ID string"),
        "pci": frame(spark, [(11, "B1", None, None, None)], "ID long, BAN string, gs_SrvID string, gs_SrvType string, Edit_Date timestamp_ntz"),
        "bmm": frame(spark, [(11, "old", "LL", None, None), (12, "old", "LL", None, None)], "BMI_ID long, gs_SrvID string, gs_SrvType string, frameID string, Edit_Date timestamp_ntz"),
        "bmb": frame(spark, [("L1", "LL", 12)], "gs_SrvID string, gs_SrvType string, BMI_ID long"),
        "pci_bmb": frame(spark, [], "gs_SrvID string, gs_SrvType string, PCI_ID long"),
        **{k: frame(spark, [("L1",), ("L2",)], f"{c} string") for k, c in service.items()},
        "ban_master": frame(spark, [("B1", 1, "BV", dt.date(2020, 1, 1), None, 3, 4)], "BAN string, ID long, BDT_Vendor string, Start_Date date, End_Date date, PlatformMasterID long, VendorMasterID long"),
        "platform_master": frame(spark, [(3, "PLAT")], "ID long, Platform string"),
        "vendor_master": frame(spark, [(4, "VEND")], "ID long, Vendor string"),
        "cust_file": frame(spark, [("M1",)], "Macnum string"),
        "queue_prov": frame(spark, [("BMI", "12", None, None, None)], "Source_TBL string, Source_ID string, Root_Cause string, Prov_Note string, New_Root_Cause string"),
        "queue_lv": frame(spark, [("BMI", "12", "no", None)], "Source_TBL string, Source_ID string, Is_Rejected string, Sugg_Action string"),
        "ticket_core": frame(spark, [(10, 1)], "Ticket_ID long, Ticket_Status_ID int"),
        "ticket_status": frame(spark, [(1, "Open")], "Ticket_Status_ID int, Status string"),
        **{
            name: frame(spark, [], f"Source_TBL string, Source_ID string, {log}")
            for name in ("unmapped", "pci_unmapped", "zero_revenue", "pci_zero_revenue")
        },
    }


ACTIONS = "Line_ID long, Action string, DSB_ID string, Comp_Serial string, Amount_Or_Days string, Credit_Invoice_Date string, Action_Reason string"


def state(df):
    return {r["DSB_ID"]: r.asDict() for r in df.collect()}


def errors(result):
    return {r["Line_ID"]: r["Error_Message"] for r in result.results.select("Line_ID", "Error_Message").collect()}


def test_every_spec_moves_only_its_dispute(spark, tables):
    before = state(tables["dispute_current"])
    for name, spec in SPECS.items():
        act = frame(spark, [(1, name, "2", "S1", "5", None, "why")], ACTIONS)
        step = transition(act, tables, NOW, [name])
        after = state(step.snapshot(tables["dispute_current"]))
        assert after.keys() == before.keys()
        assert all(after[k]["Status"] == before[k]["Status"] for k in (1, 3, 4, 5))
        moved = after[2]
        if spec.status is None:
            assert moved["Dispute_Note"] == "why" and moved["Note_Assigned_To"] == "Ann" and moved["DN_ID"] == 1
            assert moved["DH_ID"] == 102 and step.history.isEmpty()
        else:
            row = step.history.first()
            assert row["Display_Status"] == moved["Display_Status"] == spec.status
            assert moved["DH_ID"] == row["DH_ID"] == 105
            assert moved["Last_GRT_Action"] == spec.last_action and moved["Source_File"] == "GRT Status: 20240126"
            assert moved["Status"] == ("Closed" if spec.closes else "Open")
            assert row["Dispute_Reason"] == ("why" if name == "Escalate" else "reason 2")


def test_transition_errors(spark, tables):
    act = frame(
        spark,
        [
            (1, "Denied", "1", "S1", None, None, None),
            (2, "Denied", "77", "S1", None, None, None),
            (3, "Denied", "2", "S9", None, None, None),
            (4, "Denied", "5", "S1", None, None, None),
            (5, "Denied", "x", "S1", None, None, None),
            (6, "Denied", "4", "S1", None, None, None),
            (7, "Denied", "4", "S2", None, None, None),
        ],
        ACTIONS,
    )
    step = transition(act, tables, NOW, ["Denied"])
    got = {r["Line_ID"]: r["Error_Message"] for r in step.results.collect()}
    assert got == {
        1: "Dispute_Type is not Email for DSB_ID",
        2: "DSB_ID does not exist in Dispute Current",
        3: "Comp_Serial does not exist",
        4: "DSB_ID has no prior version in Dispute History",
        5: "DSB_ID does not exist in Dispute Current",
        6: None,
        7: "DSB_ID was already given for this action",
    }
    assert step.history.count() == 1


def test_actions_of_one_dispute_follow_each_other(spark, tables):
    act = frame(
        spark,
        [
            (1, "Close", "1", "S1", None, None, "shut"),
            (2, "Escalate", "1", "S2", None, None, "push"),
            (3, "Paid", "3", "S1", "12", "2024-02-29", None),
            (4, "Nope", "3", "S1", None, None, None),
            (5, "Paid", "2", "S1", "-1", None, None),
            (6, "Dispute Note", "2", "S1", "31", None, None),
            (7, "Dispute Note", "2", "S1", "30", None, "note"),
        ],
        ACTIONS,
    )
    result = direct_actions(act, tables, NOW)
    assert errors(result) == {
        1: None,
        2: None,
        3: None,
        4: "Nope is not a listed Action",
        5: "Amount_Or_Days is <= 0",
        6: "DN max day cap is 30 day(s)",
        7: None,
    }
    after = state(result.snapshots["dispute_current"])
    assert after[1]["#_Of_Escalations"] == 1 and after[1]["Status"] == "Closed"
    assert after[1]["Close_Reason"] == "shut" and after[1]["Dispute_Reason"] == "push"
    assert after[1]["Last_GRT_Action"] == "GRT Close" and after[3]["Credit_Approved"] == 12
    assert after[2]["Dispute_Note"] == "note" and after[2]["Status"] == "Open"
    history = {r["DH_ID"]: r for r in result.appends["dispute_history"].collect()}
    assert sorted(history) == [105, 106, 107]
    # The close came after the escalation and carries its version.
    close = history[after[1]["DH_ID"]]
    assert (close["Display_Status"], close["Escalate"], close["Dispute_Reason"]) == ("Denied - Closed", "Y", "push")
    assert after.keys() == state(tables["dispute_current"]).keys()


def test_current_is_the_fold_of_history(spark, tables):
    act = frame(
        spark,
        [(i, a, str(d), "S1", "5", None, "r") for i, (a, d) in enumerate([("Escalate", 1), ("Approved", 2), ("Close", 3)])],
        ACTIONS,
    )
    result = direct_actions(act, tables, NOW)
    after = advance(tables, result)
    last = {r["DSB_ID"]: r for r in sorted(after["dispute_history"].collect(), key=lambda r: r["DH_ID"])}
    for dsb, row in state(after["dispute_current"]).items():
        if dsb in (1, 2, 3):
            assert row["DH_ID"] == last[dsb]["DH_ID"] and row["Display_Status"] == last[dsb]["Display_Status"]


def test_same_transition_on_disjoint_keys_commutes(spark, tables):
    one = frame(spark, [(1, "Escalate", "1", "S1", None, None, "a")], ACTIONS)
    two = frame(spark, [(2, "Escalate", "3", "S2", None, None, "b")], ACTIONS)
    skip = ("DH_ID",)

    def run(first, second):
        t = dict(tables)
        for a in (first, second):
            step = transition(a, t, NOW, ["Escalate"])
            t = {**t, "dispute_current": step.snapshot(t["dispute_current"])}
        return {k: {c: v for c, v in r.items() if c not in skip} for k, r in state(t["dispute_current"]).items()}

    assert run(one, two) == run(two, one)


def test_review_folder(spark, tables, tmp_path):
    (tmp_path / "PCI_13_scan.pdf").write_text("x")
    sub = frame(
        spark,
        [
            (1, "Escalate Disputes", "BMI", "11", "S1", None, "esc"),
            (2, "Escalate Disputes", "BMI", "11", "S2", None, "again"),
            (3, "Escalate Disputes", "BMI", "99", "S1", None, None),
            (4, "Close Disputes", "BMI", "11", "S1", None, None),
            (5, "Send to Audit", "BMI", "12", "S2", None, None),
            (6, "Send to Prov", "BMI", "12", "S1", "M1", None),
            (7, "Send to Prov", "BMI", "11", "S1", "M1", "issue"),
            (8, "Send to LV", "PCI", "13", "S1", "M1", None),
            (9, "Send to LV", "BMI", "12", "S1", "M2", None),
            (10, "Phone Call", "BMI", "12", "S1", None, None),
            (11, "Nope", "BMI", "12", "S1", None, None),
        ],
        "Line_ID long, Action string, Source_TBL string, Source_ID string, Comp_Serial string, Macnum string, Action_Reason string",
    )
    config = JobConfig(other_review_actions=("Phone Call",), attachment_folder=str(tmp_path))
    result = review_folder(sub, tables, NOW, config)
    got = errors(result)
    assert got == {
        1: None,
        2: "Source_ID was already given for this action",
        3: "There are no open Denied - Pending/Email GRT CNR disputes for this Source_TBL & Source_ID combo",
        4: None,
        5: None,
        6: "This Source_TBL and Source_ID is already pending in Send to Prov table",
        7: None,
        8: None,
        9: "This Macnum is not a known customer",
        10: None,
        11: "Nope is not a listed Action",
    }
    prov = result.appends["queue_prov"].collect()
    assert [(r["Source_ID"], r["Assigned_To"], r["Issue"]) for r in prov] == [("11", "Ann", "issue")]
    lv = result.appends["queue_lv"].collect()
    assert [(r["Source_TBL"], r["Source_ID"], r["Vendor"]) for r in lv] == [("PCI", "13", None)]
    assert [r["CSR_File_Name"] for r in lv] == ["PCI_13_scan.pdf"]
    # Both disputes of source 11 were escalated, and then closed: one was no longer pending but Email.
    after = state(result.snapshots["dispute_current"])
    assert after[1]["#_Of_Escalations"] == 1 and after[2]["#_Of_Escalations"] == 3
    assert after[1]["Status"] == "Open" and after[2]["Status"] == "Closed"
    work = {(r["Source_TBL"], r["Source_ID"]): r for r in result.snapshots["worklist"].collect()}
    assert work["BMI", "12"]["Audit_Result"] == "Phone Call"
    assert work["BMI", "11"]["Comment"] == "GRT Closed"


def test_dispute_job_opens_linked_disputes(spark, tables):
    sub = frame(
        spark,
        [
            (1, "Dispute", "BMI", "12", "S1", "2023-12-31", "over"),
            (2, "Dispute", "BMI", "11", "S1", None, None),
            (3, "Dispute", "BMI", "12", "S2", None, None),
            (4, "Dispute", "XXX", "12", "S2", None, None),
            (5, "Dispute", "PCI", "11", "S9", None, None),
        ],
        "Line_ID long, Action string, Source_TBL string, Source_ID string, Comp_Serial string, Start_Date string, Action_Reason string",
    )
    result = dispute_job(sub, tables, NOW)
    none = "Valid cost was not found for the Source_TBL, Source_ID, Start_Date combo"
    assert errors(result) == {
        1: None,
        2: none,
        3: "Source_ID was already given for this action",
        4: "XXX is not a listed Source_TBL",
        5: "Comp_Serial does not exist",
    }
    header = {r["DSB_ID"]: r for r in result.appends["dispute_header"].collect()}
    current = {r["DSB_ID"]: r for r in result.appends["dispute_current"].collect()}
    history = {r["DSB_ID"]: r for r in result.appends["dispute_history"].collect()}
    detail = {r["DSB_ID"]: r for r in result.appends["dispute_detail"].collect()}
    assert sorted(header) == sorted(current) == sorted(history) == sorted(detail) == [6, 7]
    assert header[6]["STC_Claim_Number"] == "20240126_M900" and header[6]["Orig_DH_ID"] == history[6]["DH_ID"] == 105
    assert [r["Claimed_Amt"] for _, r in sorted(detail.items())] == [7.5, 8.5]
    assert current[6]["Norm_Platform"] == "PLAT" and current[6]["Norm_Vendor"] == "VEND"
    assert current[6]["Display_Status"] == "Pending Review" and current[6]["USI"] == "C"
    assert detail[6]["CPID"] == "CP" and detail[7]["CPID"] is None


def test_map_job(spark, tables, rows):
    sub = frame(
        spark,
        [
            (1, "BMI", "11", "S1", "LL", "L1, L2"),
            (2, "BMI", "12", "S1", "LL", "L1,L2"),
            (3, "PCI", "11", "S2", "LL", "L2"),
            (4, "BMI", "11", "S1", "LL", "L9"),
            (5, "BMI", "13", "S1", "ZZ", "L1"),
        ],
        "Line_ID long, Source_TBL string, Source_ID string, Comp_Serial string, Gs_SrvType string, Gs_SrvID string",
    )
    result = map_job(sub, tables, NOW)
    got = rows(result.results, "Line_ID", "Gs_SrvID", "Error_Message")
    gone = "LL L9 is not found in LL"
    taken = "BMB table is already mapped to LL L1"
    assert got == [
        (1, "L1", gone),
        (1, "L2", gone),
        (2, "L1", taken),
        (2, "L2", taken),
        (3, "L2", None),
        (4, "L9", gone),
        (5, "L1", "ZZ is not a listed Gs_SrvType"),
    ]
    assert rows(result.snapshots["pci"], "ID", "gs_SrvID", "gs_SrvType") == [(11, "L2", "LL")]
    assert result.appends["bmb"].isEmpty() and result.appends["pci_unmapped"].count() == 1
    only = map_job(sub.filter("Line_ID = 1"), tables, NOW)
    assert rows(only.snapshots["bmm"], "BMI_ID", "gs_SrvID", "gs_SrvType", "frameID") == [
        (11, "11", "BMB", "AN"),
        (12, "old", "LL", None),
    ]
    assert rows(only.appends["bmb"], "gs_SrvID", "BMI_ID") == [("L1", 11), ("L2", 11)]


def test_empty_files_change_nothing(spark, tables):
    act = frame(spark, [], ACTIONS)
    result = run_folder("04_Dispute-Actions", act, tables, NOW)
    assert result.results.isEmpty()
    before = state(tables["dispute_current"])
    after = state(result.snapshots["dispute_current"])
    assert {k: v["Status"] for k, v in after.items()} == {k: v["Status"] for k, v in before.items()}


def test_batch_replay_is_idempotent(spark, tables, tmp_path):
    batch = frame(
        spark,
        [("04_Dispute-Actions", "Escalate", "1", "S1", "why"), ("04_Dispute-Actions", "Close", "66", "S1", None)],
        "Folder_Name string, Action string, DSB_ID string, Comp_Serial string, Action_Reason string",
    ).withColumn("Folder_Rank", F.lit(4))
    save_base(tables, str(tmp_path))
    for _ in range(2):
        serve_batch(batch, 3, lambda n: load_state(spark, str(tmp_path), n), str(tmp_path), lambda: NOW)
    history = spark.read.parquet(f"{tmp_path}/appends/dispute_history")
    assert [(r["DH_ID"], r["batch_id"]) for r in history.collect()] == [(105, 3)]
    # Only the dispute that moved is written, and a replay raises its counter once.
    assert [r["DSB_ID"] for r in spark.read.parquet(f"{tmp_path}/changes/dispute_current").collect()] == [1]
    now = state(load_state(spark, str(tmp_path), 4, ["dispute_current"])["dispute_current"])
    assert len(now) == 5 and now[1]["#_Of_Escalations"] == 1
    assert len(list((tmp_path / "errors/batch_id=3").rglob("part-*"))) == 1


def test_files_to_tables_through_the_stream(spark, tables, tmp_path):
    def rowset(folder, name, records):
        path = tmp_path / "in" / folder
        path.mkdir(parents=True, exist_ok=True)
        body = "".join("<z:row " + " ".join(f'{k}="{v}"' for k, v in r.items()) + "/>" for r in records)
        (path / name).write_text(
            '<xml xmlns:rs="urn:schemas-microsoft-com:rowset" xmlns:z="#RowsetSchema"><rs:data>'
            + body
            + "</rs:data></xml>"
        )

    rowset("02_Seeds", "s.xml", [{"Comp_Serial": "S1", "Cost_Type": "MRC", "Cost_Type_Seed": "900"}])
    rowset("04_Dispute-Actions", "a.xml", [{"Comp_Serial": "S1", "Action": "Escalate", "DSB_ID": " 6 "}])
    rowset("09_Other", "o.xml", [{"Comp_Serial": "S2", "Action": "Escalate", "DSB_ID": "1"}])
    columns = ("Comp_Serial", "Action", "DSB_ID", "Action_Reason", "Cost_Type", "Cost_Type_Seed")
    stream = intake_stream(spark, f"{tmp_path}/in", columns)
    query = start_intake(
        stream,
        f"{tmp_path}/ckpt",
        lambda b, i: serve_batch(b, i, lambda n: tables, f"{tmp_path}/out", lambda: NOW),
    )
    assert query.awaitTermination(300)
    out = tmp_path / "out"
    # The seed opened dispute 6, and the action file, served after it, escalated that dispute.
    current = state(spark.read.parquet(f"{out}/changes/dispute_current"))
    assert current[6]["Display_Status"] == "Filed" and current[6]["#_Of_Escalations"] == 1
    assert current.keys() == {6}
    history = spark.read.parquet(f"{out}/appends/dispute_history")
    assert sorted((r["DSB_ID"], r["DH_ID"]) for r in history.collect()) == [(6, 105), (6, 106)]
    errors = [p.read_text() for p in (out / "errors").rglob("part-*")]
    assert len(errors) == 1 and "is not an inbox folder" in errors[0]


def test_second_batch_sees_the_first(spark, tables, tmp_path):
    """Ids go on, changes add up, and a new base gives the same state."""
    root = str(tmp_path)
    save_base(tables, root)
    shape = "Folder_Name string, Action string, DSB_ID string, Comp_Serial string, Action_Reason string"
    for batch_id, number in enumerate(("1", "01")):
        batch = frame(spark, [("04_Dispute-Actions", "Escalate", number, "S1", "why")], shape).withColumn("Folder_Rank", F.lit(4))
        serve_batch(batch, batch_id, lambda n: load_state(spark, root, n), root, lambda: NOW)
    history = spark.read.parquet(f"{root}/appends/dispute_history")
    assert sorted((r["DH_ID"], r["batch_id"]) for r in history.collect()) == [(105, 0), (106, 1)]
    after = state(load_state(spark, root, 2, ["dispute_current"])["dispute_current"])
    assert after[1]["#_Of_Escalations"] == 2 and after[1]["DH_ID"] == 106 and len(after) == 5
    between = state(load_state(spark, root, 1, ["dispute_current"])["dispute_current"])
    assert between[1]["#_Of_Escalations"] == 1
    compact(spark, root, 0, ["dispute_current", "dispute_history"])
    again = state(load_state(spark, root, 2, ["dispute_current"])["dispute_current"])
    assert {k: v["#_Of_Escalations"] for k, v in again.items()} == {k: v["#_Of_Escalations"] for k, v in after.items()}
    assert load_state(spark, root, 2, ["dispute_history"])["dispute_history"].count() == 6


def test_a_row_whose_disputes_all_fail_is_one_error(spark, tables):
    gone = {**tables, "dispute_history": tables["dispute_history"].filter("DH_ID > 200")}
    sub = frame(spark, [(1, "Close Disputes", "BMI", "11", "S1"), (2, "Close Disputes", "BMI", "77", "S1")],
                "Line_ID long, Action string, Source_TBL string, Source_ID string, Comp_Serial string")
    result = review_folder(sub, gone, NOW)
    got = errors(result)
    assert len(result.results.collect()) == 2
    assert got[1] == "DSB_ID has no prior version in Dispute History" and got[2].startswith("There are no open")
    work = {(r["Source_TBL"], r["Source_ID"]): r["Rep"] for r in result.snapshots["worklist"].collect()}
    assert work["BMI", "11"] is None


def test_claims_of_two_batches_differ(spark, tables):
    rows = [(0, "S1", "B1", "5")]
    sub = frame(spark, rows, "Line_ID long, Comp_Serial string, BAN string, Dispute_Amt string")
    first = run_folder("03_Non-Seeds", sub, tables, NOW)
    second = run_folder("03_Non-Seeds", sub, advance(tables, first), NOW)
    claims = [r.appends["dispute_header"].first()["STC_Claim_Number"] for r in (first, second)]
    assert claims[0] != claims[1]
