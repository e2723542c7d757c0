"""Business tables for the job queries, made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.checks.operator_queries import seed_tables, worklist
from ledgerflow.checks.views import money, table, text, v_ban, v_current, v_emp, v_history, v_sub


def actions(spark, sf, action=None):
    """Submissions as dispute actions, one DSB_ID each."""
    n = F.col("line_id")
    named = F.col("action") if action is None else F.lit(action)
    return v_sub(spark, sf).select(
        n.alias("Line_ID"),
        named.alias("Action"),
        text("dsb_id").alias("DSB_ID"),
        F.col("comp_serial").alias("Comp_Serial"),
        F.col("amount_txt").alias("Amount_Or_Days"),
        F.col("date_txt").alias("Credit_Invoice_Date"),
        F.concat(F.lit("N "), "action").alias("Action_Norm_Reason"),
        F.col("reason").alias("Action_Reason"),
        F.when(n % 3 == 0, "Boss").alias("Assign_Rep"),
        F.lit("T").alias("Note_Tag"),
        F.concat(F.lit("I"), text(n)).alias("ILEC_Confirmation"),
    )


def review_sub(spark, sf, action):
    """Submissions as review rows; many rows name the same source."""
    n = F.col("line_id")
    return v_sub(spark, sf).select(
        n.alias("Line_ID"),
        F.lit(action).alias("Action"),
        F.col("source_tbl").alias("Source_TBL"),
        F.col("source_id").alias("Source_ID"),
        F.col("comp_serial").alias("Comp_Serial"),
        F.col("amount_txt").alias("Amount_Or_Days"),
        F.col("amount_txt").alias("Ticket"),
        F.col("date_txt").alias("Credit_Invoice_Date"),
        F.concat(F.lit("N "), "action").alias("Action_Norm_Reason"),
        F.col("reason").alias("Action_Reason"),
        F.col("source_id").alias("Macnum"),
        F.when(n % 2 == 0, "1998-01-01").alias("Start_Date"),
        F.when(n % 3 == 0, "own").alias("BAN"),
    )


def base_tables(spark, sf):
    """Employees, disputes, their history and notes."""
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    current = v_current(spark, sf).withColumnRenamed("n_escalations", "#_Of_Escalations")
    notes = orders.select(
        key.alias("DN_ID"),
        key.alias("DSB_ID"),
        F.when(key % 8 == 0, "2024-01-31 08:00:00")
        .otherwise("2024-01-30 08:00:00")
        .cast("timestamp_ntz")
        .alias("Edit_Date"),
    )
    return {
        "employee": v_emp(spark, sf),
        "dispute_current": current,
        "dispute_history": v_history(spark, sf),
        "dispute_notes": notes,
        "dispute_header": orders.select(key.alias("DSB_ID")),
        "dispute_detail": orders.select(key.alias("DS_ID")),
        "worklist": worklist(spark, sf),
    }


def master_tables(spark, sf):
    """Account master with platform and vendor dimensions."""
    master = v_ban(spark, sf).select(
        F.col("ban").alias("BAN"),
        F.col("id").alias("ID"),
        F.concat(F.lit("BDT "), "ban").alias("BDT_Vendor"),
        F.col("start_date").alias("Start_Date"),
        F.col("end_date").alias("End_Date"),
        F.col("platform_id").alias("PlatformMasterID"),
        (F.col("platform_id") % 5).alias("VendorMasterID"),
    )
    return {
        "ban_master": master,
        "platform_master": table(spark, sf, "nation").select(
            F.col("n_nationkey").cast("long").alias("ID"), F.col("n_name").alias("Platform")
        ),
        "vendor_master": table(spark, sf, "region").select(
            F.col("r_regionkey").cast("long").alias("ID"), F.col("r_name").alias("Vendor")
        ),
    }


def mining_tables(spark, sf):
    """Charges keyed by customer, with all columns that a seed takes over."""
    tables = seed_tables(spark, sf)
    orders, part = table(spark, sf, "orders"), table(spark, sf, "part")
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    bill = F.lit("2001-07-31").cast("date")
    total = F.col("o_totalprice")
    tables["mrc"] = orders.select(
        F.col("o_orderkey").alias("BDT_MRC_ID"),
        F.col("o_custkey").alias("BMI_ID"),
        F.col("o_orderdate").cast("date").alias("Invoice_Date"),
        F.col("o_orderdate").cast("date").alias("Bill_Date"),
        money(total - 100000).alias("Amount"),
        F.col("o_orderpriority").alias("Vendor"),
        F.lit("MP").alias("Platform"),
        text(F.col("o_orderkey") % 100).alias("BAN"),
        F.lit("TX").alias("State"),
        F.lit("U").alias("USOC"),
        F.lit("UD").alias("USOC_Description"),
        text("o_orderkey").alias("WTN"),
        F.lit("").alias("Circuit_ID"),
        F.lit("").alias("BTN"),
        F.col("o_orderpriority").alias("Product_Type"),
    )
    tables["mrc_cmp"] = orders.select(
        F.col("o_orderkey").alias("BDT_MRC_ID"),
        F.col("o_orderdate").cast("date").alias("Invoice_Date"),
        F.lit("CP").alias("CPID"),
        F.lit(None).cast("bigint").alias("BANMasterID"),
    )
    tables["paper_cost"] = tables["paper_cost"].withColumns(
        {
            "MRC": F.col("MRC") - 100000,
            "NRC": F.col("NRC") - 200000,
            "FRAC": F.col("FRAC") - 300000,
        }
    )
    tables["occ"] = part.select(
        F.col("p_partkey").alias("BDT_OCC_ID"),
        F.lower("p_type").alias("Activity_Type"),
        F.lit("V").alias("Vendor"),
        F.lit("OP").alias("Platform"),
        text("p_partkey").alias("BAN"),
        bill.alias("Invoice_Date"),
        bill.alias("Bill_Date"),
        F.lit("CA").alias("State"),
        money(F.col("p_retailprice") - 905).alias("Amount"),
        F.lit("U").alias("USOC"),
        F.lit("UD").alias("USOC_Description"),
        F.lit("PH").alias("Phrase_Code"),
        F.lit("SO").alias("SO"),
        F.lit("PN").alias("PON"),
        text("p_partkey").alias("BTN"),
        F.concat(F.lit("C"), text("p_partkey")).alias("Circuit_ID"),
    )
    tables["bmi"] = customer.select(
        F.col("c_custkey").alias("BMI_ID"),
        F.lit("V").alias("Vendor"),
        text("c_custkey").alias("BAN"),
        text("c_custkey").alias("WTN"),
        F.concat(F.lit("C"), text("c_custkey")).alias("Circuit_ID"),
    )
    tables["pci"] = customer.select(
        F.col("c_custkey").alias("ID"), text("c_custkey").alias("BAN")
    )
    tables["limitations"] = customer.join(
        nation, customer.c_nationkey == nation.n_nationkey
    ).select(
        text("c_custkey").alias("BAN"), (F.col("n_nationkey") * 100 + 30).alias("Dispute_Limit")
    )
    return tables


def queue_tables(spark, sf):
    """Outbound queues, customers with service, and product types."""
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey")
    source = [
        F.when(key % 4 == 0, "PCI").otherwise("BMI").alias("Source_TBL"),
        text(key).alias("Source_ID"),
    ]
    return {
        "cust_file": table(spark, sf, "supplier").select(text("s_suppkey").alias("Macnum")),
        "queue_prov": orders.select(
            *source,
            F.when(key % 5 == 0, None).otherwise("x").alias("Root_Cause"),
            F.when(key % 2 == 0, None).otherwise("x").alias("Prov_Note"),
            F.lit(None).cast("string").alias("New_Root_Cause"),
        ),
        "queue_lv": orders.select(
            *source,
            F.when(key % 5 == 0, None).otherwise("x").alias("Is_Rejected"),
            F.when(key % 7 == 0, None).otherwise("x").alias("Sugg_Action"),
        ),
        "mrc": orders.select(
            key.alias("BMI_ID"),
            F.col("o_orderdate").cast("date").alias("Invoice_Date"),
            F.col("o_orderpriority").alias("Product_Type"),
        ),
    }


def ticket_tables(spark, sf):
    key = F.col("c_custkey")
    return {
        "ticket_core": table(spark, sf, "customer").select(
            key.alias("Ticket_ID"),
            F.when(key % 7 == 0, None).otherwise(F.col("c_nationkey")).alias("Ticket_Status_ID"),
        ),
        "ticket_status": table(spark, sf, "nation").select(
            F.col("n_nationkey").alias("Ticket_Status_ID"), F.col("n_name").alias("Status")
        ),
    }


def map_tables(spark, sf):
    """Service masters over the part names, bridges and mapping targets over the parts."""
    part, key = table(spark, sf, "part"), F.col("p_partkey")
    word = F.split("p_name", " ")
    big = F.when(F.col("p_size") > 30, F.element_at(word, 1)).otherwise(F.element_at(word, 2))
    other = F.when(key % 50 == 0, key).otherwise(-key - 1)
    bridge = part.select(
        F.lit("BRD").alias("gs_SrvType"),
        F.element_at(word, 1).alias("gs_SrvID"),
        other.alias("BMI_ID"),
        other.alias("PCI_ID"),
    )
    target = part.select(
        key.alias("BMI_ID"),
        key.alias("ID"),
        F.col("p_brand").alias("gs_SrvID"),
        F.col("p_type").alias("gs_SrvType"),
        F.lit(None).cast("string").alias("frameID"),
        F.lit(None).cast("timestamp_ntz").alias("Edit_Date"),
    )
    return {
        "ll": part.select(big.alias("ORD_WTN")),
        "brd": part.select(F.element_at(word, 1).alias("ORD_BRD_ID")),
        "ded": part.select(F.col("p_brand").alias("CUS_DED_ID")),
        "ld": part.select(F.col("p_type").alias("ORD_WTN")),
        "tf": part.select(F.col("p_name").alias("ORD_POTS_ANI_BIL")),
        "bmb": bridge.drop("PCI_ID"),
        "pci_bmb": bridge.drop("BMI_ID"),
        "bmm": target.drop("ID"),
        "pci": target.drop("BMI_ID"),
    }
