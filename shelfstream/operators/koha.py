"""The same extracts over the second library system's tables (unscoped)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfstream.operators.circulation import _null_if_zero
from shelfstream.operators.copies import before_day
from shelfstream.operators.transactions import previous_day

# Lost codes and their labels; any other code reads "Not Lost".
LOST_LABELS = {0: "Not Lost", 1: "Lost", 2: "Long Overdue (lost)", 3: "Lost & Paid For", 4: "Missing"}


def status_case(itemlost: Column) -> Column:
    pairs = [part for code, label in LOST_LABELS.items() for part in (F.lit(code), F.lit(label))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), itemlost.cast("int")), F.lit("Not Lost"))


def items(source: DataFrame, accessioned_before: str | None) -> DataFrame:
    """Loanable, not withdrawn items; ``None`` is the all-time variant."""
    chosen = source.filter((F.col("withdrawn") == 0) & F.col("notforloan").isin(0, -1))
    if accessioned_before is not None:
        chosen = chosen.filter(F.col("dateaccessioned") < F.lit(accessioned_before).cast("date"))
    return chosen.select(
        F.col("itemnumber").alias("ac_id"),
        "barcode",
        F.col("dateaccessioned").alias("create_date"),
        F.col("permanent_location").alias("copy_location"),
        F.col("holdingbranch").alias("library"),
        F.col("itemcallnumber").alias("call_number"),
        "itype",
        F.col("biblionumber").alias("biblio_id"),
        status_case(F.col("itemlost")).alias("status"),
    )


def fund_by_item(aqorders_items: DataFrame, aqorders: DataFrame, aqbudgets: DataFrame) -> DataFrame:
    """One budget name per item over the order chain, the lowest where several match."""
    budgets = aqorders.select("ordernumber", "budget_id").join(aqbudgets, "budget_id").select("ordernumber", "budget_name")
    return (
        aqorders_items.join(budgets, "ordernumber")
        .groupBy(F.col("itemnumber").alias("ac_id"))
        .agg(F.min("budget_name").alias("fund"))
    )


def isbn_ean(biblioitems: DataFrame) -> DataFrame:
    """One ``isbn,ean`` text per title."""
    return biblioitems.groupBy(F.col("biblionumber").alias("biblio_id")).agg(
        F.min(F.concat_ws(",", "isbn", "ean")).alias("eans")
    )


def join_eans(item_rows: DataFrame, biblioitems: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Attach ISBN and EAN by title.

    ``strict_reference`` keeps the known defect of matching the item number
    with the title number.
    """
    eans = isbn_ean(biblioitems)
    if strict_reference:
        return item_rows.join(eans.withColumnRenamed("biblio_id", "ac_id"), "ac_id", "left")
    return item_rows.join(eans, "biblio_id", "left")


def circ_stats(issues: DataFrame, old_issues: DataFrame, as_of: str | None) -> DataFrame:
    """Loan counts per item in one pass; ``as_of=None`` leaves every column unfiltered."""
    columns = ("issue_id", "itemnumber", "issuedate", "returndate", "date_due")
    loans = issues.select(*columns).unionByName(old_issues.select(*columns))
    start = F.col("issuedate")
    if as_of is None:
        since_month = since_year = F.lit(True)
    else:
        day = F.lit(as_of).cast("date")
        since_month = start > F.add_months(day, -1).cast("timestamp_ntz")
        since_year = start > F.add_months(day, -12).cast("timestamp_ntz")
    earlier = before_day("issuedate", as_of)
    return loans.groupBy(F.col("itemnumber").alias("ac_id")).agg(
        F.count("issue_id").alias("all_circs"),
        _null_if_zero(F.count(F.when(since_month, F.col("issue_id")))).alias("monthly_circs"),
        _null_if_zero(F.count(F.when(since_year, F.col("issue_id")))).alias("annual_circs"),
        F.max(F.when(earlier, F.to_date("returndate"))).alias("last_checkin"),
        F.max(F.when(earlier, F.to_date("date_due"))).alias("last_due"),
        F.max(F.when(earlier, F.to_date(start))).alias("last_circ"),
    )


def item_table(
    source: DataFrame, biblioitems: DataFrame, funds: DataFrame, stats: DataFrame,
    accessioned_before: str | None, strict_reference: bool = False,
) -> DataFrame:
    rows = join_eans(items(source, accessioned_before), biblioitems, strict_reference)
    return rows.join(funds, "ac_id", "left").join(stats, "ac_id", "left")


def order_counts(aqorders: DataFrame, reserves: DataFrame) -> DataFrame:
    """Reserves on titles with unreceived orders, once per such order (fan-out kept)."""
    pending = (
        aqorders.filter("datereceived IS NULL").groupBy("biblionumber").agg(F.count(F.lit(1)).alias("orders"))
    )
    waiting = reserves.groupBy("biblionumber", "branchcode").agg(F.count("reserve_id").alias("reserves"))
    return waiting.join(pending, "biblionumber").select(
        F.col("biblionumber").alias("biblio_id"),
        (F.col("reserves") * F.col("orders")).alias("hold_count"),
        F.col("branchcode").alias("holds_branch"),
    )


def open_holds(reserves: DataFrame, as_of: str) -> DataFrame:
    day = F.lit(as_of).cast("date")
    chosen = reserves.filter(F.col("reservedate") < day)
    for ended in ("cancellationdate", "expirationdate", "waitingdate"):
        chosen = chosen.filter(F.col(ended).isNull() | (F.col(ended) > day))
    return chosen.select("reserve_id", F.col("biblionumber").alias("biblio_id"), F.col("branchcode").alias("holds_branch"))


def holds_alltime(reserves: DataFrame, old_reserves: DataFrame) -> DataFrame:
    both = [
        df.select("reserve_id", F.col("biblionumber").alias("biblio_id"), F.col("branchcode").alias("holds_branch"))
        for df in (reserves, old_reserves)
    ]
    return both[0].unionByName(both[1])


def hold_counts(holds: DataFrame) -> DataFrame:
    return holds.groupBy("biblio_id", "holds_branch").agg(F.count("reserve_id").alias("hold_count"))


def transactions(source: DataFrame, issues: DataFrame, as_of: str | None, strict_reference: bool = False) -> DataFrame:
    """Check-outs, renewals, check-ins and withdrawals.

    With ``as_of=None`` pass live and archived issues together; ``strict_reference``
    then keeps events without a time and marks every item as deleted.
    """
    def event(kind, when, due):
        return issues.filter(previous_day(when, as_of, strict_reference)).select(
            "itemnumber", F.lit(kind).alias("transaction_type"), F.col(when).alias("transaction_date"),
            F.col("branchcode").alias("transaction_branch"), due.cast("timestamp_ntz").alias("due_date"),
        )

    nothing = F.lit(None)
    events = (
        event("circ", "issuedate", F.col("date_due"))
        .unionByName(event("renewal", "lastreneweddate", F.col("date_due")))
        .unionByName(event("checkin", "returndate", nothing))
    )
    owners = source.select("itemnumber", "barcode", F.col("biblionumber").alias("biblio_id"))
    gone = source.filter(previous_day("timestamp", as_of, strict_reference))
    if as_of is not None or not strict_reference:
        gone = gone.filter(F.col("withdrawn") != 0)
    gone = gone.select(
        "itemnumber", "barcode", F.col("biblionumber").alias("biblio_id"), F.lit("deleted").alias("transaction_type"),
        F.col("timestamp").alias("transaction_date"), F.col("homebranch").alias("transaction_branch"),
        nothing.cast("timestamp_ntz").alias("due_date"),
    )
    return events.join(owners, "itemnumber").unionByName(gone)


def bibs(biblio: DataFrame, biblioitems: DataFrame, source: DataFrame) -> DataFrame:
    """Title table; price and fallback material type come from any item (the lowest)."""
    from_items = source.groupBy("biblionumber").agg(F.min("price").alias("price"), F.min("itype").alias("itype"))
    details = biblioitems.withColumn("eans", F.concat_ws(",", "isbn", "ean"))
    return (
        biblio.join(details, "biblionumber")
        .join(from_items, "biblionumber", "left")
        .select(
            F.col("biblionumber").alias("biblio_id"),
            "eans",
            F.coalesce("itemtype", "itype").alias("material_type"),
            "title", "author",
            F.col("seriestitle").alias("series"),
            F.col("publicationyear").alias("pub_date"),
            F.col("publishercode").alias("publisher_supplier"),
            F.col("price").cast("string").alias("price"),
            F.to_date("timestamp").cast("string").alias("last_update"),
        )
    )
