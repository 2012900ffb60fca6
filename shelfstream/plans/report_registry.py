"""The ready-made reports, grouped by folder.

Names, labels and conditions are fixed values of the report catalogue.
"""

from __future__ import annotations

from shelfstream.plans.reports import Join, Out, Report, Where


def left(alias: str, source: str, key: str = "id") -> Join:
    return Join(alias, source, key, "left")


def inner(alias: str, source: str, key: str = "id") -> Join:
    return Join(alias, source, key, "inner")


def count(name: str, source: str) -> Out:
    return Out(name, source, agg="count")


def isin(source: str, part: str | None = None) -> Where:
    return Where(source, "in", part)


def between(source: str, part: str | None = None) -> Where:
    return Where(source, "between", part)


def days(source: str) -> Where:
    return Where(source, "between", "date")


def fixed(source: str, value) -> Where:
    return Where(source, "=", value=value)


ACN = left("acn", "acp.call_number")
BRE = left("bre", "acn.record")
RMSR = left("rmsr", "bre.id")
ACPL = inner("acpl", "acp.location")
VOLUME_OWNER = left("aou", "acn.owning_lib")
HOLDINGS = (inner("acn", "acp.call_number"), inner("aou", "acn.owning_lib"))
MODIFIER = inner("ccm", "acp.circ_modifier", "code")

COLLECTIONS = "General Report Templates/Library Collections"
PATRONS = "General Report Templates/Library Patrons"
SERVICES = "General Report Templates/Library Services"
CIRCULATION = "Custom Reports/Circulation Reports"
ACQUISITIONS = "Custom Reports/Acquisitions"

_COLLECTION_REPORTS = (
    Report("rpt_brief_inventory_list", "Brief Inventory List", COLLECTIONS, "acp",
           (ACN, BRE, RMSR, ACPL),
           (Out("shelving_location", "acpl.name"), Out("call_number", "acn.label"), Out("title", "rmsr.title"),
            Out("barcode", "acp.barcode")),
           (between("acn.label"), isin("acn.owning_lib"), isin("acpl.id"))),
    Report("rpt_detailed_inventory_list", "Detailed Inventory List", COLLECTIONS, "acp",
           (ACN, BRE, RMSR, ACPL),
           (Out("call_number", "acn.label"), Out("tcn_value", "rmsr.tcn_value"), Out("title", "rmsr.title"),
            Out("author", "rmsr.author"), Out("isbn", "rmsr.isbn"), Out("publication_year", "rmsr.pubdate"),
            Out("publisher", "rmsr.publisher"), Out("barcode", "acp.barcode")),
           (between("acn.label"), isin("acn.owning_lib"), isin("acpl.id"))),
    Report("rpt_list_pre_cats", "List Pre-Cats", COLLECTIONS, "acp",
           (left("circ", "acp.id", "target_copy"),),
           (Out("precat_title", "acp.dummy_title"), Out("precat_author", "acp.dummy_author"), Out("barcode", "acp.barcode")),
           (fixed("acp.call_number", -1), isin("circ.circ_lib"))),
    Report("rpt_list_titles_by_circulation_modifier", "List Titles by Circulation Modifier", COLLECTIONS, "acp",
           (ACN, BRE, RMSR, VOLUME_OWNER, MODIFIER),
           (Out("circ_modifier", "ccm.name"), Out("call_number", "acn.label"), Out("title", "rmsr.title")),
           (isin("aou.id"), isin("ccm.code"))),
    Report("rpt_list_titles_by_physical_format_item_type", "List Titles by Physical Format/Item Type", COLLECTIONS, "acp",
           (ACN, BRE, RMSR, left("mrd", "bre.id", "record"), left("citm", "mrd.item_type", "code"), VOLUME_OWNER, ACPL,
            MODIFIER),
           (Out("type", "mrd.item_type"), Out("call_number_label", "acn.label"), Out("title", "rmsr.title"),
            Out("shelving_location", "acpl.name")),
           (isin("aou.id"), isin("ccm.code"), isin("citm.code"))),
    Report("rpt_list_of_titles_deleted_by_date_range", "List of Titles Deleted by Date Range", COLLECTIONS, "bre",
           (RMSR,),
           (Out("title", "rmsr.title"), Out("author", "rmsr.author"), Out("pub_year", "rmsr.pubdate"),
            Out("isbn", "rmsr.isbn"), Out("tcn_source", "rmsr.tcn_source"), Out("tcn_value", "rmsr.tcn_value")),
           (fixed("bre.active", False), fixed("bre.deleted", True), days("bre.edit_date"))),
    Report("rpt_list_items_by_copy_status", "List Items by Copy Status", COLLECTIONS, "acp",
           (ACN, BRE, RMSR, VOLUME_OWNER, inner("ccs", "acp.status")),
           (Out("owning_library", "aou.name"), Out("copy_status", "ccs.name"), Out("call_number", "acn.label"),
            Out("title", "rmsr.title"), Out("item_barcode", "acp.barcode")),
           (isin("acn.owning_lib"), isin("ccs.id"))),
    Report("rpt_list_items_added_by_date_range", "List Items Added by Date Range", COLLECTIONS, "acp",
           (ACN, inner("aou", "acn.owning_lib"), BRE, RMSR),
           (Out("owning_library", "aou.name"), Out("call_number", "acn.label"), Out("title", "rmsr.title"),
            Out("item_barcode", "acp.barcode")),
           (days("acp.create_date"), fixed("acp.deleted", False), isin("acn.owning_lib"))),
    Report("rpt_count_items_by_circulation_modifier_shelving_location",
           "Count Items by Circulation Modifier & Shelving Location", COLLECTIONS, "acp",
           (ACPL, MODIFIER, *HOLDINGS),
           (Out("owning_library", "aou.name"), Out("circulation_modifier", "ccm.name"), Out("shelving_location", "acpl.name"),
            count("items", "acp.id")),
           (days("acp.create_date"), fixed("acp.deleted", False), isin("acpl.id"), isin("ccm.code"), isin("acn.owning_lib"))),
    Report("rpt_count_items_added_by_date_range_statistical_category",
           "Count Items Added by Date Range & Statistical Category", COLLECTIONS, "acp",
           (*HOLDINGS, left("ascecm", "acp.id", "owning_copy"), left("asce", "ascecm.stat_cat_entry"),
            left("asc", "asce.stat_cat"), left("asc2", "ascecm.stat_cat"), left("asce2", "asc2.id", "stat_cat")),
           (Out("owning_library", "aou.name"), Out("value", "asce2.value"), count("items_added", "acp.id")),
           (fixed("acp.deleted", False), days("acp.create_date"), isin("acn.owning_lib"), isin("asc.id"))),
    Report("rpt_count_items_deleted_by_date_range", "Count Items Deleted by Date Range", COLLECTIONS, "acp", HOLDINGS,
           (Out("owning_library", "aou.name"), count("items_deleted", "acp.id")),
           (isin("acn.owning_lib"), fixed("acn.deleted", True), days("acn.edit_date"))),
    Report("rpt_count_items_added_by_date_range", "Count Items Added by Date Range", COLLECTIONS, "acp", HOLDINGS,
           (Out("owning_library", "aou.name"), count("items_added", "acp.id")),
           (fixed("acp.deleted", False), days("acp.create_date"), isin("acn.owning_lib"))),
    Report("rpt_count_items_by_library", "Count Items by Library", COLLECTIONS, "acp", HOLDINGS,
           (Out("owning_library", "aou.name"), count("items", "acp.id")),
           (fixed("acp.deleted", False), isin("acn.owning_lib"))),
    Report("rpt_count_titles_by_library", "Count Titles by Library", COLLECTIONS, "bre",
           (left("acn", "bre.id", "record"), VOLUME_OWNER),
           (Out("owning_library", "aou.name"), count("titles", "bre.id")),
           (fixed("bre.active", True), fixed("bre.deleted", False), isin("acn.owning_lib"))),
)

_CARD = left("ac", "au.id", "usr")
_HOME = inner("aou", "au.home_ou")
_LOAN = left("circ", "aoc.id")
_LOAN_ITEM = (left("acp", "circ.target_copy"), ACN, BRE, RMSR)
_OPEN_COLUMNS = (
    Out("last_name", "au.family_name"), Out("first_name", "au.first_given_name"), Out("patron_barcode", "ac.barcode"),
    Out("title", "rmsr.title"), Out("call_number", "acn.label"), Out("item_barcode", "acp.barcode"),
    Out("due_date", "circ.due_date", part="date"),
)

_PATRON_REPORTS = (
    Report("rpt_count_inactive_patron_accounts_by_library", "Count Inactive Patron Accounts by Library", PATRONS, "au",
           (_CARD, _HOME),
           (Out("home_library", "aou.name"), count("accounts", "au.id")),
           (isin("au.home_ou"), fixed("ac.active", False))),
    Report("rpt_patron_mailing_list", "Patron Mailing List", PATRONS, "au",
           (left("aua", "au.id", "usr"), _CARD),
           (Out("last_name", "au.family_name"), Out("first_name", "au.first_given_name"), Out("address_1", "aua.street1"),
            Out("address_2", "aua.street2"), Out("city", "aua.city"), Out("state", "aua.state"),
            Out("zip_code", "aua.post_code")),
           (isin("au.home_ou"), fixed("ac.active", True))),
    Report("rpt_list_patrons_with_open_transactions_by_permission_group",
           "List Patrons with Open Transactions by Permission Group", PATRONS, "aoc",
           (_LOAN, left("au", "circ.usr"), _CARD, *_LOAN_ITEM, left("au2", "circ.usr"), left("aou", "au2.home_ou"),
            left("pgt", "au2.profile")),
           _OPEN_COLUMNS,
           (days("circ.due_date"), isin("aou.id"), isin("pgt.id"))),
    Report("rpt_list_patrons_with_open_transactions", "List Patrons with Open Transactions", PATRONS, "aoc",
           (_LOAN, left("au", "circ.usr"), _CARD, *_LOAN_ITEM, left("au2", "circ.usr"), left("aou", "au2.home_ou")),
           _OPEN_COLUMNS,
           (days("circ.due_date"), isin("aou.id"))),
    Report("rpt_list_patrons_with_outstanding_balances_by_permission_group",
           "List Patrons with Outstanding Balances by Permission Group", PATRONS, "mobts",
           (left("au", "mobts.usr"), _CARD, left("pgt", "au.profile")),
           (Out("permission_group", "pgt.name"), Out("last_name", "au.family_name"), Out("first_name", "au.first_given_name"),
            Out("patron_barcode", "ac.barcode"), Out("balance_owed", "mobts.balance_owed", agg="sum")),
           (isin("au.home_ou"), isin("pgt.id"))),
    Report("rpt_list_patrons_with_outstanding_balances", "List Patrons with Outstanding Balances", PATRONS, "mobts",
           (left("au", "mobts.usr"), _CARD),
           (Out("last_name", "au.family_name"), Out("first_name", "au.first_given_name"),
            Out("patron_barcode", "ac.barcode"), Out("balance_owed", "mobts.balance_owed", agg="sum")),
           (isin("au.home_ou"),)),
    Report("rpt_count_patrons_by_permission_group", "Count Patrons by Permission Group", PATRONS, "au",
           (inner("pgt", "au.profile"), _HOME),
           (Out("home_library", "aou.name"), Out("permission_group", "pgt.name"), count("patrons", "au.id")),
           (days("au.create_date"), isin("pgt.id"), isin("aou.id"))),
    Report("rpt_count_patrons_by_library_statistical_category", "Count Patrons by Library & Statistical Category", PATRONS,
           "au",
           (_HOME, left("actscecm", "au.id", "target_usr"), left("actsc", "actscecm.stat_cat"),
            left("actsce", "actsc.id", "stat_cat")),
           (Out("home_library", "aou.name"), Out("stat_cat_value", "actsce.value"), count("patrons", "au.id")),
           (isin("aou.id"), isin("actsc.id"))),
    Report("rpt_count_patrons_added_by_zip_code_date", "Count Patrons Added by Zip Code & Date", PATRONS, "au",
           (_CARD, _HOME, left("aua", "au.id", "usr")),
           (Out("library", "aou.name"), Out("postal_code", "aua.post_code"), count("patrons", "au.id")),
           (days("au.create_date"), fixed("ac.active", True), isin("aou.id"))),
    Report("rpt_count_patrons_added_by_date_range", "Count Patrons Added by Date Range", PATRONS, "au",
           (_CARD, _HOME),
           (Out("library", "aou.name"), count("patrons", "au.id")),
           (days("au.create_date"), fixed("ac.active", True), isin("aou.id"))),
)

_LOAN_LIB = inner("aou", "circ.circ_lib")
_LOAN_MONTH = Out("check_out_date", "circ.xact_start", part="month_trunc")
_TRANSITS = (inner("aou", "atc.dest"), left("ahtc", "atc.id"), left("aou2", "ahtc.source"))
_SENT = Out("send_date", "atc.source_send_time", part="month_trunc")

_SERVICE_REPORTS = (
    Report("rpt_list_titles_used_in_house", "List Titles Used in House", SERVICES, "aihu",
           (left("acp", "aihu.item"), ACN, BRE, RMSR, left("acp2", "acn.id", "call_number")),
           (Out("use_date", "aihu.use_time", part="month_trunc"), Out("title", "rmsr.title"), Out("author", "rmsr.author"),
            Out("isbn", "rmsr.isbn"), Out("barcode", "acp2.barcode"), count("times_used", "aihu.id")),
           (days("aihu.use_time"), isin("aihu.org_unit")), many=("acp2",)),
    Report("rpt_count_in_house_usage_by_library", "Count In House Usage by Library", SERVICES, "aihu",
           (inner("acp", "aihu.item"), inner("aou", "acp.circ_lib")),
           (Out("use_date", "aihu.use_time", part="month_trunc"), count("uses", "aihu.id")),
           (days("aihu.use_time"), isin("aou.id"))),
    Report("rpt_open_pre_cat_circulations", "Open Pre-Cat Circulations", SERVICES, "aoc",
           (_LOAN, left("acp", "circ.target_copy"), left("au", "circ.usr"), _CARD),
           (Out("due_date", "circ.due_date", part="date"), Out("last_name", "au.family_name"),
            Out("first_name", "au.first_given_name"), Out("barcode", "ac.barcode"),
            Out("precat_title", "acp.dummy_title"), Out("precat_author", "acp.dummy_author")),
           (days("circ.xact_start"), isin("circ.circ_lib"), fixed("acp.call_number", -1))),
    Report("rpt_list_available_holds_by_capture_date_clean_holds_shelf",
           "List Available Holds by Capture Date (Clean Holds Shelf)", SERVICES, "ahr",
           (left("acp", "ahr.current_copy"), ACN, BRE, RMSR, left("au", "ahr.requestor"), _CARD,
            left("aua", "au.id", "usr"), left("au2", "aua.usr")),
           (Out("call_number", "acn.label"), Out("title", "rmsr.title"), Out("item_barcode", "acp.barcode"),
            Out("patron_barcode", "ac.barcode"), Out("daytime_phone", "au2.day_phone"),
            Out("evening_phone", "au2.evening_phone"), Out("email_address", "au2.email"),
            Out("date_available", "ahr.capture_time", part="date")),
           (isin("ahr.pickup_lib"), days("ahr.capture_time"))),
    Report("rpt_items_loaned_by_receiving_library_date_range", "Items Loaned by Receiving Library & Date Range", SERVICES,
           "atc", _TRANSITS,
           (Out("destination_library", "aou.shortname"), Out("sending_library", "aou2.name"), _SENT,
            count("transits", "atc.id")),
           (days("atc.source_send_time"), isin("aou.id"))),
    Report("rpt_items_loaned_by_sending_library_date_range", "Items Loaned by Sending Library & Date Range", SERVICES,
           "atc", _TRANSITS,
           (Out("sending_library", "aou2.name"), Out("destination_library", "aou.shortname"), _SENT,
            count("transits", "atc.id")),
           (days("atc.source_send_time"), isin("ahtc.source"))),
    Report("rpt_count_holds_unfulfilled_by_library", "Count Holds Unfulfilled by Library", SERVICES, "ahr",
           (inner("aou", "ahr.pickup_lib"),),
           (Out("pickup_library", "aou.name"), Out("capture_date", "ahr.capture_time", part="date"), count("holds", "ahr.id")),
           (isin("ahr.pickup_lib"), days("ahr.capture_time"))),
    Report("rpt_count_holds_filled_by_library_date_range", "Count Holds Filled by Library & Date Range", SERVICES, "ahr",
           (inner("aou", "ahr.fulfillment_lib"),),
           (Out("fulfillment_date", "ahr.fulfillment_time", part="month_trunc"), Out("library", "aou.name"),
            count("holds", "ahr.id")),
           (isin("ahr.fulfillment_lib"), days("ahr.fulfillment_time"))),
    Report("rpt_count_circulations_by_non_cataloged_type_date_range",
           "Count Circulations by Non-Cataloged Type & Date Range", SERVICES, "ancc",
           (inner("cnct", "ancc.item_type"), inner("aou", "ancc.circ_lib")),
           (Out("circulation_date", "ancc.circ_time", part="month_trunc"), Out("circulating_library", "aou.name"),
            Out("non_cataloged_type", "cnct.name"), count("circulations", "ancc.id")),
           (isin("ancc.circ_lib"), days("ancc.circ_time"), isin("cnct.id"))),
    Report("rpt_count_circulations_by_patron_permission_group", "Count Circulations by Patron Permission Group", SERVICES,
           "circ", (inner("au", "circ.usr"), inner("pgt", "au.profile"), _LOAN_LIB),
           (_LOAN_MONTH, Out("permission_group", "pgt.name"), Out("circulating_library", "aou.name"),
            count("circulations", "circ.id")),
           (isin("circ.circ_lib"), days("circ.xact_start"), isin("pgt.id"))),
    Report("rpt_count_circulations_by_library_shelving_location", "Count Circulations by Library & Shelving Location",
           SERVICES, "circ", (_LOAN_LIB, inner("acp", "circ.target_copy"), ACPL),
           (Out("shelving_location", "acpl.name"), _LOAN_MONTH, Out("circulating_library", "aou.name"),
            count("circulations", "circ.id")),
           (between("circ.xact_start", "month_trunc"), isin("circ.circ_lib"), isin("acpl.id"))),
    Report("rpt_count_circulations_by_library_circulation_modifier",
           "Count Circulations by Library & Circulation Modifier", SERVICES, "circ",
           (_LOAN_LIB, inner("acp", "circ.target_copy"), MODIFIER),
           (_LOAN_MONTH, Out("circulating_library", "aou.name"), Out("circ_modifier", "ccm.name"),
            count("circulations", "circ.id")),
           (between("circ.xact_start", "month_trunc"), isin("circ.circ_lib"), isin("ccm.code"))),
    Report("rpt_count_circulations_by_hour_of_the_day", "Count Circulations by Hour of the Day", SERVICES, "circ",
           (_LOAN_LIB,),
           (Out("hour_of_day", "circ.xact_start", part="hour_trunc"), Out("circulating_library", "aou.name"),
            count("circulations", "circ.id")),
           (days("circ.xact_start"), isin("circ.circ_lib"))),
    Report("rpt_count_circulation_by_library_day_of_the_week", "Count Circulation by Library & Day of the Week", SERVICES,
           "circ", (),
           (Out("check_out_day", "circ.xact_start", part="day_name"), count("circulations", "circ.id")),
           (isin("circ.circ_lib"), days("circ.xact_start"))),
)

_DESK = (inner("aws", "circ.workstation"), inner("aou", "aws.owning_lib"))
_DESK_COLUMNS = (Out("workstation_library", "aou.name"), Out("workstation_name", "aws.name"))
_CHECKED_OUT_MONTHS = isin("circ.xact_start", "month_trunc")

_CIRCULATION_REPORTS = (
    Report("rpt_hourly_checkouts", "Hourly Checkouts", CIRCULATION, "circ",
           (*_DESK, left("mbt", "circ.id")),
           (*_DESK_COLUMNS, Out("date", "mbt.xact_start", part="date"),
            Out("hour_of_day", "circ.xact_start", part="hour_trunc"), count("circulations", "circ.id")),
           (days("circ.xact_start"), isin("aou.id"))),
    Report("rpt_hourly_checkins", "Hourly Checkins", CIRCULATION, "circ",
           (left("mbt", "circ.id"), left("aou", "circ.checkin_lib"), left("aws", "aou.id", "owning_lib")),
           (*_DESK_COLUMNS, Out("date", "mbt.xact_start", part="date"),
            Out("hour_of_day", "circ.checkin_time", part="hod"), count("checkins", "circ.id")),
           (days("circ.checkin_time"), isin("aou.id"))),
    Report("rpt_checkout_statistics_by_circulating_library", "Checkout Statistics by Circulating Library", CIRCULATION,
           "circ", (_LOAN_LIB,),
           (Out("month", "circ.xact_start", part="month_trunc"), Out("circulating_library", "aou.name"),
            count("circulation_count", "circ.id")),
           (_CHECKED_OUT_MONTHS, isin("aou.id"))),
    Report("rpt_circulation_placed_holds_by_patron_group_report", "Circulation (Placed Holds by Patron Group) Report",
           CIRCULATION, "ahr",
           (inner("au", "ahr.requestor"), inner("pgt", "au.profile"), inner("aou", "ahr.request_lib"),
            left("aws", "aou.id", "owning_lib"), left("aou2", "aws.owning_lib")),
           (Out("request_date", "ahr.request_time", part="month_trunc"), Out("workstation_library", "aou2.name"),
            count("holds_filled", "ahr.id")),
           (isin("ahr.request_time", "month_trunc"), isin("pgt.id"))),
    Report("rpt_checkins_yearly", "Checkins Yearly", CIRCULATION, "circ", _DESK,
           (*_DESK_COLUMNS, count("circulations", "circ.id")),
           (Where("circ.checkin_time", "=", "year_trunc"), isin("aou.id"))),
    Report("rpt_circulation_yearly", "Circulation Yearly", CIRCULATION, "circ", _DESK,
           (*_DESK_COLUMNS, count("circulations", "circ.id")),
           (Where("circ.xact_start", "=", "year_trunc"), isin("aou.id"))),
    Report("rpt_checkin_statistics", "Checkin Statistics", CIRCULATION, "circ", _DESK,
           (Out("check_in_date", "circ.checkin_time", part="month_trunc"), *_DESK_COLUMNS,
            count("circulation_count", "circ.id")),
           (isin("circ.checkin_time", "month_trunc"), isin("aws.owning_lib"))),
    Report("rpt_opac_renewal_statistics", "OPAC Renewal Statistics", CIRCULATION, "circ", (),
           (Out("month", "circ.xact_start", part="month_trunc"), count("renewals", "circ.id")),
           (_CHECKED_OUT_MONTHS, fixed("circ.opac_renewal", True))),
    Report("rpt_checkout_statistics_by_circulation_type", "Checkout Statistics by Circulation Type", CIRCULATION, "rcirct",
           (left("circ", "rcirct.id"), left("aws", "circ.workstation"), left("circ2", "rcirct.id"),
            left("aws2", "circ2.workstation"), left("aou", "aws2.owning_lib")),
           (Out("month", "circ.xact_start", part="month_trunc"), *_DESK_COLUMNS, Out("circulation_type", "rcirct.type"),
            Out("circulations", "circ.id", agg="count_distinct")),
           (_CHECKED_OUT_MONTHS, isin("aou.id")), unique_counts=True),
    Report("rpt_checkout_statistics", "Checkout Statistics", CIRCULATION, "circ", _DESK,
           (Out("month", "circ.xact_start", part="month_trunc"), *_DESK_COLUMNS, count("circulation_count", "circ.id")),
           (_CHECKED_OUT_MONTHS, isin("aws.owning_lib"))),
    Report("rpt_holds_filled_report_by_fulfillment_date_pickup_library",
           "Holds Filled Report (by Fulfillment Date & Pickup Library)", CIRCULATION, "ahr",
           (inner("aou", "ahr.pickup_lib"),),
           (Out("fulfillment_date", "ahr.fulfillment_time", part="month_trunc"), Out("pickup_library", "aou.name"),
            count("hold_count", "ahr.id")),
           (days("ahr.fulfillment_time"), isin("ahr.pickup_lib"))),
    Report("rpt_circulation_statistics_by_patron_address", "Circulation Statistics by Patron Address", CIRCULATION, "circ",
           (left("au", "circ.usr"), left("aua", "au.id", "usr"), *_DESK),
           (Out("workstation_library", "aou.name"), Out("street_1", "aua.street1"), Out("street_2", "aua.street2"),
            Out("city", "aua.city"), Out("state", "aua.state"), Out("postal_code", "aua.post_code"),
            Out("circ_total", "circ.id", agg="count_distinct")),
           (days("circ.xact_start"), isin("aws.owning_lib")), distinct_leaves=("aua",), unique_counts=True),
    Report("rpt_placed_holds_by_patron_group_and_requesting_library",
           "Placed Holds by Patron Group and Requesting Library", CIRCULATION, "ahr",
           (inner("au", "ahr.requestor"), inner("pgt", "au.profile"), inner("aou", "ahr.request_lib")),
           (Out("request_date", "ahr.request_time", part="month_trunc"), Out("requesting_library", "aou.name"),
            count("holds_placed", "ahr.id")),
           (isin("ahr.request_time", "month_trunc"), isin("pgt.id"))),
)

_RATIO_COLUMNS = (
    Out("holdable_copy_count", "rhcrpb.copy_count"), Out("active_holds", "rhcrpb.hold_count"),
    Out("hold_copy_ratio", "rhcrpb.hold_copy_ratio"),
)
_RATIO_AT_LEAST = Where("rhcrpb.hold_copy_ratio", ">=")
_TITLE_COLUMNS = (
    Out("author", "rmsr.author"), Out("title", "rmsr.title"), Out("isbn", "rmsr.isbn"), Out("publisher", "rmsr.publisher"),
    Out("pub_year", "rmsr.pubdate"), Out("price", "acp.price", agg="max"),
)
_POPULAR_COLUMNS = (
    Out("title", "rmsr.title"), Out("author", "rmsr.author"), count("holdable_copy_count", "rhcrpb.copy_count"),
    Out("hold_copy_ratio", "rhcrpb.hold_copy_ratio"),
)
_COLLECTION_SIZE = (
    Out("owning_library", "aou.name"), Out("shelving_location", "acpl.name"), count("copies", "acp.id"),
    count("circulations", "circ.id"),
)
_COPIES_AND_LOANS = (*HOLDINGS, ACPL, left("circ", "acp.id", "target_copy"))

_ACQUISITION_REPORTS = (
    Report("rpt_purchase_alerts_report", "Purchase Alerts Report", ACQUISITIONS, "rhcrpb",
           (left("bre", "rhcrpb.id"), RMSR, left("acn", "bre.id", "record"), left("acp", "acn.id", "call_number"),
            left("bre2", "acn.record"), left("mrd", "bre2.id", "record")),
           (Out("lang", "mrd.item_lang"), Out("call_number", "acn.label"), Out("record_id", "rhcrpb.id"),
            *_TITLE_COLUMNS, *_RATIO_COLUMNS),
           (_RATIO_AT_LEAST, between("acn.label")), fold_leaves=("acp",)),
    Report("rpt_popular_titles_on_hold", "Popular Titles on Hold", ACQUISITIONS, "rhcrpb",
           (left("bre", "rhcrpb.id"), RMSR), _POPULAR_COLUMNS, (_RATIO_AT_LEAST,)),
    Report("rpt_size_of_collection_report", "Size of Collection Report", ACQUISITIONS, "acp", _COPIES_AND_LOANS,
           _COLLECTION_SIZE, (days("circ.xact_start"), isin("acn.owning_lib")), fold_leaves=("circ",)),
    Report("rpt_ytd_circs_by_owning_library_and_shelving_location",
           "YTD Circs by Owning Library and Shelving Location", ACQUISITIONS, "acp", _COPIES_AND_LOANS,
           _COLLECTION_SIZE, (days("circ.xact_start"), isin("acn.owning_lib")), fold_leaves=("circ",)),
    Report("rpt_new_purchase_alerts_report", "NEW Purchase Alerts Report", ACQUISITIONS, "rhcrpb",
           (left("bre", "rhcrpb.id"), left("acn", "bre.id", "record"), left("bre2", "acn.record"),
            left("mrd", "bre2.id", "record"), left("acn2", "bre.id", "record"), left("bre3", "acn2.record"),
            left("rmsr", "bre3.id"), left("acp", "acn2.id", "call_number")),
           (Out("lang", "mrd.item_lang"), Out("call_number", "acn.label"), Out("record_id", "bre.id"),
            *_TITLE_COLUMNS, *_RATIO_COLUMNS),
           (between("acn.label"), _RATIO_AT_LEAST), fold_chains=(("acp", "acn2"),)),
    Report("rpt_new_popular_titles_on_hold", "NEW Popular Titles on Hold", ACQUISITIONS, "rhcrpb",
           (left("bre", "rhcrpb.id"), left("acn", "bre.id", "record"), left("bre2", "acn.record"), left("rmsr", "bre2.id")),
           _POPULAR_COLUMNS, (_RATIO_AT_LEAST,), fold_leaves=("acn",)),
)

REPORTS: dict[str, Report] = {
    r.key: r
    for r in (
        *_COLLECTION_REPORTS, *_PATRON_REPORTS, *_SERVICE_REPORTS, *_CIRCULATION_REPORTS, *_ACQUISITION_REPORTS
    )
}
