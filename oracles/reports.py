"""Oracle SQL of the ready-made reports (DuckDB dialect), joins written out one by one."""

from __future__ import annotations

UNITS = "(SELECT id FROM {org_unit})"
DAYS = "BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"
EVENT_DAYS = "BETWEEN DATE '2024-01-03' AND DATE '2024-01-25'"
MONTHS = "BETWEEN DATE '1996-01-01' AND DATE '1999-12-01'"
MONTH_LIST = "IN (DATE '1997-03-01', DATE '1998-03-01', DATE '1999-03-01')"
MODIFIERS = "('LARGE', 'MEDIUM', 'STANDARD', 'SMALL')"
PLACES = "BETWEEN 1 AND 20"
GROUPS = "(1, 2, 4)"
ADDED = "BETWEEN DATE '1990-06-01' AND DATE '1999-12-31'"
JOINED = "BETWEEN DATE '1995-06-01' AND DATE '1999-12-31'"
LABELS = "BETWEEN 'b' AND 's'"


def day(column: str) -> str:
    return f"CAST({column} AS DATE)"


def month(column: str) -> str:
    return f"CAST(date_trunc('month', {column}) AS DATE)"


ISBN = "array_to_string(rmsr.isbn, ',')"
TO_TITLE = """
    LEFT JOIN {call_number} acn ON acn.id = acp.call_number LEFT JOIN {record_entry} bre ON bre.id = acn.record
    LEFT JOIN {simple_record} rmsr ON rmsr.id = bre.id"""
HOLDINGS = """
    FROM {copy} acp JOIN {call_number} acn ON acn.id = acp.call_number JOIN {org_unit} aou ON aou.id = acn.owning_lib"""
DESK = """
    FROM {circulation} circ JOIN {workstation} aws ON aws.id = circ.workstation JOIN {org_unit} aou ON aou.id = aws.owning_lib"""
DESK_NAMES = "aou.name AS workstation_library, aws.name AS workstation_name"
OPEN_LOANS = """
    FROM {open_circulation} aoc LEFT JOIN {circulation} circ ON circ.id = aoc.id LEFT JOIN {usr} au ON au.id = circ.usr
    LEFT JOIN {card} ac ON ac.usr = au.id LEFT JOIN {copy} acp ON acp.id = circ.target_copy""" + TO_TITLE + """
    LEFT JOIN {usr} au2 ON au2.id = circ.usr LEFT JOIN {org_unit} aou ON aou.id = au2.home_ou"""
OPEN_COLUMNS = f"""
    au.family_name AS last_name, au.first_given_name AS first_name, ac.barcode AS patron_barcode, rmsr.title,
    acn.label AS call_number, acp.barcode AS item_barcode, {day('circ.due_date')} AS due_date"""
TRANSITS = """
    FROM {transit_copy} atc JOIN {org_unit} aou ON aou.id = atc.dest LEFT JOIN {hold_transit_copy} ahtc ON ahtc.id = atc.id
    LEFT JOIN {org_unit} aou2 ON aou2.id = ahtc.source"""
COPIES_AND_LOANS = HOLDINGS + """
    JOIN {copy_location} acpl ON acpl.id = acp.location LEFT JOIN {circulation} circ ON circ.target_copy = acp.id"""
RATIO_COLUMNS = "q.copy_count AS holdable_copy_count, q.hold_count AS active_holds, q.hold_copy_ratio"
TITLE_COLUMNS = f"rmsr.author, rmsr.title, {ISBN} AS isbn, rmsr.publisher, rmsr.pubdate AS pub_year"

REPORT_ORACLES: dict[str, str] = {
    "rpt_brief_inventory_list": f"""
        SELECT acpl.name AS shelving_location, acn.label AS call_number, rmsr.title, acp.barcode
        FROM {{copy}} acp {TO_TITLE} JOIN {{copy_location}} acpl ON acpl.id = acp.location
        WHERE acn.label {LABELS} AND acn.owning_lib IN {UNITS} AND acpl.id {PLACES}""",
    "rpt_detailed_inventory_list": f"""
        SELECT acn.label AS call_number, rmsr.tcn_value, rmsr.title, rmsr.author, {ISBN} AS isbn,
               rmsr.pubdate AS publication_year, rmsr.publisher, acp.barcode
        FROM {{copy}} acp {TO_TITLE} JOIN {{copy_location}} acpl ON acpl.id = acp.location
        WHERE acn.label {LABELS} AND acn.owning_lib IN {UNITS} AND acpl.id {PLACES}""",
    "rpt_list_pre_cats": f"""
        SELECT acp.dummy_title AS precat_title, acp.dummy_author AS precat_author, acp.barcode
        FROM {{copy}} acp LEFT JOIN {{circulation}} circ ON circ.target_copy = acp.id
        WHERE acp.call_number = -1 AND circ.circ_lib IN {UNITS}""",
    "rpt_list_titles_by_circulation_modifier": f"""
        SELECT ccm.name AS circ_modifier, acn.label AS call_number, rmsr.title
        FROM {{copy}} acp {TO_TITLE} LEFT JOIN {{org_unit}} aou ON aou.id = acn.owning_lib
        JOIN {{circ_modifier}} ccm ON ccm.code = acp.circ_modifier
        WHERE aou.id IN {UNITS} AND ccm.code IN {MODIFIERS}""",
    "rpt_list_titles_by_physical_format_item_type": f"""
        SELECT mrd.item_type AS type, acn.label AS call_number_label, rmsr.title, acpl.name AS shelving_location
        FROM {{copy}} acp {TO_TITLE} LEFT JOIN {{rec_descriptor}} mrd ON mrd.record = bre.id
        LEFT JOIN {{item_type_map}} citm ON citm.code = mrd.item_type LEFT JOIN {{org_unit}} aou ON aou.id = acn.owning_lib
        JOIN {{copy_location}} acpl ON acpl.id = acp.location JOIN {{circ_modifier}} ccm ON ccm.code = acp.circ_modifier
        WHERE aou.id IN {UNITS} AND ccm.code IN {MODIFIERS} AND citm.code IN ('a', 'g', 't')""",
    "rpt_list_of_titles_deleted_by_date_range": f"""
        SELECT rmsr.title, rmsr.author, rmsr.pubdate AS pub_year, {ISBN} AS isbn, rmsr.tcn_source, rmsr.tcn_value
        FROM {{record_entry}} bre LEFT JOIN {{simple_record}} rmsr ON rmsr.id = bre.id
        WHERE NOT bre.active AND bre.deleted AND {day('bre.edit_date')} BETWEEN DATE '1998-01-01' AND DATE '1998-11-30'""",
    "rpt_list_items_by_copy_status": f"""
        SELECT aou.name AS owning_library, ccs.name AS copy_status, acn.label AS call_number, rmsr.title,
               acp.barcode AS item_barcode
        FROM {{copy}} acp {TO_TITLE} LEFT JOIN {{org_unit}} aou ON aou.id = acn.owning_lib
        JOIN {{copy_status}} ccs ON ccs.id = acp.status WHERE acn.owning_lib IN {UNITS} AND ccs.id IN (3, 4, 13, 14)""",
    "rpt_list_items_added_by_date_range": f"""
        SELECT aou.name AS owning_library, acn.label AS call_number, rmsr.title, acp.barcode AS item_barcode
        FROM {{copy}} acp {TO_TITLE} JOIN {{org_unit}} aou ON aou.id = acn.owning_lib
        WHERE {day('acp.create_date')} BETWEEN DATE '1990-06-01' AND DATE '1994-12-31' AND NOT acp.deleted
          AND acn.owning_lib IN {UNITS}""",
    "rpt_count_items_by_circulation_modifier_shelving_location": f"""
        SELECT aou.name AS owning_library, ccm.name AS circulation_modifier, acpl.name AS shelving_location,
               count(acp.id) AS items {HOLDINGS} JOIN {{copy_location}} acpl ON acpl.id = acp.location
        JOIN {{circ_modifier}} ccm ON ccm.code = acp.circ_modifier
        WHERE {day('acp.create_date')} {ADDED} AND NOT acp.deleted AND acpl.id {PLACES} AND ccm.code IN {MODIFIERS}
          AND acn.owning_lib IN {UNITS} GROUP BY 1, 2, 3""",
    "rpt_count_items_added_by_date_range_statistical_category": f"""
        SELECT aou.name AS owning_library, asce2.value, count(acp.id) AS items_added {HOLDINGS}
        LEFT JOIN {{asset_stat_cat_map}} m ON m.owning_copy = acp.id LEFT JOIN {{asset_stat_cat_entry}} e ON e.id = m.stat_cat_entry
        LEFT JOIN {{asset_stat_cat}} sc ON sc.id = e.stat_cat LEFT JOIN {{asset_stat_cat}} sc2 ON sc2.id = m.stat_cat
        LEFT JOIN {{asset_stat_cat_entry}} asce2 ON asce2.stat_cat = sc2.id
        WHERE NOT acp.deleted AND {day('acp.create_date')} {ADDED} AND acn.owning_lib IN {UNITS} AND sc.id IN (0, 1, 3)
        GROUP BY 1, 2""",
    "rpt_count_items_deleted_by_date_range": f"""
        SELECT aou.name AS owning_library, count(acp.id) AS items_deleted {HOLDINGS}
        WHERE acn.owning_lib IN {UNITS} AND acn.deleted AND {day('acn.edit_date')} BETWEEN DATE '1998-01-01' AND DATE '1998-11-30'
        GROUP BY 1""",
    "rpt_count_items_added_by_date_range": f"""
        SELECT aou.name AS owning_library, count(acp.id) AS items_added {HOLDINGS}
        WHERE NOT acp.deleted AND {day('acp.create_date')} {ADDED} AND acn.owning_lib IN {UNITS} GROUP BY 1""",
    "rpt_count_items_by_library": f"""
        SELECT aou.name AS owning_library, count(acp.id) AS items {HOLDINGS}
        WHERE NOT acp.deleted AND acn.owning_lib IN {UNITS} GROUP BY 1""",
    "rpt_count_titles_by_library": f"""
        SELECT aou.name AS owning_library, count(bre.id) AS titles FROM {{record_entry}} bre
        LEFT JOIN {{call_number}} acn ON acn.record = bre.id LEFT JOIN {{org_unit}} aou ON aou.id = acn.owning_lib
        WHERE bre.active AND NOT bre.deleted AND acn.owning_lib IN {UNITS} GROUP BY 1""",
    "rpt_count_inactive_patron_accounts_by_library": f"""
        SELECT aou.name AS home_library, count(au.id) AS accounts FROM {{usr}} au LEFT JOIN {{card}} ac ON ac.usr = au.id
        JOIN {{org_unit}} aou ON aou.id = au.home_ou WHERE au.home_ou IN {UNITS} AND NOT ac.active GROUP BY 1""",
    "rpt_patron_mailing_list": f"""
        SELECT au.family_name AS last_name, au.first_given_name AS first_name, aua.street1 AS address_1,
               aua.street2 AS address_2, aua.city, aua.state, aua.post_code AS zip_code
        FROM {{usr}} au LEFT JOIN {{usr_address}} aua ON aua.usr = au.id LEFT JOIN {{card}} ac ON ac.usr = au.id
        WHERE au.home_ou IN {UNITS} AND ac.active""",
    "rpt_list_patrons_with_open_transactions_by_permission_group": f"""
        SELECT {OPEN_COLUMNS} {OPEN_LOANS} LEFT JOIN {{grp_tree}} pgt ON pgt.id = au2.profile
        WHERE {day('circ.due_date')} {DAYS} AND aou.id IN {UNITS} AND pgt.id IN {GROUPS}""",
    "rpt_list_patrons_with_open_transactions": f"""
        SELECT {OPEN_COLUMNS} {OPEN_LOANS} WHERE {day('circ.due_date')} {DAYS} AND aou.id IN {UNITS}""",
    "rpt_list_patrons_with_outstanding_balances_by_permission_group": f"""
        SELECT pgt.name AS permission_group, au.family_name AS last_name, au.first_given_name AS first_name,
               ac.barcode AS patron_barcode, CAST(sum(x.balance_owed) AS DOUBLE) AS balance_owed
        FROM {{open_billable_xact_summary}} x LEFT JOIN {{usr}} au ON au.id = x.usr LEFT JOIN {{card}} ac ON ac.usr = au.id
        LEFT JOIN {{grp_tree}} pgt ON pgt.id = au.profile WHERE au.home_ou IN {UNITS} AND pgt.id IN {GROUPS} GROUP BY 1, 2, 3, 4""",
    "rpt_list_patrons_with_outstanding_balances": f"""
        SELECT au.family_name AS last_name, au.first_given_name AS first_name, ac.barcode AS patron_barcode,
               CAST(sum(x.balance_owed) AS DOUBLE) AS balance_owed
        FROM {{open_billable_xact_summary}} x LEFT JOIN {{usr}} au ON au.id = x.usr LEFT JOIN {{card}} ac ON ac.usr = au.id
        WHERE au.home_ou IN {UNITS} GROUP BY 1, 2, 3""",
    "rpt_count_patrons_by_permission_group": f"""
        SELECT aou.name AS home_library, pgt.name AS permission_group, count(au.id) AS patrons
        FROM {{usr}} au JOIN {{grp_tree}} pgt ON pgt.id = au.profile JOIN {{org_unit}} aou ON aou.id = au.home_ou
        WHERE {day('au.create_date')} {JOINED} AND pgt.id IN {GROUPS} AND aou.id IN {UNITS} GROUP BY 1, 2""",
    "rpt_count_patrons_by_library_statistical_category": f"""
        SELECT aou.name AS home_library, e.value AS stat_cat_value, count(au.id) AS patrons
        FROM {{usr}} au JOIN {{org_unit}} aou ON aou.id = au.home_ou LEFT JOIN {{actor_stat_cat_map}} m ON m.target_usr = au.id
        LEFT JOIN {{actor_stat_cat}} s ON s.id = m.stat_cat LEFT JOIN {{actor_stat_cat_entry}} e ON e.stat_cat = s.id
        WHERE aou.id IN {UNITS} AND s.id IN (0, 2, 3) GROUP BY 1, 2""",
    "rpt_count_patrons_added_by_zip_code_date": f"""
        SELECT aou.name AS library, aua.post_code AS postal_code, count(au.id) AS patrons
        FROM {{usr}} au LEFT JOIN {{card}} ac ON ac.usr = au.id JOIN {{org_unit}} aou ON aou.id = au.home_ou
        LEFT JOIN {{usr_address}} aua ON aua.usr = au.id
        WHERE {day('au.create_date')} {JOINED} AND ac.active AND aou.id IN {UNITS} GROUP BY 1, 2""",
    "rpt_count_patrons_added_by_date_range": f"""
        SELECT aou.name AS library, count(au.id) AS patrons
        FROM {{usr}} au LEFT JOIN {{card}} ac ON ac.usr = au.id JOIN {{org_unit}} aou ON aou.id = au.home_ou
        WHERE {day('au.create_date')} {JOINED} AND ac.active AND aou.id IN {UNITS} GROUP BY 1""",
    "rpt_list_titles_used_in_house": f"""
        SELECT {month('u.use_time')} AS use_date, rmsr.title, rmsr.author, {ISBN} AS isbn, acp2.barcode, count(u.id) AS times_used
        FROM {{in_house_use}} u LEFT JOIN {{copy}} acp ON acp.id = u.item {TO_TITLE}
        LEFT JOIN {{copy}} acp2 ON acp2.call_number = acn.id
        WHERE {day('u.use_time')} {EVENT_DAYS} AND u.org_unit IN {UNITS} GROUP BY 1, 2, 3, 4, 5""",
    "rpt_count_in_house_usage_by_library": f"""
        SELECT {month('u.use_time')} AS use_date, count(u.id) AS uses FROM {{in_house_use}} u JOIN {{copy}} acp ON acp.id = u.item
        JOIN {{org_unit}} aou ON aou.id = acp.circ_lib WHERE {day('u.use_time')} {EVENT_DAYS} AND aou.id IN {UNITS} GROUP BY 1""",
    "rpt_open_pre_cat_circulations": f"""
        SELECT {day('circ.due_date')} AS due_date, au.family_name AS last_name, au.first_given_name AS first_name, ac.barcode,
               acp.dummy_title AS precat_title, acp.dummy_author AS precat_author
        FROM {{open_circulation}} aoc LEFT JOIN {{circulation}} circ ON circ.id = aoc.id
        LEFT JOIN {{copy}} acp ON acp.id = circ.target_copy LEFT JOIN {{usr}} au ON au.id = circ.usr
        LEFT JOIN {{card}} ac ON ac.usr = au.id
        WHERE {day('circ.xact_start')} {DAYS} AND circ.circ_lib IN {UNITS} AND acp.call_number = -1""",
    "rpt_list_available_holds_by_capture_date_clean_holds_shelf": f"""
        SELECT acn.label AS call_number, rmsr.title, acp.barcode AS item_barcode, ac.barcode AS patron_barcode,
               au2.day_phone AS daytime_phone, au2.evening_phone, au2.email AS email_address,
               {day('ahr.capture_time')} AS date_available
        FROM {{hold_request}} ahr LEFT JOIN {{copy}} acp ON acp.id = ahr.current_copy {TO_TITLE}
        LEFT JOIN {{usr}} au ON au.id = ahr.requestor LEFT JOIN {{card}} ac ON ac.usr = au.id
        LEFT JOIN {{usr_address}} aua ON aua.usr = au.id LEFT JOIN {{usr}} au2 ON au2.id = aua.usr
        WHERE ahr.pickup_lib IN {UNITS} AND {day('ahr.capture_time')} {DAYS}""",
    "rpt_items_loaned_by_receiving_library_date_range": f"""
        SELECT aou.shortname AS destination_library, aou2.name AS sending_library, {month('atc.source_send_time')} AS send_date,
               count(atc.id) AS transits {TRANSITS}
        WHERE {day('atc.source_send_time')} {DAYS} AND aou.id IN {UNITS} GROUP BY 1, 2, 3""",
    "rpt_items_loaned_by_sending_library_date_range": f"""
        SELECT aou2.name AS sending_library, aou.shortname AS destination_library, {month('atc.source_send_time')} AS send_date,
               count(atc.id) AS transits {TRANSITS}
        WHERE {day('atc.source_send_time')} {DAYS} AND ahtc.source IN {UNITS} GROUP BY 1, 2, 3""",
    "rpt_count_holds_unfulfilled_by_library": f"""
        SELECT aou.name AS pickup_library, {day('ahr.capture_time')} AS capture_date, count(ahr.id) AS holds
        FROM {{hold_request}} ahr JOIN {{org_unit}} aou ON aou.id = ahr.pickup_lib
        WHERE ahr.pickup_lib IN {UNITS} AND {day('ahr.capture_time')} {DAYS} GROUP BY 1, 2""",
    "rpt_count_holds_filled_by_library_date_range": f"""
        SELECT {month('ahr.fulfillment_time')} AS fulfillment_date, aou.name AS library, count(ahr.id) AS holds
        FROM {{hold_request}} ahr JOIN {{org_unit}} aou ON aou.id = ahr.fulfillment_lib
        WHERE ahr.fulfillment_lib IN {UNITS} AND {day('ahr.fulfillment_time')} {DAYS} GROUP BY 1, 2""",
    "rpt_count_circulations_by_non_cataloged_type_date_range": f"""
        SELECT {month('c.circ_time')} AS circulation_date, aou.name AS circulating_library, t.name AS non_cataloged_type,
               count(c.id) AS circulations
        FROM {{non_cataloged_circulation}} c JOIN {{non_cataloged_type}} t ON t.id = c.item_type
        JOIN {{org_unit}} aou ON aou.id = c.circ_lib
        WHERE c.circ_lib IN {UNITS} AND {day('c.circ_time')} {EVENT_DAYS} AND t.id IN (0, 1, 2, 4) GROUP BY 1, 2, 3""",
    "rpt_count_circulations_by_patron_permission_group": f"""
        SELECT {month('circ.xact_start')} AS check_out_date, pgt.name AS permission_group, aou.name AS circulating_library,
               count(circ.id) AS circulations
        FROM {{circulation}} circ JOIN {{usr}} au ON au.id = circ.usr JOIN {{grp_tree}} pgt ON pgt.id = au.profile
        JOIN {{org_unit}} aou ON aou.id = circ.circ_lib
        WHERE circ.circ_lib IN {UNITS} AND {day('circ.xact_start')} {DAYS} AND pgt.id IN {GROUPS} GROUP BY 1, 2, 3""",
    "rpt_count_circulations_by_library_shelving_location": f"""
        SELECT acpl.name AS shelving_location, {month('circ.xact_start')} AS check_out_date, aou.name AS circulating_library,
               count(circ.id) AS circulations
        FROM {{circulation}} circ JOIN {{org_unit}} aou ON aou.id = circ.circ_lib JOIN {{copy}} acp ON acp.id = circ.target_copy
        JOIN {{copy_location}} acpl ON acpl.id = acp.location
        WHERE {month('circ.xact_start')} {MONTHS} AND circ.circ_lib IN {UNITS} AND acpl.id {PLACES} GROUP BY 1, 2, 3""",
    "rpt_count_circulations_by_library_circulation_modifier": f"""
        SELECT {month('circ.xact_start')} AS check_out_date, aou.name AS circulating_library, ccm.name AS circ_modifier,
               count(circ.id) AS circulations
        FROM {{circulation}} circ JOIN {{org_unit}} aou ON aou.id = circ.circ_lib JOIN {{copy}} acp ON acp.id = circ.target_copy
        JOIN {{circ_modifier}} ccm ON ccm.code = acp.circ_modifier
        WHERE {month('circ.xact_start')} {MONTHS} AND circ.circ_lib IN {UNITS} AND ccm.code IN {MODIFIERS} GROUP BY 1, 2, 3""",
    "rpt_count_circulations_by_hour_of_the_day": f"""
        SELECT date_trunc('hour', circ.xact_start) AS hour_of_day, aou.name AS circulating_library, count(circ.id) AS circulations
        FROM {{circulation}} circ JOIN {{org_unit}} aou ON aou.id = circ.circ_lib
        WHERE {day('circ.xact_start')} {DAYS} AND circ.circ_lib IN {UNITS} GROUP BY 1, 2""",
    "rpt_count_circulation_by_library_day_of_the_week": f"""
        SELECT dayname(circ.xact_start) AS check_out_day, count(circ.id) AS circulations FROM {{circulation}} circ
        WHERE circ.circ_lib IN {UNITS} AND {day('circ.xact_start')} {DAYS} GROUP BY 1""",
    "rpt_hourly_checkouts": f"""
        SELECT {DESK_NAMES}, {day('mbt.xact_start')} AS date, date_trunc('hour', circ.xact_start) AS hour_of_day,
               count(circ.id) AS circulations {DESK} LEFT JOIN {{billable_xact}} mbt ON mbt.id = circ.id
        WHERE {day('circ.xact_start')} {DAYS} AND aou.id IN {UNITS} GROUP BY 1, 2, 3, 4""",
    "rpt_hourly_checkins": f"""
        SELECT {DESK_NAMES}, {day('mbt.xact_start')} AS date, CAST(hour(circ.checkin_time) AS INTEGER) AS hour_of_day,
               count(circ.id) AS checkins
        FROM {{circulation}} circ LEFT JOIN {{billable_xact}} mbt ON mbt.id = circ.id
        LEFT JOIN {{org_unit}} aou ON aou.id = circ.checkin_lib LEFT JOIN {{workstation}} aws ON aws.owning_lib = aou.id
        WHERE {day('circ.checkin_time')} {DAYS} AND aou.id IN {UNITS} GROUP BY 1, 2, 3, 4""",
    "rpt_checkout_statistics_by_circulating_library": f"""
        SELECT {month('circ.xact_start')} AS month, aou.name AS circulating_library, count(circ.id) AS circulation_count
        FROM {{circulation}} circ JOIN {{org_unit}} aou ON aou.id = circ.circ_lib
        WHERE {month('circ.xact_start')} {MONTH_LIST} AND aou.id IN {UNITS} GROUP BY 1, 2""",
    "rpt_circulation_placed_holds_by_patron_group_report": f"""
        SELECT {month('ahr.request_time')} AS request_date, aou2.name AS workstation_library, count(ahr.id) AS holds_filled
        FROM {{hold_request}} ahr JOIN {{usr}} au ON au.id = ahr.requestor JOIN {{grp_tree}} pgt ON pgt.id = au.profile
        JOIN {{org_unit}} aou ON aou.id = ahr.request_lib LEFT JOIN {{workstation}} aws ON aws.owning_lib = aou.id
        LEFT JOIN {{org_unit}} aou2 ON aou2.id = aws.owning_lib
        WHERE {month('ahr.request_time')} {MONTH_LIST} AND pgt.id IN {GROUPS} GROUP BY 1, 2""",
    "rpt_checkins_yearly": f"""
        SELECT {DESK_NAMES}, count(circ.id) AS circulations {DESK}
        WHERE CAST(date_trunc('year', circ.checkin_time) AS DATE) = DATE '1998-01-01' AND aou.id IN {UNITS} GROUP BY 1, 2""",
    "rpt_circulation_yearly": f"""
        SELECT {DESK_NAMES}, count(circ.id) AS circulations {DESK}
        WHERE CAST(date_trunc('year', circ.xact_start) AS DATE) = DATE '1998-01-01' AND aou.id IN {UNITS} GROUP BY 1, 2""",
    "rpt_checkin_statistics": f"""
        SELECT {month('circ.checkin_time')} AS check_in_date, {DESK_NAMES}, count(circ.id) AS circulation_count {DESK}
        WHERE {month('circ.checkin_time')} {MONTH_LIST} AND aws.owning_lib IN {UNITS} GROUP BY 1, 2, 3""",
    "rpt_opac_renewal_statistics": f"""
        SELECT {month('circ.xact_start')} AS month, count(circ.id) AS renewals FROM {{circulation}} circ
        WHERE {month('circ.xact_start')} {MONTH_LIST} AND circ.opac_renewal GROUP BY 1""",
    "rpt_checkout_statistics_by_circulation_type": f"""
        SELECT {month('circ.xact_start')} AS month, {DESK_NAMES}, r.type AS circulation_type,
               count(DISTINCT circ.id) AS circulations
        FROM {{circ_type}} r LEFT JOIN {{circulation}} circ ON circ.id = r.id LEFT JOIN {{workstation}} aws ON aws.id = circ.workstation
        LEFT JOIN {{circulation}} circ2 ON circ2.id = r.id LEFT JOIN {{workstation}} aws2 ON aws2.id = circ2.workstation
        LEFT JOIN {{org_unit}} aou ON aou.id = aws2.owning_lib
        WHERE {month('circ.xact_start')} {MONTH_LIST} AND aou.id IN {UNITS} GROUP BY 1, 2, 3, 4""",
    "rpt_checkout_statistics": f"""
        SELECT {month('circ.xact_start')} AS month, {DESK_NAMES}, count(circ.id) AS circulation_count {DESK}
        WHERE {month('circ.xact_start')} {MONTH_LIST} AND aws.owning_lib IN {UNITS} GROUP BY 1, 2, 3""",
    "rpt_holds_filled_report_by_fulfillment_date_pickup_library": f"""
        SELECT {month('ahr.fulfillment_time')} AS fulfillment_date, aou.name AS pickup_library, count(ahr.id) AS hold_count
        FROM {{hold_request}} ahr JOIN {{org_unit}} aou ON aou.id = ahr.pickup_lib
        WHERE {day('ahr.fulfillment_time')} {DAYS} AND ahr.pickup_lib IN {UNITS} GROUP BY 1, 2""",
    "rpt_circulation_statistics_by_patron_address": f"""
        SELECT aou.name AS workstation_library, aua.street1 AS street_1, aua.street2 AS street_2, aua.city, aua.state,
               aua.post_code AS postal_code, count(DISTINCT circ.id) AS circ_total
        {DESK} LEFT JOIN {{usr}} au ON au.id = circ.usr LEFT JOIN {{usr_address}} aua ON aua.usr = au.id
        WHERE {day('circ.xact_start')} {DAYS} AND aws.owning_lib IN {UNITS} GROUP BY 1, 2, 3, 4, 5, 6""",
    "rpt_placed_holds_by_patron_group_and_requesting_library": f"""
        SELECT {month('ahr.request_time')} AS request_date, aou.name AS requesting_library, count(ahr.id) AS holds_placed
        FROM {{hold_request}} ahr JOIN {{usr}} au ON au.id = ahr.requestor JOIN {{grp_tree}} pgt ON pgt.id = au.profile
        JOIN {{org_unit}} aou ON aou.id = ahr.request_lib
        WHERE {month('ahr.request_time')} {MONTH_LIST} AND pgt.id IN {GROUPS} GROUP BY 1, 2""",
    "rpt_purchase_alerts_report": f"""
        SELECT mrd.item_lang AS lang, acn.label AS call_number, q.id AS record_id, {TITLE_COLUMNS},
               CAST(max(acp.price) AS DOUBLE) AS price, {RATIO_COLUMNS}
        FROM {{ratio}} q LEFT JOIN {{record_entry}} bre ON bre.id = q.id LEFT JOIN {{simple_record}} rmsr ON rmsr.id = bre.id
        LEFT JOIN {{call_number}} acn ON acn.record = bre.id LEFT JOIN {{copy}} acp ON acp.call_number = acn.id
        LEFT JOIN {{record_entry}} bre2 ON bre2.id = acn.record LEFT JOIN {{rec_descriptor}} mrd ON mrd.record = bre2.id
        WHERE q.hold_copy_ratio >= 3.0 AND acn.label {LABELS} GROUP BY ALL""",
    "rpt_popular_titles_on_hold": """
        SELECT rmsr.title, rmsr.author, count(q.copy_count) AS holdable_copy_count, q.hold_copy_ratio
        FROM {ratio} q LEFT JOIN {record_entry} bre ON bre.id = q.id LEFT JOIN {simple_record} rmsr ON rmsr.id = bre.id
        WHERE q.hold_copy_ratio >= 3.0 GROUP BY 1, 2, 4""",
    "rpt_size_of_collection_report": f"""
        SELECT aou.name AS owning_library, acpl.name AS shelving_location, count(acp.id) AS copies, count(circ.id) AS circulations
        {COPIES_AND_LOANS} WHERE {day('circ.xact_start')} {DAYS} AND acn.owning_lib IN {UNITS} GROUP BY 1, 2""",
    "rpt_ytd_circs_by_owning_library_and_shelving_location": f"""
        SELECT aou.name AS owning_library, acpl.name AS shelving_location, count(acp.id) AS copies, count(circ.id) AS circulations
        {COPIES_AND_LOANS} WHERE {day('circ.xact_start')} BETWEEN DATE '1998-01-01' AND DATE '1998-07-01'
          AND acn.owning_lib IN {UNITS} GROUP BY 1, 2""",
    "rpt_new_purchase_alerts_report": f"""
        SELECT mrd.item_lang AS lang, acn.label AS call_number, bre.id AS record_id, {TITLE_COLUMNS},
               CAST(max(acp.price) AS DOUBLE) AS price, {RATIO_COLUMNS}
        FROM {{ratio}} q LEFT JOIN {{record_entry}} bre ON bre.id = q.id LEFT JOIN {{call_number}} acn ON acn.record = bre.id
        LEFT JOIN {{record_entry}} bre2 ON bre2.id = acn.record LEFT JOIN {{rec_descriptor}} mrd ON mrd.record = bre2.id
        LEFT JOIN {{call_number}} acn2 ON acn2.record = bre.id LEFT JOIN {{record_entry}} bre3 ON bre3.id = acn2.record
        LEFT JOIN {{simple_record}} rmsr ON rmsr.id = bre3.id LEFT JOIN {{copy}} acp ON acp.call_number = acn2.id
        WHERE acn.label {LABELS} AND q.hold_copy_ratio >= 3.0 GROUP BY ALL""",
    "rpt_new_popular_titles_on_hold": """
        SELECT rmsr.title, rmsr.author, count(q.copy_count) AS holdable_copy_count, q.hold_copy_ratio
        FROM {ratio} q LEFT JOIN {record_entry} bre ON bre.id = q.id LEFT JOIN {call_number} acn ON acn.record = bre.id
        LEFT JOIN {record_entry} bre2 ON bre2.id = acn.record LEFT JOIN {simple_record} rmsr ON rmsr.id = bre2.id
        WHERE q.hold_copy_ratio >= 3.0 GROUP BY 1, 2, 4""",
}
