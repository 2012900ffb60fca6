"""Oracle SQL of the operator queries (DuckDB dialect)."""

from __future__ import annotations

from oracles.shared import (
    D, csv, hashed, isbn13, line, marc_any, marc_first, naco, price, raw, subjects, year,
)

ITEM_HEADER = (
    "copy_id,barcode,biblio_id,eans,circ_modifier,call_number,copy_location,library,create_date,"
    "status,last_circ,last_checkin,last_due,monthly_circs,annual_circs,all_circs,fund"
)


def unit_files(header: str, body: str) -> str:
    return f"SELECT DISTINCT root, '{header}' AS line FROM {{scope}} UNION ALL {body}"


def with_header(header: str, body: str) -> str:
    return f"SELECT '{header}' AS line UNION ALL {body}"


ITEM_CELLS = line(
    raw("ac_id"), csv("barcode"), raw("biblio_id"), csv("eans"), csv("circ_modifier"), csv("call_number"),
    csv("copy_location"), csv("library"), raw("create_date"), csv("status"), raw("last_circ"), raw("last_checkin"),
    raw("last_due"), raw("monthly_circs"), raw("annual_circs"), raw("all_circs"), csv("fund"),
)
BIB_CELLS = line(
    raw("biblio_id"), csv("eans"), csv("material_type"), csv("title"), csv("author"), csv("series"), csv("pub_date"),
    csv("publisher_supplier"), csv("price"),
)
BIB_HEADER = "biblio_id,eans,material_type,title,author,series,pub_date,publisher_supplier,price"
HOLD_HEADER = "biblio_id,hold_count,holds_branch"
STAMP = "'##19980701##'"
HOLD_ROW = line(
    "'##HOLD##'", "CAST(biblio_id AS VARCHAR)", "'##AUTH##'", hashed("library_code"), hashed("last_circ_lib"),
    hashed("barcode"), hashed("last_use_date"), "use_total", "'0 '", hashed("status"), hashed("date_added"),
    raw("price"), "''", hashed("rotating_stock"), "''", "''", hashed("note"), STAMP, hashed("collection_code"), "''",
    hashed("filter_level_1"), "''", "''", "''", hashed("isbn"),
)
BIB_ROW = line(
    "'##BIB##'", "CAST(biblio_id AS VARCHAR)", "'##SVC##'", hashed("isbn"), hashed("title"), hashed("author"),
    hashed("edition"), hashed("publication_date"), hashed("publisher"), raw("price"), hashed("item_type"),
    hashed("class_num"), STAMP, hashed("subject"), hashed("genre"),
)
COUNTS = "loans, renewals, holds, copies, copies_out, copies_on_order"


def windowed_with_server(mark: str, minutes: int, warn: int, crit: int) -> str:
    bucket = f"time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '1970-01-01')"
    return f"""
        SELECT c.window_start, c.n, c.severity, s.server AS top_server FROM ({windowed(mark, minutes, warn, crit)}) c
        JOIN (SELECT {bucket} AS window_start, split_part(line, ' ', 3) AS server, count(*) AS k FROM {{app_log}}
              WHERE contains(line, '{mark}') GROUP BY 1, 2
              QUALIFY row_number() OVER (PARTITION BY {bucket} ORDER BY k DESC, server) = 1) s USING (window_start)"""


def windowed(mark: str, minutes: int, warn: int, crit: int) -> str:
    return f"""
        SELECT time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n,
               CASE WHEN count(*) >= {crit} THEN 2 WHEN count(*) >= {warn} THEN 1 ELSE 0 END AS severity
        FROM {{app_log}} WHERE contains(line, '{mark}') GROUP BY 1"""


def koha_transactions(loans: str, window: bool, corrected: bool = False) -> str:
    def test(column: str) -> str:
        if corrected:
            return f"{column} IS NOT NULL"
        return f"{column} > {D} - INTERVAL 1 DAY AND {column} < {D}" if window else "TRUE"

    gone = f"{test('i.timestamp')} AND i.withdrawn <> 0" if window or corrected else "TRUE"
    return f"""
        SELECT i.itemnumber, i.barcode, i.biblionumber AS biblio_id, e.kind AS transaction_type,
               CAST(e.at AS DATE) AS transaction_day, e.branchcode AS transaction_branch, CAST(e.due AS DATE) AS due_day
        FROM {{koha_items}} i JOIN (
            SELECT itemnumber, 'circ' AS kind, issuedate AS at, branchcode, date_due AS due FROM {{{loans}}} WHERE {test('issuedate')}
            UNION ALL SELECT itemnumber, 'renewal', lastreneweddate, branchcode, date_due FROM {{{loans}}} WHERE {test('lastreneweddate')}
            UNION ALL SELECT itemnumber, 'checkin', returndate, branchcode, NULL FROM {{{loans}}} WHERE {test('returndate')}) e
          ON e.itemnumber = i.itemnumber
        UNION ALL
        SELECT i.itemnumber, i.barcode, i.biblionumber, 'deleted', CAST(i.timestamp AS DATE), i.homebranch, NULL
        FROM {{koha_items}} i WHERE {gone}"""


HEALTH = """
    SELECT line_no, ts, CASE WHEN pct IS NOT NULL THEN CAST(ceil(pct * 100) AS BIGINT) END AS drone_pct,
           CASE WHEN regexp_matches(line, '(listener|master|controller) count: 0') OR pct >= 0.9 THEN 2
                WHEN pct >= 0.75 THEN 1 ELSE 0 END AS severity
    FROM (SELECT *, CAST(regexp_extract(line, 'drone count: (\\d+)/(\\d+)', 1) AS DOUBLE)
                    / CAST(regexp_extract(line, 'drone count: (\\d+)/(\\d+)', 2) AS DOUBLE) AS pct FROM {service_log})"""

ALLTIME_TRANSACTIONS = """
    SELECT t.root, t.id AS ac_id, t.barcode, n.record AS biblio_id, e.kind AS transaction_type,
           CAST(e.at AS DATE) AS transaction_day, o.shortname AS transaction_branch, CAST(e.due AS DATE) AS due_day
    FROM (
        SELECT target_copy, circ_lib, CASE WHEN parent_circ IS NOT NULL THEN 'renewal' ELSE 'circ' END AS kind,
               xact_start AS at, due_date AS due FROM {circulation}
        UNION ALL SELECT target_copy, circ_lib, 'checkin', checkin_time, NULL FROM {circulation}) e
    JOIN {trans_all} t ON t.id = e.target_copy JOIN {org_unit} o ON o.id = e.circ_lib
    LEFT JOIN {call_number} n ON n.id = t.call_number
    UNION ALL
    SELECT t.root, t.id, t.barcode, n.record, k.kind, CAST(t.edit_date AS DATE), o.shortname, NULL
    FROM {trans_all} t JOIN {org_unit} o ON o.id = t.circ_lib LEFT JOIN {call_number} n ON n.id = t.call_number
    JOIN {status_kinds} k ON (k.status = t.status OR k.status IS NULL)"""

NEWEST = """
    SELECT n.record AS biblio_id, max(c.create_date) AS newest FROM {copy} c JOIN {call_number} n ON n.id = c.call_number
    WHERE c.location IN (1, 2, 3, 5, 8, 13) AND NOT c.deleted GROUP BY 1 ORDER BY newest DESC, biblio_id DESC LIMIT 10"""

LINE_PID = r"^\[.+?\] \S+ \[.+?:(\d+):.+"
LINE_AUTH = r"([0-9a-f]{32})"
LINE_TRACE = r"^\[.+?\] \S+ \[.+?:\d+:.+?:\d+:(\d+)\]"


def found(pattern: str) -> str:
    return f"nullif(regexp_extract(line, '{pattern}', 1), '')"


ORACLES: dict[str, str] = {
    "src_relational": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
    "src_log_text": "SELECT date_trunc('hour', ts) AS hour, count(*) AS lines FROM {service_log} GROUP BY 1",
    "sink_csv_protect": f"SELECT id, {csv('title')} AS title_field, {csv('author', trim=False)} AS author_field FROM {{simple_record}}",
    "sink_items_csv": unit_files(ITEM_HEADER, f"SELECT root, {ITEM_CELLS} FROM {{items_file}}"),
    "sink_orders_csv": unit_files(
        HOLD_HEADER, f"SELECT root, {line(raw('biblio_id'), raw('order_count'), csv('branch'))} FROM {{order_counts}}"),
    "sink_circs_csv": unit_files(
        "copy_id,barcode,biblio_id,transaction_type,transaction_date,transaction_branch,due_date",
        f"SELECT root, {line(raw('ac_id'), csv('barcode'), raw('biblio_id'), csv('transaction_type'), raw('transaction_day'), csv('transaction_branch'), raw('due_day'))} FROM {{transactions}}"),
    "sink_bibs_csv": unit_files(BIB_HEADER, f"SELECT root, {BIB_CELLS} FROM {{distinct_bibs}} LEFT JOIN {{bib_fields}} USING (biblio_id)"),
    "sink_holds_csv": unit_files(
        HOLD_HEADER,
        f"SELECT root, {line(raw('biblio_id'), raw('hold_type'), raw('hold_count'), csv('holds_branch'))} FROM {{hold_counts}}"),
    "sink_holds_alltime_csv": unit_files(
        HOLD_HEADER,
        f"""SELECT root, {line(raw('biblio_id'), raw('n'), csv('holds_branch'))} FROM (
            SELECT root, biblio_id, hold_type, holds_branch, count(*) AS n FROM {{resolved_all}} GROUP BY ALL)"""),
    "sink_metarecords_csv": unit_files(
        "metarecord,biblio_id", f"SELECT root, {line(raw('metarecord'), raw('biblio_id'))} FROM {{held_metarecords}}"),
    "sink_branch_csv": with_header(
        "System_Code,Branch_Code,Branch_Name,Postal_Code,Address,User_Count,DateEnd",
        f"SELECT {line(raw('system_code'), raw('branch_code'), csv('branch_name', False), csv('postal_code', False), csv('address', False), raw('user_count'), raw('date_end'))} FROM {{branches}}"),
    "sink_lending_csv": with_header(
        "BranchCode,CatalogueKey,EAN_ISBN13,Loans,Renewals,Holds,Copies,CopiesOut,CopiesOnOrder,DateEnd",
        f"SELECT {line(*[raw(c) for c in ('branch_code', 'catalogue_key', 'isbns', *COUNTS.split(', '), 'date_end')])} FROM {{lending}}"),
    "sink_koha_items_csv": with_header(
        ITEM_HEADER.replace("circ_modifier", "itype"),
        f"""SELECT {ITEM_CELLS.replace('circ_modifier', 'itype')} FROM (
            SELECT s.*, e.eans, f.fund, k.* EXCLUDE (ac_id) FROM {{koha_selected}} s
            LEFT JOIN {{koha_eans}} e ON e.biblio_id = s.biblio_id
            LEFT JOIN (SELECT i.itemnumber, min(b.budget_name) AS fund FROM {{koha_aqorders_items}} i
                       JOIN {{koha_aqorders}} a ON a.ordernumber = i.ordernumber
                       JOIN {{koha_aqbudgets}} b ON b.budget_id = a.budget_id GROUP BY 1) f ON f.itemnumber = s.ac_id
            LEFT JOIN {{koha_stats}} k ON k.ac_id = s.ac_id)"""),
    "sink_koha_bibs_csv": with_header(BIB_HEADER, f"SELECT {BIB_CELLS} FROM {{koha_bib_rows}}"),
    "sink_hash_delimited": f"SELECT id, {hashed('dummy_title')} AS quoted_title, {hashed('status')} AS quoted_status FROM {{copy}}",
    "sink_dat_file": f"""
        SELECT 0 AS section, CAST(0 AS BIGINT) AS key, '##HEADER##,##DAT##,##19980701##,##LIB##,,,##USA##' AS line
        UNION ALL SELECT 1, biblio_id, {BIB_ROW} FROM {{chq_bibs}}
        UNION ALL SELECT 2, ac_id, {HOLD_ROW} FROM {{chq_items}}
        UNION ALL SELECT 3, 0, '##TRAILER##,' || (SELECT count(*) FROM {{chq_bibs}}) || ',' || (SELECT count(*) FROM {{chq_items}})""",
    "run_audit": """
        SELECT '1998-07-01' AS run_date, e.event, u.root, count(f.unit) AS rows
        FROM (SELECT DISTINCT root FROM {scope}) u CROSS JOIN (VALUES ('orders file generated'), ('holds file generated')) e(event)
        LEFT JOIN (SELECT 'orders file generated' AS event, root AS unit FROM {order_counts}
                   UNION ALL SELECT 'holds file generated', root FROM {hold_counts}) f ON f.event = e.event AND f.unit = u.root
        GROUP BY ALL""",
    "exclude_modifiers": "SELECT id, circ_modifier FROM {copy} WHERE circ_modifier NOT IN ('ECONOMY', 'PROMO')",
    "scope_orgs": "SELECT root, count(*) AS copies FROM {copy} c JOIN {scope} s ON s.org_id = c.circ_lib GROUP BY 1",
    "as_of": "SELECT id FROM {copy} WHERE CAST(create_date AS DATE) < DATE '1996-03-15'",
    "filter_active_copies": "SELECT root, id, barcode, location_name FROM {active}",
    "filter_trans_copies": "SELECT root, id, barcode, location_name FROM {trans}",
    "filter_active_copies_alltime": "SELECT root, id, barcode, location_name FROM {active_all}",
    "koha_items": "SELECT * FROM {koha_selected}",
    "filter_open_holds_asof": "SELECT root, id, hold_type, target, holds_branch, current_copy FROM {open_holds}",
    "filter_holds_alltime": "SELECT root, id, hold_type, target, holds_branch, current_copy FROM {all_holds}",
    "koha_open_holds_asof": "SELECT * FROM {koha_open}",
    "koha_open_holds_alltime": """
        SELECT reserve_id, biblionumber AS biblio_id, branchcode AS holds_branch FROM {koha_reserves}
        UNION ALL SELECT reserve_id, biblionumber, branchcode FROM {koha_old_reserves}""",
    "case_status_name": "SELECT c.id, c.status, k.kind AS label FROM {copy} c JOIN {status_kinds} k ON k.status = c.status",
    "case_renewal": f"""
        SELECT CASE WHEN parent_circ IS NOT NULL THEN 'renewal' ELSE 'circ' END AS transaction_type, count(*) AS n
        FROM {{circulation}} WHERE xact_start > {D} - INTERVAL 1 DAY AND xact_start < {D} GROUP BY 1""",
    "call_number_display": "SELECT * FROM {volumes}",
    "address_concat": "SELECT org_unit, address FROM {first_address}",
    "join_items_dims": """
        SELECT a.root, a.id, a.location_name, o.shortname AS library, s.name AS status_name
        FROM {active} a JOIN {org_unit} o ON o.id = a.circ_lib JOIN {copy_status} s ON s.id = a.status""",
    "join_volume": """
        SELECT a.root, a.id, v.biblio_id, v.call_number_text FROM {active} a LEFT JOIN {volumes} v ON v.call_number = a.call_number""",
    "join_fund": "SELECT a.root, a.id AS ac_id, f.fund FROM {active} a LEFT JOIN {funds} f ON f.ac_id = a.id",
    "join_isbn_array": """
        SELECT h.root, h.ac_id, h.biblio_id, array_to_string(r.isbn, ',') AS eans
        FROM {hold_items} h LEFT JOIN {simple_record} r ON r.id = h.biblio_id""",
    "koha_join_eans": """
        SELECT s.ac_id, s.biblio_id, e.eans FROM {koha_selected} s LEFT JOIN {koha_eans} e ON e.biblio_id = s.biblio_id""",
    "koha_join_eans_strict": """
        SELECT s.ac_id, s.biblio_id, e.eans FROM {koha_selected} s LEFT JOIN {koha_eans} e ON e.biblio_id = s.ac_id""",
    "semi_in_items": "SELECT ac_id, all_circs FROM {stats} WHERE ac_id IN (SELECT id FROM {active})",
    "semi_title_holds": """
        SELECT h.root, h.id, h.target FROM {open_holds} h WHERE h.hold_type = 'T'
        AND EXISTS (SELECT 1 FROM {hold_items} i WHERE i.root = h.root AND i.biblio_id = h.target)""",
    "semi_metarecords": "SELECT * FROM {held_metarecords}",
    "anti_missing_bibs": """
        SELECT DISTINCT biblio_id FROM {distinct_bibs} WHERE biblio_id NOT IN (SELECT biblio_id FROM {bib_extract})""",
    "anti_deleted_bibs": """
        SELECT biblio_id, title FROM {bib_extract} WHERE biblio_id NOT IN (SELECT id FROM {record_entry} WHERE deleted)""",
    "anti_invalid_metarecord": """
        SELECT root, id, target FROM {open_holds} WHERE hold_type = 'M'
        AND target NOT IN (SELECT metarecord FROM {metarecord_source_map})""",
    "left_items_circs": "SELECT * FROM {items_file}",
    "join_copy_circ_org": """
        SELECT root, ac_id, transaction_type, transaction_branch, biblio_id FROM {transactions}
        WHERE transaction_type IN ('circ', 'renewal', 'checkin')""",
    "join_holds_resolve": "SELECT root, id, hold_type, target, biblio_id, holds_branch FROM {resolved_open}",
    "lending_multi_left": "SELECT * FROM {lending}",
    "join_org_type": """
        SELECT s.root, o.shortname FROM {branch_scope} s JOIN {org_unit} o ON o.id = s.org_id
        JOIN {org_unit_type} t ON t.id = o.ou_type WHERE t.can_have_vols""",
    "join_transit_arrival": "SELECT ac_id, arrived FROM {arrivals}",
    "range_after_arrival": """
        SELECT a.ac_id, count(c.id) AS uses_since_arrival FROM {arrivals} a
        LEFT JOIN {circulation} c ON c.target_copy = a.ac_id AND c.xact_start > a.arrived GROUP BY 1""",
    "last_circ_lib": "SELECT ac_id, last_circ_lib FROM {latest}",
    "lookup_hold_copy_ratio": """
        SELECT q.id, r.title, q.hold_copy_ratio FROM {ratio} q LEFT JOIN {simple_record} r ON r.id = q.id""",
    "agg_circs_all": "SELECT ac_id, all_circs FROM {stats}",
    "agg_circs_monthly": "SELECT ac_id, monthly_circs FROM {stats}",
    "agg_circs_annual": "SELECT ac_id, annual_circs FROM {stats}",
    "agg_last_checkin": "SELECT ac_id, last_checkin FROM {stats}",
    "agg_last_due": "SELECT ac_id, last_due FROM {stats}",
    "agg_last_circ": "SELECT ac_id, last_circ FROM {stats}",
    "agg_circs_incremental": "SELECT * FROM {stats}",
    "agg_circs_alltime_koha": """
        SELECT itemnumber AS ac_id, count(*) AS all_circs, count(*) AS monthly_circs, count(*) AS annual_circs,
               max(CAST(returndate AS DATE)) AS last_checkin, max(CAST(date_due AS DATE)) AS last_due,
               max(CAST(issuedate AS DATE)) AS last_circ FROM {koha_loans} GROUP BY 1""",
    "koha_agg_circs": "SELECT * FROM {koha_stats}",
    "agg_circs_hist_quirk": """
        SELECT target_copy AS ac_id, count(id) AS all_circs, count(id) AS monthly_circs, count(id) AS annual_circs,
               max(CAST(checkin_time AS DATE)) AS last_checkin, max(CAST(due_date AS DATE)) AS last_due,
               max(CAST(xact_start AS DATE)) AS last_circ FROM {loans} GROUP BY 1""",
    "agg_orders": "SELECT * FROM {order_counts}",
    "koha_agg_orders": """
        SELECT a.biblionumber AS biblio_id, count(r.reserve_id) AS hold_count, r.branchcode AS holds_branch
        FROM {koha_aqorders} a JOIN {koha_reserves} r ON r.biblionumber = a.biblionumber
        WHERE a.datereceived IS NULL GROUP BY 1, 3""",
    "agg_holds_count": "SELECT * FROM {hold_counts}",
    "koha_agg_holds": "SELECT biblio_id, holds_branch, count(*) AS hold_count FROM {koha_open} GROUP BY 1, 2",
    "agg_distinct_bibs": "SELECT * FROM {distinct_bibs}",
    "agg_patrons": "SELECT home_ou, count(*) AS patron_count FROM {usr} WHERE NOT deleted AND active GROUP BY 1",
    "agg_lending": f"SELECT branch_code, catalogue_key, {COUNTS} FROM {{lending}}",
    "agg_arrival": "SELECT ac_id, CAST(arrived AS DATE) AS arrived_on FROM {arrivals}",
    "agg_circ_count": """
        SELECT c.id AS ac_id, CAST((SELECT count(*) FROM {loans} l WHERE l.target_copy = c.id) AS VARCHAR) AS use_total
        FROM {copy} c""",
    "agg_material_types": "SELECT * FROM {material}",
    "agg_subject_string": f"SELECT id, {subjects('650')} AS subject, {subjects('655')} AS genre FROM {{record_entry}}",
    "agg_hold_copy_ratio": "SELECT * FROM {ratio}",
    "agg_update_backlog": "SELECT count(*) AS backlog FROM {pending_bibs}",
    "latest_per_copy": "SELECT ac_id, last_circ_lib, last_use FROM {latest}",
    "first_note": "SELECT * FROM {note_one}",
    "first_isbn": "SELECT * FROM {isbn_one}",
    "first_address": "SELECT * FROM {first_address}",
    "any_item_type": """
        SELECT n.record AS biblio_id, min(c.circ_modifier) AS item_type FROM {copy} c JOIN {call_number} n ON n.id = c.call_number
        WHERE NOT c.deleted AND NOT n.deleted GROUP BY 1""",
    "ordered_items": """
        SELECT id, barcode FROM {copy} WHERE NOT deleted AND circ_lib IN (SELECT org_id FROM {one_scope}) ORDER BY id""",
    "newest_items_topn": NEWEST,
    "newest_record_list": f"""
        SELECT 'record_list(' || string_agg(CAST(biblio_id AS VARCHAR), ',' ORDER BY newest DESC, biblio_id DESC) || ')' AS record_list
        FROM ({NEWEST})""",
    "feed_record_ids": """
        SELECT page_id, array_to_string(regexp_extract_all('<id>tag:biblio-record_entry/' || page_id || '</id>' || html
            || '<id>tag:biblio-record_entry/' || page_id || '</id>', 'biblio-record_entry/([0-9]+)', 1), ',') AS record_ids
        FROM pages""",
    "top_server": """
        SELECT split_part(line, ' ', 3) AS server, count(*) AS n FROM {app_log} WHERE contains(line, 'Returning NULL')
        GROUP BY 1 ORDER BY n DESC, server LIMIT 1""",
    "oldest_query": """
        SELECT current_query, database FROM {activity} WHERE current_query NOT LIKE '<IDL%' AND current_query NOT LIKE '%vacuum%'
        ORDER BY query_start, current_query LIMIT 1""",
    "sample_delta": """
        SELECT host, sample_no, cpu_user - lag(cpu_user) OVER w AS d_cpu_user, cpu_idle - lag(cpu_idle) OVER w AS d_cpu_idle
        FROM {cpu_sample} WINDOW w AS (PARTITION BY host ORDER BY ts, sample_no)""",
    "union_current_aged": "SELECT is_live, circ_lib, count(id) AS loans FROM {loans} GROUP BY 1, 2",
    "transactions_union": "SELECT * FROM {transactions}",
    "transactions_alltime": ALLTIME_TRANSACTIONS,
    "transactions_alltime_corrected": f"""
        SELECT * FROM ({ALLTIME_TRANSACTIONS}) WHERE transaction_day IS NOT NULL
        AND (transaction_type <> 'deleted' OR ac_id IN (SELECT id FROM {{copy}} WHERE deleted))""",
    "koha_transactions": koha_transactions("koha_issues", True),
    "koha_transactions_alltime": koha_transactions("koha_loans", False),
    "koha_transactions_alltime_corrected": koha_transactions("koha_loans", False, corrected=True),
    "uniq_list": """
        SELECT r.id, u.unique_isbns FROM {simple_record} r LEFT JOIN (
            SELECT id, string_agg(v, ';' ORDER BY i) AS unique_isbns FROM (
                SELECT id, v, min(i) AS i FROM (SELECT id, trim(unnest(isbn)) AS v, generate_subscripts(isbn, 1) AS i
                                                FROM {simple_record}) GROUP BY 1, 2) GROUP BY 1) u ON u.id = r.id""",
    "upsert_bibs": f"""
        SELECT * REPLACE (CAST(last_update AS DATE) AS last_update) FROM {{kept_bibs}} WHERE last_update IS NOT NULL
        UNION ALL
        SELECT p.biblio_id, b.eans, b.material_type, b.title, b.author, b.series, b.pub_date, b.publisher_supplier, b.price, {D}
        FROM {{pending_bibs}} p LEFT JOIN {{bib_fields}} b ON b.biblio_id = p.biblio_id""",
    "attempt_year": f"SELECT id, {year(marc_any('260|264', 'c'))} AS year FROM {{record_entry}}",
    "attempt_price": f"SELECT id, {price(marc_first('020', 'c'))} AS price FROM {{record_entry}}",
    "price_fallback": "SELECT ac_id, price FROM {chq_items}",
    "attempt_isbn": "SELECT biblio_id, length(isbn) AS isbn_length, isbn FROM {isbn_one}",
    "norm_isbn": f"SELECT id, raw, {isbn13('raw')} AS isbn13 FROM (SELECT id, unnest(isbn) AS raw FROM {{simple_record}})",
    "extract_isbns": "SELECT * FROM {isbn_lists}",
    "isbn_normalize": f"""
        SELECT DISTINCT id, {isbn13('raw')} AS isbn13 FROM (SELECT id, unnest(isbn) AS raw FROM {{simple_record}})
        WHERE {isbn13('raw')} IS NOT NULL""",
    "price_year_clean": f"""
        SELECT c.id, {year(marc_first('260', 'c'))} AS year,
               coalesce(nullif({price('CAST(c.price AS VARCHAR)')}, ''), {price(marc_first('020', 'c'))}) AS price_cents
        FROM {{copy}} c JOIN {{call_number}} n ON n.id = c.call_number LEFT JOIN {{record_entry}} e ON e.id = n.record""",
    "bib_fields": "SELECT * FROM {bib_fields}",
    "marc_title": "SELECT biblio_id AS id, title FROM {bib_fields}",
    "marc_arrays": "SELECT biblio_id AS id, series, pub_date, publisher_supplier AS publisher, price FROM {bib_fields}",
    "marc_first": f"""
        SELECT id, {marc_first('250', 'a')} AS f250a, {marc_first('260', 'c')} AS f260c, {marc_first('260', 'b')} AS f260b,
               {marc_first('020', 'c')} AS f020c, {marc_first('082', 'a')} AS f082a FROM {{record_entry}}""",
    "naco_normalize": f"SELECT id, {naco(marc_first('250', 'a'))} AS edition FROM {{record_entry}}",
    "substr_caps": "SELECT biblio_id, title, author, edition, publisher, class_num FROM {chq_bibs}",
    "yyyymmdd": "SELECT id, strftime(create_date, '%Y%m%d') AS added FROM {copy}",
    "floating_flag": "SELECT id, CASE WHEN floating > 0 THEN 'Y' END AS rotating FROM {copy}",
    "isbn_ean_concat": "SELECT * FROM {koha_eans}",
    "koha_status_case": """
        SELECT itemnumber, CASE itemlost WHEN 1 THEN 'Lost' WHEN 2 THEN 'Long Overdue (lost)' WHEN 3 THEN 'Lost & Paid For'
               WHEN 4 THEN 'Missing' ELSE 'Not Lost' END AS status FROM {koha_items}""",
    "koha_bibs": "SELECT * FROM {koha_bib_rows}",
    "date_parts": """
        SELECT id, CAST(xact_start AS DATE) AS date, CAST(date_trunc('month', xact_start) AS DATE) AS month_trunc,
               CAST(date_trunc('year', xact_start) AS DATE) AS year_trunc, date_trunc('hour', xact_start) AS hour_trunc,
               CAST(hour(xact_start) AS INTEGER) AS hod, dayname(xact_start) AS day_name FROM {circulation}""",
    "format_mmddyyyy": "SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS day FROM orders",
    "regex_log_fields": f"SELECT line_no, {found(LINE_PID)} AS pid, {found(LINE_AUTH)} AS auth, {found(LINE_TRACE)} AS trace FROM {{app_log}}",
    "parse_service_health": f"SELECT line_no, drone_pct, severity FROM ({HEALTH})",
    "stream_service_health": f"""
        SELECT date_trunc('hour', ts) AS hour, max(severity) AS severity, count(CASE WHEN severity > 0 THEN 1 END) AS findings
        FROM ({HEALTH}) GROUP BY 1""",
    "missing_log_warn": """
        SELECT hour, 1 AS severity FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-03 23:00:00',
            INTERVAL 1 HOUR)) AS hour)
        WHERE hour NOT IN (SELECT date_trunc('hour', ts) FROM {service_log})""",
    "service_counts": r"""
        SELECT c.service, count(CASE WHEN lower(p.role) = 'listener' THEN 1 END) AS listeners,
               count(CASE WHEN lower(p.role) = 'drone' THEN 1 END) AS drones, c.max_children
        FROM {service_config} c LEFT JOIN (
            SELECT regexp_extract(line, '(\w+) \[([^\]]+)\]', 1) AS role, regexp_extract(line, '(\w+) \[([^\]]+)\]', 2) AS service
            FROM {process_list}) p ON p.service = c.service GROUP BY c.service, c.max_children""",
    "cpu_shares": """
        SELECT host, sample_no, floor(u / total * 100 * 100 + 0.5) / 100 AS user_pct, floor(d / total * 100 * 100 + 0.5) / 100 AS idle_pct,
               floor(w / total * 100 * 100 + 0.5) / 100 AS iow_pct, floor(s / total * 100 * 100 + 0.5) / 100 AS steal_pct
        FROM (SELECT host, sample_no, CAST(u AS DOUBLE) AS u, CAST(d AS DOUBLE) AS d, CAST(w AS DOUBLE) AS w, CAST(s AS DOUBLE) AS s,
                     CAST(nullif(u + n + y + d + w + i + f + s, 0) AS DOUBLE) AS total FROM (
            SELECT host, sample_no, cpu_user - lag(cpu_user) OVER h AS u, cpu_nice - lag(cpu_nice) OVER h AS n,
                   cpu_system - lag(cpu_system) OVER h AS y, cpu_idle - lag(cpu_idle) OVER h AS d,
                   cpu_iowait - lag(cpu_iowait) OVER h AS w, cpu_irq - lag(cpu_irq) OVER h AS i,
                   cpu_softirq - lag(cpu_softirq) OVER h AS f, cpu_steal - lag(cpu_steal) OVER h AS s
            FROM {cpu_sample} WINDOW h AS (PARTITION BY host ORDER BY ts, sample_no)) WHERE u IS NOT NULL)""",
    "ram_shares": """
        SELECT host, sample_no, mem_free + buffers + cached AS available,
               floor(CAST(mem_free AS DOUBLE) / mem_total * 100 * 100 + 0.5) / 100 AS free_pct,
               floor(CAST(buffers AS DOUBLE) / mem_total * 100 * 100 + 0.5) / 100 AS buffers_pct,
               floor(CAST(cached AS DOUBLE) / mem_total * 100 * 100 + 0.5) / 100 AS cached_pct,
               floor(CAST(mem_free + buffers + cached AS DOUBLE) / mem_total * 100 * 100 + 0.5) / 100 AS available_pct FROM {ram_sample}""",
    "stream_window_alert": windowed("Returning NULL", 60, 2, 4),
    "window_count_alert": windowed_with_server("Returning NULL", 15, 2, 4),
    "hour_count_alert": windowed_with_server("IS NOT CONNECTED TO THE NETWORK", 60, 3, 6),
    "recent_count_alert": """
        SELECT count(*) AS n, CASE WHEN count(*) >= 40 THEN 2 WHEN count(*) >= 20 THEN 1 ELSE 0 END AS severity
        FROM {app_log} WHERE contains(line, 'Returning NULL')
        AND ts BETWEEN TIMESTAMP '2024-01-14 12:30:00' AND TIMESTAMP '2024-01-15 12:30:45'""",
    "failed_trigger_events": """
        SELECT count(name) AS failures, coalesce(string_agg(DISTINCT name, ',' ORDER BY name), '') AS names,
               CASE WHEN count(name) > 0 THEN 2 ELSE 0 END AS severity
        FROM {event_definition} WHERE id IN (SELECT event_def FROM {trigger_event}
            WHERE (state = 'error' OR error_output IS NOT NULL) AND CAST(add_time AS DATE) = DATE '2024-01-15')""",
    "pending_backlog": """
        SELECT count(*) AS pending, CASE WHEN count(*) > 1000000 THEN 2 WHEN count(*) > 900000 THEN 1 ELSE 0 END AS severity
        FROM {trigger_event} WHERE state = 'pending'""",
    "replication_lag": """
        SELECT *, CASE WHEN st_lag_num_events > 200 THEN 2 WHEN st_lag_num_events > 150 THEN 1 ELSE 0 END AS severity
        FROM {replication_status}""",
    "long_query": """
        SELECT database, hours, CASE WHEN hours > 7 THEN 2 WHEN hours > 5 THEN 1 ELSE 0 END AS severity FROM (
            SELECT database, CAST(floor((epoch(TIMESTAMP '2024-01-30') - floor(epoch(min(query_start)))) / 3600) AS BIGINT) AS hours
            FROM {activity} WHERE current_query NOT LIKE '<IDL%' AND current_query NOT LIKE '%vacuum%' GROUP BY 1)""",
    "classify": """
        SELECT event_id, CASE WHEN value > 400 THEN 2 WHEN value > 300 THEN 1 ELSE 0 END AS high,
               CASE WHEN value < 10 THEN 2 WHEN value < 50 THEN 1 ELSE 0 END AS low,
               CASE WHEN value < CAST(490.0 AS DOUBLE) * CAST(0.05 AS DOUBLE) OR value > CAST(490.0 AS DOUBLE) * CAST(0.9 AS DOUBLE) THEN 2
                    WHEN value < CAST(490.0 AS DOUBLE) * CAST(0.1 AS DOUBLE) OR value > CAST(490.0 AS DOUBLE) * CAST(0.8 AS DOUBLE) THEN 1
                    ELSE 0 END AS band,
               CASE WHEN value * 100 >= 490 * 66 AND value >= user_id * 4 THEN 2
                    WHEN value * 100 >= 490 * 66 AND value * 100 >= user_id * 4 * 66 THEN 1 ELSE 0 END AS memory,
               CASE WHEN value > 400 THEN 'CRIT' WHEN value > 300 THEN 'WARN' ELSE 'OK' END AS high_name
        FROM events""",
    "trace_related_lines": f"""
        SELECT * FROM (WITH RECURSIVE hits(line_no, auth, trace) AS (
            SELECT line_no, {found(LINE_AUTH)}, {found(LINE_TRACE)} FROM {{app_log}}
            WHERE contains(line, '8f14e45fceea167a5a36dedd4bea2543')
            UNION
            SELECT l.line_no, nullif(regexp_extract(l.line, '{LINE_AUTH}', 1), ''), nullif(regexp_extract(l.line, '{LINE_TRACE}', 1), '')
            FROM hits h JOIN {{app_log}} l ON l.line_no > h.line_no
             AND ((h.auth IS NOT NULL AND contains(l.line, h.auth)) OR (h.trace IS NOT NULL AND contains(l.line, h.trace))))
        SELECT DISTINCT line_no FROM hits)""",
    "chq_item_rows": f"SELECT ac_id, {HOLD_ROW} AS line FROM {{chq_items}} WHERE biblio_id IS NOT NULL",
    "chq_bib_rows": f"SELECT biblio_id, {BIB_ROW} AS line FROM {{chq_bibs}}",
    "org_descendants": "SELECT root, org_id FROM {scope}",
    "org_lookup": """
        SELECT o.id, o.shortname, o.name, a.post_code, a.address FROM {org_unit} o LEFT JOIN {first_address} a ON a.org_unit = o.id""",
    "branch_file": "SELECT * FROM {branches}",
}
