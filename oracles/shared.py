"""Shared sub-queries and expression helpers of the oracle SQL (DuckDB dialect)."""

from __future__ import annotations

D = "DATE '1998-07-01'"
LENDING_DAY = "DATE '1999-07-01'"


def walk(condition: str) -> str:
    return f"""
        WITH RECURSIVE walk(root, org_id) AS (
            SELECT shortname, id FROM {{org_unit}} WHERE {condition}
            UNION ALL
            SELECT w.root, o.id FROM walk w JOIN {{org_unit}} o ON o.parent_ou = w.org_id)
        SELECT root, org_id FROM walk"""


def eligible(date_test: str, deleted_test: str) -> str:
    return f"""
        SELECT s.root, c.*, l.name AS location_name
        FROM {{copy}} c JOIN {{copy_location}} l ON l.id = c.location JOIN {{scope}} s ON s.org_id = c.circ_lib
        WHERE l.circulate AND c.circulate AND c.circ_modifier NOT IN ('ECONOMY', 'PROMO')
          AND {date_test} AND {deleted_test}"""


def open_test(ended: str, day: str) -> str:
    return f"({ended} IS NULL OR {ended} > {day})"


def resolved(holds: str, items: str) -> str:
    """Row-by-row resolution in the order of the hold types."""
    return f"""
        SELECT * FROM (
            SELECT h.*, CASE
                WHEN hold_type = 'T' THEN (SELECT min(i.biblio_id) FROM {{{items}}} i WHERE i.root = h.root AND i.biblio_id = h.target)
                WHEN hold_type = 'V' THEN (SELECT min(i.biblio_id) FROM {{{items}}} i WHERE i.root = h.root AND i.acn_id = h.target)
                WHEN hold_type IN ('C', 'F', 'R') THEN (SELECT min(i.biblio_id) FROM {{{items}}} i WHERE i.root = h.root AND i.ac_id = h.target)
                WHEN hold_type = 'P' THEN (SELECT min(i.biblio_id) FROM {{{items}}} i JOIN {{copy_part_map}} p ON p.target_copy = i.ac_id
                                           WHERE i.root = h.root AND p.part = h.target)
                WHEN hold_type = 'M' AND current_copy IS NOT NULL THEN
                    (SELECT min(i.biblio_id) FROM {{{items}}} i WHERE i.root = h.root AND i.ac_id = h.current_copy)
                WHEN hold_type = 'M' THEN (SELECT min(m.source) FROM {{metarecord_source_map}} m WHERE m.metarecord = h.target)
                END AS biblio_id
            FROM {{{holds}}} h) r
        WHERE biblio_id IS NOT NULL
          AND NOT (hold_type = 'M' AND target NOT IN (SELECT metarecord FROM {{metarecord_source_map}}))"""


def csv(value: str, trim: bool = True) -> str:
    text = f"coalesce(CAST({value} AS VARCHAR), '')"
    if trim:
        text = f"regexp_replace(regexp_replace({text}, '/$', ''), '\\s+$', '')"
    doubled = f"replace({text}, '\"', '\"\"')"
    return f"CASE WHEN regexp_matches({doubled}, '[^a-zA-Z0-9]') THEN '\"' || {doubled} || '\"' ELSE {doubled} END"


def raw(value: str) -> str:
    return f"coalesce(CAST({value} AS VARCHAR), '')"


def line(*cells: str) -> str:
    return " || ',' || ".join(f"({cell})" for cell in cells)


def hashed(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {text} IS NULL OR {text} = '' THEN '' ELSE '##' || {text} || '##' END"


def year(value: str) -> str:
    return f"substring(regexp_replace({value}, '[^0-9]', '', 'g'), 1, 4)"


def price(value: str) -> str:
    amount = f"TRY_CAST(regexp_replace({value}, '[^0-9.]', '', 'g') AS DECIMAL(8, 2))"
    return (
        f"CASE WHEN {value} IS NOT NULL THEN coalesce(CAST(CAST({amount} * 100 AS INTEGER) AS VARCHAR), '') END"
    )


def naco(value: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(translate(strip_accents(lower({value})), '\u00f8\u0142\u0111', 'old'), "
        r"'[''\[\]\p{M}]', '', 'g'), '[^\p{L}\p{N}]+', ' ', 'g'))"
    )


def isbn13(value: str) -> str:
    packed = f"lower(regexp_replace({value}, '[-\\s]', '', 'g'))"
    body = f"('978' || substring({packed}, 1, 9))"
    total = " + ".join(f"CAST(substring({body}, {i}, 1) AS INTEGER) * {1 if i % 2 else 3}" for i in range(1, 13))
    return (
        f"CASE WHEN regexp_matches({packed}, '^[0-9]{{12}}[0-9x]') THEN "
        f"(CASE WHEN regexp_matches({packed}, '^[0-9]*[1-9]') THEN substring({packed}, 1, 13) END) "
        f"WHEN regexp_matches({packed}, '^[0-9]{{9}}[0-9x]') THEN {body} || CAST((10 - ({total}) % 10) % 10 AS VARCHAR) END"
    )


def isbn_token(value: str) -> str:
    return f"regexp_extract({value}, '^\\s*([^\\s():.]*)', 1)"


def _unescape(value: str) -> str:
    return f"replace(replace(replace({value}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


def _subfield(field: str, code: str) -> str:
    return _unescape(f"nullif(regexp_extract({field}, '<subfield code=\"{code}\">([^<]*)</subfield>', 1), '')")


def marc_first(tag: str, code: str) -> str:
    """First subfield of the first field with the tag."""
    return _subfield(f"regexp_extract(marc, '<datafield tag=\"{tag}\">(.*?)</datafield>', 1)", code)


def marc_any(tags: str, code: str) -> str:
    """First such subfield in any field whose tag matches the pattern."""
    fields = f"regexp_extract_all(marc, '<datafield tag=\"(?:{tags})\">(.*?)</datafield>', 1)"
    return f"list_filter(list_transform({fields}, lambda f: {_subfield('f', code)}), lambda v: v IS NOT NULL)[1]"


def subjects(tag: str) -> str:
    fields = f"regexp_extract_all(marc, '<datafield tag=\"{tag}\">(.*?)</datafield>', 1)"
    values = f"list_transform({fields}, lambda f: {naco(_subfield('f', 'a'))})"
    return f"CASE WHEN len({fields}) > 0 THEN '!!!' || substring(array_to_string({values}, '!!!'), 1, 200) || '!!!' END"


EXTRA: dict[str, str] = {
    "scope": walk("lower(shortname) IN ('cons', 'nation_8')"),
    "one_scope": walk("shortname = 'CONS'"),
    "branch_scope": walk("shortname IN ('CONS', 'NATION_8')"),
    "active": eligible(f"CAST(c.create_date AS DATE) < {D}", "NOT c.deleted"),
    "active_all": eligible("TRUE", "NOT c.deleted"),
    "trans": eligible(f"CAST(c.create_date AS DATE) < {D}", "TRUE"),
    "trans_all": eligible("TRUE", "TRUE"),
    "volumes": """
        SELECT n.id AS call_number, n.record AS biblio_id,
               trim(concat_ws(' ', p.label, n.label, s.label)) AS call_number_text
        FROM {call_number} n LEFT JOIN {call_number_prefix} p ON p.id = n.prefix
        LEFT JOIN {call_number_suffix} s ON s.id = n.suffix""",
    "funds": """
        SELECT d.eg_copy_id AS ac_id, min(f.name) AS fund
        FROM {acq_lineitem_detail} d JOIN {fund} f ON f.id = d.fund WHERE d.eg_copy_id IS NOT NULL GROUP BY 1""",
    "loans": """
        SELECT *, TRUE AS is_live FROM {circulation} UNION ALL SELECT *, FALSE FROM {aged_circulation}""",
    "stats": f"""
        SELECT a.ac_id, a.all_circs, m.n AS monthly_circs, y.n AS annual_circs, a.last_checkin, a.last_due, a.last_circ
        FROM (SELECT target_copy AS ac_id, count(id) AS all_circs, max(CAST(checkin_time AS DATE)) AS last_checkin,
                     max(CAST(due_date AS DATE)) AS last_due, max(CAST(xact_start AS DATE)) AS last_circ
              FROM {{loans}} WHERE CAST(xact_start AS DATE) < {D} GROUP BY 1) a
        LEFT JOIN (SELECT target_copy, count(id) AS n FROM {{loans}}
                   WHERE CAST(xact_start AS DATE) > {D} - INTERVAL 1 MONTH GROUP BY 1) m ON m.target_copy = a.ac_id
        LEFT JOIN (SELECT target_copy, count(id) AS n FROM {{loans}}
                   WHERE CAST(xact_start AS DATE) > {D} - INTERVAL 1 YEAR GROUP BY 1) y ON y.target_copy = a.ac_id""",
    "items": """
        SELECT a.root, a.id AS ac_id, a.barcode, v.biblio_id, array_to_string(r.isbn, ',') AS eans, a.circ_modifier,
               v.call_number_text AS call_number, a.location_name AS copy_location, o.shortname AS library,
               CAST(a.create_date AS DATE) AS create_date, s.name AS status, f.fund
        FROM {active} a JOIN {org_unit} o ON o.id = a.circ_lib JOIN {copy_status} s ON s.id = a.status
        LEFT JOIN {volumes} v ON v.call_number = a.call_number LEFT JOIN {simple_record} r ON r.id = v.biblio_id
        LEFT JOIN {funds} f ON f.ac_id = a.id""",
    "items_file": """
        SELECT i.*, s.all_circs, s.monthly_circs, s.annual_circs, s.last_checkin, s.last_due, s.last_circ
        FROM {items} i LEFT JOIN {stats} s ON s.ac_id = i.ac_id""",
    "order_counts": """
        SELECT s.root, l.eg_bib_id AS biblio_id, o.shortname AS branch, count(d.id) AS order_count
        FROM {purchase_order} p JOIN {scope} s ON s.org_id = p.ordering_agency
        JOIN {acq_lineitem} l ON l.purchase_order = p.id JOIN {acq_lineitem_detail} d ON d.lineitem = l.id
        JOIN {org_unit} o ON o.id = d.owning_lib
        WHERE l.state IN ('new', 'on-order') GROUP BY 1, 2, 3""",
    "hold_items": """
        SELECT t.root, t.id AS ac_id, t.call_number AS acn_id, n.record AS biblio_id
        FROM {trans} t LEFT JOIN {call_number} n ON n.id = t.call_number""",
    "hold_items_all": """
        SELECT t.root, t.id AS ac_id, t.call_number AS acn_id, n.record AS biblio_id
        FROM {trans_all} t LEFT JOIN {call_number} n ON n.id = t.call_number""",
    "all_holds": """
        SELECT s.root, h.*, o.shortname AS holds_branch FROM {hold_request} h JOIN {scope} s ON s.org_id = h.pickup_lib
        JOIN {org_unit} o ON o.id = h.pickup_lib""",
    "open_holds": f"""
        SELECT * FROM {{all_holds}} WHERE request_time < {D} AND {open_test('cancel_time', D)}
        AND {open_test('capture_time', D)} AND {open_test('fulfillment_time', D)}""",
    "resolved_open": resolved("open_holds", "hold_items"),
    "resolved_all": resolved("all_holds", "hold_items_all"),
    "hold_counts": """
        SELECT root, biblio_id, hold_type, holds_branch, count(*) AS hold_count FROM {resolved_open} GROUP BY ALL""",
    "held_metarecords": """
        SELECT DISTINCT h.root, m.metarecord, m.source AS biblio_id FROM {metarecord_source_map} m
        JOIN {resolved_open} h ON h.hold_type = 'M' AND h.target = m.metarecord""",
    "transactions": f"""
        SELECT t.root, t.id AS ac_id, t.barcode, n.record AS biblio_id, e.kind AS transaction_type,
               CAST(e.at AS DATE) AS transaction_day, o.shortname AS transaction_branch, CAST(e.due AS DATE) AS due_day
        FROM (
            SELECT target_copy, circ_lib, CASE WHEN parent_circ IS NOT NULL THEN 'renewal' ELSE 'circ' END AS kind,
                   xact_start AS at, due_date AS due FROM {{circulation}}
            WHERE xact_start > {D} - INTERVAL 1 DAY AND xact_start < {D}
            UNION ALL
            SELECT target_copy, circ_lib, 'checkin', checkin_time, NULL FROM {{circulation}}
            WHERE checkin_time > {D} - INTERVAL 1 DAY AND checkin_time < {D}) e
        JOIN {{trans}} t ON t.id = e.target_copy JOIN {{org_unit}} o ON o.id = e.circ_lib
        LEFT JOIN {{call_number}} n ON n.id = t.call_number
        UNION ALL
        SELECT t.root, t.id, t.barcode, n.record, k.kind, CAST(t.edit_date AS DATE), o.shortname, NULL
        FROM {{trans}} t JOIN {{org_unit}} o ON o.id = t.circ_lib LEFT JOIN {{call_number}} n ON n.id = t.call_number
        JOIN {{status_kinds}} k ON (k.status = t.status OR (k.status IS NULL AND t.deleted))
        WHERE t.edit_date > {D} - INTERVAL 1 DAY AND t.edit_date < {D}""",
    "status_kinds": """
        SELECT * FROM (VALUES (NULL, 'deleted'), (2, 'Bindery'), (3, 'Lost'), (4, 'Missing'), (5, 'In Process'),
            (6, 'In Transit'), (8, 'On Holds Shelf'), (9, 'On Order'), (11, 'Cataloging'), (13, 'Discard/Weed'),
            (14, 'Damaged')) AS v(status, kind)""",
    "distinct_bibs": """
        SELECT DISTINCT a.root, n.record AS biblio_id FROM {active_all} a JOIN {call_number} n ON n.id = a.call_number""",
    "material": """
        SELECT id AS biblio_id, string_agg(value, ',' ORDER BY value) AS material_type
        FROM {record_attr_flat} WHERE attr = 'search_format' GROUP BY 1""",
    "bib_fields": f"""
        SELECT e.id AS biblio_id, array_to_string(r.isbn, ',') AS eans, m.material_type,
               trim(concat_ws(' ', {marc_any('245', 'a')}, {marc_any('245', 'b')}, {marc_any('245', 'p')})) AS title,
               r.author, coalesce({marc_any('490', 'a')}, '') AS series,
               coalesce({marc_any('260|264', 'c')}, '') AS pub_date,
               coalesce({marc_any('260|264', 'b')}, '') AS publisher_supplier,
               coalesce({marc_any('020|024', 'c')}, '') AS price
        FROM {{record_entry}} e LEFT JOIN {{simple_record}} r ON r.id = e.id LEFT JOIN {{material}} m ON m.biblio_id = e.id""",
    "first_address": """
        SELECT org_unit, first(post_code) AS post_code, first(address) AS address FROM (
            SELECT org_unit, post_code, street1 || ' ' || street2 || ';' || city || ';' || state AS address
            FROM {org_address} WHERE post_code IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY org_unit ORDER BY address_type = 'MAILING', id) = 1) GROUP BY 1""",
    "branches": f"""
        SELECT s.root AS system_code, o.shortname AS branch_code, o.name AS branch_name, a.post_code AS postal_code,
               a.address, (SELECT count(*) FROM {{usr}} u WHERE u.home_ou = o.id AND NOT u.deleted AND u.active) AS user_count,
               strftime({LENDING_DAY}, '%m/%d/%Y') AS date_end
        FROM {{branch_scope}} s JOIN {{org_unit}} o ON o.id = s.org_id JOIN {{org_unit_type}} t ON t.id = o.ou_type
        LEFT JOIN {{first_address}} a ON a.org_unit = o.id WHERE t.can_have_vols""",
    "isbn_lists": f"""
        SELECT id AS biblio_id, coalesce((SELECT string_agg(v, ';' ORDER BY first_at) FROM (
            SELECT v, min(i) AS first_at FROM (SELECT {isbn13('u.x')} AS v, u.i FROM
                (SELECT unnest(isbn) AS x, generate_subscripts(isbn, 1) AS i) u) WHERE v IS NOT NULL GROUP BY v)), '') AS isbns
        FROM {{simple_record}}""",
    "lending": f"""
        SELECT o.shortname AS branch_code, b.biblio_id AS catalogue_key, b.isbns,
               count(DISTINCT ci.id) AS loans, count(DISTINCT rn.id) AS renewals, count(DISTINCT h.id) AS holds,
               count(DISTINCT c.id) AS copies, count(DISTINCT co.id) AS copies_out,
               count(DISTINCT CASE WHEN c.status = 9 THEN c.id END) AS copies_on_order,
               strftime({LENDING_DAY}, '%m/%d/%Y') AS date_end
        FROM {{copy}} c JOIN (SELECT DISTINCT org_id FROM {{branch_scope}}) s ON s.org_id = c.circ_lib
        JOIN {{org_unit}} o ON o.id = c.circ_lib JOIN {{org_unit_type}} t ON t.id = o.ou_type AND t.can_have_vols
        LEFT JOIN (SELECT * FROM {{circulation}} WHERE xact_start > {LENDING_DAY} - INTERVAL 7 DAY) ci ON ci.target_copy = c.id
        LEFT JOIN (SELECT * FROM {{circulation}} WHERE xact_start > {LENDING_DAY} - INTERVAL 7 DAY
                   AND parent_circ IS NOT NULL) rn ON rn.target_copy = c.id
        LEFT JOIN (SELECT * FROM {{circulation}} WHERE checkin_time IS NULL AND xact_finish IS NULL) co ON co.target_copy = c.id
        JOIN {{call_number}} n ON n.id = c.call_number JOIN {{isbn_lists}} b ON b.biblio_id = n.record
        LEFT JOIN {{hold_request}} h ON h.current_copy = c.id AND h.pickup_lib = c.circ_lib
             AND h.capture_time IS NOT NULL AND h.fulfillment_time IS NULL
        WHERE NOT c.deleted GROUP BY 1, 2, 3""",
    "latest": """
        SELECT g.ac_id, o.shortname AS last_circ_lib, g.last_use, g.circ_count FROM (
            SELECT target_copy AS ac_id, max(CASE WHEN is_live THEN CAST(xact_start AS DATE) END) AS last_use,
                   count(id) AS circ_count FROM {loans} GROUP BY 1) g
        JOIN (SELECT target_copy, circ_lib FROM {loans}
              QUALIFY row_number() OVER (PARTITION BY target_copy ORDER BY xact_start DESC, id DESC) = 1) l
          ON l.target_copy = g.ac_id
        LEFT JOIN {org_unit} o ON o.id = l.circ_lib""",
    "arrivals": """
        SELECT c.id AS ac_id, max(t.dest_recv_time) AS arrived FROM {transit_copy} t
        JOIN {copy} c ON c.id = t.target_copy AND c.circ_lib = t.dest GROUP BY 1 HAVING max(t.dest_recv_time) IS NOT NULL""",
    "isbn_one": f"""
        SELECT record AS biblio_id, token AS isbn FROM (
            SELECT record, {isbn_token('value')} AS token FROM {{full_rec}} WHERE tag = '020' AND subfield IN ('a', 'z'))
        WHERE length(token) < 14
        QUALIFY row_number() OVER (PARTITION BY record ORDER BY length(token) DESC, token) = 1""",
    "note_one": """
        SELECT owning_copy AS ac_id, substring(value, 1, 100) AS note FROM {copy_note} WHERE title ILIKE '%collectionHQ%'
        QUALIFY row_number() OVER (PARTITION BY owning_copy ORDER BY id) = 1""",
    "chq_items": f"""
        SELECT c.id AS ac_id, n.record AS biblio_id, o.shortname AS library_code, l.last_circ_lib, c.barcode,
               strftime(l.last_use, '%Y%m%d') AS last_use_date, CAST(coalesce(l.circ_count, 0) AS VARCHAR) AS use_total,
               CAST(c.status AS VARCHAR) AS status, strftime(c.create_date, '%Y%m%d') AS date_added,
               coalesce(nullif({price('CAST(c.price AS VARCHAR)')}, ''), {price('m.c020')}) AS price,
               CASE WHEN c.floating > 0 THEN 'Y' END AS rotating_stock, t.note, p.name AS collection_code,
               n.label AS filter_level_1, i.isbn
        FROM {{copy}} c JOIN {{one_scope}} s ON s.org_id = c.circ_lib JOIN {{call_number}} n ON n.id = c.call_number
        LEFT JOIN {{org_unit}} o ON o.id = c.circ_lib LEFT JOIN {{copy_location}} p ON p.id = c.location
        LEFT JOIN {{latest}} l ON l.ac_id = c.id LEFT JOIN {{note_one}} t ON t.ac_id = c.id
        LEFT JOIN {{isbn_one}} i ON i.biblio_id = n.record
        LEFT JOIN (SELECT id, {marc_first('020', 'c')} AS c020 FROM {{record_entry}}) m ON m.id = n.record
        WHERE NOT c.deleted""",
    "chq_bibs": f"""
        SELECT e.id AS biblio_id, CASE WHEN r.id IS NOT NULL THEN i.isbn END AS isbn, substring(r.title, 1, 100) AS title,
               substring(r.author, 1, 50) AS author, substring({naco(marc_first('250', 'a'))}, 1, 20) AS edition,
               {year(marc_first('260', 'c'))} AS publication_date,
               substring({naco(marc_first('260', 'b'))}, 1, 100) AS publisher, {price(marc_first('020', 'c'))} AS price,
               y.item_type, substring({naco(marc_first('082', 'a'))}, 1, 20) AS class_num,
               {subjects('650')} AS subject, {subjects('655')} AS genre
        FROM {{record_entry}} e LEFT JOIN {{simple_record}} r ON r.id = e.id LEFT JOIN {{isbn_one}} i ON i.biblio_id = e.id
        LEFT JOIN (SELECT n.record, min(c.circ_modifier) AS item_type FROM {{copy}} c JOIN {{call_number}} n ON n.id = c.call_number
                   JOIN {{one_scope}} s ON s.org_id = c.circ_lib WHERE NOT n.deleted AND NOT c.deleted GROUP BY 1) y ON y.record = e.id
        WHERE NOT e.deleted AND e.id IN (SELECT n.record FROM {{call_number}} n JOIN {{one_scope}} s ON s.org_id = n.owning_lib
                                         WHERE NOT n.deleted)""",
    "ratio": """
        SELECT y.bib AS id, coalesce(x.copy_count, 0) AS copy_count, y.hold_count,
               CAST(y.hold_count AS DOUBLE) / (CASE WHEN x.copy_count = 0 OR x.copy_count IS NULL THEN CAST(0.1 AS DOUBLE)
                                              ELSE CAST(x.copy_count AS DOUBLE) END) AS hold_copy_ratio
        FROM (SELECT (SELECT min(r.bib_record) FROM {hold_request_record} r WHERE r.id = h.id) AS bib, count(*) AS hold_count
              FROM {hold_request} h WHERE h.cancel_time IS NULL AND h.fulfillment_time IS NULL GROUP BY 1) y
        LEFT JOIN (SELECT e.id AS bib, count(*) AS copy_count FROM {copy} c JOIN {copy_location} l ON l.id = c.location
                   LEFT JOIN {call_number} n ON n.id = c.call_number LEFT JOIN {record_entry} e ON e.id = n.record
                   WHERE l.holdable AND c.holdable AND NOT c.deleted
                     AND c.status IN (SELECT id FROM {copy_status} WHERE holdable) GROUP BY 1) x ON x.bib = y.bib""",
    "kept_bibs": """
        SELECT b.* REPLACE (CASE WHEN b.last_update IS NOT NULL AND e.edit_date IS NOT NULL AND b.last_update < e.edit_date
                                 THEN NULL ELSE b.last_update END AS last_update)
        FROM {bib_extract} b LEFT JOIN {record_entry} e ON e.id = b.biblio_id
        WHERE b.biblio_id NOT IN (SELECT id FROM {record_entry} WHERE deleted)""",
    "pending_bibs": """
        SELECT biblio_id FROM {kept_bibs} WHERE last_update IS NULL
        UNION ALL
        SELECT DISTINCT biblio_id FROM {distinct_bibs} WHERE biblio_id NOT IN (SELECT biblio_id FROM {kept_bibs})""",
    "koha_loans": "SELECT * FROM {koha_issues} UNION ALL SELECT * FROM {koha_old_issues}",
    "koha_stats": f"""
        SELECT itemnumber AS ac_id, count(issue_id) AS all_circs,
               nullif(count(CASE WHEN issuedate > {D} - INTERVAL 1 MONTH THEN 1 END), 0) AS monthly_circs,
               nullif(count(CASE WHEN issuedate > {D} - INTERVAL 1 YEAR THEN 1 END), 0) AS annual_circs,
               max(CASE WHEN issuedate < {D} THEN CAST(returndate AS DATE) END) AS last_checkin,
               max(CASE WHEN issuedate < {D} THEN CAST(date_due AS DATE) END) AS last_due,
               max(CASE WHEN issuedate < {D} THEN CAST(issuedate AS DATE) END) AS last_circ
        FROM {{koha_loans}} GROUP BY 1""",
    "koha_selected": f"""
        SELECT itemnumber AS ac_id, barcode, dateaccessioned AS create_date, permanent_location AS copy_location,
               holdingbranch AS library, itemcallnumber AS call_number, itype, biblionumber AS biblio_id,
               CASE itemlost WHEN 1 THEN 'Lost' WHEN 2 THEN 'Long Overdue (lost)' WHEN 3 THEN 'Lost & Paid For'
                             WHEN 4 THEN 'Missing' ELSE 'Not Lost' END AS status
        FROM {{koha_items}} WHERE withdrawn = 0 AND notforloan IN (0, -1) AND dateaccessioned < {D}""",
    "koha_eans": """
        SELECT biblionumber AS biblio_id, min(concat_ws(',', isbn, ean)) AS eans FROM {koha_biblioitems} GROUP BY 1""",
    "koha_bib_rows": """
        SELECT b.biblionumber AS biblio_id, concat_ws(',', i.isbn, i.ean) AS eans,
               coalesce(i.itemtype, x.itype) AS material_type, b.title, b.author, b.seriestitle AS series,
               i.publicationyear AS pub_date, i.publishercode AS publisher_supplier, CAST(x.price AS VARCHAR) AS price,
               CAST(CAST(b."timestamp" AS DATE) AS VARCHAR) AS last_update
        FROM {koha_biblio} b JOIN {koha_biblioitems} i ON i.biblionumber = b.biblionumber
        LEFT JOIN (SELECT biblionumber, min(price) AS price, min(itype) AS itype FROM {koha_items} GROUP BY 1) x
          ON x.biblionumber = b.biblionumber""",
    "koha_open": f"""
        SELECT reserve_id, biblionumber AS biblio_id, branchcode AS holds_branch FROM {{koha_reserves}}
        WHERE reservedate < {D} AND {open_test('cancellationdate', D)} AND {open_test('expirationdate', D)}
          AND {open_test('waitingdate', D)}""",
}
