"""Contract tables derived from the supplied test tables.

Operators take DataFrames in the contract schema (library tables).  The test
data is TPC-H-like, so each contract table is one SELECT over the supplied
tables, kept in SQL that both Spark and DuckDB accept: the oracle queries use
the very same text as common table expressions.  ``{name}`` refers to another
table, ``[TS]`` and ``[ARRAY]`` to the zone-free timestamp type and the array
constructor of the engine at hand.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from shelfstream.session import materialize
from shelfstream.sources.tables import BASE_SCHEMAS, read_parquet_table

RUN_DATE = "1998-07-01"

_LIB = "1000 + CAST(floor(p_partkey / (20 * (1 + p_partkey % 4))) AS BIGINT)"
_BRAND = "TRY_CAST(replace(p_brand, 'Brand#', '') AS BIGINT)"
# Unique loan id: order, line, part and the price in cents.
_LINE_ID = (
    "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
    "CAST(l_partkey AS STRING) || '-' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING)"
)
_CLOCK = (
    "CAST(CAST(ts AS DATE) AS STRING) || ' ' || lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || "
    "lpad(CAST(minute(ts) AS STRING), 2, '0') || ':' || lpad(CAST(CAST(floor(second(ts)) AS INT) AS STRING), 2, '0')"
)
_LOAN_START = (
    "l_shipdate + ((l_orderkey * 7 + l_linenumber) % 24) * INTERVAL '1' HOUR "
    "+ (l_orderkey % 60) * INTERVAL '1' MINUTE"
)
_CIRC_COLUMNS = f"""
    {_LINE_ID} AS id,
    l_partkey AS target_copy,
    1000 + l_suppkey AS circ_lib,
    1000 + l_suppkey AS checkin_lib,
    CAST(floor(l_orderkey / 10) AS BIGINT) AS usr,
    l_suppkey * 2 + l_linenumber % 2 AS workstation,
    CASE WHEN l_linenumber > 4 THEN l_orderkey * 8 + 1 END AS parent_circ,
    {_LOAN_START} AS xact_start,
    {_LOAN_START} + INTERVAL '21' DAY AS due_date,
    CASE WHEN l_linestatus = 'F'
         THEN l_shipdate + CAST(l_quantity AS INT) * INTERVAL '1' DAY + (l_partkey % 24) * INTERVAL '1' HOUR
    END AS checkin_time,
    CASE WHEN l_linestatus = 'F' AND l_tax < 0.06
         THEN l_shipdate + CAST(l_quantity AS INT) * INTERVAL '1' DAY + (l_partkey % 24) * INTERVAL '1' HOUR
    END AS xact_finish,
    l_discount > 0.05 AS opac_renewal
"""
_REQUEST = "o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR"

TABLES: dict[str, str] = {
    # ---- organisation -------------------------------------------------
    "org_unit": """
        SELECT CAST(1 AS BIGINT) AS id, 'CONS' AS shortname, 'Consortium' AS name,
               1 AS ou_type, CAST(NULL AS BIGINT) AS parent_ou
        UNION ALL
        SELECT CAST(10 + r_regionkey AS BIGINT), r_name, 'Region ' || r_name, 2, CAST(1 AS BIGINT) FROM {region}
        UNION ALL
        SELECT CAST(100 + n_nationkey AS BIGINT), n_name, 'System ' || n_name, 3,
               CAST(10 + n_regionkey AS BIGINT) FROM {nation}
        UNION ALL
        SELECT 1000 + s_suppkey, s_name, 'The "' || s_name || '" Library', 4,
               CAST(100 + s_nationkey AS BIGINT) FROM {supplier}
    """,
    "org_unit_type": "SELECT DISTINCT ou_type AS id, ou_type >= 3 AS can_have_vols FROM {org_unit}",
    "org_address": """
        SELECT s_suppkey * 2 AS id, 1000 + s_suppkey AS org_unit, 'MAILING' AS address_type,
               'PO Box ' || CAST(s_suppkey AS STRING) AS street1, 'Floor 1' AS street2,
               'City ' || CAST(s_nationkey AS STRING) AS city, 'ST' AS state,
               '9' || CAST(s_suppkey AS STRING) AS post_code
        FROM {supplier}
        UNION ALL
        SELECT s_suppkey * 2 + 1, 1000 + s_suppkey, 'PHYSICAL',
               CAST(s_suppkey AS STRING) || ' Main St',
               CASE WHEN s_acctbal >= 2000 THEN 'Suite 2' END,
               'City ' || CAST(s_nationkey AS STRING), 'ST',
               CASE WHEN s_acctbal < 7000 THEN 'Z ' || CAST(s_suppkey AS STRING) END
        FROM {supplier}
    """,
    "workstation": """
        SELECT s_suppkey * 2 AS id, 'ws-' || CAST(s_suppkey AS STRING) || '-desk' AS name,
               1000 + s_suppkey AS owning_lib FROM {supplier}
        UNION ALL
        SELECT s_suppkey * 2 + 1, 'ws-' || CAST(s_suppkey AS STRING) || '-self', 1000 + s_suppkey FROM {supplier}
    """,
    # ---- holdings -----------------------------------------------------
    "copy": f"""
        SELECT p_partkey AS id,
               'B' || lpad(CAST(p_partkey AS STRING), 9, '0') || CASE WHEN p_size = 30 THEN '/' ELSE '' END AS barcode,
               CASE WHEN p_size = 50 THEN CAST(-1 AS BIGINT) ELSE p_partkey - p_partkey % 2 END AS call_number,
               {_LIB} AS circ_lib,
               {_BRAND} AS location,
               p_size % 15 AS status,
               CASE WHEN p_size <> 7 THEN p_type END AS circ_modifier,
               p_size <> 3 AS circulate,
               p_size <> 5 AS holdable,
               p_size IN (11, 22, 33) AS deleted,
               CAST(DATE '1990-01-01' + CAST(p_partkey % 4000 AS INT) AS [TS]) AS create_date,
               CAST(DATE '1998-06-25' AS [TS]) + (p_partkey % 240) * INTERVAL '1' HOUR AS edit_date,
               CASE WHEN p_size <> 9 THEN CAST(p_retailprice AS DECIMAL(8, 2)) END AS price,
               CASE WHEN p_size > 40 THEN 1 WHEN p_size > 30 THEN 0 END AS floating,
               CASE WHEN p_size = 50 THEN p_name END AS dummy_title,
               CASE WHEN p_size = 50 THEN p_brand END AS dummy_author
        FROM {{part}}
    """,
    "copy_location": f"""
        SELECT DISTINCT {_BRAND} AS id, p_brand AS name,
               {_BRAND} % 6 <> 0 AS circulate, {_BRAND} % 7 <> 0 AS holdable
        FROM {{part}}
    """,
    "copy_status": """
        SELECT DISTINCT p_size % 15 AS id, 'Status ' || CAST(p_size % 15 AS STRING) AS name,
               p_size % 15 NOT IN (2, 3, 4, 13, 14) AS holdable
        FROM {part}
    """,
    "circ_modifier": "SELECT DISTINCT p_type AS code, 'Modifier ' || p_type AS name FROM {part}",
    "copy_note": """
        SELECT p_partkey * 2 + 1 AS id, p_partkey AS owning_copy, 'CollectionHQ rotation' AS title,
               p_name || ' ' || p_type || ' ' || p_brand || repeat(' weed,', 30) AS value
        FROM {part} WHERE p_size < 20
        UNION ALL
        SELECT p_partkey * 2, p_partkey,
               CASE WHEN p_size < 10 THEN 'for collectionhq' ELSE 'Binding' END, 'note ' || p_name
        FROM {part} WHERE p_size < 30
    """,
    "copy_part_map": """
        SELECT CAST(floor(p_partkey / 4) AS BIGINT) AS part, p_partkey AS target_copy
        FROM {part} WHERE p_size < 40
    """,
    "call_number": f"""
        SELECT p_partkey AS id, CAST(floor(p_partkey / 4) AS BIGINT) AS record,
               p_name || ' ' || CAST(p_size AS STRING) AS label,
               p_size % 7 AS prefix, p_size % 9 AS suffix,
               {_LIB} AS owning_lib, p_size = 13 AS deleted,
               CAST(DATE '1998-01-01' + CAST(p_partkey % 365 AS INT) AS [TS]) AS edit_date
        FROM {{part}}
    """,
    "call_number_prefix": "SELECT r_regionkey AS id, substring(r_name, 1, 3) AS label FROM {region}",
    "call_number_suffix": """
        SELECT r_regionkey AS id, CASE WHEN r_regionkey = 0 THEN '' ELSE 'v.' || CAST(r_regionkey AS STRING) END AS label
        FROM {region}
    """,
    "asset_stat_cat": "SELECT r_regionkey AS id, r_name AS name FROM {region}",
    "asset_stat_cat_entry": "SELECT n_nationkey AS id, n_regionkey AS stat_cat, n_name AS value FROM {nation}",
    "asset_stat_cat_map": """
        SELECT p_partkey AS owning_copy, p_size % 25 AS stat_cat_entry, (p_size % 25) % 5 AS stat_cat FROM {part}
    """,
    # ---- patrons ------------------------------------------------------
    "usr": """
        SELECT c_custkey AS id, CAST(100 + c_nationkey AS BIGINT) AS home_ou,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
                                 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS profile,
               c_acctbal >= 0 AS active, c_acctbal < -900 AS deleted,
               CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INT) AS [TS]) AS create_date,
               c_name AS family_name, 'Given' || CAST(c_custkey % 100 AS STRING) AS first_given_name,
               c_name || '@example.org' AS email, '555-' || CAST(c_custkey AS STRING) AS day_phone,
               CASE WHEN c_acctbal > 5000 THEN '556-' || CAST(c_custkey AS STRING) END AS evening_phone
        FROM {customer}
    """,
    "card": """
        SELECT c_custkey AS usr, 'C' || CAST(c_custkey AS STRING) AS barcode, c_acctbal > 1000 AS active FROM {customer}
        UNION ALL
        SELECT c_custkey, 'L' || CAST(c_custkey AS STRING), c_acctbal > 8000 FROM {customer} WHERE c_acctbal > 6000
    """,
    "usr_address": """
        SELECT c_custkey AS usr, CAST(c_custkey AS STRING) || ' Elm St' AS street1,
               CASE WHEN c_acctbal > 3000 THEN 'Apt 1' END AS street2,
               'Town ' || CAST(c_nationkey AS STRING) AS city, 'ST' AS state,
               'P' || CAST(c_custkey % 50 AS STRING) AS post_code
        FROM {customer} WHERE c_acctbal > -500
        UNION ALL
        SELECT c_custkey, 'Box ' || CAST(c_custkey AS STRING), CAST(NULL AS STRING),
               'Town ' || CAST(c_nationkey AS STRING), 'ST', 'Q' || CAST(c_custkey % 20 AS STRING)
        FROM {customer} WHERE c_acctbal > 7000
    """,
    "grp_tree": "SELECT DISTINCT profile AS id, 'Group ' || CAST(profile AS STRING) AS name FROM {usr}",
    "actor_stat_cat": "SELECT r_regionkey AS id, r_name AS name FROM {region}",
    "actor_stat_cat_entry": "SELECT n_nationkey AS id, n_regionkey AS stat_cat, n_name AS value FROM {nation}",
    "actor_stat_cat_map": """
        SELECT c_custkey AS target_usr, c_nationkey % 5 AS stat_cat FROM {customer} WHERE c_acctbal > 2000
    """,
    "open_billable_xact_summary": """
        SELECT o_custkey AS usr, CAST(o_totalprice AS DECIMAL(18, 2)) AS balance_owed
        FROM {orders} WHERE o_orderstatus = 'O'
    """,
    # ---- circulation --------------------------------------------------
    "circulation": f"SELECT {_CIRC_COLUMNS} FROM {{lineitem}} WHERE l_returnflag <> 'R'",
    "aged_circulation": f"SELECT {_CIRC_COLUMNS} FROM {{lineitem}} WHERE l_returnflag = 'R'",
    "open_circulation": "SELECT id, target_copy, usr FROM {circulation} WHERE checkin_time IS NULL",
    "billable_xact": "SELECT id, xact_start FROM {circulation}",
    "circ_type": """
        SELECT id, CASE WHEN opac_renewal OR parent_circ IS NOT NULL THEN 'RENEWAL' ELSE 'CHECKOUT' END AS type
        FROM {circulation}
    """,
    "transit_copy": f"""
        SELECT p_partkey * 2 AS id, p_partkey AS target_copy, {_LIB} AS dest,
               CAST(DATE '1996-01-01' + CAST(p_partkey % 1200 AS INT) AS [TS]) AS source_send_time,
               CASE WHEN p_size < 45 THEN CAST(DATE '1996-01-04' + CAST(p_partkey % 1200 AS INT) AS [TS]) END
                   AS dest_recv_time
        FROM {{part}}
        UNION ALL
        SELECT p_partkey * 2 + 1, p_partkey, 1000 + CAST(floor(p_partkey / 50) AS BIGINT),
               CAST(DATE '1997-06-01' + CAST(p_partkey % 700 AS INT) AS [TS]),
               CASE WHEN p_size > 5 THEN CAST(DATE '1997-06-06' + CAST(p_partkey % 700 AS INT) AS [TS]) END
        FROM {{part}}
    """,
    "hold_transit_copy": """
        SELECT p_partkey * 2 AS id, 1000 + CAST(floor(p_partkey / 30) AS BIGINT) AS source
        FROM {part} WHERE p_size > 15
    """,
    "in_house_use": """
        SELECT event_id AS id, CAST(floor(event_id / 5) AS BIGINT) AS item,
               1000 + CAST(floor(event_id / 100) AS BIGINT) AS org_unit, ts AS use_time
        FROM {events} WHERE event_type IN ('view', 'click')
    """,
    "non_cataloged_circulation": """
        SELECT event_id AS id, 1000 + CAST(floor(event_id / 100) AS BIGINT) AS circ_lib,
               CAST(user_id % 5 AS INT) AS item_type, ts AS circ_time
        FROM {events} WHERE event_type IN ('purchase', 'signup')
    """,
    "non_cataloged_type": "SELECT r_regionkey AS id, 'Type ' || r_name AS name FROM {region}",
    # ---- holds --------------------------------------------------------
    "hold_request": f"""
        SELECT o_orderkey AS id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'T' WHEN o_orderpriority = '2-HIGH' THEN 'V'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'P' WHEN o_orderpriority = '5-LOW' THEN 'M'
                    WHEN o_totalprice > 350000 THEN 'F' WHEN o_totalprice > 200000 THEN 'R' ELSE 'C' END AS hold_type,
               CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(floor(o_custkey / 2) AS BIGINT)
                    WHEN o_orderpriority = '2-HIGH' THEN o_custkey - o_custkey % 2
                    WHEN o_orderpriority = '3-MEDIUM' THEN o_custkey
                    WHEN o_totalprice < 40000 THEN -o_custkey
                    ELSE CAST(floor(o_custkey / 5) AS BIGINT) END AS target,
               1000 + CAST(floor(o_custkey / 15) AS BIGINT) AS pickup_lib,
               1000 + CAST(floor(o_orderkey / 150) AS BIGINT) AS request_lib,
               CASE WHEN o_orderstatus = 'F' THEN 1000 + CAST(floor(o_custkey / 15) AS BIGINT) END AS fulfillment_lib,
               o_custkey AS requestor,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(floor(o_orderkey / 8) AS BIGINT) END AS current_copy,
               {_REQUEST} AS request_time,
               CASE WHEN o_orderstatus <> 'O' THEN {_REQUEST} + INTERVAL '10' DAY END AS capture_time,
               CASE WHEN o_orderstatus = 'F' THEN {_REQUEST} + INTERVAL '15' DAY END AS fulfillment_time,
               CASE WHEN o_orderstatus = 'O' AND o_totalprice > 400000 THEN {_REQUEST} + INTERVAL '30' DAY END
                   AS cancel_time
        FROM {{orders}}
    """,
    "hold_request_record": """
        SELECT o_orderkey AS id, CAST(floor(o_custkey / 3) AS BIGINT) AS bib_record FROM {orders}
    """,
    "metarecord_source_map": """
        SELECT CAST(floor(doc_id / 3) AS BIGINT) AS metarecord, doc_id AS source FROM {documents}
    """,
    # ---- acquisitions -------------------------------------------------
    "purchase_order": """
        SELECT o_orderkey AS id, 1000 + CAST(floor(o_custkey / 15) AS BIGINT) AS ordering_agency FROM {orders}
    """,
    "acq_lineitem": """
        SELECT o_orderkey AS id, o_orderkey AS purchase_order, CAST(floor(o_custkey / 3) AS BIGINT) AS eg_bib_id,
               CASE o_orderstatus WHEN 'O' THEN 'on-order' WHEN 'P' THEN 'new' ELSE 'received' END AS state
        FROM {orders}
    """,
    "acq_lineitem_detail": f"""
        SELECT {_LINE_ID} AS id, l_orderkey AS lineitem, 1000 + l_suppkey AS owning_lib,
               l_linenumber AS fund, CASE WHEN l_linestatus = 'F' THEN l_partkey END AS eg_copy_id
        FROM {{lineitem}}
    """,
    "fund": "SELECT n_nationkey AS id, 'Fund ' || n_name AS name FROM {nation}",
    # ---- bibliographic ------------------------------------------------
    "record_entry": """
        SELECT doc_id AS id,
               CASE WHEN n_chars < 60 THEN '<record><datafield tag="245"><subfield code="a">broken'
               ELSE '<record xmlns="http://www.loc.gov/MARC21/slim"><leader>00000nam a2200000 a 4500</leader>'
                 || '<controlfield tag="001">' || CAST(doc_id AS STRING) || '</controlfield>'
                 || CASE WHEN n_chars % 5 = 0 THEN '<datafield tag="020"><subfield code="a">nocode</subfield></datafield>'
                    ELSE '' END
                 || CASE WHEN n_chars % 3 <> 0 THEN '<datafield tag="020"><subfield code="a">978'
                      || lpad(CAST(doc_id AS STRING), 10, '0') || '</subfield><subfield code="c">$'
                      || CAST(n_chars % 97 AS STRING) || '.' || CAST(n_chars % 1000 AS STRING)
                      || ' pbk</subfield></datafield>' ELSE '' END
                 || CASE WHEN n_chars % 4 <> 1 THEN '<datafield tag="082"><subfield code="a">'
                      || CAST(n_chars % 1000 AS STRING) || '.' || CAST(doc_id AS STRING) || ' /22</subfield></datafield>'
                    ELSE '' END
                 || '<datafield tag="245"><subfield code="a">Title ' || source || ' &amp; ' || lang
                 || '</subfield><subfield code="b">volume ' || CAST(doc_id AS STRING) || '</subfield>'
                 || CASE WHEN n_chars % 2 = 0 THEN '<subfield code="p">Part ' || CAST(n_chars % 9 AS STRING)
                      || '</subfield>' ELSE '' END || '</datafield>'
                 || CASE WHEN n_chars % 6 < 4 THEN '<datafield tag="250"><subfield code="a">Éd. Révisée ('
                      || CAST(n_chars % 12 AS STRING) || ')</subfield></datafield>' ELSE '' END
                 || CASE WHEN n_chars % 7 <> 0 THEN '<datafield tag="' || CASE WHEN n_chars % 2 = 0 THEN '260' ELSE '264' END
                      || '"><subfield code="b">Pub. ' || source || ',</subfield><subfield code="c">c'
                      || CAST(1950 + n_chars % 70 AS STRING) || ', ' || CAST(1960 + n_chars % 50 AS STRING)
                      || '</subfield></datafield>' ELSE '' END
                 || CASE WHEN n_chars % 4 = 0 THEN '<datafield tag="490"><subfield code="a">Series ' || source
                      || '</subfield></datafield>' ELSE '' END
                 || '<datafield tag="520"><subfield code="a">'
                 || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
                 || '</subfield></datafield>'
                 || '<datafield tag="650"><subfield code="a">Subject ' || lang || '</subfield></datafield>'
                 || CASE WHEN n_chars % 3 = 1 THEN '<datafield tag="650"><subfield code="a">Topic--' || source
                      || repeat(' long heading', 12) || '</subfield></datafield>' ELSE '' END
                 || CASE WHEN n_chars % 5 = 2 THEN '<datafield tag="655"><subfield code="a">Genre '
                      || source || '</subfield></datafield>' ELSE '' END
                 || '</record>' END AS marc,
               n_chars % 5 <> 0 AS active, n_chars % 17 = 0 AS deleted,
               CAST(DATE '1998-01-01' + CAST(doc_id % 365 AS INT) AS [TS]) AS edit_date
        FROM {documents}
    """,
    "simple_record": """
        SELECT doc_id AS id, 'Title ' || source || ' ' || lang || ' ' || CAST(doc_id AS STRING) || ' /' AS title,
               'Author "' || lang || '", ' || source AS author,
               CASE WHEN n_chars >= 100 THEN [ARRAY](
                   '978' || lpad(CAST(doc_id AS STRING), 10, '0'),
                   '0-' || lpad(CAST(doc_id % 1000 AS STRING), 3, '0') || '-' || lpad(CAST(n_chars % 100000 AS STRING), 5, '0')
                       || '-' || CASE WHEN n_chars % 11 = 10 THEN 'X' ELSE CAST(n_chars % 11 AS STRING) END,
                   ' 978' || lpad(CAST(doc_id AS STRING), 10, '0') || ' ', 'nocode') END AS isbn,
               CAST(1950 + n_chars % 70 AS STRING) AS pubdate, 'Pub ' || source AS publisher,
               CASE WHEN n_chars % 2 = 0 THEN 'OCLC' ELSE 'LOCAL' END AS tcn_source,
               'ocm' || lpad(CAST(doc_id AS STRING), 8, '0') AS tcn_value
        FROM {documents}
    """,
    "full_rec": """
        SELECT doc_id AS record, '020' AS tag, 'a' AS subfield,
               ' 978' || lpad(CAST(doc_id AS STRING), 10, '0') || ' (pbk.) : $12.95' AS value
        FROM {documents} WHERE n_chars % 3 <> 0
        UNION ALL
        SELECT doc_id, '020', 'z', '0306' || lpad(CAST(n_chars % 1000000 AS STRING), 6, '0') || ':sewn' FROM {documents}
        WHERE n_chars % 4 <> 0
        UNION ALL
        SELECT doc_id, '020', 'a', '12345678901234567' FROM {documents}
        UNION ALL
        SELECT doc_id, '245', 'a', source FROM {documents}
    """,
    "record_attr_flat": """
        SELECT doc_id AS id, 'search_format' AS attr, CASE WHEN n_chars % 2 = 0 THEN 'book' ELSE 'ebook' END AS value
        FROM {documents}
        UNION ALL
        SELECT doc_id, 'search_format', 'lpbook' FROM {documents} WHERE n_chars % 5 = 0
        UNION ALL
        SELECT doc_id, 'item_lang', lang FROM {documents}
    """,
    "rec_descriptor": """
        SELECT doc_id AS record, CASE n_chars % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'g' WHEN 2 THEN 'j' ELSE 't' END AS item_type,
               lang AS item_lang
        FROM {documents}
    """,
    "item_type_map": "SELECT DISTINCT item_type AS code, 'Item type ' || item_type AS value FROM {rec_descriptor}",
    "bib_extract": """
        SELECT doc_id AS biblio_id, 'old ean' AS eans, 'old material' AS material_type, 'old title ' || source AS title,
               'old author' AS author, CAST(NULL AS STRING) AS series, '1900' AS pub_date,
               'old publisher' AS publisher_supplier, CAST(NULL AS STRING) AS price,
               CASE WHEN n_chars % 10 <> 0 THEN CAST(DATE '1998-05-01' AS [TS]) END AS last_update
        FROM {documents} WHERE n_chars % 2 = 0
    """,
    # ---- second integrated library system -----------------------------
    "koha_items": f"""
        SELECT p_partkey AS itemnumber, CAST(floor(p_partkey / 4) AS BIGINT) AS biblionumber,
               'K' || CAST(p_partkey AS STRING) AS barcode,
               DATE '1990-01-01' + CAST(p_partkey % 4000 AS INT) AS dateaccessioned,
               p_brand AS permanent_location, 'BR' || CAST({_LIB} AS STRING) AS holdingbranch,
               'HB' || CAST({_LIB} AS STRING) AS homebranch, p_name AS itemcallnumber, p_type AS itype,
               p_size % 7 AS itemlost, CASE WHEN p_size = 20 THEN 1 ELSE 0 END AS withdrawn,
               CASE WHEN p_size % 10 = 1 THEN -1 WHEN p_size % 10 = 2 THEN 1 ELSE 0 END AS notforloan,
               CASE WHEN p_size <> 9 THEN CAST(p_retailprice AS DECIMAL(8, 2)) END AS price,
               CAST(DATE '1998-06-25' AS [TS]) + (p_partkey % 240) * INTERVAL '1' HOUR AS "timestamp"
        FROM {{part}}
    """,
    "koha_issues": f"""
        SELECT {_LINE_ID} AS issue_id, l_partkey AS itemnumber, 'BR' || CAST(l_suppkey AS STRING) AS branchcode,
               {_LOAN_START} AS issuedate,
               CASE WHEN l_linenumber > 3 THEN {_LOAN_START} + INTERVAL '7' DAY END AS lastreneweddate,
               CAST(NULL AS [TS]) AS returndate, {_LOAN_START} + INTERVAL '21' DAY AS date_due
        FROM {{lineitem}} WHERE l_linestatus = 'O'
        UNION ALL
        SELECT {_LINE_ID}, l_partkey, 'BR' || CAST(l_suppkey AS STRING), {_LOAN_START}, CAST(NULL AS [TS]),
               {_LOAN_START} + INTERVAL '9' DAY, {_LOAN_START} + INTERVAL '21' DAY
        FROM {{lineitem}} WHERE l_linestatus = 'F' AND l_returnflag = 'A'
    """,
    "koha_old_issues": f"""
        SELECT {_LINE_ID} AS issue_id, l_partkey AS itemnumber, 'BR' || CAST(l_suppkey AS STRING) AS branchcode,
               {_LOAN_START} AS issuedate,
               CASE WHEN l_linenumber > 5 THEN {_LOAN_START} + INTERVAL '7' DAY END AS lastreneweddate,
               {_LOAN_START} + CAST(l_quantity AS INT) * INTERVAL '1' DAY AS returndate,
               {_LOAN_START} + INTERVAL '21' DAY AS date_due
        FROM {{lineitem}} WHERE l_linestatus = 'F' AND l_returnflag <> 'A'
    """,
    "koha_reserves": """
        SELECT o_orderkey AS reserve_id, CAST(floor(o_custkey / 3) AS BIGINT) AS biblionumber,
               'BR' || CAST(CAST(floor(o_custkey / 15) AS BIGINT) AS STRING) AS branchcode, CAST(o_orderdate AS DATE) AS reservedate,
               CASE WHEN o_totalprice > 400000 THEN CAST(o_orderdate AS DATE) + 20 END AS cancellationdate,
               CASE WHEN o_totalprice < 100000 THEN CAST(o_orderdate AS DATE) + 365 END AS expirationdate,
               CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) + 12 END AS waitingdate
        FROM {orders} WHERE o_orderstatus <> 'F'
    """,
    "koha_old_reserves": """
        SELECT o_orderkey AS reserve_id, CAST(floor(o_custkey / 3) AS BIGINT) AS biblionumber,
               'BR' || CAST(CAST(floor(o_custkey / 15) AS BIGINT) AS STRING) AS branchcode, CAST(o_orderdate AS DATE) AS reservedate,
               CAST(NULL AS DATE) AS cancellationdate, CAST(NULL AS DATE) AS expirationdate,
               CAST(o_orderdate AS DATE) + 12 AS waitingdate
        FROM {orders} WHERE o_orderstatus = 'F'
    """,
    "koha_biblio": """
        SELECT doc_id AS biblionumber, 'Title ' || source || ' ' || CAST(doc_id AS STRING) AS title,
               'Author ' || lang AS author, CASE WHEN n_chars % 4 = 0 THEN 'Series ' || source END AS seriestitle,
               CAST(DATE '1998-01-01' + CAST(doc_id % 365 AS INT) AS [TS]) AS "timestamp"
        FROM {documents}
    """,
    "koha_biblioitems": """
        SELECT doc_id AS biblionumber,
               CASE WHEN n_chars % 3 <> 0 THEN '978' || lpad(CAST(doc_id AS STRING), 10, '0') END AS isbn,
               CASE WHEN n_chars % 4 = 0 THEN 'EAN' || CAST(doc_id AS STRING) END AS ean,
               CAST(1950 + n_chars % 70 AS STRING) AS publicationyear, 'Pub ' || source AS publishercode,
               CASE WHEN n_chars % 3 = 0 THEN 'BK' END AS itemtype
        FROM {documents}
    """,
    "koha_aqorders": """
        SELECT o_orderkey AS ordernumber, CAST(floor(o_custkey / 3) AS BIGINT) AS biblionumber,
               CAST(o_custkey % 25 AS INT) AS budget_id,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 30 END AS datereceived
        FROM {orders}
    """,
    "koha_aqorders_items": "SELECT l_partkey AS itemnumber, l_orderkey AS ordernumber FROM {lineitem}",
    "koha_aqbudgets": "SELECT n_nationkey AS budget_id, 'Budget ' || n_name AS budget_name FROM {nation}",
    # ---- monitoring ---------------------------------------------------
    "trigger_event": """
        SELECT event_id AS id, user_id % 20 AS event_def,
               CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'pending' ELSE 'complete' END AS state,
               CASE WHEN value > 400 THEN 'timeout' END AS error_output, ts AS add_time
        FROM {events}
    """,
    "event_definition": """
        SELECT DISTINCT user_id % 20 AS id, 'Definition ' || CAST(user_id % 20 AS STRING) AS name FROM {events}
    """,
    "activity": """
        SELECT CASE event_type WHEN 'click' THEN '<IDLE> in transaction' WHEN 'signup' THEN 'autovacuum: public.t'
               ELSE 'SELECT ' || CAST(event_id AS STRING) END AS current_query,
               ts AS query_start, 'db' || CAST(user_id % 4 AS STRING) AS database
        FROM {events}
    """,
    "replication_status": "SELECT event_id AS node, CAST(floor(value) AS BIGINT) AS st_lag_num_events FROM {events}",
    "service_log": """
        SELECT event_id AS line_no, ts, 'host' || CAST(user_id % 10 AS STRING) AS host,
               'SERVICE (svc.' || event_type || ') : '
                 || CASE user_id % 3 WHEN 0 THEN 'listener' WHEN 1 THEN 'master' ELSE 'controller' END
                 || ' count: ' || CAST((event_id * 7 + user_id) % 40 AS STRING)
                 || ', drone count: ' || CAST(CAST(floor(value / 5) AS INT) AS STRING) || '/100' AS line
        FROM {events}
    """,
    "app_log": f"""
        SELECT event_id AS line_no, ts,
               '[' || {_CLOCK} || '] host' || CAST(user_id % 10 AS STRING) || ' ['
                 || CASE WHEN event_type = 'error' THEN 'ERR ' ELSE 'INFO' END
                 || ':' || CAST(30000 + user_id AS STRING) || ':Module.pm:' || CAST(100 + event_id % 7 AS STRING)
                 || ':' || CAST(7000000 + event_id AS STRING) || '] '
                 || CASE WHEN event_type = 'error' THEN 'Returning NULL'
                         WHEN value > 300 THEN 'IS NOT CONNECTED TO THE NETWORK'
                         WHEN event_type = 'signup' THEN 'login token ' || md5(CAST(event_id % 100 AS STRING))
                         ELSE 'call ' || CAST(7000000 + event_id - 1 AS STRING) || ' finished' END AS line
        FROM {{events}}
    """,
    "cpu_sample": """
        SELECT 'host' || CAST(user_id % 10 AS STRING) AS host, ts, event_id AS sample_no,
               event_id * 5 + CAST(floor(value) AS BIGINT) AS cpu_user, event_id AS cpu_nice,
               event_id * 2 + user_id AS cpu_system, event_id * 90 + user_id * 3 AS cpu_idle,
               event_id * 3 AS cpu_iowait, event_id AS cpu_irq, event_id AS cpu_softirq,
               CAST(floor(event_id / 2) AS BIGINT) AS cpu_steal
        FROM {events}
    """,
    "ram_sample": """
        SELECT 'host' || CAST(user_id % 10 AS STRING) AS host, ts, event_id AS sample_no,
               CAST(16000000 AS BIGINT) AS mem_total, CAST(floor(value * 10000) AS BIGINT) AS mem_free,
               event_id * 10 AS buffers, user_id * 20000 AS cached
        FROM {events}
    """,
    "process_list": """
        SELECT event_id AS pid, 'host' || CAST(user_id % 10 AS STRING) AS host,
               CAST(event_id AS STRING) || ' ?  S  0:00 App ' || CASE WHEN value < 20 THEN 'Listener' ELSE 'Drone' END
                 || ' [svc.' || event_type || ']' AS line
        FROM {events} WHERE event_type <> 'click' OR value < 100
    """,
    "service_config": """
        SELECT DISTINCT 'svc.' || event_type AS service, CAST(2000 + length(event_type) * 10 AS BIGINT) AS max_children FROM {events}
    """,
}


# Small tables that are distinct values of large ones.  They are written once per
# run, as the dimension tables they stand for would be: Catalyst then knows their
# size and does not shuffle the facts for them.
DIMENSIONS = {
    "copy_location", "copy_status", "circ_modifier", "grp_tree", "org_unit_type", "event_definition", "item_type_map",
    "service_config",
}


def render(name: str, timestamp_type: str, array_function: str) -> str:
    text = TABLES[name].replace("[TS]", timestamp_type).replace("[ARRAY]", array_function)
    return text


def references(name: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", TABLES[name])))


class Testbed:
    """Lazy contract tables over one data folder; attribute access by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            if name in TABLES:
                text = render(name, "TIMESTAMP_NTZ", "array").replace('"timestamp"', "`timestamp`")
                inputs = {ref: self.table(ref) for ref in references(name)}
                table = self.spark.sql(text, **inputs)
                self._tables[name] = materialize(table, name) if name in DIMENSIONS else table
            else:
                self._tables[name] = read_parquet_table(self.spark, self.folder, name)
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES or name in BASE_SCHEMAS:
            return self.table(name)
        raise AttributeError(name)
