"""The registered queries as SQL over the same parquet tables.

`VIEWS` are common table expressions that build on each other; `ORACLES` select from them. `oracle_sql` puts the
ones a query needs in front of it. The SQL takes other ways than the Spark code where there are any: subqueries for
lookups, a list of faults for the status, whole-number arithmetic for rounded shares.
"""

from __future__ import annotations

import re

VIEWS = {
    "vendor_base": """
        SELECT 'V' || s_suppkey AS code, s_name AS label, s_nationkey AS nk,
               CAST(s_acctbal AS DECIMAL(12,2)) AS bal, 'SUPPLIER' AS segment
        FROM supplier
        UNION ALL
        SELECT 'C' || c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)), c_mktsegment
        FROM customer""",
    "stg_vendor": """
        SELECT code AS VendorCode,
               r_name || ' ' || segment || ' ' || CAST(FLOOR(ABS(bal) / 3) AS BIGINT)
                 || CASE WHEN right(label, 1) IN ('0','1','2') THEN ', LLC.'
                         WHEN right(label, 1) IN ('3','4') THEN ' Inc'
                         WHEN right(label, 1) = '5' THEN ' S.A.'
                         WHEN right(label, 1) = '6' THEN ' GmbH' ELSE '' END AS VendorName,
               CASE WHEN bal < -500 THEN '' WHEN bal < 0 THEN '   '
                    ELSE 'T' || nk || '-' || CAST(FLOOR(bal / 10) AS BIGINT) END AS TaxID,
               n_name AS Country,
               CASE WHEN r_name = 'EUROPE' THEN 'EUR' WHEN r_name = 'AFRICA' THEN 'CRC'
                    WHEN r_name = 'MIDDLE EAST' AND bal > 8000 THEN 'COL' ELSE 'USD' END AS Currency,
               CASE WHEN segment = 'BUILDING' THEN 'n30'
                    WHEN segment = 'FURNITURE' THEN ' Net45 '
                    WHEN segment = 'HOUSEHOLD' THEN 'NET 15'
                    WHEN segment = 'MACHINERY' THEN CASE WHEN bal > 9000 THEN '2% 10 Net 30' ELSE 'Net60' END
                    WHEN segment = 'SUPPLIER' AND bal > 9500 THEN 'NET30'
                    WHEN segment = 'SUPPLIER' AND bal > 5000 THEN '30 days '
                    ELSE 'Net30' END AS PaymentTerms,
               CASE WHEN bal BETWEEN 100 AND 300 THEN ''
                    WHEN bal BETWEEN 300 AND 400 THEN 'accounts payable'
                    ELSE ' ' || lower(replace(label, '#', '.')) || '@' || lower(n_name) || '.example ' END AS Email,
               CASE WHEN bal > 9900 THEN 'Blocked' ELSE 'Active' END AS Status,
               CAST(DATE '2010-01-01' + CAST(FLOOR(ABS(bal)) AS INTEGER) AS VARCHAR) AS CreatedDate
        FROM vendor_base JOIN nation ON n_nationkey = nk JOIN region ON r_regionkey = n_regionkey""",
    "stg_item": """
        SELECT 'ITM-' || p_partkey AS ItemNumber, p_name AS Description, p_type AS ItemGroup, 'EA' AS UoM,
               CAST(p_retailprice AS VARCHAR) AS StandardCost
        FROM part""",
    "order_line": """
        SELECT * FROM (
          SELECT *, SUM(l_quantity) OVER (PARTITION BY l_orderkey, l_linenumber) AS ordered,
                 ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                                    ORDER BY l_partkey, l_suppkey, l_linestatus) AS nth
          FROM lineitem) WHERE nth = 1""",
    "stg_po_line": """
        SELECT 'PO-' || l_orderkey AS PurchaseOrderNumber, CAST(l_linenumber AS BIGINT) AS LineNumber,
               CASE WHEN l_partkey % 13 = 0 THEN 'X' ELSE 'V' END || l_suppkey AS VendorAccount,
               CASE WHEN l_suppkey % 23 = 0 THEN 'ITX-' ELSE 'ITM-' END || l_partkey AS ItemNumber,
               CAST(ordered AS BIGINT) AS OrderedQuantity, CAST(p_retailprice AS DECIMAL(12,2)) AS UnitPrice,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS OrderDate, 'SITE-' || l_linestatus AS Site
        FROM order_line JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey""",
    "stg_receipt": """
        SELECT 'RC-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS ReceiptNumber,
               CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN 'NOPO-' ELSE 'PO-' END || l_orderkey
                 AS PurchaseOrderNumber,
               CAST(l_linenumber AS BIGINT) AS LineNumber,
               CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 1 THEN 0 ELSE CAST(l_quantity AS BIGINT) END
                 AS ReceivedQuantity,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ReceiptDate
        FROM lineitem""",
    "stg_invoice": """
        SELECT 'INV-' || l_orderkey AS InvoiceNumber,
               CASE WHEN l_partkey % 13 = 0 THEN 'X' ELSE 'V' END || l_suppkey AS VendorAccount,
               CASE WHEN l_orderkey % 50 = 7 THEN 'NOPO-' ELSE 'PO-' END || l_orderkey AS PurchaseOrderNumber,
               CAST(l_linenumber AS BIGINT) AS LineNumber,
               CAST(l_quantity AS BIGINT) AS InvoiceQuantity,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) + CAST(l_discount AS DECIMAL(4,2)))
                    AS DECIMAL(12,2)) AS InvoiceUnitPrice,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS InvoiceDate
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "terms_fix": """
        SELECT * FROM (VALUES ('N30','Net30'), ('NET 30','Net30'), ('30 DAYS','Net30'), ('N45','Net45'),
                              ('NET45','Net45'), ('N60','Net60'), ('NET 15','Net15')) AS t(key, fixed)""",
    "checked": """
        SELECT v.*, trim(PaymentTerms) AS terms,
               CASE WHEN trim(PaymentTerms) NOT IN ('Net15','Net30','Net45','Net60') THEN fixed END AS fixed,
               trim(PaymentTerms) IN ('Net15','Net30','Net45','Net60') AS known_terms,
               regexp_matches(trim(Email), '^[\\p{L}\\p{N}_.+-]+@[\\p{L}\\p{N}_-]+\\.[\\p{L}\\p{N}_.]+$') AS email_ok
        FROM stg_vendor v LEFT JOIN terms_fix ON key = upper(trim(PaymentTerms))""",
    "oldest": """
        SELECT TaxID, VendorCode AS Oldest FROM (
          SELECT TaxID, VendorCode,
                 ROW_NUMBER() OVER (PARTITION BY TaxID ORDER BY CreatedDate, VendorCode) AS nth
          FROM stg_vendor WHERE trim(TaxID) <> '') WHERE nth = 1""",
    "survivors": """
        SELECT VendorCode, VendorName, c.TaxID, Country, Currency, COALESCE(fixed, PaymentTerms) AS PaymentTerms,
               Email, Status, CreatedDate, COALESCE(Oldest, VendorCode) AS SurvivorCode,
               trim(regexp_replace(regexp_replace(upper(VendorName),
                    '\\b(LLC|INC|CORP|CO|LTD|GMBH|S\\.?A\\.?)\\b', '', 'g'), '[^A-Z0-9]', '', 'g')) AS NormName
        FROM checked c LEFT JOIN oldest o ON o.TaxID = c.TaxID""",
    "row_issues": """
        SELECT 'VEN-001' AS RuleID, 'Missing Tax ID' AS RuleDescription, 'High' AS Severity, 'Vendor' AS Entity,
               VendorCode AS RecordKey, 'TaxID' AS FieldName, TaxID AS BadValue, 'Open' AS Status,
               TRUE AS IsBlocking
        FROM checked WHERE trim(TaxID) = ''
        UNION ALL
        SELECT 'VEN-002', 'Invalid currency code', 'High', 'Vendor', VendorCode, 'Currency', Currency, 'Open', TRUE
        FROM checked WHERE Currency NOT IN ('USD','CRC','EUR')
        UNION ALL
        SELECT 'VEN-003', 'Missing or invalid AP email', 'Low', 'Vendor', VendorCode, 'Email', Email, 'Open', FALSE
        FROM checked WHERE NOT email_ok
        UNION ALL
        SELECT 'VEN-004', 'Non-standard payment terms', CASE WHEN fixed IS NULL THEN 'Medium' ELSE 'Low' END,
               'Vendor', VendorCode, 'PaymentTerms', terms,
               CASE WHEN fixed IS NULL THEN 'Open' ELSE 'Auto-fixed -> ' || fixed END, fixed IS NULL
        FROM checked WHERE NOT known_terms""",
    "key_issues": """
        SELECT 'VEN-005' AS RuleID, 'Duplicate vendor (same Tax ID)' AS RuleDescription, 'High' AS Severity,
               'Vendor' AS Entity, VendorCode AS RecordKey, 'TaxID' AS FieldName, TaxID AS BadValue,
               'Merged into ' || SurvivorCode AS Status, FALSE AS IsBlocking
        FROM survivors WHERE VendorCode <> SurvivorCode""",
    "name_groups": """
        SELECT VendorCode, VendorName,
               FIRST_VALUE(VendorCode) OVER (PARTITION BY NormName ORDER BY CreatedDate, VendorCode) AS first_code
        FROM survivors WHERE VendorCode = SurvivorCode""",
    "name_issues": """
        SELECT 'VEN-006' AS RuleID, 'Possible duplicate (same name, different Tax ID)' AS RuleDescription,
               'Medium' AS Severity, 'Vendor' AS Entity, VendorCode AS RecordKey, 'VendorName' AS FieldName,
               VendorName || ' (matches ' || first_code || ')' AS BadValue, 'Open' AS Status, TRUE AS IsBlocking
        FROM name_groups WHERE VendorCode <> first_code""",
    "issues": """
        SELECT * FROM row_issues UNION ALL SELECT * FROM key_issues UNION ALL SELECT * FROM name_issues""",
    "golden": """
        SELECT VendorCode, VendorName, TaxID, Country, Currency, PaymentTerms, Email, Status, CreatedDate,
               SurvivorCode,
               'VEND-' || CASE WHEN n < 100000 THEN lpad(CAST(n AS VARCHAR), 5, '0') ELSE CAST(n AS VARCHAR) END
                 AS VendorAccount,
               CASE WHEN VendorCode IN (SELECT RecordKey FROM issues WHERE IsBlocking) THEN 'Exception'
                    ELSE 'Ready' END AS MigrationStatus
        FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY VendorCode) AS n
              FROM survivors WHERE VendorCode = SurvivorCode)""",
    "vendor_xref_v": """
        SELECT s.VendorCode AS LegacyVendorCode, s.SurvivorCode, g.VendorAccount,
               CASE WHEN s.VendorCode <> s.SurvivorCode THEN 'Merged by Tax ID' ELSE 'Self' END AS MatchType
        FROM survivors s JOIN golden g ON g.VendorCode = s.SurvivorCode""",
    "dim_vendor_v": """
        SELECT VendorAccount, VendorCode AS LegacyVendorCode, VendorName, TaxID, Country, Currency, PaymentTerms,
               Email, Status, MigrationStatus
        FROM golden
        UNION ALL
        SELECT 'UNKNOWN', NULL, '** Vendor not in master **', NULL, NULL, NULL, NULL, NULL, NULL, 'Exception'""",
    "dim_item_v": """
        SELECT ItemNumber, Description, ItemGroup, UoM, CAST(StandardCost AS DECIMAL(12,1)) AS StandardCost
        FROM stg_item
        UNION ALL
        SELECT 'UNKNOWN', '** Item not in master **', 'UNKNOWN', NULL, NULL""",
    "days": """
        SELECT CAST(d AS DATE) AS day
        FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE)::TIMESTAMP,
                                            CAST(max(o_orderdate) AS DATE)::TIMESTAMP, INTERVAL 1 DAY)) AS d
              FROM orders)""",
    "dim_date_v": """
        SELECT day AS "Date", CAST(year(day) AS INTEGER) AS "YEAR", CAST(quarter(day) AS INTEGER) AS QuarterNum,
               'Q' || quarter(day) AS "QUARTER", strftime(day, '%B') AS "MONTHNAME",
               strftime(day, '%Y-%m') AS YearMonth
        FROM days""",
    "po_keys": """
        SELECT *, PurchaseOrderNumber || '-' || LineNumber AS POLineKey,
               COALESCE((SELECT max(n.VendorAccount) FROM vendor_xref_v n WHERE n.LegacyVendorCode = o.VendorAccount),
                        'UNKNOWN') AS account,
               CASE WHEN ItemNumber IN (SELECT ItemNumber FROM stg_item) THEN ItemNumber ELSE 'UNKNOWN' END AS item
        FROM stg_po_line o""",
    "po_fact": """
        SELECT POLineKey, PurchaseOrderNumber, LineNumber, account AS VendorAccount, item AS ItemNumber,
               CAST(OrderDate AS DATE) AS OrderDate, Site, CAST(OrderedQuantity AS DECIMAL(12,2)) AS OrderedQty,
               UnitPrice, CAST(OrderedQuantity * UnitPrice AS DECIMAL(14,2)) AS POAmount
        FROM po_keys""",
    "receipt_fact": """
        SELECT ReceiptNumber, PurchaseOrderNumber || '-' || LineNumber AS POLineKey,
               CAST(ReceivedQuantity AS DECIMAL(12,2)) AS ReceivedQty, CAST(ReceiptDate AS DATE) AS ReceiptDate
        FROM stg_receipt""",
    "numbered": """
        SELECT ROW_NUMBER() OVER (ORDER BY InvoiceNumber, PurchaseOrderNumber, LineNumber, VendorAccount,
                                           InvoiceQuantity, InvoiceUnitPrice, InvoiceDate) AS InvoiceLineID, *
        FROM stg_invoice""",
    "invoice_fact": """
        SELECT ROW_NUMBER() OVER (ORDER BY InvoiceNumber, PurchaseOrderNumber, LineNumber, account,
                                           InvoiceQuantity, InvoiceUnitPrice, InvoiceDate) AS InvoiceLineID,
               InvoiceNumber, account AS VendorAccount, PurchaseOrderNumber || '-' || LineNumber AS POLineKey,
               CAST(InvoiceQuantity AS DECIMAL(12,2)) AS InvoiceQty, InvoiceUnitPrice,
               CAST(InvoiceQuantity * InvoiceUnitPrice AS DECIMAL(14,2)) AS InvoiceAmount,
               CAST(InvoiceDate AS DATE) AS InvoiceDate
        FROM (SELECT *, COALESCE((SELECT max(n.VendorAccount) FROM vendor_xref_v n
                                  WHERE n.LegacyVendorCode = b.VendorAccount), 'UNKNOWN') AS account
              FROM stg_invoice b)""",
    "received": """
        SELECT POLineKey, CAST(SUM(ReceivedQty) AS DECIMAL(24,2)) AS ReceivedQty
        FROM receipt_fact GROUP BY POLineKey""",
    "ranked": """
        SELECT *, COUNT(*) OVER copies AS DupRank
        FROM invoice_fact
        WINDOW copies AS (PARTITION BY POLineKey, InvoiceNumber, VendorAccount ORDER BY InvoiceLineID
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "running": """
        SELECT *, CAST(COALESCE(SUM(InvoiceQty) FILTER (DupRank = 1) OVER so_far, 0) AS DECIMAL(24,2))
                  AS CumInvoicedQty
        FROM ranked
        WINDOW so_far AS (PARTITION BY POLineKey ORDER BY InvoiceLineID
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "billed": """
        SELECT running.*, ItemNumber, OrderedQty, UnitPrice AS POUnitPrice, InvoiceUnitPrice - UnitPrice AS gap,
               CAST(COALESCE((SELECT max(ReceivedQty) FROM received WHERE received.POLineKey = running.POLineKey), 0)
                    AS DECIMAL(24,2)) AS got
        FROM running, po_fact
        WHERE running.POLineKey = po_fact.POLineKey""",
    "match_v": """
        SELECT InvoiceLineID, InvoiceNumber, VendorAccount, POLineKey, InvoiceDate, ItemNumber, OrderedQty,
               POUnitPrice, got AS ReceivedQty, InvoiceQty, InvoiceUnitPrice, InvoiceAmount,
               CAST(sign(gap) * ((20000 * CAST(100 * abs(gap) AS BIGINT) + CAST(100 * POUnitPrice AS BIGINT))
                                 // CAST(200 * POUnitPrice AS BIGINT)) / 10000 AS DECIMAL(9,4)) AS PriceVariancePct,
               CAST(gap * InvoiceQty AS DECIMAL(14,2)) AS PriceVarianceAmount,
               statuses[list_position(faults, TRUE)] AS MatchStatus
        FROM (SELECT *, ['Duplicate invoice', 'Unknown vendor', 'No receipt', 'Qty variance', 'Price variance',
                         'Matched'] AS statuses,
                     [DupRank <> 1, VendorAccount = 'UNKNOWN', got = 0, CumInvoicedQty > got,
                      100 * abs(gap) > 5 * POUnitPrice, TRUE] AS faults
              FROM billed)""",
    "unmatched": """
        SELECT * FROM invoice_fact WHERE POLineKey NOT IN (SELECT POLineKey FROM po_fact)""",
    "run_span": """
        SELECT least(DATE '2025-01-01', min(day)) AS first_day, greatest(DATE '2026-12-31', max(day)) AS last_day
        FROM (SELECT OrderDate AS day FROM po_fact UNION ALL SELECT ReceiptDate FROM receipt_fact
              UNION ALL SELECT CAST(InvoiceDate AS DATE) FROM stg_invoice)""",
    "staged_counts": """
        SELECT 'stg_vendor' AS table_name, COUNT(*) AS row_count FROM stg_vendor
        UNION ALL SELECT 'stg_item', COUNT(*) FROM stg_item
        UNION ALL SELECT 'stg_po_line', COUNT(*) FROM stg_po_line
        UNION ALL SELECT 'stg_receipt', COUNT(*) FROM stg_receipt
        UNION ALL SELECT 'stg_invoice', COUNT(*) FROM stg_invoice""",
}

_PO_COLUMNS = (
    "POLineKey",
    "PurchaseOrderNumber",
    "LineNumber",
    "VendorAccount",
    "ItemNumber",
    "OrderDate",
    "Site",
    "OrderedQty",
    "UnitPrice",
    "POAmount",
)
_PO_TYPES = (
    "string",
    "string",
    "bigint",
    "string",
    "string",
    "date",
    "string",
    "decimal(12,2)",
    "decimal(12,2)",
    "decimal(14,2)",
)

_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT({c}) AS row_count,
        ROUND(AVG(CAST({c} AS DOUBLE)), 4) AS mean, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 4) AS std,
        ROUND(MIN(CAST({c} AS DOUBLE)), 4) AS min,
        ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25), 4) AS p25,
        ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5), 4) AS p50,
        ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75), 4) AS p75,
        ROUND(MAX(CAST({c} AS DOUBLE)), 4) AS max FROM po_fact"""
    for c in ("LineNumber", "OrderedQty", "UnitPrice", "POAmount")
)

_SURVIVOR_COLUMNS = (
    "VendorCode, VendorName, TaxID, Country, Currency, PaymentTerms, Email, Status, CreatedDate, SurvivorCode"
)

# A share with one decimal, rounded half up from whole numbers.
_SHARE = "CAST((2000 * {n} + {t}) // (2 * {t}) AS DECIMAL(10,1)) / 10"

ORACLES = {
    "src_paged_json": """
        SELECT PurchaseOrderNumber, LineNumber, VendorAccount, ItemNumber, OrderedQuantity,
               CAST(UnitPrice AS DOUBLE) AS UnitPrice, OrderDate, Site FROM stg_po_line""",
    "src_page_stream": """
        SELECT PurchaseOrderNumber, LineNumber, VendorAccount, ItemNumber, OrderedQuantity,
               CAST(UnitPrice AS DOUBLE) AS UnitPrice, OrderDate, Site FROM stg_po_line""",
    "src_page_manifest": """
        SELECT 'PurchaseOrderLines' AS entity, 'PurchaseOrderLines_page' || page AS page,
               CASE WHEN page < MAX(page) OVER () THEN 'PurchaseOrderLines_page' || (page + 1) END AS next_page,
               COUNT(*) AS row_count
        FROM (SELECT (ROW_NUMBER() OVER (ORDER BY PurchaseOrderNumber, LineNumber) - 1) // 5000 + 1 AS page
              FROM stg_po_line)
        GROUP BY page""",
    "src_page_totals": """
        SELECT 'extract' AS stage, 'PurchaseOrderLines' AS table_name, COUNT(*) AS row_count,
               (COUNT(*) + 4999) // 5000 AS page_count
        FROM stg_po_line""",
    "src_page_faults": """
        SELECT t.fault, CAST(CASE t.fault WHEN 'missing pages' THEN pages >= 2
                                          WHEN 'pages without a link to them' THEN pages >= 3
                                          WHEN 'last pages other than one' THEN pages = 2 ELSE FALSE END AS BIGINT) AS n
        FROM (SELECT (COUNT(*) + 4999) // 5000 AS pages FROM stg_po_line),
             (VALUES ('missing pages'), ('repeated pages'), ('pages without a link to them'),
                     ('pages with too many links'), ('no first page'), ('pages without rows array'),
                     ('last pages other than one'), ('backward links'), ('links to no known page')) AS t(fault)""",
    "src_staged_views": "SELECT * FROM staged_counts",
    "src_catalog_table": "SELECT * FROM dim_item_v",
    "dq_no_issues": "SELECT * FROM issues WHERE FALSE",
    "src_csv_text": "SELECT * FROM stg_vendor",
    "src_stored_table": "SELECT * FROM po_fact",
    "src_date_rows": 'SELECT day AS "Date" FROM days',
    "src_run_log": """
        SELECT 'extract' AS stage, table_name, row_count, CAST(NULL AS BIGINT) AS page_count FROM staged_counts""",
    "snk_audited_load": "SELECT *, 'LegacyERP' AS _SourceSystem, TRUE AS stamped FROM stg_vendor",
    "snk_load_log": """
        SELECT 'load' AS stage, 'fact_receipt' AS table_name, COUNT(*) AS row_count,
               CAST(NULL AS BIGINT) AS page_count
        FROM receipt_fact
        UNION ALL SELECT 'load', 'dim_item', COUNT(*), NULL FROM dim_item_v""",
    "snk_published_set": """
        SELECT CAST(version AS BIGINT) AS version, table_name, COUNT(*) AS row_count
        FROM (SELECT version, 'stg_po_line' AS table_name
              FROM stg_po_line, (VALUES (1), (2)) AS v(version) WHERE version = 2 OR Site = 'SITE-F'
              UNION ALL
              SELECT version, 'stg_item' FROM stg_item, (VALUES (1), (2)) AS v(version)
              UNION ALL
              SELECT DISTINCT ON (version, PurchaseOrderNumber) version, 'order_totals'
              FROM stg_po_line, (VALUES (1), (2)) AS v(version) WHERE version = 2 OR Site = 'SITE-F')
        GROUP BY version, table_name""",
    "snk_full_reload": """
        SELECT * FROM staged_counts
        UNION ALL SELECT 'vendor_golden', COUNT(*) FROM golden
        UNION ALL SELECT 'vendor_xref', COUNT(*) FROM vendor_xref_v
        UNION ALL SELECT 'dq_issues', COUNT(*) FROM issues
        UNION ALL SELECT 'dim_vendor', COUNT(*) + 1 FROM golden
        UNION ALL SELECT 'dim_item', COUNT(*) + 1 FROM stg_item
        UNION ALL SELECT 'dim_date', date_diff('day', first_day, last_day) + 1 FROM run_span
        UNION ALL SELECT 'fact_po_line', COUNT(*) FROM stg_po_line
        UNION ALL SELECT 'fact_receipt', COUNT(*) FROM stg_receipt
        UNION ALL SELECT 'fact_invoice', COUNT(*) FROM stg_invoice
        UNION ALL SELECT 'fact_three_way_match', COUNT(*) FROM match_v
        UNION ALL SELECT 'unmatched_invoice', COUNT(*) FROM unmatched
        UNION ALL SELECT 'reconciliation', 4""",
    "snk_import_file": "SELECT VendorAccount AS VENDORACCOUNTNUMBER FROM golden WHERE MigrationStatus = 'Ready'",
    "snk_exceptions_file": """
        SELECT RuleID, RuleDescription, Severity, Entity, RecordKey, FieldName, BadValue, Status,
               'True' AS IsBlocking, TRUE AS DetectedAt
        FROM issues WHERE IsBlocking""",
    "prj_columns": "SELECT LineNumber, OrderedQty, POAmount AS Amount FROM po_fact",
    "flt_above": "SELECT * FROM po_fact WHERE POAmount > 10000",
    "flt_count_above": "SELECT COUNT(*) AS row_count FROM po_fact WHERE POAmount > 10000",
    "flt_large_orders": """
        SELECT LineNumber, OrderedQty, UnitPrice, POAmount FROM po_fact
        WHERE POAmount > 10000 AND OrderedQty >= 20""",
    "flt_in_list": "SELECT * FROM po_fact WHERE LineNumber IN (1, 2)",
    "flt_not_in_list": "SELECT * FROM po_fact WHERE LineNumber NOT IN (1, 2)",
    "flt_in_range": "SELECT * FROM po_fact WHERE UnitPrice BETWEEN 920 AND 950",
    "flt_equals": "SELECT * FROM vendor_xref_v WHERE MatchType = 'Merged by Tax ID'",
    "flt_non_blank": "SELECT VendorCode, TaxID FROM stg_vendor WHERE trim(TaxID) <> ''",
    "join_resolve_vendor": """
        SELECT PurchaseOrderNumber, LineNumber, VendorAccount, account AS ResolvedAccount FROM po_keys""",
    "join_resolve_item": """
        SELECT PurchaseOrderNumber, LineNumber, ItemNumber, item AS ResolvedItem FROM po_keys""",
    "join_staged_to_xref": """
        SELECT PurchaseOrderNumber, LineNumber, n.VendorAccount AS NewAccount, MatchType
        FROM vendor_xref_v n, stg_po_line o WHERE o.VendorAccount = n.LegacyVendorCode""",
    "join_receipt_totals": """
        SELECT PurchaseOrderNumber || '-' || LineNumber AS POLineKey, OrderedQuantity,
               CAST(COALESCE(ReceivedQty, 0) AS DECIMAL(24,2)) AS ReceivedQty
        FROM stg_po_line LEFT JOIN received ON POLineKey = PurchaseOrderNumber || '-' || LineNumber""",
    "join_blocked_codes": """
        SELECT VendorCode, SurvivorCode,
               VendorCode IN (SELECT RecordKey FROM row_issues WHERE IsBlocking) AS Blocked
        FROM survivors""",
    "join_terms_table": """
        SELECT VendorCode, PaymentTerms, fixed AS FixedTerms FROM checked WHERE NOT known_terms""",
    "agg_receipt_totals": "SELECT * FROM received",
    "agg_repeated_tax_ids": """
        SELECT TaxID, COUNT(*) AS vendors FROM stg_vendor WHERE trim(TaxID) <> '' GROUP BY TaxID
        HAVING COUNT(*) > 1""",
    "win_surrogate_key": "SELECT * FROM numbered",
    "win_append_numbers": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY InvoiceNumber, VendorAccount ORDER BY InvoiceLineID) AS CopyRank
        FROM (SELECT ROW_NUMBER() OVER (ORDER BY load, InvoiceNumber, PurchaseOrderNumber, LineNumber, VendorAccount,
                                                 InvoiceQuantity, InvoiceUnitPrice, InvoiceDate) AS InvoiceLineID,
                     * EXCLUDE (load)
              FROM (SELECT *, CASE WHEN right(InvoiceNumber, 1) < '3' THEN 1 WHEN right(InvoiceNumber, 1) < '5' THEN 2
                                   ELSE 3 END AS load
                    FROM stg_invoice))""",
    "win_duplicate_rank": "SELECT InvoiceLineID, VendorAccount, InvoiceNumber, POLineKey, DupRank FROM ranked",
    "win_running_quantity": "SELECT InvoiceLineID, POLineKey, InvoiceQty, CumInvoicedQty FROM running",
    "win_oldest_by_tax_id": "SELECT TaxID, Oldest FROM oldest",
    "win_oldest_by_name": """
        SELECT NormName, VendorCode AS Oldest FROM (
          SELECT NormName, VendorCode,
                 ROW_NUMBER() OVER (PARTITION BY NormName ORDER BY CreatedDate, VendorCode) AS nth
          FROM survivors) WHERE nth = 1""",
    "win_dense_numbers": """
        SELECT VendorCode, Number, 'VEND-' || CASE WHEN Number < 100000 THEN lpad(CAST(Number AS VARCHAR), 5, '0')
                                              ELSE CAST(Number AS VARCHAR) END AS Code
        FROM (SELECT VendorCode, ROW_NUMBER() OVER (ORDER BY VendorCode) AS Number FROM stg_vendor)""",
    "win_share_of_total": f"""
        SELECT Country, n AS row_count, CAST({_SHARE.format(n="n", t="t")} AS DECIMAL(5,1)) AS pct_of_rows
        FROM (SELECT Country, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS t
              FROM stg_vendor GROUP BY Country)""",
    "profile_shape": "SELECT COUNT(*) AS row_count, CAST(10 AS BIGINT) AS column_count FROM po_fact",
    "profile_columns": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({i} AS BIGINT) AS position, '{t}' AS data_type,"
        f" COUNT({c}) AS non_null_count FROM po_fact"
        for i, (c, t) in enumerate(zip(_PO_COLUMNS, _PO_TYPES))
    ),
    "profile_nulls": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM dim_vendor_v"
        for c in (
            "VendorAccount",
            "LegacyVendorCode",
            "VendorName",
            "TaxID",
            "Country",
            "Currency",
            "PaymentTerms",
            "Email",
            "Status",
            "MigrationStatus",
        )
    ),
    "profile_distinct": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_count FROM po_fact" for c in _PO_COLUMNS
    ),
    "profile_numeric": _DESCRIBE,
    "profile_sketch_distinct": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count,"
        f" COUNT(DISTINCT {c}) AS distinct_count, TRUE AS within_bound FROM po_fact"
        for c in _PO_COLUMNS
    ),
    "profile_sketch_quantiles": """
        SELECT column_name, TRUE AS p25, TRUE AS p50, TRUE AS p75
        FROM (VALUES ('LineNumber'), ('OrderedQty'), ('UnitPrice'), ('POAmount')) AS t(column_name)
        WHERE EXISTS (SELECT * FROM po_fact)""",
    "profile_key_overlap": """
        SELECT 'first_values' AS measure, COUNT(DISTINCT POLineKey) AS n, TRUE AS within_bound FROM po_fact
        UNION ALL SELECT 'second_values', COUNT(DISTINCT POLineKey), TRUE FROM receipt_fact
        UNION ALL SELECT 'shared', COUNT(DISTINCT POLineKey), TRUE FROM po_fact
                  WHERE POLineKey IN (SELECT POLineKey FROM receipt_fact)""",
    "ord_head": "SELECT * FROM po_fact ORDER BY POLineKey LIMIT 5",
    "ord_top_lines": "SELECT * FROM po_fact ORDER BY POAmount DESC, POLineKey LIMIT 5",
    "sca_strip": "SELECT VendorCode, trim(PaymentTerms) AS Terms, trim(Email) AS Email FROM stg_vendor",
    "sca_normalize_name": "SELECT VendorCode, NormName FROM survivors",
    "sca_email_test": "SELECT VendorCode, email_ok AS IsEmail FROM checked",
    "sca_fixed_terms": "SELECT VendorCode, COALESCE(fixed, PaymentTerms) AS PaymentTerms FROM checked",
    "sca_line_key": """
        SELECT PurchaseOrderNumber, LineNumber,
               concat(PurchaseOrderNumber, '-', CASE WHEN Site = 'SITE-F' THEN LineNumber END) AS LineKey
        FROM stg_po_line""",
    "sca_decimal_casts": """
        SELECT PurchaseOrderNumber, LineNumber, CAST(UnitPrice AS DECIMAL(12,1)) AS Cost,
               CAST(OrderedQuantity * UnitPrice AS DECIMAL(14,2)) AS Amount, CAST(OrderDate AS DATE) AS OrderDay,
               strftime(CAST(OrderDate AS DATE), '%Y-%m') AS OrderMonth
        FROM stg_po_line""",
    "sca_exact_amount": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CAST(CAST(l_quantity AS BIGINT) * 100000 * (CAST(l_tax AS DECIMAL(4,2)) * 0.0000001)
                    AS DECIMAL(14,2)) AS Amount
        FROM lineitem""",
    "dq_row_rules": "SELECT * FROM row_issues",
    "dq_duplicate_tax_id": "SELECT * FROM key_issues",
    "dq_duplicate_name": "SELECT * FROM name_issues",
    "dq_issues": "SELECT * FROM issues",
    "dq_validated_vendors": f"SELECT {_SURVIVOR_COLUMNS} FROM survivors",
    "vendor_golden": "SELECT * FROM golden",
    "vendor_xref": "SELECT * FROM vendor_xref_v",
    "migration_status": "SELECT VendorAccount, VendorCode, MigrationStatus FROM golden",
    "dim_vendor": "SELECT * FROM dim_vendor_v",
    "dim_item": "SELECT * FROM dim_item_v",
    "dim_date": "SELECT * FROM dim_date_v",
    "fact_po_line": "SELECT * FROM po_fact",
    "fact_receipt": "SELECT * FROM receipt_fact",
    "fact_invoice": "SELECT * FROM invoice_fact",
    "three_way_match": "SELECT * FROM match_v",
    "match_together": "SELECT * FROM match_v",
    "match_incremental": "SELECT * EXCLUDE (InvoiceLineID) FROM match_v",
    "match_summary": f"""
        SELECT MatchStatus, InvoiceLines, Amount,
               CAST({_SHARE.format(n="InvoiceLines", t="total")} AS DECIMAL(5,1)) AS PctOfLines
        FROM (SELECT MatchStatus, COUNT(*) AS InvoiceLines, CAST(SUM(InvoiceAmount) AS DECIMAL(24,2)) AS Amount,
                     CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total
              FROM match_v GROUP BY MatchStatus)""",
    "rec_content_diff": """
        SELECT PurchaseOrderNumber, LineNumber, status, CAST(one AS BIGINT) AS rows_first, CAST(two AS BIGINT) AS rows_second
        FROM (SELECT PurchaseOrderNumber, LineNumber, 'only in first' AS status, 1 AS one, 0 AS two
              FROM stg_po_line WHERE CAST(substr(PurchaseOrderNumber, 4) AS BIGINT) % 997 = 1
              UNION ALL
              SELECT PurchaseOrderNumber, LineNumber, 'changed', 1, 1 FROM stg_po_line
              WHERE CAST(substr(PurchaseOrderNumber, 4) AS BIGINT) % 991 = 2
                AND CAST(substr(PurchaseOrderNumber, 4) AS BIGINT) % 997 <> 1
              UNION ALL
              SELECT 'NEW-' || substr(PurchaseOrderNumber, 4), LineNumber, 'only in second', 0, 1 FROM stg_po_line
              WHERE CAST(substr(PurchaseOrderNumber, 4) AS BIGINT) % 983 = 3)""",
    "rec_row_counts": """
        SELECT table_name, row_count AS "Rows" FROM staged_counts WHERE table_name <> 'stg_item'
        UNION ALL SELECT 'vendor_xref', COUNT(*) FROM vendor_xref_v""",
    "rec_fact_counts": """
        SELECT table_name, n AS "Rows", want AS Expected, n = want AS Agrees
        FROM (SELECT 'fact_po_line' AS table_name, (SELECT COUNT(*) FROM po_fact) AS n,
                     (SELECT COUNT(*) FROM stg_po_line) AS want
              UNION ALL SELECT 'fact_receipt', (SELECT COUNT(*) FROM receipt_fact), (SELECT COUNT(*) FROM stg_receipt)
              UNION ALL SELECT 'fact_invoice', (SELECT COUNT(*) FROM invoice_fact), (SELECT COUNT(*) FROM stg_invoice)
              UNION ALL SELECT 'fact_three_way_match', (SELECT COUNT(*) FROM match_v),
                     (SELECT COUNT(*) FROM stg_invoice))""",
    "rec_orphan_vendors": """
        SELECT PurchaseOrderNumber, LineNumber, VendorAccount FROM stg_po_line
        WHERE VendorAccount NOT IN (SELECT LegacyVendorCode FROM vendor_xref_v)""",
    "rec_orphan_items": """
        SELECT PurchaseOrderNumber, LineNumber, ItemNumber FROM stg_po_line
        WHERE ItemNumber NOT IN (SELECT ItemNumber FROM stg_item)""",
    "rec_merged_code_lines": """
        SELECT n.LegacyVendorCode, n.VendorAccount, lines AS count_lines
        FROM vendor_xref_v n, (SELECT VendorAccount, COUNT(*) AS lines FROM stg_po_line GROUP BY VendorAccount) o
        WHERE o.VendorAccount = n.LegacyVendorCode AND n.LegacyVendorCode <> n.SurvivorCode""",
    "rec_unknown_vendor_lines": """
        SELECT 'UNKNOWN' AS VendorAccount, COUNT(*) AS line_count FROM stg_po_line
        WHERE VendorAccount NOT IN (SELECT LegacyVendorCode FROM vendor_xref_v) HAVING COUNT(*) > 0""",
    "rec_unknown_item_lines": """
        SELECT 'UNKNOWN' AS ItemNumber, COUNT(*) AS line_count FROM stg_po_line
        WHERE ItemNumber NOT IN (SELECT ItemNumber FROM stg_item) HAVING COUNT(*) > 0""",
    "rec_unmatched_invoices": "SELECT * FROM unmatched",
    "rec_run": """
        SELECT table_name, n AS "Rows", want AS Expected, n = want AS Agrees
        FROM (SELECT 'fact_po_line' AS table_name, (SELECT COUNT(*) FROM po_fact) AS n,
                     (SELECT COUNT(*) FROM stg_po_line) AS want
              UNION ALL SELECT 'fact_receipt', (SELECT COUNT(*) FROM receipt_fact), (SELECT COUNT(*) FROM stg_receipt)
              UNION ALL SELECT 'fact_invoice', (SELECT COUNT(*) FROM invoice_fact), (SELECT COUNT(*) FROM stg_invoice)
              UNION ALL SELECT 'fact_three_way_match', (SELECT COUNT(*) FROM match_v),
                     (SELECT COUNT(*) FROM stg_invoice))""",
    "kpi_readiness": """
        SELECT COUNT(*) AS vendors, COUNT(*) FILTER (MigrationStatus = 'Ready') AS ready,
               COUNT(*) FILTER (MigrationStatus <> 'Ready') AS exceptions,
               CAST(COUNT(*) FILTER (MigrationStatus = 'Ready') / COUNT(*) AS DECIMAL(9,4)) AS ready_share
        FROM golden""",
    "kpi_issues_by_rule": "SELECT RuleID, Severity, COUNT(*) AS issue_count FROM issues GROUP BY RuleID, Severity",
    "kpi_rescued_lines": """
        SELECT COUNT(*) AS po_lines, COUNT(*) FILTER (merged) AS rescued_lines,
               CAST(COUNT(*) FILTER (merged) / COUNT(*) AS DECIMAL(9,4)) AS rescued_share
        FROM (SELECT VendorAccount IN (SELECT LegacyVendorCode FROM vendor_xref_v
                                       WHERE LegacyVendorCode <> SurvivorCode) AS merged
              FROM stg_po_line)""",
    "kpi_match_rate": """
        SELECT COUNT(*) AS invoice_lines, COUNT(*) FILTER (MatchStatus = 'Matched') AS matched_lines,
               CAST(COUNT(*) FILTER (MatchStatus = 'Matched') / COUNT(*) AS DECIMAL(9,4)) AS match_rate
        FROM match_v""",
    "kpi_amount_on_hold": """
        SELECT COUNT(*) AS lines_on_hold, CAST(COALESCE(SUM(InvoiceAmount), 0) AS DECIMAL(24,2)) AS amount_on_hold
        FROM match_v WHERE MatchStatus <> 'Matched'""",
    "kpi_hold_list": """
        SELECT InvoiceLineID, VendorAccount, InvoiceAmount, MatchStatus FROM match_v
        WHERE MatchStatus <> 'Matched'""",
    "kpi_exposure": """
        SELECT MatchStatus, COUNT(*) AS invoice_lines,
               CAST(SUM(CASE WHEN MatchStatus = 'Price variance' THEN PriceVarianceAmount ELSE InvoiceAmount END)
                    AS DECIMAL(24,2)) AS exposure
        FROM match_v WHERE MatchStatus IN ('Price variance', 'Duplicate invoice') GROUP BY MatchStatus""",
    "kpi_secondary_price_issues": """
        SELECT InvoiceLineID, MatchStatus, PriceVariancePct FROM match_v
        WHERE 100 * abs(InvoiceUnitPrice - POUnitPrice) > 5 * POUnitPrice AND MatchStatus <> 'Price variance'""",
    "kpi_monthly_spend": """
        SELECT YearMonth, CAST(SUM(POAmount) AS DECIMAL(24,2)) AS spend
        FROM po_fact JOIN dim_date_v ON "Date" = OrderDate GROUP BY YearMonth""",
    "kpi_spend_on_days": """
        SELECT strftime(OrderDate, '%Y-%m') AS YearMonth, CAST(SUM(POAmount) AS DECIMAL(24,2)) AS spend
        FROM po_fact WHERE year(OrderDate) IN (1994, 1996) AND isodow(OrderDate) = 1 GROUP BY 1""",
    "kpi_monthly_spend_of_run": """
        SELECT strftime(OrderDate, '%Y-%m') AS YearMonth, CAST(SUM(POAmount) AS DECIMAL(24,2)) AS spend
        FROM po_fact GROUP BY YearMonth""",
    "kpi_top_vendors": """
        SELECT s.VendorAccount, s.spend, d.VendorName, d.MigrationStatus
        FROM (SELECT VendorAccount, CAST(SUM(POAmount) AS DECIMAL(24,2)) AS spend FROM po_fact
              GROUP BY VendorAccount ORDER BY spend DESC, VendorAccount LIMIT 10) s
        LEFT JOIN dim_vendor_v d ON d.VendorAccount = s.VendorAccount""",
    "kpi_spend_by_item_group": """
        SELECT ItemGroup, CAST(SUM(POAmount) AS DECIMAL(24,2)) AS spend
        FROM po_fact p JOIN dim_item_v i ON i.ItemNumber = p.ItemNumber GROUP BY ItemGroup""",
    "kpi_spend_by_site": """
        SELECT Site, CAST(SUM(POAmount) AS DECIMAL(24,2)) AS spend FROM po_fact GROUP BY Site""",
    "kpi_blocked_vendor_spend": """
        SELECT p.VendorAccount, CAST(SUM(POAmount) AS DECIMAL(24,2)) AS spend, d.VendorName
        FROM po_fact p JOIN dim_vendor_v d ON d.VendorAccount = p.VendorAccount
        WHERE d.MigrationStatus = 'Exception' AND d.VendorAccount <> 'UNKNOWN'
        GROUP BY p.VendorAccount, d.VendorName""",
}


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in VIEWS:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(VIEWS[name], found)
            found.append(name)
    return found


def full_sql(name: str) -> str:
    select = ORACLES[name]
    # Written out once each: it also keeps DuckDB's join over dictionary-coded columns away from their plans, which
    # fails with an internal error every now and then.
    views = ",\n".join(f"{v} AS MATERIALIZED ({VIEWS[v]})" for v in _needed(select, []))
    return f"WITH {views}\n{select}" if views else select


def oracle_sql() -> dict[str, str]:
    return {name: full_sql(name) for name in ORACLES}
