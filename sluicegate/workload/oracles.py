"""The registered queries in plain SQL, written by hand and run by another engine."""

from __future__ import annotations

# Raw product records with their trace columns.
_BRONZE = """
bronze AS (
  SELECT
    l_orderkey, l_linenumber, l_partkey,
    CASE WHEN k % 53 = 0 AND l_linenumber <= 3 THEN NULL
         ELSE CAST(l_partkey AS VARCHAR) END AS _id,
    CASE WHEN k % 53 = 0 THEN NULL
         WHEN k % 59 = 0 THEN '  '
         WHEN k % 61 = 0 THEN ''
         ELSE CAST(l_partkey AS VARCHAR) END AS code,
    CASE WHEN (l_orderkey + l_linenumber) % 47 = 0 THEN NULL
         ELSE '  ' || p_name || ' ' END AS product_name,
    CASE WHEN l_partkey % 11 = 0 THEN NULL
         WHEN l_partkey % 17 = 0 THEN '   '
         WHEN l_partkey % 13 = 0 THEN ' ' || lower(p_brand) || ' '
         ELSE p_brand END AS brands,
    p_type AS categories,
    'Nation ' || CAST(l_suppkey % 25 AS VARCHAR) AS countries,
    CASE WHEN l_linenumber >= 5 THEN NULL ELSE 'cocoa, sugar' END AS ingredients_text,
    '' AS allergens,
    CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE upper(substr(p_type, 1, 1)) END
      AS nutrition_grades,
    CASE WHEN k % 43 = 0 THEN NULL ELSE CAST(epoch(l_shipdate) AS BIGINT) END
      AS last_modified_t,
    CASE WHEN nn THEN NULL ELSE l_extendedprice / 100 END AS raw_energy,
    CASE WHEN nn THEN NULL ELSE l_quantity END AS raw_fat,
    CASE WHEN nn OR l_quantity > 40 THEN NULL ELSE l_discount * 100 END AS raw_proteins,
    CASE WHEN nn THEN NULL ELSE l_tax * 100 - CAST(0.01 AS DOUBLE) END AS raw_salt,
    CASE WHEN nn THEN NULL ELSE l_quantity * CAST(2.2 AS DOUBLE) END AS raw_sugars
  FROM (
    SELECT *, l_orderkey * 7 + l_linenumber AS k,
           (l_linenumber = 7 AND l_partkey % 3 = 0) AS nn
    FROM lineitem
  ) AS items JOIN part ON l_partkey = p_partkey
)"""

# Standardized, scored and checked rows.
_CHECKED = (
    _BRONZE
    + """,
flat AS (
  SELECT
    l_orderkey, l_linenumber, l_partkey,
    coalesce(code, _id) AS barcode,
    trim(product_name) AS product_name,
    trim(brands) AS brand,
    trim(categories) AS categories,
    trim(countries) AS countries,
    trim(ingredients_text) AS ingredients_text,
    trim(allergens) AS allergens,
    lower(trim(nutrition_grades)) AS nutrition_grade,
    last_modified_t AS source_last_modified_timestamp,
    raw_energy AS energy_kcal_100g,
    raw_fat AS fat_100g,
    raw_proteins AS proteins_100g,
    raw_salt AS salt_100g,
    raw_sugars AS sugars_100g
  FROM bronze
),
scored AS (
  SELECT *,
    round((
      CASE WHEN trim(barcode) <> '' THEN 1 ELSE 0 END
      + CASE WHEN trim(product_name) <> '' THEN 1 ELSE 0 END
      + CASE WHEN trim(brand) <> '' THEN 1 ELSE 0 END
      + CASE WHEN trim(categories) <> '' THEN 1 ELSE 0 END
      + CASE WHEN trim(countries) <> '' THEN 1 ELSE 0 END
      + CASE WHEN trim(ingredients_text) <> '' THEN 1 ELSE 0 END
      + CASE WHEN trim(nutrition_grade) <> '' THEN 1 ELSE 0 END
      + CASE WHEN energy_kcal_100g IS NOT NULL THEN 1 ELSE 0 END
      + CASE WHEN fat_100g IS NOT NULL THEN 1 ELSE 0 END
      + CASE WHEN proteins_100g IS NOT NULL THEN 1 ELSE 0 END
      + CASE WHEN salt_100g IS NOT NULL THEN 1 ELSE 0 END
      + CASE WHEN sugars_100g IS NOT NULL THEN 1 ELSE 0 END
    ) / 12.0, 4) AS completeness_score,
    barcode IS NULL OR trim(barcode) = '' AS missing_barcode,
    product_name IS NULL OR trim(product_name) = '' AS missing_product_name,
    coalesce(sugars_100g < 0 OR sugars_100g > 100, false) AS invalid_sugars_100g,
    coalesce(fat_100g < 0 OR fat_100g > 100, false) AS invalid_fat_100g,
    coalesce(proteins_100g < 0 OR proteins_100g > 100, false) AS invalid_proteins_100g,
    coalesce(salt_100g < 0 OR salt_100g > 100, false) AS invalid_salt_100g,
    coalesce(energy_kcal_100g < 0 OR energy_kcal_100g > 1000, false)
      AS invalid_energy_kcal_100g
  FROM flat
),
checked AS (
  SELECT *, concat_ws('; ',
    CASE WHEN missing_barcode THEN 'missing_barcode' END,
    CASE WHEN missing_product_name THEN 'missing_product_name' END,
    CASE WHEN invalid_sugars_100g THEN 'invalid_sugars_100g' END,
    CASE WHEN invalid_fat_100g THEN 'invalid_fat_100g' END,
    CASE WHEN invalid_proteins_100g THEN 'invalid_proteins_100g' END,
    CASE WHEN invalid_salt_100g THEN 'invalid_salt_100g' END,
    CASE WHEN invalid_energy_kcal_100g THEN 'invalid_energy_kcal_100g' END
  ) AS rejection_reason
  FROM scored
)"""
)

# Silver: the latest valid row of each key.
def _latest(name: str, condition: str = "true") -> str:
    return f"""
{name} AS (
  SELECT * FROM checked WHERE rejection_reason = '' AND {condition}
  QUALIFY row_number() OVER (
    PARTITION BY barcode
    ORDER BY source_last_modified_timestamp DESC NULLS LAST,
      product_name ASC NULLS FIRST, brand ASC NULLS FIRST, categories ASC NULLS FIRST,
      countries ASC NULLS FIRST, ingredients_text ASC NULLS FIRST,
      nutrition_grade ASC NULLS FIRST, energy_kcal_100g ASC NULLS FIRST,
      fat_100g ASC NULLS FIRST, proteins_100g ASC NULLS FIRST, salt_100g ASC NULLS FIRST,
      sugars_100g ASC NULLS FIRST
  ) = 1
)"""


_SILVER = f"{_CHECKED},{_latest('silver')}"

_TRACE = "l_orderkey, l_linenumber, l_partkey"

_RAW_COLUMNS = """
  _id, code, product_name, brands, categories, countries, ingredients_text, allergens,
  nutrition_grades, last_modified_t, raw_energy AS energy_kcal_100g, raw_fat AS fat_100g,
  raw_proteins AS proteins_100g, raw_salt AS salt_100g, raw_sugars AS sugars_100g"""

_CLOCK = "CAST(epoch(TIMESTAMP '2024-03-01 12:00:00') AS BIGINT)"

_SILVER_COLUMNS = f"""
  barcode, product_name, brand, categories, countries, ingredients_text, allergens,
  nutrition_grade, source_last_modified_timestamp, energy_kcal_100g, fat_100g,
  proteins_100g, salt_100g, sugars_100g, completeness_score,
  CAST(epoch(make_timestamp(source_last_modified_timestamp * 1000000)) AS BIGINT)
    AS source_last_modified_epoch,
  'run-a' AS pipeline_run_id, {_CLOCK} AS processed_epoch"""


def _mean(column: str, digits: int) -> str:
    """Exact average of values with six decimals, rounded half up once, in whole numbers."""
    total = f"sum(CAST(CAST({column} AS DECIMAL(20,6)) * 1000000 AS HUGEINT))"
    many = f"(count({column}) * {10 ** (6 - digits)})"
    steps = f"sign({total}) * ((2 * abs({total}) + {many}) // (2 * {many}))"
    return f"CAST({steps} AS DOUBLE) / {10**digits} AS average_{column}"


_BRAND_LABEL = "CASE WHEN brand IS NULL OR trim(brand) = '' THEN 'Unknown' ELSE brand END"
_CANONICAL_LABEL = """CASE WHEN brand IS NULL OR trim(brand) = '' THEN 'Unknown'
  ELSE array_to_string(list_transform(string_split(trim(brand), ' '),
         lambda w: upper(w[1]) || lower(w[2:])), ' ') END"""
_GRADE_LABEL = """CASE WHEN nutrition_grade IS NULL OR trim(nutrition_grade) = ''
  THEN 'unknown' ELSE lower(nutrition_grade) END"""

_GOLD = (
    _SILVER
    + f""",
brand_gold AS (
  SELECT {_BRAND_LABEL} AS brand, count(DISTINCT barcode) AS product_count,
    {_mean("completeness_score", 4)}, {_mean("sugars_100g", 2)}, {_mean("fat_100g", 2)},
    {_mean("energy_kcal_100g", 2)}
  FROM silver GROUP BY 1
),
canonical_gold AS (
  SELECT label AS brand, count(*) AS product_count,
    {_mean("energy_kcal_100g", 2)}, {_mean("proteins_100g", 2)}, {_mean("fat_100g", 2)},
    {_mean("sugars_100g", 2)}, {_mean("completeness_score", 4)}
  FROM (SELECT *, {_CANONICAL_LABEL} AS label FROM silver) AS labelled GROUP BY label
),
grade_gold AS (
  SELECT {_GRADE_LABEL} AS nutrition_grade, count(DISTINCT barcode) AS product_count,
    {_mean("sugars_100g", 2)}, {_mean("fat_100g", 2)}, {_mean("salt_100g", 3)},
    {_mean("energy_kcal_100g", 2)}, {_mean("completeness_score", 4)}
  FROM silver GROUP BY 1
),
counts AS (
  SELECT count(*) AS source_record_count,
    (SELECT count(*) FROM silver) AS valid_record_count,
    count(*) FILTER (rejection_reason <> '') AS quarantined_record_count,
    count(*) FILTER (rejection_reason = '') - (SELECT count(*) FROM silver)
      AS duplicate_record_count
  FROM checked
),
rates AS (
  SELECT *,
    CASE WHEN source_record_count > 0
      THEN round(valid_record_count / source_record_count, 4) ELSE 0.0 END
      AS acceptance_rate,
    CASE WHEN source_record_count > 0
      THEN round(quarantined_record_count / source_record_count, 4) ELSE 0.0 END
      AS quarantine_rate
  FROM counts
),
quality_gold AS (
  SELECT rates.*, q.* FROM rates, (
    SELECT {_mean("completeness_score", 4)},
      min(completeness_score) AS minimum_completeness_score,
      max(completeness_score) AS maximum_completeness_score,
      CAST(sum(CASE WHEN completeness_score < 0.5 THEN 1 ELSE 0 END) AS BIGINT)
        AS low_completeness_count
    FROM silver
  ) AS q
),
breakdown AS (
  SELECT rejection_reason, count(*) AS record_count
  FROM checked WHERE rejection_reason <> '' GROUP BY rejection_reason
)"""
)


def _from(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _flat(columns: str) -> str:
    return _from(_CHECKED, f"SELECT {_TRACE}, {columns} FROM checked")


_RAW = _from(_BRONZE, f"SELECT {_RAW_COLUMNS} FROM bronze")
_SILVER_ROWS = _from(_SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver")


def oracle_sql() -> dict[str, str]:
    return {
        "json_scan": _RAW,
        "json_props": """
            SELECT event_type, count(k) AS k_count, CAST(sum(k) AS BIGINT) AS k_sum
            FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
                  FROM events) AS parsed
            GROUP BY event_type""",
        "page_flatten": _RAW,
        "page_landing": _from(
            _BRONZE, f"SELECT {_RAW_COLUMNS}, 'x' || l_orderkey AS extra FROM bronze"
        ),
        "json_documents": _DOCUMENTS,
        "bronze_landing": _from(
            _BRONZE,
            f"SELECT {_RAW_COLUMNS}, '2024-03-01' AS ingestion_date, 'run-a' AS run_id "
            "FROM bronze",
        ),
        "run_metadata": _from(
            _BRONZE,
            """SELECT 'run-a' AS run_id, 'line items' AS source, 'all' AS category,
              100 AS page_size, count(DISTINCT l_orderkey // 25) AS page_count,
              CAST(0 AS BIGINT) AS empty_envelope_count, count(*) AS record_count,
              CAST(61.26 AS DOUBLE) AS duration_seconds, 'pages' AS product_path
            FROM bronze""",
        ),
        "silver_roundtrip": _SILVER_ROWS,
        "quarantine_roundtrip": _from(
            _CHECKED,
            f"SELECT {_SILVER_COLUMNS}, rejection_reason FROM checked "
            "WHERE rejection_reason <> ''",
        ),
        "gold_roundtrip": _from(
            _GOLD,
            "SELECT *, '2024-03-01' AS processing_date, 'run-a' AS run_id FROM brand_gold",
        ),
        "partition_pruned_scan": _from(
            _SILVER,
            f"SELECT {_SILVER_COLUMNS}, '2024-03-01' AS processing_date, 'run-a' AS run_id "
            "FROM silver",
        ),
        "catalog_evolution": _from(
            _SILVER,
            f"""SELECT * REPLACE (NULL AS salt_100g, NULL AS allergens),
              '2024-03-01' AS processing_date, 'run-a' AS run_id
            FROM (SELECT {_SILVER_COLUMNS} FROM silver)
            UNION ALL BY NAME
            SELECT {_SILVER_COLUMNS}, '2024-03-02' AS processing_date, 'run-b' AS run_id
            FROM silver""",
        ),
        "sql_top_brands": _from(
            _GOLD,
            """SELECT brand, product_count, average_sugars_100g, average_energy_kcal_100g
            FROM brand_gold ORDER BY product_count DESC, brand LIMIT 20""",
        ),
        "resolve_key": _flat("barcode"),
        "trim_fields": _flat(
            "product_name, brand, categories, countries, ingredients_text, allergens"
        ),
        "normalize_grade": _flat("nutrition_grade"),
        "nested_extract": _flat(
            "energy_kcal_100g, fat_100g, proteins_100g, salt_100g, sugars_100g"
        ),
        "cast_fields": _from(
            _BRONZE,
            f"""SELECT {_TRACE}, TRY_CAST(code AS BIGINT) AS code_number,
              TRY_CAST(code AS DOUBLE) AS code_double,
              last_modified_t AS source_last_modified_timestamp,
              raw_energy AS energy_kcal_100g
            FROM bronze""",
        ),
        "epoch_to_timestamp": _from(
            _BRONZE,
            f"""SELECT {_TRACE},
              CAST(epoch(make_timestamp(last_modified_t * 1000000)) AS BIGINT)
                AS source_last_modified_epoch
            FROM bronze""",
        ),
        "lineage_columns": _flat(
            "barcode, 'run-a' AS pipeline_run_id, "
            "CAST(epoch(TIMESTAMP '2024-03-01 12:00:00') AS BIGINT) AS processed_epoch"
        ),
        "brand_default": _flat(f"{_BRAND_LABEL} AS brand_group"),
        "grade_default": _flat(f"{_GRADE_LABEL} AS grade_group"),
        "brand_initcap": _flat(f"{_CANONICAL_LABEL} AS brand_clean"),
        "completeness_score": _flat("completeness_score"),
        "rule_missing_key": _flat("missing_barcode"),
        "rule_missing_name": _flat("missing_product_name"),
        "rule_range": _flat(
            "invalid_sugars_100g, invalid_fat_100g, invalid_proteins_100g, invalid_salt_100g"
        ),
        "rule_range_accounts": """
            SELECT *, 'invalid_c_acctbal' AS rejection_reason
            FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000""",
        "rule_energy_range": _flat("invalid_energy_kcal_100g"),
        "rejection_reason": _flat("rejection_reason"),
        "route_quarantine": _flat(
            "barcode, product_name, completeness_score, rejection_reason"
        )
        + " WHERE rejection_reason <> ''",
        "route_accepted": _flat("barcode, product_name, completeness_score")
        + " WHERE rejection_reason = ''",
        "dedup_latest": _SILVER_ROWS,
        "dedup_latest_events": """
            SELECT event_id, user_id, event_type, value, props,
              CAST(floor(epoch(ts)) AS BIGINT) AS ts_epoch
            FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1""",
        "brand_summary": _from(
            _GOLD, "SELECT * FROM brand_gold ORDER BY product_count DESC, brand"
        ),
        "brand_summary_canonical": _from(_GOLD, "SELECT * FROM canonical_gold"),
        "grade_summary": _from(_GOLD, "SELECT * FROM grade_gold ORDER BY nutrition_grade"),
        "brand_summary_runs": _from(
            _RUNS,
            f"""SELECT {_BRAND_LABEL} AS brand, count(DISTINCT barcode) AS product_count,
              {_mean("completeness_score", 4)}, {_mean("sugars_100g", 2)},
              {_mean("fat_100g", 2)}, {_mean("energy_kcal_100g", 2)}
            FROM runs GROUP BY 1""",
        ),
        "grade_summary_runs": _from(
            _RUNS,
            f"""SELECT {_GRADE_LABEL} AS nutrition_grade,
              count(DISTINCT barcode) AS product_count,
              {_mean("sugars_100g", 2)}, {_mean("fat_100g", 2)}, {_mean("salt_100g", 3)},
              {_mean("energy_kcal_100g", 2)}, {_mean("completeness_score", 4)}
            FROM runs GROUP BY 1""",
        ),
        "run_quality": _from(_GOLD, "SELECT * FROM quality_gold"),
        "route_rates": _from(_GOLD, "SELECT acceptance_rate, quarantine_rate FROM rates"),
        "quarantine_breakdown": _from(_GOLD, "SELECT * FROM breakdown"),
        "stage_counts": _from(_GOLD, "SELECT * FROM counts"),
        "top_brands": _from(
            _GOLD, "SELECT * FROM canonical_gold ORDER BY product_count DESC, brand LIMIT 20"
        ),
        "bronze_to_silver": _from(
            _SILVER,
            f"""SELECT {_SILVER_COLUMNS}, NULL AS rejection_reason, 'silver' AS side
            FROM silver
            UNION ALL
            SELECT {_SILVER_COLUMNS}, rejection_reason, 'quarantine' AS side
            FROM checked WHERE rejection_reason <> ''""",
        ),
        "silver_to_gold": _from(
            _GOLD,
            f"""SELECT *, 'run-a' AS run_id, {_CLOCK} AS generated_epoch FROM (
              SELECT *, 'brand_summary' AS gold_table FROM brand_gold
              UNION ALL BY NAME
              SELECT *, 'brand_summary_canonical' AS gold_table FROM canonical_gold
              UNION ALL BY NAME
              SELECT *, 'nutrition_grade_summary' AS gold_table FROM grade_gold
              UNION ALL BY NAME
              SELECT *, 'pipeline_quality_summary' AS gold_table FROM quality_gold
            )""",
        ),
        "run_report": _REPORT,
        "pages_to_report": _REPORT,
    }


_RUNS = f"""{_CHECKED},{_latest("first_run", "l_orderkey % 3 <> 0")},
{_latest("second_run", "l_orderkey % 3 <> 1")},
runs AS (SELECT * FROM first_run UNION ALL SELECT * FROM second_run)"""

# Lists of records, most of them with a fault that their line number decides.
_DOCUMENTS = """
WITH elements AS (
  SELECT l_orderkey // 100 AS document, l_linenumber AS line,
    CAST(l_partkey AS VARCHAR) AS part, CAST(l_quantity AS BIGINT) AS quantity
  FROM lineitem
), written AS (
  SELECT *, '{' || CASE line
      WHEN 1 THEN '"code":' || part || ',"nutriments":{"fat_100g":' || quantity || '}'
      WHEN 2 THEN '"code":"' || part || '","nutriments":[]'
      WHEN 3 THEN '"code":"' || part || '","last_modified_t":1.5'
      WHEN 4 THEN '"code":"' || part || '","last_modified_t":"12","nutriments":{"salt_100g":"35.0"}'
      WHEN 5 THEN ''
      WHEN 6 THEN '"_id":"' || part || '","unknown":{"x":1}'
      ELSE '"code":"' || part || '","last_modified_t":' || quantity END || '}' AS element
  FROM elements
), documents_read AS (
  SELECT document, document % 5 IN (0, 1) AS refused,
    document % 5 IN (0, 1) OR bool_or(line IN (2, 3, 4)) AS damaged,
    count(*) AS n_elements, count(*) FILTER (line = 5) AS n_empty,
    '[' || string_agg(element, ',' ORDER BY element)
      || CASE document % 5 WHEN 0 THEN ',{"co' WHEN 1 THEN ',7]' ELSE ']' END AS document_text
  FROM written GROUP BY document
), records AS (
  SELECT CASE WHEN line = 6 THEN part END AS _id,
    CASE WHEN line NOT IN (5, 6) THEN part END AS code,
    CASE WHEN line = 7 THEN quantity END AS last_modified_t,
    CASE WHEN line = 1 THEN CAST(quantity AS DOUBLE) END AS fat_100g
  FROM elements JOIN documents_read USING (document)
  WHERE NOT refused AND NOT (damaged AND line = 5)
)
SELECT 'record' AS side, _id, code, last_modified_t, fat_100g,
  CAST(NULL AS VARCHAR) AS product_name, CAST(NULL AS VARCHAR) AS brands,
  CAST(NULL AS VARCHAR) AS categories, CAST(NULL AS VARCHAR) AS countries,
  CAST(NULL AS VARCHAR) AS ingredients_text, CAST(NULL AS VARCHAR) AS allergens,
  CAST(NULL AS VARCHAR) AS nutrition_grades, CAST(NULL AS DOUBLE) AS energy_kcal_100g,
  CAST(NULL AS DOUBLE) AS proteins_100g, CAST(NULL AS DOUBLE) AS salt_100g,
  CAST(NULL AS DOUBLE) AS sugars_100g, CAST(NULL AS BIGINT) AS row_count,
  CAST(NULL AS BIGINT) AS lost_row_count, CAST(NULL AS VARCHAR) AS document_text
FROM records
UNION ALL BY NAME
SELECT 'letter' AS side, CASE WHEN refused THEN 1 ELSE n_elements END AS row_count,
  CASE WHEN refused THEN 1 ELSE n_empty END AS lost_row_count, document_text
FROM documents_read WHERE damaged"""

_REPORT = _from(
    _GOLD,
    """SELECT 'run-a' AS run_id, 'success' AS status, 'line items' AS source,
      'all' AS category,
      source_record_count AS extracted_record_count,
      valid_record_count AS silver_record_count,
      quarantined_record_count, duplicate_record_count,
      (SELECT count(*) FROM brand_gold) AS brand_summary_count,
      (SELECT count(*) FROM grade_gold) AS nutrition_grade_summary_count,
      CAST(3 AS BIGINT) AS gold_table_count,
      acceptance_rate,
      (SELECT string_agg(rejection_reason || '=' || record_count, ' | '
                         ORDER BY rejection_reason) FROM breakdown)
        AS quarantine_breakdown
    FROM rates""",
)
