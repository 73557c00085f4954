"""DuckDB SQL oracles, one per registered query.

Written independently of the Spark code: plain SQL over the driver's views (``orders``,
``customer``, ``nation``). The fixture CTEs restate FIXTURES.md §5 in DuckDB's dialect:
``ts + to_seconds(n)`` adds seconds, ``date_diff('hour', a, b)`` counts hour boundaries and
``round_even`` rounds half to even. Counts are cast to BIGINT (DuckDB's ``count_if``/``sum`` give
HUGEINT). Conditional counts use ``count(*) FILTER (WHERE ...)``: DuckDB's ``count_if`` returns
NULL for a group whose conditions are all NULL, while a conditional count is never NULL.
"""

from __future__ import annotations

from tierwise.sources.fixtures import AGING_TIMES, AS_OF, REPLAY_CUTS

TS_AS_OF = f"TIMESTAMP '{AS_OF}'"

# clean source with its order key k
_RT_K = f"""
rt_k AS (
  SELECT o.o_orderkey AS k,
         'TRX-' || repeat('0', greatest(0, 8 - length(CAST(o.o_orderkey AS VARCHAR)))) || CAST(o.o_orderkey AS VARCHAR) AS id,
         'CUST-' || CAST(o.o_custkey AS VARCHAR) AS "customerId",
         CASE o.o_orderkey % 6 WHEN 0 THEN 'BOOKED' WHEN 1 THEN 'PROCESSING' WHEN 2 THEN 'IN_TRANSIT'
              WHEN 3 THEN 'OUT_FOR_DELIVERY' WHEN 4 THEN 'DELIVERED' ELSE 'CANCELLED' END AS "lastStatus",
         n_o.n_name AS "posOrigin",
         n_d.n_name AS "posDestination",
         CAST(o.o_orderdate AS TIMESTAMP) + to_seconds(o.o_orderkey * 7919 % 86400)
             + to_microseconds(o.o_orderkey * 104729 % 1000000) AS "createdAt"
  FROM orders o
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n_o ON n_o.n_nationkey = c.c_nationkey
  LEFT JOIN nation n_d ON n_d.n_nationkey = (o.o_orderkey * 7 + 3) % 25
),
rt_u AS (
  SELECT *,
         CASE WHEN k % 6 < 4 AND (k // 6) % 4 = 0
              THEN {TS_AS_OF} - to_seconds(((k // 24) % 48) * 1800 + k % 1800)
              ELSE "createdAt" + to_seconds(k * 31337 % 864000) END AS "updatedAt"
  FROM rt_k
),
rtk AS (
  SELECT *, CASE WHEN k % 6 = 4 AND k % 7 = 0 THEN "updatedAt" END AS "deletedAt" FROM rt_u
),
rt AS (
  SELECT id, "customerId", "lastStatus", "posOrigin", "posDestination", "createdAt", "updatedAt", "deletedAt"
  FROM rtk
)"""

_SRC_COLS = 'id, "customerId", "lastStatus", "posOrigin", "posDestination", "createdAt"'


def _bronze_of(src: str, name: str, load_at: str = AS_OF) -> str:
    return f"""
{name} AS (
  SELECT {_SRC_COLS}, coalesce("updatedAt", TIMESTAMP '1970-01-01 00:00:00') AS "updatedAt", "deletedAt",
         TIMESTAMP '{load_at}' AS load_at
  FROM {src}
)"""


def _silver_of(bronze: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT trim(id) AS id, trim("customerId") AS customer_id, upper(trim("lastStatus")) AS last_status,
         trim("posOrigin") AS pos_origin, trim("posDestination") AS pos_destination,
         "createdAt" AS created_at, "updatedAt" AS updated_at, "deletedAt" AS deleted_at, load_at,
         CAST(CASE WHEN "deletedAt" IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS is_deleted
  FROM {bronze}
)"""


# dirty source (planted violations)
_DIRTY = """
dirty_k AS (
  SELECT k, copy,
         CASE WHEN k % 157 = 0 THEN NULL WHEN k % 151 = 0 AND copy = 1 THEN id || ' '
              WHEN k % 149 = 0 THEN ' ' || id || '  ' ELSE id END AS id,
         ' ' || "customerId" AS "customerId",
         CASE WHEN k % 107 = 0 THEN NULL
              WHEN k % 103 = 0 THEN 'DELIVRED'
              WHEN k % 101 = 0 THEN '  ' || lower("lastStatus") || ' '
              ELSE "lastStatus" END AS "lastStatus",
         CASE WHEN k % 163 = 0 THEN NULL WHEN k % 167 = 0 THEN ' ' || "posOrigin" || ' ' ELSE "posOrigin" END AS "posOrigin",
         CASE WHEN k % 173 = 0 THEN '  ' || "posDestination" ELSE "posDestination" END AS "posDestination",
         CASE WHEN k % 113 = 0 THEN NULL ELSE "createdAt" END AS "createdAt",
         CASE WHEN k % 139 = 0 THEN NULL
              WHEN k % 109 = 0 THEN "createdAt" - to_seconds(172800) ELSE "updatedAt" END AS "updatedAt",
         "deletedAt"
  FROM (SELECT *, 0 AS copy FROM rtk UNION ALL SELECT *, 1 AS copy FROM rtk WHERE k % 97 = 0 OR k % 151 = 0)
),
dirty AS (
  SELECT id, "customerId", "lastStatus", "posOrigin", "posDestination", "createdAt", "updatedAt", "deletedAt"
  FROM dirty_k
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts)


BASE = with_ctes(_RT_K, _bronze_of("rt", "bronze"), _silver_of("bronze", "silver"))
DIRTY_BASE = with_ctes(
    _RT_K, _DIRTY, _bronze_of("dirty", "dbronze"), _silver_of("dbronze", "dsilver")
)

# --- marts over a Silver relation ------------------------------------------------------------


def m1(silver: str = "silver") -> str:
    return f"""
SELECT CAST(created_at AS DATE) AS transaction_date, last_status, pos_origin, pos_destination,
       count(id) AS total_valid_transactions, {TS_AS_OF} AS processed_at
FROM {silver}
WHERE is_deleted = 0 AND last_status != 'CANCELLED'
GROUP BY 1, 2, 3, 4"""


def m2(silver: str = "silver") -> str:
    return f"""
SELECT CAST(created_at AS DATE) AS transaction_date, last_status, pos_origin, pos_destination,
       count(id) AS total_transactions, CAST(count(*) FILTER (WHERE is_deleted = 1) AS BIGINT) AS total_soft_deleted,
       {TS_AS_OF} AS processed_at
FROM {silver}
GROUP BY 1, 2, 3, 4"""


def m3(silver: str = "silver") -> str:
    return f"""
SELECT pos_origin, pos_destination, count(id) AS total_delivered_packages,
       round_even(avg(date_diff('hour', created_at, updated_at)), 2) AS avg_delivery_time_hours,
       min(date_diff('hour', created_at, updated_at)) AS fastest_delivery_hours,
       max(date_diff('hour', created_at, updated_at)) AS slowest_delivery_hours,
       {TS_AS_OF} AS processed_at
FROM {silver}
WHERE last_status = 'DELIVERED' AND is_deleted = 0
GROUP BY 1, 2"""


def m4(silver: str = "silver", threshold: str = "12") -> str:
    return f"""
SELECT last_status, pos_origin, pos_destination, count(id) AS total_stuck_packages,
       round_even(avg(date_diff('hour', updated_at, {TS_AS_OF})), 2) AS avg_hours_stuck,
       max(date_diff('hour', updated_at, {TS_AS_OF})) AS max_hours_stuck,
       {TS_AS_OF} AS processed_at
FROM {silver}
WHERE last_status NOT IN ('DELIVERED', 'CANCELLED') AND is_deleted = 0
  AND date_diff('hour', updated_at, {TS_AS_OF}) >= {threshold}
GROUP BY 1, 2, 3"""


def m5(silver: str = "silver") -> str:
    return f"""
SELECT pos_origin, pos_destination, count(id) AS total_packages,
       CAST(count(*) FILTER (WHERE last_status = 'DELIVERED') AS BIGINT) AS total_delivered,
       CAST(count(*) FILTER (WHERE last_status = 'CANCELLED') AS BIGINT) AS total_cancelled,
       round_even((count(*) FILTER (WHERE last_status = 'DELIVERED') / count(id)) * 100, 2) AS success_rate_pct,
       round_even((count(*) FILTER (WHERE last_status = 'CANCELLED') / count(id)) * 100, 2) AS cancelled_rate_pct,
       {TS_AS_OF} AS processed_at
FROM {silver}
WHERE is_deleted = 0
GROUP BY 1, 2
HAVING count(id) > 0"""



# --- change feed, snapshots and replayed loads ----------------------------------------------
_CHG = """
chg_n AS (
  SELECT *,
         CASE "lastStatus" WHEN 'BOOKED' THEN 1 WHEN 'PROCESSING' THEN 1 WHEN 'IN_TRANSIT' THEN 2
              WHEN 'OUT_FOR_DELIVERY' THEN 3
              WHEN 'DELIVERED' THEN CASE WHEN "deletedAt" IS NOT NULL THEN 5 ELSE 4 END
              ELSE 1 + (k // 6) % 4 END AS n,
         date_diff('microsecond', "createdAt", "updatedAt") // 1000000 AS s
  FROM rtk
),
chg_j AS (
  SELECT *, unnest(range(0, n + 1)) AS j FROM chg_n
),
chg AS (
  SELECT id, "customerId",
         CASE WHEN "lastStatus" = 'CANCELLED' AND j = n THEN 'CANCELLED'
              WHEN "lastStatus" = 'BOOKED' THEN 'BOOKED'
              ELSE (['BOOKED', 'PROCESSING', 'IN_TRANSIT', 'OUT_FOR_DELIVERY', 'DELIVERED'])[least(j, 4) + 1]
         END AS "lastStatus",
         "posOrigin", "posDestination", "createdAt",
         CASE WHEN j = n THEN "updatedAt"
              ELSE "createdAt" + to_seconds(CAST(floor(s * j / n) AS BIGINT)) END AS "updatedAt",
         CASE WHEN j = 5 THEN "deletedAt" END AS "deletedAt",
         j AS version
  FROM chg_j
)"""


def _snap(i: int, cut: str) -> str:
    return f"""
snap{i} AS (
  SELECT {_SRC_COLS}, "updatedAt", "deletedAt"
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "updatedAt" DESC, version DESC) AS rn
        FROM chg WHERE "updatedAt" <= TIMESTAMP '{cut}')
  WHERE rn = 1
)"""


def _batch(i: int, cut: str) -> str:
    where = "" if i == 1 else f'WHERE "updatedAt" >= (SELECT max("updatedAt") FROM snap{i - 1})'
    return f"""
batch{i} AS (
  SELECT {_SRC_COLS}, coalesce("updatedAt", TIMESTAMP '1970-01-01 00:00:00') AS "updatedAt", "deletedAt",
         TIMESTAMP '{cut}' AS load_at, {i} AS load_no
  FROM snap{i} {where}
)"""


_REPLAY_PARTS = [_CHG]
for _i, _cut in enumerate(REPLAY_CUTS, start=1):
    _REPLAY_PARTS.append(_snap(_i, _cut))
    _REPLAY_PARTS.append(_batch(_i, _cut))
_REPLAY_PARTS.append(
    """
allb AS (
  """ + "\n  UNION ALL ".join(f"SELECT * FROM batch{i}" for i in range(1, len(REPLAY_CUTS) + 1)) + """
),
log AS (
  SELECT * EXCLUDE (load_no),
         CAST(year("createdAt") * 100 + month("createdAt") AS INTEGER) AS created_month
  FROM (SELECT * FROM allb UNION ALL SELECT * REPLACE (load_at + INTERVAL 1 HOUR AS load_at) FROM allb)
),
final_bronze AS (
  SELECT * EXCLUDE (rn, load_no)
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY load_no DESC) AS rn FROM allb)
  WHERE rn = 1
)"""
)
REPLAY = with_ctes(_RT_K, *_REPLAY_PARTS)
N_LOADS = len(REPLAY_CUTS)

CLEAN_BUILD = with_ctes(
    _RT_K,
    _bronze_of("rt", "bronze"),
    _silver_of("bronze", "silver"),
    "\nm1 AS (" + m1() + ")",
    "\nm2 AS (" + m2() + ")",
    "\nm3 AS (" + m3() + ")",
    "\nm4 AS (" + m4() + ")",
    "\nm5 AS (" + m5() + ")",
)
DIRTY_BUILD = with_ctes(
    _RT_K,
    _DIRTY,
    _bronze_of("dirty", "dbronze"),
    _silver_of("dbronze", "dsilver"),
    "\ndm1 AS (" + m1("dsilver") + ")",
    "\ndm2 AS (" + m2("dsilver") + ")",
    "\ndm3 AS (" + m3("dsilver") + ")",
    "\ndm4 AS (" + m4("dsilver") + ")",
    "\ndm5 AS (" + m5("dsilver") + ")",
)
_STATUS_LIST = "('BOOKED', 'PROCESSING', 'IN_TRANSIT', 'OUT_FOR_DELIVERY', 'DELIVERED', 'CANCELLED')"


def _suite_rows() -> str:
    def row(model, test, col, sql):
        c = "NULL" if col is None else f"'{col}'"
        return f"SELECT '{model}' AS model, '{test}' AS test_name, CAST({c} AS VARCHAR) AS column_name, ({sql}) AS failures"

    b, s = "bronze_retail_transactions", "silver_retail_transactions_cleansed"
    rows = [
        row(b, "unique", "id", "SELECT count(*) FROM (SELECT id FROM dbronze WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)"),
        row(b, "not_null", "id", "SELECT count(*) FROM dbronze WHERE id IS NULL"),
        row(b, "not_null", "lastStatus", 'SELECT count(*) FROM dbronze WHERE "lastStatus" IS NULL'),
        row(b, "accepted_values", "lastStatus",
            f'SELECT count(DISTINCT "lastStatus") FROM dbronze WHERE "lastStatus" NOT IN {_STATUS_LIST}'),
        row(s, "unique", "id", "SELECT count(*) FROM (SELECT id FROM dsflip WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)"),
        row(s, "not_null", "id", "SELECT count(*) FROM dsflip WHERE id IS NULL"),
        row(s, "not_null", "last_status", "SELECT count(*) FROM dsflip WHERE last_status IS NULL"),
        row(s, "accepted_values", "last_status",
            f"SELECT count(DISTINCT last_status) FROM dsflip WHERE last_status NOT IN {_STATUS_LIST}"),
        row(s, "not_null", "is_deleted", "SELECT count(*) FROM dsflip WHERE is_deleted IS NULL"),
        row(s, "accepted_values", "is_deleted", "SELECT count(DISTINCT is_deleted) FROM dsflip WHERE is_deleted NOT IN (0, 1)"),
    ]
    gold_nn = [
        ("gold_daily_transaction_comprehensive", "dm2", ("transaction_date", "total_transactions", "total_soft_deleted")),
        ("gold_daily_transaction_valid", "dm1", ("transaction_date", "total_valid_transactions")),
        ("gold_route_performance_metrics", "dm3", ("pos_origin", "avg_delivery_time_hours")),
        ("gold_aging_bottleneck_alerts", "dm4", ("total_stuck_packages",)),
        ("gold_delivery_success_rate", "dm5", ("success_rate_pct",)),
    ]
    for model, rel, cols in gold_nn:
        for c in cols:
            rows.append(row(model, "not_null", c, f"SELECT count(*) FROM {rel} WHERE {c} IS NULL"))
    rows.append(row(s, "assert_silver_is_deleted_consistent", None,
                    "SELECT count(*) FROM dsflip WHERE (deleted_at IS NOT NULL AND is_deleted != 1) "
                    "OR (deleted_at IS NULL AND is_deleted != 0)"))
    rows.append(row("gold_daily_transaction_valid+gold_daily_transaction_comprehensive",
                    "assert_gold_daily_grain_unique", None,
                    "SELECT count(*) FROM ("
                    "SELECT 1 FROM dm1 GROUP BY transaction_date, last_status, pos_origin, pos_destination HAVING count(*) > 1 "
                    "UNION ALL "
                    "SELECT 1 FROM dm2 GROUP BY transaction_date, last_status, pos_origin, pos_destination HAVING count(*) > 1)"))
    rows.append(row("gold_route_performance_metrics", "assert_route_lead_time_valid", None,
                    "SELECT count(*) FROM dm3 WHERE fastest_delivery_hours < 0 OR avg_delivery_time_hours < 0 "
                    "OR slowest_delivery_hours < fastest_delivery_hours"))
    rows.append(row("gold_delivery_success_rate", "assert_success_rate_within_bounds", None,
                    "SELECT count(*) FROM dm5 WHERE success_rate_pct < 0 OR success_rate_pct > 100 "
                    "OR cancelled_rate_pct < 0 OR cancelled_rate_pct > 100 "
                    "OR (success_rate_pct + cancelled_rate_pct) > 100.01"))
    return "\nUNION ALL\n".join(rows)


_PLANTED_RATES = """
SELECT pos_origin, pos_destination,
       CASE WHEN pos_origin = 'NATION_1' AND pos_destination = 'NATION_1' THEN 120.0
            WHEN pos_origin = 'NATION_2' AND pos_destination = 'NATION_2' THEN -1.0
            WHEN pos_origin = 'NATION_3' AND pos_destination = 'NATION_3' THEN 60.0
            ELSE success_rate_pct END AS success_rate_pct,
       CASE WHEN pos_origin = 'NATION_3' AND pos_destination = 'NATION_3' THEN 60.0
            ELSE cancelled_rate_pct END AS cancelled_rate_pct
FROM m5"""

def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["source_scan"] = with_ctes(_RT_K) + "\nSELECT * FROM rt"
    q["bronze_projection"] = DIRTY_BASE + "\nSELECT * FROM dbronze"
    q["silver_cleansed"] = DIRTY_BASE + "\nSELECT * FROM dsilver"
    q["gold_daily_transaction_valid"] = BASE + m1()
    q["gold_daily_transaction_comprehensive"] = BASE + m2()
    q["gold_route_performance_metrics"] = BASE + m3()
    q["gold_aging_bottleneck_alerts"] = BASE + m4()
    q["gold_delivery_success_rate"] = BASE + m5()

    # loads
    q["bronze_watermark"] = REPLAY + "\n" + "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS load_number, TIMESTAMP '{cut}' AS load_at, "
        f'(SELECT max("updatedAt") FROM final_state_{i}) AS watermark'
        for i, cut in enumerate(REPLAY_CUTS, start=1)
    ).replace("final_state_", "snap")
    q["bronze_incremental_batch"] = REPLAY + f"\nSELECT * EXCLUDE (load_no) FROM batch{N_LOADS}"
    q["bronze_full_load"] = (
        BASE + '\nSELECT *, CAST(year("createdAt") * 100 + month("createdAt") AS INTEGER) AS created_month FROM bronze'
    )
    gate = ["SELECT CAST(1 AS INTEGER) AS load_number, CAST(1 AS INTEGER) AS has_new_rows"]
    for i in range(2, N_LOADS + 2):
        cur = min(i, N_LOADS)
        gate.append(
            f"SELECT CAST({i} AS INTEGER), CAST(CASE WHEN EXISTS (SELECT 1 FROM snap{cur} "
            f'WHERE "updatedAt" > (SELECT max("updatedAt") FROM snap{i - 1})) THEN 1 ELSE 0 END AS INTEGER)'
        )
    q["new_data_gate"] = REPLAY + "\n" + "\nUNION ALL\n".join(gate)
    c3 = REPLAY_CUTS[2]
    q["bronze_upsert"] = with_ctes(
        _RT_K,
        _CHG,
        _snap(3, c3),
        f"""
existing AS (SELECT {_SRC_COLS}, "updatedAt", "deletedAt", TIMESTAMP '{c3}' AS load_at FROM snap3),
batch AS (
  SELECT {_SRC_COLS}, "updatedAt", "deletedAt", {TS_AS_OF} AS load_at FROM rt
  WHERE "updatedAt" >= (SELECT max("updatedAt") FROM existing)
)""",
    ) + "\nSELECT * FROM existing WHERE id NOT IN (SELECT id FROM batch)\nUNION ALL\nSELECT * FROM batch"
    q["versioned_dedup"] = REPLAY + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
      PARTITION BY created_month, CAST("updatedAt" AS DATE), "lastStatus", id
      ORDER BY "updatedAt" DESC, load_at DESC) AS rn
  FROM log)
WHERE rn = 1"""
    q["drop_month"] = (
        BASE
        + '\nSELECT * FROM (SELECT *, CAST(year("createdAt") * 100 + month("createdAt") AS INTEGER) AS created_month '
        + "FROM bronze) WHERE created_month >= 199601 OR created_month IS NULL"
    )
    q["soft_delete_sync"] = with_ctes(REPLAY[len("WITH "):], _silver_of("final_bronze", "fsilver")) + (
        "\nSELECT * FROM fsilver"
    )
    q["layer_inventory"] = CLEAN_BUILD + """
SELECT 'bronze' AS layer, 'bronze_retail_transactions' AS table_name, count(*) AS total_rows FROM bronze
UNION ALL SELECT 'silver', 'silver_retail_transactions_cleansed', count(*) FROM silver
UNION ALL SELECT 'gold', 'gold_daily_transaction_valid', count(*) FROM m1
UNION ALL SELECT 'gold', 'gold_daily_transaction_comprehensive', count(*) FROM m2
UNION ALL SELECT 'gold', 'gold_route_performance_metrics', count(*) FROM m3
UNION ALL SELECT 'gold', 'gold_aging_bottleneck_alerts', count(*) FROM m4
UNION ALL SELECT 'gold', 'gold_delivery_success_rate', count(*) FROM m5"""

    # reports and reconciliation
    q["top_routes"] = CLEAN_BUILD + """
SELECT pos_origin, pos_destination, total_packages, total_delivered, success_rate_pct FROM m5
ORDER BY total_packages DESC, pos_origin NULLS FIRST, pos_destination NULLS FIRST LIMIT 4"""
    q["recent_soft_deletes"] = BASE + """
SELECT id, last_status, deleted_at, is_deleted, updated_at, load_at FROM silver WHERE is_deleted = 1
ORDER BY updated_at DESC, id LIMIT 10"""
    q["bronze_duplicate_ids"] = REPLAY + """,
fb AS (SELECT *, CAST(year("createdAt") * 100 + month("createdAt") AS INTEGER) AS created_month FROM final_bronze),
fb_final AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY created_month, CAST("updatedAt" AS DATE), "lastStatus", id
                                              ORDER BY "updatedAt" DESC, load_at DESC) AS rn FROM fb) WHERE rn = 1),
log_final AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY created_month, CAST("updatedAt" AS DATE), "lastStatus", id
                                              ORDER BY "updatedAt" DESC, load_at DESC) AS rn FROM log) WHERE rn = 1)
SELECT 'bronze_retail_transactions' AS table_name,
       (SELECT count(*) FROM (SELECT id FROM fb_final GROUP BY id HAVING count(*) > 1)) AS duplicate_ids
UNION ALL
SELECT 'append_only_log', (SELECT count(*) FROM (SELECT id FROM log_final GROUP BY id HAVING count(*) > 1))"""
    q["cross_mart_consistency"] = CLEAN_BUILD + """
SELECT transaction_date,
       CAST(coalesce(sum(n) FILTER (WHERE src = 'valid'), 0) AS BIGINT) AS valid,
       CAST(coalesce(sum(n) FILTER (WHERE src = 'total'), 0) AS BIGINT) AS total
FROM (SELECT transaction_date, 'valid' AS src, total_valid_transactions AS n FROM m1
      UNION ALL
      SELECT transaction_date, 'total' AS src, total_transactions AS n FROM m2)
GROUP BY transaction_date"""
    q["cancelled_reconciliation"] = CLEAN_BUILD + """
SELECT a.cancelled_in_mart, b.cancelled_in_silver,
       CAST(a.cancelled_in_mart = b.cancelled_in_silver AS INTEGER) AS matches
FROM (SELECT CAST(coalesce(sum(total_transactions) FILTER (WHERE last_status = 'CANCELLED'), 0) AS BIGINT)
             AS cancelled_in_mart FROM m2) a,
     (SELECT CAST(count(*) FILTER (WHERE last_status = 'CANCELLED') AS BIGINT) AS cancelled_in_silver FROM silver) b"""
    q["soft_delete_reconciliation"] = CLEAN_BUILD + """
SELECT a.deleted_in_mart, b.deleted_in_silver, CAST(a.deleted_in_mart = b.deleted_in_silver AS INTEGER) AS matches
FROM (SELECT CAST(coalesce(sum(total_soft_deleted), 0) AS BIGINT) AS deleted_in_mart FROM m2) a,
     (SELECT CAST(count(*) FILTER (WHERE is_deleted = 1) AS BIGINT) AS deleted_in_silver FROM silver) b"""

    # data quality
    q["dq_unique"] = DIRTY_BASE + """
SELECT id AS value, count(*) AS n_records FROM dbronze WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1"""
    q["dq_not_null"] = DIRTY_BASE + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM dsilver"
        for c in ("id", "customer_id", "last_status", "pos_origin", "pos_destination", "created_at",
                  "updated_at", "deleted_at", "load_at", "is_deleted")
    )
    q["dq_accepted_values"] = DIRTY_BASE + f"""
SELECT "lastStatus" AS value, count(*) AS n_records FROM dbronze
WHERE "lastStatus" IS NOT NULL AND "lastStatus" NOT IN {_STATUS_LIST}
GROUP BY "lastStatus"
"""
    q["dq_is_deleted_consistent"] = BASE + """,
planted AS (
  SELECT * REPLACE (CAST(CASE WHEN CAST(substr(id, 5) AS BIGINT) % 127 = 0 THEN 1 - is_deleted
                              ELSE is_deleted END AS INTEGER) AS is_deleted)
  FROM silver)
SELECT id, deleted_at, is_deleted FROM planted
WHERE (deleted_at IS NOT NULL AND is_deleted != 1) OR (deleted_at IS NULL AND is_deleted != 0)"""
    q["dq_daily_grain_unique"] = CLEAN_BUILD + """,
v AS (SELECT * FROM m1 UNION ALL SELECT * FROM m1 WHERE pos_origin = pos_destination AND last_status = 'BOOKED'),
c AS (SELECT * FROM m2 UNION ALL SELECT * FROM m2 WHERE pos_origin = pos_destination AND last_status = 'CANCELLED')
SELECT 'gold_daily_transaction_valid' AS model_name, transaction_date, last_status, pos_origin, pos_destination,
       count(*) AS n_rows
FROM v GROUP BY transaction_date, last_status, pos_origin, pos_destination HAVING count(*) > 1
UNION ALL
SELECT 'gold_daily_transaction_comprehensive', transaction_date, last_status, pos_origin, pos_destination, count(*)
FROM c GROUP BY transaction_date, last_status, pos_origin, pos_destination HAVING count(*) > 1"""
    q["dq_route_lead_time_valid"] = DIRTY_BUILD + """
SELECT pos_origin, pos_destination, fastest_delivery_hours, avg_delivery_time_hours, slowest_delivery_hours
FROM dm3
WHERE fastest_delivery_hours < 0 OR avg_delivery_time_hours < 0 OR slowest_delivery_hours < fastest_delivery_hours"""
    q["dq_success_rate_bounds"] = CLEAN_BUILD + ",\nplanted AS (" + _PLANTED_RATES + """)
SELECT pos_origin, pos_destination, success_rate_pct, cancelled_rate_pct FROM planted
WHERE success_rate_pct < 0 OR success_rate_pct > 100 OR cancelled_rate_pct < 0 OR cancelled_rate_pct > 100
   OR (success_rate_pct + cancelled_rate_pct) > 100.01"""
    q["dq_suite_summary"] = DIRTY_BUILD + """,
dsflip AS (
  SELECT * REPLACE (CAST(CASE WHEN CAST(substr(id, 5) AS BIGINT) % 127 = 0 THEN 1 - is_deleted ELSE is_deleted END AS INTEGER)
                    AS is_deleted)
  FROM dsilver)
""" + _suite_rows()

    # extensions
    q["status_transition_audit"] = with_ctes(_RT_K, _CHG) + """,
planted AS (
  SELECT id, "customerId",
         CASE WHEN k % 89 = 0 AND "lastStatus" = 'DELIVERED' AND "deletedAt" IS NULL THEN 'PROCESSING'
              WHEN k % 79 = 0 AND "lastStatus" = 'CANCELLED' THEN 'BOOKED'
              WHEN k % 73 = 0 AND "lastStatus" = 'IN_TRANSIT' THEN 'DELIVERED'
              WHEN k % 71 = 0 THEN 'PROCESSING' END AS "lastStatus",
         "posOrigin", "posDestination", "createdAt",
         CASE WHEN (k % 89 = 0 AND "lastStatus" = 'DELIVERED' AND "deletedAt" IS NULL)
                OR (k % 79 = 0 AND "lastStatus" = 'CANCELLED') OR (k % 73 = 0 AND "lastStatus" = 'IN_TRANSIT')
              THEN "updatedAt" + to_seconds(3600) END AS "updatedAt",
         CAST(NULL AS TIMESTAMP) AS "deletedAt", 6 AS version
  FROM rtk),
feed AS (SELECT * FROM chg UNION ALL SELECT * FROM planted WHERE "lastStatus" IS NOT NULL),
moves AS (
  SELECT id, lag("lastStatus") OVER (PARTITION BY id ORDER BY "updatedAt" NULLS FIRST, version) AS from_status,
         "lastStatus" AS to_status, "updatedAt" AS updated_at
  FROM feed)
SELECT * FROM moves
WHERE NOT (CASE WHEN from_status IS NULL THEN to_status = 'BOOKED'
                ELSE from_status = to_status
                  OR (from_status = 'BOOKED' AND to_status = 'PROCESSING')
                  OR (from_status = 'PROCESSING' AND to_status = 'IN_TRANSIT')
                  OR (from_status = 'IN_TRANSIT' AND to_status = 'OUT_FOR_DELIVERY')
                  OR (from_status = 'OUT_FOR_DELIVERY' AND to_status = 'DELIVERED')
                  OR (from_status IN ('BOOKED', 'PROCESSING', 'IN_TRANSIT', 'OUT_FOR_DELIVERY')
                      AND to_status = 'CANCELLED') END)"""
    q["hard_delete_reconciliation"] = BASE + """
SELECT id, "lastStatus", "createdAt", "updatedAt", "deletedAt", load_at FROM bronze
WHERE id NOT IN (SELECT id FROM rtk WHERE k % 131 != 0)"""
    n = N_LOADS
    q["incremental_daily_mart"] = REPLAY + f""",
bronze_prev AS (
  SELECT * EXCLUDE (rn, load_no)
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY load_no DESC) AS rn FROM allb WHERE load_no < {n})
  WHERE rn = 1),
aff AS (
  SELECT CAST("createdAt" AS DATE) AS d FROM bronze_prev WHERE id IN (SELECT id FROM batch{n})
  UNION
  SELECT CAST("createdAt" AS DATE) FROM batch{n}),
""" + _silver_of("final_bronze", "fsilver")[1:] + """,
full_mart AS (""" + m2("fsilver") + """)
SELECT * REPLACE (
  CASE WHEN EXISTS (SELECT 1 FROM aff WHERE aff.d IS NOT DISTINCT FROM full_mart.transaction_date)
       THEN """ + TS_AS_OF + f""" ELSE TIMESTAMP '{REPLAY_CUTS[-2]}' END AS processed_at)
FROM full_mart"""
    q["aging_with_route_sla"] = BASE + """,
perf AS (""" + m3() + """),
sla AS (
  SELECT pos_origin, pos_destination,
         CAST(least(48, greatest(6, floor(avg_delivery_time_hours / 12))) AS INTEGER) AS sla_hours
  FROM perf),
enriched AS (
  SELECT s.*, coalesce(sla.sla_hours, 12) AS thr
  FROM silver s LEFT JOIN sla ON s.pos_origin = sla.pos_origin AND s.pos_destination = sla.pos_destination)
SELECT last_status, pos_origin, pos_destination, count(id) AS total_stuck_packages,
       round_even(avg(date_diff('hour', updated_at, """ + TS_AS_OF + """)), 2) AS avg_hours_stuck,
       max(date_diff('hour', updated_at, """ + TS_AS_OF + """)) AS max_hours_stuck,
       """ + TS_AS_OF + """ AS processed_at
FROM enriched
WHERE last_status NOT IN ('DELIVERED', 'CANCELLED') AND is_deleted = 0
  AND date_diff('hour', updated_at, """ + TS_AS_OF + """) >= thr
GROUP BY 1, 2, 3"""
    q["bronze_stream_upsert"] = BASE + "\nSELECT * FROM bronze"
    q["run_report"] = CLEAN_BUILD + "," + REPLAY[len("WITH ") + len(_RT_K) + 1 :] + """
SELECT 'bronze_retail_transactions' AS model, 'success' AS status, (SELECT count(*) FROM batch4) AS rows,
       '' AS failed_checks
UNION ALL SELECT 'silver_retail_transactions_cleansed', 'success', CAST(NULL AS BIGINT), ''
UNION ALL SELECT 'gold_daily_transaction_valid', 'success', (SELECT count(*) FROM m1), ''
UNION ALL SELECT 'gold_daily_transaction_comprehensive', 'success', (SELECT count(*) FROM m2), ''
UNION ALL SELECT 'gold_route_performance_metrics', 'success', (SELECT count(*) FROM m3), ''
UNION ALL SELECT 'gold_aging_bottleneck_alerts', 'success', (SELECT count(*) FROM m4), ''
UNION ALL SELECT 'gold_delivery_success_rate', 'success', (SELECT count(*) FROM m5), ''"""
    # marts by signed counts: the direct marts over what is left, or at other times
    q["route_metrics_after_deletes"] = (
        BASE
        + """,
timed AS (
  SELECT *, last_status = 'DELIVERED' AND is_deleted = 0 AS live, date_diff('hour', created_at, updated_at) AS lead FROM silver),
left_over AS (
  SELECT * FROM (
    SELECT *, min(lead) FILTER (WHERE live) OVER (PARTITION BY pos_origin, pos_destination) AS least FROM timed)
  WHERE NOT live OR lead > least)"""
        + m3("left_over")
    )
    q["aging_alerts_by_hour"] = BASE + "\nUNION ALL\n".join(m4().replace(TS_AS_OF, f"TIMESTAMP '{t}'") for t in AGING_TIMES)
    q["aging_sla_by_hour"] = q["aging_with_route_sla"]
    return q


__all__ = ["oracle_sql", "REPLAY_CUTS"]
