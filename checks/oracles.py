"""The registered queries as SQL that DuckDB runs on the same tables."""

from __future__ import annotations

import math

PLACEMENT = (
    "CASE {k} % 4 WHEN 0 THEN 'top_of_search' WHEN 1 THEN 'rest_of_search' "
    "WHEN 2 THEN 'product_detail_page' ELSE 'off_amazon' END"
)
DEVICE = "CASE {k} % 4 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet' ELSE 'ctv' END"
FORMAT = (
    "CASE {k} % 4 WHEN 0 THEN 'sponsored_product' WHEN 1 THEN 'sponsored_brand' "
    "WHEN 2 THEN 'sponsored_display' ELSE 'dsp_display' END"
)
STRATEGY = (
    "CASE {k} % 4 WHEN 0 THEN 'target_cpa' WHEN 1 THEN 'target_roas' "
    "WHEN 2 THEN 'maximize_clicks' ELSE 'manual_cpc' END"
)

RAW = f"""
src AS (
  SELECT l.*, p_brand, p_size,
    CASE WHEN l_orderkey % 97 = 0 THEN 5e0 ELSE 1e0 END AS spike,
    timestamp '2024-01-01 00:00:00'
      + to_seconds((l_orderkey*1103 + l_linenumber*7919 + l_partkey*31) % 7776000) AS ts
  FROM lineitem l JOIN part ON l_partkey = p_partkey
),
bids AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS auction_id,
    ts AS "timestamp", CAST(ts AS DATE) AS "date", CAST(extract(hour FROM ts) AS INT) AS "hour",
    {PLACEMENT.format(k='l_partkey')} AS placement_type,
    {DEVICE.format(k='l_suppkey')} AS device_type,
    {FORMAT.format(k='l_linenumber')} AS ad_format,
    p_brand AS category, CAST(l_partkey AS VARCHAR) AS campaign_id, CAST(l_suppkey AS VARCHAR) AS advertiser_id,
    CAST(2 + l_orderkey % 11 AS INT) AS auction_depth,
    5e-2 + l_quantity*12e-3 AS bid_floor_usd,
    l_extendedprice/100000e0 * spike AS winning_bid_usd,
    0.97e0 - l_discount AS price_share,
    l_extendedprice/100e0 * (p_size/50e0) * spike AS ecpm,
    CAST(l_orderkey % 20 = 0 AS INT) AS clicked, CAST(l_orderkey % 60 = 0 AS INT) AS converted
  FROM src
),
raw AS (
  SELECT * EXCLUDE (price_share),
    CAST(winning_bid_usd >= bid_floor_usd AS INT) AS filled,
    CASE WHEN winning_bid_usd >= bid_floor_usd THEN winning_bid_usd*price_share ELSE 0e0 END AS clearing_price_usd,
    CASE WHEN winning_bid_usd >= bid_floor_usd THEN winning_bid_usd*price_share ELSE 0e0 END AS revenue_usd,
    CASE WHEN "timestamp" >= timestamp '2024-03-01' THEN 'post' ELSE 'pre' END AS release_period,
    CAST("timestamp" >= timestamp '2024-03-01'
      AND placement_type IN ('top_of_search','rest_of_search') AS INT) AS treatment
  FROM bids
)"""

AUCTIONS = RAW + """,
a AS (
  SELECT *,
    CASE WHEN treatment = 1 THEN 'v2.0' ELSE 'v1.0' END AS feature_version,
    dayname("timestamp") AS day_of_week, CAST(week("timestamp") AS INT) AS week,
    CAST(month("timestamp") AS INT) AS month, isodow("timestamp") >= 6 AS is_weekend,
    round(coalesce((winning_bid_usd - clearing_price_usd)/nullif(winning_bid_usd,0),0) + 1e-10,4) AS bid_spread,
    round(winning_bid_usd - clearing_price_usd + 1e-10,4) AS margin_usd,
    clicked <> 0 AS has_click, converted <> 0 AS has_conversion,
    CASE WHEN filled = 1 THEN CAST(clicked <> 0 AS DOUBLE) END AS ctr,
    CASE WHEN clicked <> 0 THEN CAST(converted <> 0 AS DOUBLE) END AS cvr,
    winning_bid_usd < bid_floor_usd AS below_floor
  FROM raw
)"""

ENRICHED = AUCTIONS + """,
st AS (SELECT placement_type, avg(winning_bid_usd) AS m, stddev_samp(winning_bid_usd) AS s FROM a GROUP BY 1),
e AS (
  SELECT a.*, round((winning_bid_usd - m)/nullif(s,0) + 1e-10,3) + 0e0 AS bid_z_score,
    coalesce(abs(round((winning_bid_usd - m)/nullif(s,0) + 1e-10,3)) > 3, false) AS is_bid_anomaly
  FROM a LEFT JOIN st USING (placement_type)
)"""

SUPPLY_RAW = f"""
sraw AS (
  SELECT CAST(event_id AS VARCHAR) AS supply_event_id, ts AS "timestamp", CAST(ts AS DATE) AS "date",
    {PLACEMENT.format(k='user_id')} AS placement_type, {DEVICE.format(k='event_id')} AS device_type,
    CAST(1 + event_id % 5 AS INT) AS available_slots, value/(value + 10e0) AS fill_rate,
    5e-2 + (event_id % 80)*1e-2 AS floor_price_usd, CAST(50 + (event_id*37) % 2950 AS INT) AS page_load_ms
  FROM events
)"""
SUPPLY = SUPPLY_RAW + """,
s AS (
  SELECT *, CAST(extract(hour FROM "timestamp") AS INT) AS "hour", dayname("timestamp") AS day_of_week,
    round(available_slots*fill_rate + 1e-10,2) AS monetized_slots,
    round(fill_rate*0.7e0 + (1 - floor_price_usd/(SELECT max(floor_price_usd) FROM sraw))*0.3e0 + 1e-10, 4) AS supply_health
  FROM sraw
)"""

ADVERTISER = f"""
dim_advertiser AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS advertiser_id,
    CASE WHEN s_acctbal < 2000 THEN 'small' WHEN s_acctbal < 5000 THEN 'mid'
         WHEN s_acctbal < 8000 THEN 'large' ELSE 'enterprise' END AS tier,
    n_name AS category, s_acctbal + 1000e0 AS daily_budget_usd,
    {STRATEGY.format(k='s_suppkey')} AS bidding_strategy,
    1e-1 + (s_suppkey % 50)*1e-2 AS target_cpc_usd, 3e0 + (s_suppkey % 70)*1e-1 AS quality_score,
    (s_suppkey % 100)*1e-2 AS identity_match_rate
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""
CAMPAIGN = f"""
dim_campaign AS (
  SELECT CAST(p_partkey AS VARCHAR) AS campaign_id, CAST(owner AS VARCHAR) AS advertiser_id,
    {FORMAT.format(k='p_partkey')} AS ad_format, p_brand AS category, p_retailprice AS daily_budget_usd,
    p_retailprice/1000e0 AS target_bid_usd, p_size/5e0 AS quality_score, (p_partkey % 100)*1e-2 AS relevance_score
  FROM part JOIN (SELECT l_partkey, min(l_suppkey) AS owner FROM lineitem GROUP BY 1) o ON p_partkey = l_partkey
)"""

MEASURES = """
  count(auction_id) AS total_auctions, CAST(sum(filled) AS BIGINT) AS filled_auctions,
  CAST(sum(clicked) AS BIGINT) AS total_clicks, CAST(sum(converted) AS BIGINT) AS total_conversions,
  sum(revenue_usd) AS rev, avg(winning_bid_usd) AS avg_winning_bid, avg(clearing_price_usd) AS avg_clearing_price,
  avg(bid_spread) AS avg_bid_spread, avg(ecpm) AS avg_ecpm, avg(auction_depth) AS avg_auction_depth"""
BID_QUANTILES = """,
  percentile_cont(0.5) WITHIN GROUP (ORDER BY winning_bid_usd) AS p50_winning_bid,
  percentile_cont(0.9) WITHIN GROUP (ORDER BY winning_bid_usd) AS p90_winning_bid,
  percentile_cont(0.99) WITHIN GROUP (ORDER BY winning_bid_usd) AS p99_winning_bid"""
RATIOS = """
  round(filled_auctions/nullif(total_auctions,0)+1e-9,4) AS fill_rate,
  round(total_clicks/nullif(filled_auctions,0)+1e-9,4) AS ctr,
  round(total_conversions/nullif(total_clicks,0)+1e-9,4) AS cvr,
  round(rev/nullif(total_clicks,0)+1e-9,4) AS cpc_usd,
  round(rev/nullif(total_auctions,0)*1000+1e-9,4) AS rpm_usd"""


def snapshot(grain: str, quantiles: bool = True, shown: bool = True) -> str:
    inner = f"SELECT {grain}, {MEASURES}{BID_QUANTILES if quantiles else ''} FROM a GROUP BY {grain}"
    means = ["avg_winning_bid", "avg_clearing_price", "avg_bid_spread", "avg_ecpm", "avg_auction_depth"]
    if quantiles:
        means += ["p50_winning_bid", "p90_winning_bid", "p99_winning_bid"]
    columns = ", ".join(f"round({m}+1.234567e-9,6) AS {m}" if shown else m for m in means)
    revenue = "round(rev+1.234567e-9,6)" if shown else "rev"
    return (
        f"SELECT {grain}, total_auctions, filled_auctions, total_clicks, total_conversions, "
        f"{revenue} AS total_revenue_usd, {columns}, {RATIOS} FROM ({inner})"
    )


DAILY = '"date", placement_type, device_type, ad_format'
HOURLY = '"date", "hour", placement_type'
KPI_DAILY = AUCTIONS + f",\nkpi_daily AS ({snapshot(DAILY, quantiles=False, shown=False)})"
KPI_HOURLY = AUCTIONS + f",\nkpi_hourly AS ({snapshot(HOURLY, quantiles=False, shown=False)})"

KPI_VALUES = """
  count(*) AS n_samples, avg(filled) AS fill_rate, sum(revenue_usd)/count(*)*1000 AS ecpm,
  avg(bid_spread) AS bid_spread, sum(clicked)/greatest(sum(filled),1) AS ctr,
  sum(converted)/greatest(sum(clicked),1) AS cvr, avg(auction_depth) AS auction_depth,
  avg(revenue_usd) AS revenue_per_auction, avg(CAST(below_floor AS INT)) AS below_floor_rate"""
KPI_NAMES = [
    "fill_rate",
    "ecpm",
    "bid_spread",
    "ctr",
    "cvr",
    "auction_depth",
    "revenue_per_auction",
    "below_floor_rate",
]
KPI_META = """
meta(kpi, unit, target, alert_threshold, category, higher_is_better, description) AS (VALUES
  ('fill_rate','ratio',85e-2,70e-2,'delivery',true,'Share of auction requests that delivered an ad.'),
  ('ecpm','USD',NULL,NULL,'revenue',true,'Revenue per thousand auction requests, unfilled ones included.'),
  ('bid_spread','ratio',8e-2,20e-2,'efficiency',false,
   'Mean distance of the winning bid from the clearing price, relative to the bid.'),
  ('ctr','ratio',4e-2,1e-2,'quality',true,'Clicks per delivered ad.'),
  ('cvr','ratio',3e-2,5e-3,'quality',true,'Conversions per click.'),
  ('auction_depth','count',6e0,3e0,'efficiency',true,'Mean number of bidders per auction.'),
  ('revenue_per_auction','USD',NULL,NULL,'revenue',true,'Mean clearing revenue per auction request.'),
  ('below_floor_rate','ratio',5e-2,15e-2,'delivery',false,'Share of bids under the bid floor.')
)"""


def long_kpis(source: str, extra: str = "") -> str:
    """KPI columns of ``source`` as rows, unrounded."""
    lines = [f"SELECT {extra}n_samples, '{k}' AS kpi, CAST({k} AS DOUBLE) AS value FROM {source}" for k in KPI_NAMES]
    return " UNION ALL ".join(lines)


STATUS = """CASE WHEN value IS NULL OR alert_threshold IS NULL THEN 'ok'
  WHEN (higher_is_better AND round(value,9) < alert_threshold) OR (NOT higher_is_better AND round(value,9) > alert_threshold) THEN 'alert'
  WHEN target IS NULL THEN 'ok'
  WHEN (higher_is_better AND round(value,9) >= target) OR (NOT higher_is_better AND round(value,9) <= target) THEN 'on_target'
  ELSE 'below_target' END"""


def scorecard(where: str = "true", keep: str = "true") -> str:
    return f"""WITH {AUCTIONS}, {KPI_META},
t AS (SELECT {KPI_VALUES} FROM a WHERE {where}),
v AS ({long_kpis('t')}),
card AS (
  SELECT kpi, round(value,6) AS value, unit, CAST(target AS DOUBLE) AS target,
    CAST(alert_threshold AS DOUBLE) AS alert_threshold, {STATUS} AS status, category, higher_is_better,
    description, n_samples
  FROM v JOIN meta USING (kpi) WHERE n_samples > 0
)
SELECT * FROM card WHERE {keep}"""


def bin_of(freq: str, column: str = '"timestamp"') -> str:
    day = f"date_trunc('day', {column})"
    return {
        "D": f"CAST({day} AS TIMESTAMP)",
        "W": f"CAST(date_trunc('week', {column}) + INTERVAL 6 DAY AS TIMESTAMP)",
    }[freq]


def spine(source: str, freq: str, column: str = "b") -> str:
    step = {"D": "1 DAY", "W": "7 DAY"}[freq]
    return (
        f"(SELECT unnest(generate_series((SELECT min({column}) FROM {source}), "
        f"(SELECT max({column}) FROM {source}), INTERVAL {step})) AS {column})"
    )


def quantile(p: float, column: str) -> str:
    return f"percentile_cont({p}) WITHIN GROUP (ORDER BY {column})"


def did(metric: str, column: str, part: str = "all") -> str:
    base = f"""WITH {AUCTIONS},
g AS (SELECT {column} AS v, release_period AS per,
        CAST(placement_type IN (SELECT placement_type FROM a WHERE treatment = 1) AS INT) AS grp FROM a),
c AS (SELECT
  coalesce(avg(v) FILTER (grp = 0 AND per = 'pre'),0) AS pre_control,
  coalesce(avg(v) FILTER (grp = 0 AND per = 'post'),0) AS post_control,
  coalesce(avg(v) FILTER (grp = 1 AND per = 'pre'),0) AS pre_treated,
  coalesce(avg(v) FILTER (grp = 1 AND per = 'post'),0) AS post_treated,
  count(v) FILTER (grp = 1 AND per = 'pre') AS n0, count(v) FILTER (grp = 1 AND per = 'post') AS n1,
  var_samp(v) FILTER (grp = 1 AND per = 'pre') AS v0, var_samp(v) FILTER (grp = 1 AND per = 'post') AS v1
  FROM g),
d AS (SELECT *, (post_treated - pre_treated) - (post_control - pre_control) AS did,
  (post_treated - pre_treated)/sqrt(((n1-1)*v1 + (n0-1)*v0)/(n1+n0-2) * (1e0/n1 + 1e0/n0)) AS t,
  CAST(n1 + n0 - 2 AS DOUBLE) AS f FROM c)"""
    if part == "cells":
        return base + """
SELECT 'Control (pre)' AS "group", round(pre_control+1e-9,4) AS value FROM d
UNION ALL SELECT 'Control (post)', round(post_control+1e-9,4) FROM d
UNION ALL SELECT 'Treated (pre)', round(pre_treated+1e-9,4) FROM d
UNION ALL SELECT 'Treated (post)', round(post_treated+1e-9,4) FROM d"""
    # The tail of Student's t by the midpoint rule after x = |t| + u/(1-u).
    return base + f""",
tail AS (
  SELECT least(1e0, 2*sum(exp(lgamma((f+1)/2) - lgamma(f/2) - 0.5*ln(f*pi())
      - (f+1)/2*ln(1 + pow(abs(t) + u/(1-u), 2)/f)) / pow(1-u, 2) / 200000e0)) AS p
  FROM d, (SELECT (range + 0.5e0)/200000e0 AS u FROM range(200000))
)
SELECT '{metric}' AS metric, round(pre_control+1e-9,4) AS pre_control, round(post_control+1e-9,4) AS post_control,
  round(pre_treated+1e-9,4) AS pre_treated, round(post_treated+1e-9,4) AS post_treated, round(did+1e-9,4) AS did_estimate,
  coalesce(round(did/nullif(pre_treated,0)*100,2),0) AS relative_lift_pct, round(t,3) AS t_statistic,
  round(p,4) AS p_value, p < 0.05 AS significant_at_5pct
FROM d, tail"""


def rules(table: str, source: str, checks: list[tuple[str, str]]) -> str:
    lines = []
    for name, condition in checks:
        severity = "info" if name == "click_needs_fill" else "error"
        lines.append(
            f"SELECT '{table}' AS table_name, '{name}' AS rule, '{severity}' AS severity, "
            f"count(*) FILTER (NOT ({condition})) AS violations, count(*) AS n_rows FROM {source}"
        )
    return " UNION ALL ".join(lines)


def filled(*columns: str) -> list[tuple[str, str]]:
    return [(f"{c}_not_null", f'"{c}" IS NOT NULL') for c in columns]


DQ_RULES = " UNION ALL ".join(
    [
        rules(
            "dim_advertiser",
            "dim_advertiser",
            [
                ("tier_known", "tier IN ('small','mid','large','enterprise')"),
                ("quality_score_0_10", "quality_score BETWEEN 0 AND 10"),
                ("identity_match_rate_0_1", "identity_match_rate BETWEEN 0 AND 1"),
                *filled("tier", "category", "daily_budget_usd", "bidding_strategy"),
            ],
        ),
        rules(
            "dim_campaign",
            "dim_campaign",
            [
                ("quality_score_0_10", "quality_score BETWEEN 0 AND 10"),
                ("relevance_score_0_1", "relevance_score BETWEEN 0 AND 1"),
                *filled("advertiser_id", "ad_format", "category", "daily_budget_usd"),
            ],
        ),
        rules(
            "fact_auctions",
            "raw",
            [
                ("hour_0_23", '"hour" BETWEEN 0 AND 23'),
                ("auction_depth_positive", "auction_depth >= 1"),
                ("filled_0_1", "filled IN (0,1)"),
                ("clicked_0_1", "clicked IN (0,1)"),
                ("converted_0_1", "converted IN (0,1)"),
                ("release_period_known", "release_period IN ('pre','post')"),
                ("treatment_0_1", "treatment IN (0,1)"),
                ("click_needs_fill", "NOT (clicked = 1 AND filled = 0)"),
                *filled(
                    "timestamp",
                    "date",
                    "hour",
                    "placement_type",
                    "device_type",
                    "ad_format",
                    "category",
                    "auction_depth",
                    "bid_floor_usd",
                    "winning_bid_usd",
                    "clearing_price_usd",
                    "filled",
                    "clicked",
                    "converted",
                    "revenue_usd",
                ),
            ],
        ),
        rules(
            "fact_supply",
            "sraw",
            [
                ("available_slots_not_negative", "available_slots >= 0"),
                ("fill_rate_0_1", "fill_rate BETWEEN 0 AND 1"),
                *filled(
                    "timestamp",
                    "date",
                    "placement_type",
                    "device_type",
                    "available_slots",
                    "fill_rate",
                    "floor_price_usd",
                ),
                ("hour_not_null", 'extract(hour FROM "timestamp") IS NOT NULL'),
            ],
        ),
        rules(
            "dim_date",
            "dd",
            [
                ("quarter_1_4", '"quarter" BETWEEN 1 AND 4'),
                ("month_1_12", '"month" BETWEEN 1 AND 12'),
                ("is_weekend_0_1", "is_weekend IN (0,1)"),
                *filled("year", "quarter", "month", "week", "day_of_week", "is_weekend", "is_holiday"),
            ],
        ),
        rules("dim_placement", "dp", filled("placement_type", "device_type")),
        rules("kpi_daily", "kd", filled("date", "placement_type", "device_type", "ad_format")),
        rules("kpi_hourly", "kh", filled("date", "hour", "placement_type")),
    ]
)


FOREST_FEATURES = ["winning_bid_usd", "clearing_price_usd", "bid_spread", "ecpm", "auction_depth", "bid_floor_usd"]


def draw(*salt: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(salt)})), 1, 10) AS BIGINT)"


def forest(trees: int = 100, sample: int = 256, levels: int = 8, seed: int = 42) -> str:
    """CTEs that grow the trees level by level and walk all rows through them; ``f`` has the scored rows."""
    features = FOREST_FEATURES
    listed = ", ".join(f"coalesce(CAST({f} AS DOUBLE), (SELECT quantile_cont(CAST({f} AS DOUBLE), 0.5) FROM a))" for f in features)
    span = 1 << 40
    expected = "CASE WHEN n <= 1 THEN 0e0 WHEN n = 2 THEN 1e0 ELSE 2e0*(ln(n - 1) + 0.5772156649015329e0) - 2e0*(n - 1)/n END"
    usable = "list_filter(range(%d), lambda i: hi[i + 1] > lo[i + 1])" % len(features)
    bounds = ", ".join(f"min(x[{k + 1}])" for k in range(len(features))), ", ".join(f"max(x[{k + 1}])" for k in range(len(features)))
    steps = []
    for level in range(levels + 1):
        stop = "n > 1 AND len(u) > 0" if level < levels else "false"
        steps.append(f"""c{level} AS MATERIALIZED (
  SELECT tree, node, CASE WHEN {stop} THEN u[{draw("'feature'", 'tree', 'node', str(seed))} % len(u) + 1] END AS feature,
    lo, hi, {level * 10**9}::BIGINT + CAST(floor(({expected}) * 1e9 + 5e-1) AS BIGINT) AS depth
  FROM (SELECT *, {usable} AS u FROM (
    SELECT tree, node, count(*) AS n, [{bounds[0]}] AS lo, [{bounds[1]}] AS hi FROM m{level} GROUP BY tree, node))),
d{level} AS MATERIALIZED (
  SELECT tree, node, feature, depth, lo[feature + 1]
    + ({draw("'cut'", 'tree', 'node', str(seed))} + 5e-1) / {span}e0 * (hi[feature + 1] - lo[feature + 1]) AS cut FROM c{level})""")
        if level < levels:
            steps.append(f"""m{level + 1} AS MATERIALIZED (
  SELECT tree, 2*node + 1 + CAST(x[feature + 1] >= cut AS INT) AS node, x FROM m{level} JOIN d{level} USING (tree, node)
  WHERE feature IS NOT NULL)""")
    walks = [f"""w{level + 1} AS (
  SELECT id, w.tree, CASE WHEN feature IS NULL THEN node ELSE 2*node + 1 + CAST(x[feature + 1] >= cut AS INT) END AS node, x
  FROM w{level} w JOIN nodes USING (tree, node))""" for level in range(levels)]
    return f"""{AUCTIONS},
rows_of AS MATERIALIZED (SELECT auction_id AS id, [{listed}] AS x FROM a),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM rows_of),
pool AS (SELECT id, x FROM rows_of, total WHERE {draw('id', str(seed))} < CAST(floor(least(1e0, {trees * sample}e0/n) * {span}e0) AS BIGINT)),
hits AS (
  SELECT tree, draw, x FROM (SELECT CAST(t AS INT) AS tree, {draw('id', 't', str(seed))} AS draw, x FROM pool, range({trees}) g(t)), total
  WHERE draw < CAST(floor(least(1e0, {2 * sample}e0/least({trees * sample}e0, n)) * {span}e0) AS BIGINT)),
m0 AS MATERIALIZED (
  SELECT tree, 0 AS node, x FROM hits QUALIFY row_number() OVER (PARTITION BY tree ORDER BY draw, x) <= {sample}),
{", ".join(steps)},
nodes AS MATERIALIZED ({" UNION ALL ".join(f"SELECT tree, node, feature, depth, cut FROM d{level}" for level in range(levels + 1))}),
w0 AS (SELECT id, CAST(t AS INT) AS tree, 0 AS node, x FROM rows_of, range({trees}) g(t)),
{", ".join(walks)},
paths AS MATERIALIZED (
  SELECT id, pow(2e0, -(CAST(sum(depth) AS DOUBLE) / {trees}000000000e0) / {expected_depth(sample)!r}) AS score
  FROM w{levels} JOIN nodes USING (tree, node) GROUP BY id),
f AS MATERIALIZED (
  SELECT a.*, round(score, 4) AS anomaly_score, score > (SELECT quantile_cont(score, 1 - 2e-2) FROM paths) AS is_anomaly
  FROM a JOIN paths ON a.auction_id = paths.id)"""


def expected_depth(rows: int) -> float:
    return 2.0 * (math.log(rows - 1.0) + 0.5772156649015329) - 2.0 * (rows - 1.0) / rows


def primary_key(table: str, source: str, key: list[str]) -> str:
    columns = ", ".join(f'"{c}"' for c in key)
    missing = " OR ".join(f'"{c}" IS NULL' for c in key)
    return (
        f"SELECT '{table}' AS table_name, '{', '.join(key)}' AS key_columns, "
        f"count(*) FILTER (n > 1 AND NOT miss) AS repeated_keys, "
        f"CAST(coalesce(sum(n) FILTER (n > 1 AND NOT miss),0) AS BIGINT) AS rows_with_repeated_key, "
        f"CAST(coalesce(sum(n) FILTER (miss),0) AS BIGINT) AS rows_without_key "
        f"FROM (SELECT {columns}, count(*) AS n, ({missing}) AS miss FROM {source} GROUP BY ALL)"
    )


def orphans(child: str, source: str, column: str, parent: str) -> str:
    return (
        f"SELECT '{child}' AS table_name, '{column}' AS key_column, '{parent}' AS parent_table, "
        f"count(DISTINCT {column}) AS orphan_keys, count(*) AS orphan_rows FROM {source} "
        f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {parent})"
    )


ENRICHED_COLUMNS = """auction_id, "timestamp", "date", "hour", day_of_week, week, month, is_weekend, placement_type,
  device_type, ad_format, category, campaign_id, advertiser_id, auction_depth, round(bid_floor_usd,9) AS bid_floor_usd,
  round(winning_bid_usd,9) AS winning_bid_usd, round(clearing_price_usd,9) AS clearing_price_usd, bid_spread,
  margin_usd, round(ecpm,9) AS ecpm, filled, clicked, converted, round(revenue_usd,9) AS revenue_usd, has_click,
  has_conversion, ctr, cvr, bid_z_score, is_bid_anomaly, below_floor"""

BASELINES = f"""
base AS (SELECT placement_type, avg(winning_bid_usd) AS mean, stddev_samp(winning_bid_usd) AS std,
  {quantile(0.99, 'winning_bid_usd')} AS p99 FROM a GROUP BY 1),
scored AS (SELECT a.*, (winning_bid_usd - mean)/greatest(std,1e-9) AS z FROM a LEFT JOIN base USING (placement_type))"""

SERIES = f"""
w AS (SELECT {bin_of('D')} AS b, {KPI_VALUES} FROM a GROUP BY 1),
sp AS {spine('w', 'D')},
full_w AS (SELECT sp.b, w.* EXCLUDE (b) FROM sp LEFT JOIN w ON sp.b = w.b),
series AS (SELECT b AS "timestamp", kpi, value FROM ({long_kpis('full_w', 'b, ')}))"""


def scan(method: str) -> str:
    mark = {
        "zscore": "abs((x - avg(x) OVER k)/nullif(stddev_samp(x) OVER k,0)) > 2.5",
        "iqr": (
            "x < quantile_cont(x,0.25) OVER k - 2*(quantile_cont(x,0.75) OVER k - quantile_cont(x,0.25) OVER k) OR "
            "x > quantile_cont(x,0.75) OVER k + 2*(quantile_cont(x,0.75) OVER k - quantile_cont(x,0.25) OVER k)"
        ),
    }[method]
    return f"""WITH {AUCTIONS}, {SERIES},
filled_in AS (SELECT *, coalesce(value, median(value) OVER (PARTITION BY kpi)) AS x FROM series)
SELECT "timestamp", kpi, round(value+1.234567e-9,6) AS value, coalesce({mark}, false) AS is_anomaly,
  round(abs((value - avg(value) OVER k)/nullif(stddev_samp(value) OVER k,0)),3) AS anomaly_score
FROM filled_in WINDOW k AS (PARTITION BY kpi)"""


def trend(kpi: str, freq: str, group: str | None = None) -> str:
    keys = f"{group}, " if group else ""
    if group:
        step = {"D": "1 DAY", "W": "7 DAY"}[freq]
        bins = f"(SELECT {group}, unnest(generate_series(min(b), max(b), INTERVAL {step})) AS b FROM w GROUP BY {group})"
        on = f"sp.b = w.b AND sp.{group} = w.{group}"
    else:
        bins, on = spine("w", freq), "sp.b = w.b"
    part = f"PARTITION BY sp.{group} " if group else ""
    shown = f"sp.{group}, " if group else ""
    return f"""WITH {AUCTIONS},
w AS (SELECT {keys}{bin_of(freq)} AS b, {KPI_VALUES} FROM a GROUP BY ALL),
sp AS {bins}
SELECT {shown}sp.b AS "timestamp", round(CAST(w.{kpi} AS DOUBLE)+1.234567e-9,6) AS value,
  round(avg(w.{kpi}) OVER ({part}ORDER BY sp.b ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),6) AS rolling_avg,
  '{kpi}' AS kpi
FROM sp LEFT JOIN w ON {on}"""


def floor_changes(multipliers: list[float], placement: str | None) -> str:
    where = f"placement_type = '{placement}'" if placement else "true"
    lines = []
    for m in multipliers:
        meets = f"winning_bid_usd >= bid_floor_usd*{m!r}e0"
        lines.append(f"""SELECT {m!r}e0 AS floor_multiplier, '{placement or 'all'}' AS placement,
  round(avg(filled)+1e-9,4) AS baseline_fill_rate, round(avg(CAST({meets} AS INT))+1e-9,4) AS simulated_fill_rate,
  round(avg(CAST({meets} AS INT)) - avg(filled)+1e-9,4) AS fill_rate_delta, round(sum(revenue_usd),2) AS baseline_revenue_usd,
  round(coalesce(sum(revenue_usd) FILTER ({meets}),0),2) AS simulated_revenue_usd,
  coalesce(round((sum(revenue_usd) FILTER ({meets})/nullif(sum(revenue_usd),0) - 1)*100,2),0) AS revenue_delta_pct,
  count(*) AS n_auctions_affected FROM a WHERE {where}""")
    return f"WITH {AUCTIONS} " + " UNION ALL ".join(lines)


AS_OF = "date '2024-03-31'"


def windowed_kpis(minutes: int) -> str:
    return f"""WITH {AUCTIONS}
SELECT time_bucket(INTERVAL {minutes} MINUTE, "timestamp") AS window_start,
  time_bucket(INTERVAL {minutes} MINUTE, "timestamp") + INTERVAL {minutes} MINUTE AS window_end, n_samples,
  {', '.join(f'round(CAST({k} AS DOUBLE)+1.234567e-9,6) AS {k}' for k in KPI_NAMES)}
FROM (SELECT time_bucket(INTERVAL {minutes} MINUTE, "timestamp") AS "timestamp", {KPI_VALUES} FROM a GROUP BY 1)"""


def consecutive_alerts(minutes: int, closed: str = "true") -> str:
    return f"""WITH {AUCTIONS}, {KPI_META},
w AS (SELECT time_bucket(INTERVAL {minutes} MINUTE, "timestamp") AS b, {KPI_VALUES} FROM a GROUP BY 1),
v AS ({long_kpis('w', 'b, ')}),
st AS (SELECT b, kpi, value, {STATUS} AS status FROM v JOIN meta USING (kpi)),
seq AS (SELECT *, lag(b) OVER k AS prev_b, lag(status) OVER k AS prev_status FROM st WINDOW k AS (PARTITION BY kpi ORDER BY b))
SELECT kpi, b AS window_start, round(value+1.234567e-9,6) AS value FROM seq
WHERE {closed} AND status = 'alert' AND prev_status = 'alert' AND prev_b = b - INTERVAL {minutes} MINUTE"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # Enrichment
    q["auctions_enriched"] = f"WITH {ENRICHED} SELECT {ENRICHED_COLUMNS} FROM e"
    q["supply_enriched"] = f"""WITH {SUPPLY}
SELECT supply_event_id, "timestamp", "date", "hour", day_of_week, placement_type, device_type, available_slots,
  round(fill_rate,9) AS fill_rate, round(floor_price_usd,9) AS floor_price_usd, page_load_ms, monetized_slots,
  supply_health FROM s"""
    q["release_labels"] = f"""WITH {AUCTIONS}
SELECT release_period, treatment, feature_version, placement_type, count(*) AS n_auctions,
  min("timestamp") AS first_ts, max("timestamp") AS last_ts FROM a GROUP BY ALL"""
    q["release_label_rows"] = f"WITH {AUCTIONS} SELECT auction_id, release_period, treatment, feature_version FROM a"

    # KPI reports
    q["kpi_scorecard"] = scorecard()
    q["kpi_scorecard_segment"] = scorecard("placement_type = 'top_of_search' AND device_type = 'mobile'")
    q["kpi_scorecard_core"] = scorecard(
        keep="kpi IN ('fill_rate','ecpm','bid_spread','ctr','cvr','auction_depth')"
    )
    q["kpi_alerts"] = scorecard(keep="status = 'alert'")
    q["kpi_by_segment"] = f"""WITH {AUCTIONS}, {KPI_META},
t AS (SELECT placement_type, {KPI_VALUES} FROM a GROUP BY 1), v AS ({long_kpis('t', 'placement_type, ')})
SELECT placement_type, kpi, round(value,6) AS value, unit, n_samples FROM v JOIN meta USING (kpi)"""
    q["kpi_by_segment_subset"] = f"""WITH {AUCTIONS}, {KPI_META},
t AS (SELECT device_type, {KPI_VALUES} FROM a GROUP BY 1), v AS ({long_kpis('t', 'device_type, ')})
SELECT device_type, kpi, round(value,6) AS value, unit, n_samples FROM v JOIN meta USING (kpi)
WHERE kpi IN ('fill_rate','ecpm')"""
    q["kpi_own_by_segment"] = f"""WITH {AUCTIONS}
SELECT placement_type, 'win margin' AS kpi, round(avg(winning_bid_usd - clearing_price_usd),6) AS value, 'USD' AS unit,
  count(*) AS n_samples FROM a GROUP BY 1"""
    q["kpi_python_by_segment"] = f"""WITH {AUCTIONS},
m AS (SELECT *, device_type || ' ' || day_of_week AS segment FROM a),
d AS (SELECT m.*, winning_bid_usd - avg(winning_bid_usd) OVER (PARTITION BY segment) AS off FROM m)
SELECT segment, 'bid skew' AS kpi, round(avg(off*off*off)/pow(avg(off*off), 1.5e0),6) AS value, 'ratio' AS unit,
  count(*) AS n_samples FROM d GROUP BY 1
UNION ALL SELECT segment, 'fill_rate', round(avg(filled),6), 'ratio', count(*) FROM m GROUP BY 1"""
    q["kpi_trend_daily"] = trend("fill_rate", "D")
    q["kpi_trend_weekly_grouped"] = trend("ecpm", "W", "placement_type")
    q["kpi_series_daily"] = f"""WITH {AUCTIONS}, {SERIES}
SELECT "timestamp", kpi, round(value+1.234567e-9,6) AS value FROM series"""

    # Snapshots
    q["kpi_daily"] = f"WITH {AUCTIONS} {snapshot(DAILY)}"
    q["kpi_hourly"] = f"WITH {AUCTIONS} {snapshot(HOURLY)}"
    q["kpi_by_category"] = f"WITH {AUCTIONS} {snapshot('category')}"
    q["kpi_rollup_weekly"] = f"""WITH {AUCTIONS.replace('a AS (', 'a0 AS (')},
a AS (SELECT *, CAST(date_trunc('week', "date") AS DATE) + 6 AS week_ending FROM a0)
{snapshot("week_ending, placement_type", quantiles=False)}"""
    q["kpi_snapshots"] = f"""WITH {AUCTIONS}
SELECT *, NULL::INT AS "hour", 'daily' AS grain FROM ({snapshot(DAILY)})
UNION ALL BY NAME
SELECT *, NULL::VARCHAR AS device_type, NULL::VARCHAR AS ad_format, 'hourly' AS grain FROM ({snapshot(HOURLY)})"""
    q["dash_daily_revenue"] = f"""WITH {KPI_DAILY}
SELECT "date", round(sum(total_revenue_usd)+1.234567e-9,6) AS total_revenue_usd FROM kpi_daily GROUP BY 1"""
    q["dash_fill_by_placement"] = f"""WITH {KPI_DAILY}
SELECT placement_type, round(avg(fill_rate)+1.234567e-9,6) AS fill_rate FROM kpi_daily GROUP BY 1"""

    # Auction analyses
    spreads = ", ".join(
        [
            "round(avg(bid_spread)+1e-9,4) AS mean_spread",
            f"round({quantile(0.5, 'bid_spread')}+1e-9,4) AS median_spread",
            f"round({quantile(0.1, 'bid_spread')}+1e-9,4) AS p10_spread",
            f"round({quantile(0.9, 'bid_spread')}+1e-9,4) AS p90_spread",
            "round(stddev_samp(bid_spread)+1e-9,4) AS std_spread",
            "count(bid_spread) AS n_auctions",
        ]
    )
    q["bid_spread_summary"] = (
        f"WITH {AUCTIONS} SELECT placement_type, {spreads} FROM a WHERE filled = 1 GROUP BY 1"
    )
    q["bid_spread_over_time"] = f"""WITH {AUCTIONS},
w AS (SELECT {bin_of('D')} AS b, avg(bid_spread) AS m, {quantile(0.5, 'bid_spread')} AS p, stddev_samp(bid_spread) AS s,
  count(bid_spread) AS n FROM a WHERE filled = 1 GROUP BY 1),
sp AS {spine('w', 'D')}
SELECT sp.b AS "timestamp", round(m+1e-9,4) AS avg_spread, round(p+1e-9,4) AS p50_spread, round(s+1e-9,4) AS std_spread,
  coalesce(n,0) AS n_auctions FROM sp LEFT JOIN w ON sp.b = w.b"""
    q["depth_by_bucket"] = f"""WITH {AUCTIONS},
d AS (SELECT *, CASE WHEN auction_depth <= 0 THEN NULL WHEN auction_depth <= 2 THEN '2' WHEN auction_depth <= 4 THEN '3-4'
  WHEN auction_depth <= 6 THEN '5-6' WHEN auction_depth <= 8 THEN '7-8' WHEN auction_depth <= 100 THEN '9+' END
  AS depth_bucket FROM a)
SELECT depth_bucket, count(auction_id) AS n_auctions, round(avg(filled)+1e-9,4) AS fill_rate, round(avg(ecpm),4) AS avg_ecpm,
  round(avg(winning_bid_usd),4) AS avg_winning_bid, round(avg(bid_spread)+1e-9,4) AS avg_bid_spread
FROM d WHERE depth_bucket IS NOT NULL GROUP BY 1"""
    q["depth_summary"] = f"""WITH {AUCTIONS}
SELECT round(avg(auction_depth)+1.234567e-9,6) AS mean_depth, {quantile(0.5, 'auction_depth')} AS median_depth,
  {quantile(0.25, 'auction_depth')} AS p25_depth, {quantile(0.75, 'auction_depth')} AS p75_depth FROM a"""
    q["depth_distribution"] = f"WITH {AUCTIONS} SELECT auction_depth, count(*) AS n_auctions FROM a GROUP BY 1"
    q["fill_rate_analysis"] = f"""WITH {AUCTIONS}
SELECT placement_type, device_type, ad_format, count(auction_id) AS n_auctions, round(avg(filled)+1e-9,4) AS fill_rate,
  round(avg(bid_floor_usd),4) AS avg_floor_usd, round(avg(winning_bid_usd),4) AS avg_winning_bid,
  round(sum(revenue_usd),4) AS revenue_usd FROM a GROUP BY 1,2,3"""
    for freq, name in (("D", "fill_rate_over_time"), ("W", "fill_rate_over_time_weekly")):
        q[name] = f"""WITH {AUCTIONS},
w AS (SELECT {bin_of(freq)} AS b, avg(filled) AS f, count(filled) AS n FROM a GROUP BY 1), sp AS {spine('w', freq)}
SELECT sp.b AS "timestamp", round(f+1e-9,4) AS fill_rate, coalesce(n,0) AS n_auctions FROM sp LEFT JOIN w ON sp.b = w.b"""
    q["ecpm_percentiles"] = f"""WITH {AUCTIONS}
SELECT placement_type, ad_format, round({quantile(0.25, 'ecpm')}+1e-9,2) AS p25, round({quantile(0.5, 'ecpm')}+1e-9,2) AS p50,
  round({quantile(0.75, 'ecpm')}+1e-9,2) AS p75, round({quantile(0.95, 'ecpm')}+1e-9,2) AS p95, round(avg(ecpm)+1e-9,2) AS mean,
  count(ecpm) AS n FROM a WHERE filled = 1 GROUP BY 1,2"""
    q["floor_change"] = floor_changes([0.8, 0.9, 1.0, 1.1, 1.25], None)
    q["floor_change_placement"] = floor_changes([1.1], "top_of_search")
    q["format_change"] = f"""WITH {AUCTIONS}
SELECT 'second_price' AS from_format, 'first_price' AS to_format, round(sum(clearing_price_usd),2) AS baseline_revenue_usd,
  round(sum(winning_bid_usd),2) AS simulated_revenue_usd,
  round((sum(winning_bid_usd)/sum(clearing_price_usd) - 1)*100,2) AS revenue_lift_pct,
  round(avg(bid_spread)+1e-9,4) AS avg_bid_spread,
  'First-price auctions incentivize bid-shading; actual lift will be lower as advertisers adjust bids.' AS note
FROM a WHERE filled = 1"""
    q["did_fill_rate"] = did("fill_rate", "filled")
    q["did_ecpm"] = did("ecpm", "ecpm")
    q["did_revenue"] = did("revenue", "revenue_usd")
    q["dash_did_cells"] = did("ecpm", "ecpm", "cells")
    q["adoption_curve"] = f"""WITH {AUCTIONS},
w AS (SELECT {bin_of('D')} AS b, avg(treatment) AS r, count(treatment) AS n FROM a WHERE release_period = 'post' GROUP BY 1),
sp AS {spine('w', 'D')}
SELECT sp.b AS period, round(r+1e-9,4) AS adoption_rate, coalesce(n,0) AS n_events FROM sp LEFT JOIN w ON sp.b = w.b"""

    # Supply analyses
    q["inventory_health"] = f"""WITH {SUPPLY}
SELECT placement_type, device_type, count(supply_event_id) AS total_supply_events,
  round(avg(fill_rate)+1e-9,4) AS avg_fill_rate, round(avg(available_slots)+1e-9,4) AS avg_available_slots,
  round(avg(monetized_slots)+1e-9,4) AS avg_monetized_slots, round(avg(floor_price_usd)+1e-9,4) AS avg_floor_price,
  round(avg(supply_health)+1e-9,4) AS avg_supply_health, round({quantile(0.5, 'fill_rate')}+1e-9,4) AS p50_fill_rate,
  round({quantile(0.1, 'fill_rate')}+1e-9,4) AS p10_fill_rate FROM s GROUP BY 1,2"""
    q["supply_demand_balance"] = f"""WITH {AUCTIONS}, {SUPPLY},
o AS (SELECT "date", placement_type, count(*) AS supply_events, CAST(sum(available_slots) AS BIGINT) AS available_slots,
  sum(monetized_slots) AS monetized_slots FROM s GROUP BY 1,2),
r AS (SELECT "date", placement_type, count(*) AS auction_requests, CAST(sum(filled) AS BIGINT) AS filled_requests,
  sum(revenue_usd) AS revenue_usd FROM a GROUP BY 1,2)
SELECT "date", placement_type, supply_events, available_slots, round(monetized_slots+1.234567e-9,6) AS monetized_slots,
  auction_requests, filled_requests, round(revenue_usd+1.234567e-9,6) AS revenue_usd,
  round(filled_requests/nullif(auction_requests,0)+1e-9,4) AS fill_rate,
  round(revenue_usd/nullif(available_slots,0)+1e-9,4) AS monetization_rate,
  round(auction_requests/nullif(supply_events,0)+1e-9,2) AS demand_supply_ratio
FROM o FULL JOIN r USING ("date", placement_type)"""
    q["floor_sensitivity"] = f"""WITH {AUCTIONS},
x AS (SELECT * FROM a WHERE placement_type = 'top_of_search'),
ends AS (SELECT min(bid_floor_usd) AS lo, {quantile(0.95, 'bid_floor_usd')} AS hi FROM x),
fl AS (SELECT i, CASE WHEN i = 49 THEN hi ELSE lo + i*((hi - lo)/49) END AS f FROM ends, range(50) t(i)),
c AS (SELECT i, f, avg(CAST(winning_bid_usd >= f AS INT)) AS fill,
  avg(clearing_price_usd) FILTER (winning_bid_usd >= f) * avg(CAST(winning_bid_usd >= f AS INT)) AS rev
  FROM fl, x GROUP BY i, f),
r AS (SELECT i, round(f,4) AS floor_usd, round(fill+1e-9,4) AS fill_rate, round(rev,6) AS expected_rev_per_auction FROM c)
SELECT floor_usd, fill_rate, expected_rev_per_auction,
  row_number() OVER (ORDER BY expected_rev_per_auction DESC NULLS LAST, i) = 1 AS is_optimal_floor,
  'top_of_search' AS placement_type FROM r"""
    q["supply_trend"] = f"""WITH {SUPPLY},
w AS (SELECT {bin_of('W')} AS b, count(*) AS n, round(avg(fill_rate)+1e-9,4) AS fr,
  round(avg(available_slots)+1e-9,4) AS sl, round(avg(floor_price_usd)+1e-9,4) AS fp FROM s GROUP BY 1),
sp AS {spine('w', 'W')}
SELECT sp.b AS "timestamp", coalesce(n,0) AS supply_events, fr AS avg_fill_rate, sl AS avg_available_slots,
  fp AS avg_floor_price,
  round(avg(fr) OVER (ORDER BY sp.b ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)+1e-9,4) AS fill_rate_rolling
FROM sp LEFT JOIN w ON sp.b = w.b"""
    q["ad_load"] = f"""WITH {SUPPLY}
SELECT placement_type, round(avg(available_slots)+1e-9,2) AS avg_ad_load, median(available_slots) AS median_ad_load,
  max(available_slots) AS max_ad_load, round(stddev_samp(available_slots),2) AS std_ad_load FROM s GROUP BY 1"""
    q["ad_load_overall"] = f"""WITH {SUPPLY}
SELECT round(avg(available_slots)+1e-9,2) AS overall_avg_load,
  CAST(trunc({quantile(0.5, 'page_load_ms')}) AS INT) AS page_load_p50_ms,
  CAST(trunc({quantile(0.95, 'page_load_ms')}) AS INT) AS page_load_p95_ms FROM s"""

    # Warehouse queries
    margin = "winning_bid_usd - clearing_price_usd"
    q["q_depth_distribution"] = f"""WITH {AUCTIONS},
g AS (SELECT placement_type, auction_depth, count(*) AS n_auctions, round(avg(filled)+1e-9,4) AS fill_rate,
  round(avg(ecpm)+1e-9,2) AS avg_ecpm, round(avg(winning_bid_usd)+1e-9,4) AS avg_winning_bid,
  round(avg(clearing_price_usd)+1e-9,4) AS avg_clearing_price, round(avg(bid_spread)+1e-9,4) AS avg_bid_spread,
  round(sum(revenue_usd),2) AS total_revenue FROM a GROUP BY 1,2)
SELECT *, round(100e0*n_auctions/sum(n_auctions) OVER (PARTITION BY placement_type),2) AS pct_of_placement FROM g"""
    q["q_depth_buckets"] = f"""WITH {AUCTIONS},
d AS (SELECT "date", placement_type, round(avg(filled),4) AS fill FROM a GROUP BY 1,2)
SELECT placement_type, CASE WHEN auction_depth <= 2 THEN 'low (1-2)' WHEN auction_depth <= 4 THEN 'medium (3-4)'
  WHEN auction_depth <= 6 THEN 'high (5-6)' WHEN auction_depth <= 8 THEN 'very_high (7-8)' ELSE 'extreme (9+)' END
  AS depth_bucket, count(*) AS n_auctions, round(avg(fill)+1e-9,4) AS avg_fill_rate, round(avg(ecpm)+1e-9,2) AS avg_ecpm,
  round(avg(bid_spread)+1e-9,4) AS avg_bid_spread
FROM a LEFT JOIN d USING ("date", placement_type) GROUP BY 1,2"""
    q["q_depth_trend"] = f"""WITH {AUCTIONS}
SELECT "date", placement_type, round(avg(auction_depth)+1e-9,2) AS avg_depth, round(avg(filled)+1e-9,4) AS fill_rate,
  round(avg(ecpm)+1e-9,2) AS avg_ecpm, count(*) AS n_auctions FROM a GROUP BY 1,2"""
    q["q_depth_elasticity"] = f"""WITH {AUCTIONS},
g AS (SELECT auction_depth, round(avg(ecpm)+1e-9,4) AS avg_ecpm, count(*) AS n_auctions FROM a WHERE filled = 1
  GROUP BY 1 HAVING count(*) >= 50)
SELECT *, round(avg_ecpm - lag(avg_ecpm) OVER (ORDER BY auction_depth),4) AS ecpm_marginal_gain FROM g"""
    q["q_spread_summary"] = f"""WITH {AUCTIONS}
SELECT placement_type, count(*) AS n_auctions, round(avg(bid_spread)+1e-9,4) AS mean_spread,
  round({quantile(0.5, 'bid_spread')}+1e-9,4) AS median_spread, min(bid_spread) AS min_spread, max(bid_spread) AS max_spread,
  round(avg({margin}),4) AS avg_margin_usd, round(sum({margin}),2) AS total_advertiser_surplus
FROM a WHERE filled = 1 GROUP BY 1"""
    q["q_spread_format_device"] = f"""WITH {AUCTIONS}
SELECT ad_format, device_type, count(*) AS n_auctions, round(avg(bid_spread)+1e-9,4) AS avg_spread,
  round(avg(ecpm)+1e-9,2) AS avg_ecpm, round(avg(auction_depth)+1e-9,2) AS avg_depth,
  round(sum({margin}),2) AS total_advertiser_surplus_usd FROM a WHERE filled = 1 GROUP BY 1,2"""
    q["q_spread_trend"] = f"""WITH {AUCTIONS}
SELECT "date", round(avg(bid_spread)+1e-9,4) AS avg_spread, round(avg(winning_bid_usd)+1e-9,4) AS avg_winning_bid,
  round(avg(clearing_price_usd)+1e-9,4) AS avg_clearing_price, count(*) AS n_filled_auctions
FROM a WHERE filled = 1 GROUP BY 1"""
    q["q_spread_deciles"] = f"""WITH {AUCTIONS},
r AS (SELECT bid_spread, {margin} AS m, ntile(10) OVER (ORDER BY bid_spread DESC, auction_id) AS t FROM a WHERE filled = 1)
SELECT CAST(t AS INT) AS spread_decile, count(*) AS n_auctions, round(avg(bid_spread)+1e-9,4) AS avg_spread,
  round(sum(m),2) AS total_surplus_usd, round(100e0*sum(m)/sum(sum(m)) OVER (),2) AS pct_total_surplus
FROM r GROUP BY t"""
    q["q_fill_heatmap"] = f"""WITH {AUCTIONS}
SELECT placement_type, device_type, count(*) AS total_requests, CAST(sum(filled) AS BIGINT) AS filled_requests,
  round(100e0*avg(filled)+1e-9,2) AS fill_rate_pct, round(avg(bid_floor_usd)+1e-9,4) AS avg_floor_usd,
  round(avg(winning_bid_usd)+1e-9,4) AS avg_winning_bid, round(avg(ecpm) FILTER (filled = 1)+1e-9,2) AS avg_filled_ecpm,
  round(sum(revenue_usd),2) AS total_revenue_usd FROM a GROUP BY 1,2"""
    q["q_unfilled"] = f"""WITH {AUCTIONS}
SELECT placement_type, count(*) AS unfilled_auctions, round(avg(bid_floor_usd)+1e-9,4) AS avg_floor_usd,
  round(avg(winning_bid_usd)+1e-9,4) AS avg_bid_below_floor,
  round(avg(bid_floor_usd - winning_bid_usd)+1e-9,4) AS avg_shortfall_usd,
  round(100e0*count(*) FILTER (winning_bid_usd < bid_floor_usd)/count(*),2) AS pct_below_floor
FROM a WHERE filled = 0 GROUP BY 1"""
    q["q_fill_rolling"] = f"""WITH {AUCTIONS},
g AS (SELECT "date", round(avg(filled)+1e-9,4) AS fill_rate, count(*) AS n_auctions FROM a GROUP BY 1)
SELECT *, round(avg(fill_rate) OVER (ORDER BY "date" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)+1e-9,4)
  AS rolling_7d_fill_rate FROM g"""
    q["q_floor_buckets"] = f"""WITH {AUCTIONS},
g AS (SELECT placement_type, round(bid_floor_usd*20)/20 AS floor_bucket, count(*) AS n_auctions,
  round(avg(filled)+1e-9,4) AS fill_rate, round(sum(revenue_usd),2) AS revenue_usd FROM a GROUP BY 1,2 HAVING count(*) >= 100)
SELECT *, round(revenue_usd/n_auctions+1e-9,4) AS rev_per_request FROM g"""
    q["q_hourly_imbalance"] = f"""WITH {AUCTIONS}
SELECT "hour", count(*) AS n_requests, round(avg(filled)+1e-9,4) AS fill_rate, round(avg(auction_depth)+1e-9,2) AS avg_depth,
  round(avg(ecpm)+1e-9,2) AS avg_ecpm, round(sum(revenue_usd),2) AS hourly_revenue FROM a GROUP BY 1"""
    lines = []
    for kpi, agg, digits in (
        ("fill_rate", "avg", 4),
        ("avg_ecpm", "avg", 2),
        ("avg_bid_spread", "avg", 4),
        ("ctr", "avg", 4),
        ("total_revenue_usd", "sum", 2),
    ):
        lines.append(
            f"SELECT '{kpi}' AS kpi, round(n+1e-9,{digits}) AS current_value, round(p+1e-9,{digits}) AS prior_value, "
            f"round(100e0*(n-p)/nullif(p,0),2) AS pct_change FROM (SELECT (SELECT {agg}({kpi}) FROM cur) AS n, "
            f"(SELECT {agg}({kpi}) FROM pri) AS p)"
        )
    q["q_scorecard_30d"] = f"""WITH {KPI_DAILY},
cur AS (SELECT * FROM kpi_daily WHERE "date" >= {AS_OF} - 30),
pri AS (SELECT * FROM kpi_daily WHERE "date" >= {AS_OF} - 60 AND "date" < {AS_OF} - 30)
""" + " UNION ALL ".join(lines)
    q["q_revenue_by_placement"] = f"""WITH {KPI_DAILY}
SELECT placement_type, round(sum(total_revenue_usd)+0,2) AS revenue_usd, round(avg(fill_rate)+1e-9,4) AS avg_fill_rate,
  round(avg(avg_ecpm)+1e-9,2) AS avg_ecpm, CAST(sum(total_auctions) AS BIGINT) AS total_auctions,
  round(avg(avg_bid_spread)+1e-9,4) AS avg_bid_spread,
  round(100e0*sum(total_revenue_usd)/sum(sum(total_revenue_usd)) OVER (),2) AS revenue_share_pct
FROM kpi_daily WHERE "date" >= {AS_OF} - 30 GROUP BY 1"""
    q["q_wow"] = f"""WITH {KPI_DAILY}
SELECT x."date", x.placement_type, round(sum(x.total_revenue_usd),2) AS revenue_usd, round(avg(x.fill_rate)+1e-9,4) AS fill_rate,
  round(avg(x.avg_ecpm)+1e-9,2) AS avg_ecpm, round(sum(y.total_revenue_usd),2) AS revenue_usd_wow,
  round(100e0*(sum(x.total_revenue_usd) - sum(y.total_revenue_usd))/nullif(sum(y.total_revenue_usd),0),2) AS wow_pct_change
FROM kpi_daily x LEFT JOIN kpi_daily y ON x.placement_type = y.placement_type AND x.device_type = y.device_type
  AND x.ad_format = y.ad_format AND y."date" = x."date" - 7 GROUP BY 1,2"""
    q["q_format_performance"] = f"""WITH {KPI_DAILY}
SELECT ad_format, device_type, round(avg(fill_rate)+1e-9,4) AS avg_fill_rate, round(avg(avg_ecpm)+1e-9,2) AS avg_ecpm,
  round(avg(ctr)+1e-9,4) AS avg_ctr, round(avg(cvr)+1e-9,4) AS avg_cvr, round(avg(avg_bid_spread)+1e-9,4) AS avg_bid_spread,
  CAST(sum(total_auctions) AS BIGINT) AS total_auctions, round(sum(total_revenue_usd),2) AS total_revenue
FROM kpi_daily GROUP BY 1,2"""
    q["q_intraday"] = f"""WITH {KPI_HOURLY}
SELECT "hour", placement_type, round(avg(total_revenue_usd)+1e-9,2) AS avg_hourly_revenue,
  round(avg(fill_rate)+1e-9,4) AS avg_fill_rate, round(avg(avg_ecpm)+1e-9,2) AS avg_ecpm,
  CAST(sum(total_auctions) AS BIGINT) AS total_auctions FROM kpi_hourly WHERE "date" >= {AS_OF} - 7 GROUP BY 1,2"""
    q["star_by_tier"] = f"""WITH {AUCTIONS}, {ADVERTISER}
SELECT tier, bidding_strategy, count(DISTINCT advertiser_id) AS n_advertisers, count(*) AS n_auctions,
  round(avg(filled)+1e-9,4) AS fill_rate, round(avg(winning_bid_usd)+1e-9,4) AS avg_winning_bid, round(sum(revenue_usd),2) AS revenue_usd
FROM a LEFT JOIN dim_advertiser USING (advertiser_id) GROUP BY 1,2"""

    q["star_by_campaign"] = f"""WITH {AUCTIONS}, {ADVERTISER}, {CAMPAIGN},
c AS (SELECT campaign_id, count(*) AS n, sum(filled) AS fills, sum(clicked) AS clicks, sum(revenue_usd) AS revenue,
  count(DISTINCT "date") AS days FROM a GROUP BY 1)
SELECT tier, d.ad_format AS campaign_format, count(*) AS n_campaigns, CAST(sum(n) AS BIGINT) AS n_auctions,
  round(sum(fills)/sum(n)+1e-9,4) AS fill_rate, round(sum(clicks)/sum(fills)+1e-9,4) AS ctr, round(sum(revenue),2) AS revenue_usd,
  round(sum(revenue)/sum(d.daily_budget_usd*days)+1e-9,6) AS budget_use
FROM c LEFT JOIN dim_campaign d USING (campaign_id) LEFT JOIN dim_advertiser v ON v.advertiser_id = d.advertiser_id GROUP BY 1,2"""

    # Detectors
    q["detect_zscore"] = f"""WITH {AUCTIONS}
SELECT auction_id, round(winning_bid_usd,9) AS winning_bid_usd, coalesce(abs((winning_bid_usd - avg(winning_bid_usd) OVER ())
  /nullif(stddev_samp(winning_bid_usd) OVER (),0)) > 2.5, false) AS is_anomaly FROM a"""
    q["detect_iqr"] = f"""WITH {AUCTIONS},
qs AS (SELECT {quantile(0.25, 'ecpm')} AS q1, {quantile(0.75, 'ecpm')} AS q3 FROM a)
SELECT auction_id, round(ecpm,9) AS ecpm, ecpm < q1 - 2*(q3-q1) OR ecpm > q3 + 2*(q3-q1) AS is_anomaly FROM a, qs"""
    q["detect_zscore_keyed"] = f"""WITH {AUCTIONS}
SELECT auction_id, placement_type, coalesce(abs((winning_bid_usd - avg(winning_bid_usd) OVER k)
  /nullif(stddev_samp(winning_bid_usd) OVER k,0)) > 2.5, false) AS is_anomaly FROM a WINDOW k AS (PARTITION BY placement_type)"""
    q["scan_kpis"] = scan("zscore")
    q["scan_kpis_iqr"] = scan("iqr")
    q["bid_baselines"] = f"""WITH {AUCTIONS}, {BASELINES}
SELECT placement_type, round(mean+1.234567e-9,6) AS mean, round(std+1.234567e-9,6) AS std, round(p99+1.234567e-9,6) AS p99 FROM base"""
    q["bid_anomaly_scores"] = f"""WITH {AUCTIONS}, {BASELINES}
SELECT auction_id, placement_type, round(winning_bid_usd,9) AS winning_bid_usd, round(z + 1e-10,3) + 0e0 AS bid_z_score,
  coalesce(abs(z) > 3, false) AS bid_is_anomaly FROM scored"""
    q["top_bid_anomalies"] = f"""WITH {AUCTIONS}, {BASELINES}
SELECT auction_id, placement_type, device_type, round(winning_bid_usd,9) AS winning_bid_usd,
  round(bid_floor_usd,9) AS bid_floor_usd, round(z + 1e-10,3) + 0e0 AS bid_z_score FROM scored WHERE abs(z) > 3
ORDER BY round(z + 1e-10,3) + 0e0 DESC, auction_id LIMIT 15"""
    q["dash_bid_anomaly_share"] = f"""WITH {AUCTIONS}, {BASELINES}
SELECT count(*) FILTER (abs(z) > 3) AS n_anomalies, count(*) AS n_auctions,
  round(count(*) FILTER (abs(z) > 3)/count(*),6) AS anomaly_share FROM scored"""
    q["dash_score_histogram"] = f"""WITH {ENRICHED},
x AS (SELECT bid_z_score AS x FROM e WHERE bid_z_score IS NOT NULL),
span AS (SELECT min(x) AS low, (max(x) - min(x))/40 AS width FROM x),
c AS (SELECT CAST(least(coalesce(floor((x - low)/nullif(width,0)),0),39) + 1 AS INT) AS bin, count(*) AS n FROM x, span GROUP BY 1)
SELECT CAST(i AS INT) AS bin, round(low + (i-1)*width,6) AS from_score, round(low + i*width,6) AS to_score,
  coalesce(n,0) AS n_rows FROM span, range(1,41) t(i) LEFT JOIN c ON c.bin = i"""
    q["bid_rolling_baseline"] = f"""WITH {AUCTIONS}
SELECT auction_id, placement_type, round(avg(winning_bid_usd) OVER k+1.234567e-9,6) AS rolling_mean,
  round(stddev_samp(winning_bid_usd) OVER k+1.234567e-9,6) AS rolling_std FROM a
WINDOW k AS (PARTITION BY placement_type ORDER BY "timestamp", auction_id ROWS BETWEEN 1000 PRECEDING AND 1 PRECEDING)"""
    q["bid_rolling_flags"] = f"""WITH {AUCTIONS},
r AS (SELECT auction_id, winning_bid_usd AS bid, avg(winning_bid_usd) OVER k AS m, stddev_samp(winning_bid_usd) OVER k AS s FROM a
  WINDOW k AS (PARTITION BY placement_type ORDER BY "timestamp", auction_id ROWS BETWEEN 1000 PRECEDING AND 1 PRECEDING))
SELECT auction_id, round(m + 3e0*s+1.234567e-9,6) AS rolling_limit,
  coalesce(abs((bid - m)/nullif(s,0)) > 3e0, false) AS is_rolling_anomaly FROM r"""
    q["stream_rolling_flags"] = q["bid_rolling_flags"]
    features = ["winning_bid_usd", "clearing_price_usd", "bid_spread", "ecpm", "auction_depth", "bid_floor_usd"]
    q["iforest_training"] = f"WITH {AUCTIONS} " + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(quantile_cont(CAST({f} AS DOUBLE), 0.5)+1.234567e-9,6) AS median, "
        f"round(avg({f})+1.234567e-9,6) AS mean, round(stddev_pop({f})+1.234567e-9,6) AS std FROM a"
        for f in features
    )
    q["iforest_flag_rate"] = f"""WITH {forest()}
SELECT count(*) AS n_auctions, count(*) FILTER (is_anomaly) AS n_anomalies, round(count(*) FILTER (is_anomaly)/count(*),4) AS anomaly_rate
FROM f"""
    q["iforest_scores"] = q["iforest_scores_native"] = f"WITH {forest()} SELECT auction_id, anomaly_score, is_anomaly FROM f"
    q["tree_table_scores"] = f"""WITH {RAW}
SELECT auction_id, CASE WHEN winning_bid_usd <= 1.25 THEN 0.5 ELSE -0.25 END::DOUBLE
  + CASE WHEN auction_depth <= 4 THEN CASE WHEN bid_floor_usd <= 0.4 THEN 1 ELSE 2 END
    ELSE CASE WHEN winning_bid_usd <= 2.0 THEN 4 ELSE 8 END END + 16 AS tree_sum FROM raw"""
    q["iforest_summary"] = f"""WITH {forest()}
SELECT placement_type, device_type, count(auction_id) AS total, count(*) FILTER (is_anomaly) AS anomalies,
  round(count(*) FILTER (is_anomaly)/count(*)+1e-9,4) AS anomaly_rate, round(avg(anomaly_score)+1e-9,4) AS avg_anomaly_score
FROM f GROUP BY 1, 2"""
    q["top_anomalies"] = f"""WITH {forest()}
SELECT auction_id, placement_type, device_type, winning_bid_usd, ecpm, bid_spread, anomaly_score FROM f WHERE is_anomaly
ORDER BY anomaly_score DESC, auction_id LIMIT 20"""
    q["anomaly_union"] = f"""WITH {forest()},
st AS (SELECT placement_type, avg(winning_bid_usd) AS m, stddev_samp(winning_bid_usd) AS s FROM a GROUP BY 1),
b AS (SELECT f.*, coalesce(abs((winning_bid_usd - m)/greatest(s, 1e-9)) > 3, false) AS by_bid FROM f LEFT JOIN st USING (placement_type))
SELECT auction_id, is_anomaly AS by_forest, by_bid AS by_bid_monitor FROM b WHERE is_anomaly OR by_bid"""
    q["fill_hold_out"] = f"""WITH {RAW}
SELECT filled, count(*) AS n_rows, CAST(floor(2e-1*(count(*) - 1)) AS BIGINT) + 1 AS n_test FROM raw GROUP BY 1"""
    q["ranking_metrics"] = f"""WITH {AUCTIONS},
g AS (SELECT round(winning_bid_usd,3) AS score, sum(filled) AS h, count(*) AS n FROM a GROUP BY 1),
c AS (SELECT *, sum(h) OVER k AS ha, sum(n) OVER k AS na FROM g WINDOW k AS (ORDER BY score DESC)),
t AS (SELECT sum(h) AS hits, sum(n) AS total, sum((n-h)*(ha - h + h/2)) AS won, sum(h*ha/na) AS prec FROM c)
SELECT round(won/(CAST(hits AS DOUBLE)*(total-hits)),4) AS roc_auc, round(prec/hits,4) AS avg_precision,
  CAST(total AS BIGINT) AS test_samples, round(hits/total,4) AS positive_rate FROM t"""

    # Sources and sinks
    q["scan_csv"] = f"""WITH {RAW}
SELECT auction_id, "timestamp", "date", "hour", placement_type, device_type, ad_format, category, campaign_id, advertiser_id,
  auction_depth, round(bid_floor_usd,9) AS bid_floor_usd, round(winning_bid_usd,9) AS winning_bid_usd,
  round(clearing_price_usd,9) AS clearing_price_usd, round(ecpm,9) AS ecpm, filled, clicked, converted,
  round(revenue_usd,9) AS revenue_usd, release_period, treatment,
  CASE WHEN treatment = 1 THEN 'v2.0' ELSE 'v1.0' END AS feature_version FROM raw"""
    q["sql_param_scan"] = f"""WITH {RAW}
SELECT auction_id, placement_type, "date", round(winning_bid_usd,9) AS winning_bid_usd FROM raw
WHERE placement_type = 'off_amazon' AND auction_depth >= 8 AND "date" >= date '2024-02-01'"""
    q["sink_append_counts"] = f"""WITH {SUPPLY_RAW}
SELECT count(*) AS rows_replaced, count(*) AS rows_appended, 2*count(*) AS rows_in_table,
  CAST(2*sum(available_slots) AS BIGINT) AS available_slots FROM sraw"""
    counts = (
        "SELECT 'dim_advertiser' AS \"table\", count(*) AS {n} FROM dim_advertiser UNION ALL "
        "SELECT 'dim_campaign', count(*) FROM dim_campaign UNION ALL SELECT 'fact_supply', count(*) FROM sraw"
    )
    q["table_info"] = f"WITH {SUPPLY_RAW}, {ADVERTISER}, {CAMPAIGN} {counts.format(n='row_count')}"
    q["warehouse_summary"] = f"WITH {SUPPLY_RAW}, {ADVERTISER}, {CAMPAIGN} {counts.format(n='rows')}"
    q["etl_row_counts"] = f"""WITH {RAW}, {SUPPLY_RAW}, {ADVERTISER}, {CAMPAIGN} {counts.format(n='row_count')}
UNION ALL SELECT 'fact_auctions', count(*) FROM raw
UNION ALL SELECT 'kpi_daily', count(*) FROM (SELECT DISTINCT "date", placement_type, device_type, ad_format FROM raw)
UNION ALL SELECT 'kpi_hourly', count(*) FROM (SELECT DISTINCT "date", "hour", placement_type FROM raw)"""
    q["etl_kpi_daily"] = q["etl_incremental"] = q["kpi_daily"]
    q["etl_incremental_facts"] = q["auctions_enriched"]
    apart = "placement_type = 'off_amazon'"
    whole = 'count(DISTINCT "date") AS n_dates FROM sraw'
    fault = "CAST(supply_event_id AS BIGINT) % 50"
    q["csv_quarantine"] = f"""WITH {SUPPLY_RAW},
x AS (SELECT CASE {fault} WHEN 1 THEN 'unreadable available_slots' WHEN 2 THEN 'unreadable available_slots' WHEN 3 THEN 'fill_rate_0_1'
    WHEN 4 THEN 'fill_rate_0_1, unreadable available_slots' WHEN 5 THEN 'placement_type_not_null' ELSE 'accepted' END AS outcome,
  CASE WHEN {fault} NOT IN (1, 2, 4) THEN available_slots END AS available_slots FROM sraw)
SELECT outcome, count(*) AS n_rows, CAST(sum(available_slots) AS BIGINT) AS available_slots FROM x GROUP BY 1"""
    q["table_versions"] = f"""WITH {SUPPLY_RAW}
SELECT 1::BIGINT AS version, count(*) AS n_rows, sum(available_slots)::BIGINT AS available_slots, {whole} WHERE NOT {apart}
UNION ALL SELECT 2, count(*), sum(available_slots)::BIGINT, {whole}
UNION ALL SELECT 3, count(*), (sum(available_slots) + count(*) FILTER ({apart}))::BIGINT, {whole}
UNION ALL SELECT 4, count(*), sum(available_slots)::BIGINT, {whole} WHERE {apart}"""
    advertiser_columns = (
        "tier, category, {budget} AS daily_budget_usd, bidding_strategy, round(target_cpc_usd,9) AS target_cpc_usd, "
        "round(quality_score,9) AS quality_score, round(identity_match_rate,9) AS identity_match_rate"
    )
    plain = advertiser_columns.format(budget="round(daily_budget_usd,9)")
    raised = advertiser_columns.format(
        budget="round(CASE WHEN tier = 'small' THEN daily_budget_usd*2 ELSE daily_budget_usd END,9)"
    )
    q["upsert_merge"] = f"""WITH {ADVERTISER}
SELECT advertiser_id, {raised} FROM dim_advertiser
UNION ALL SELECT advertiser_id || '-2', {plain} FROM dim_advertiser WHERE tier = 'enterprise'"""
    q["upsert_partitioned"] = f"""WITH {SUPPLY_RAW},
f AS (SELECT min("date") AS first FROM sraw)
SELECT supply_event_id, placement_type, CAST(available_slots + ("date" = first)::INT AS INT) AS available_slots, "date" FROM sraw, f
UNION ALL SELECT supply_event_id || '-2', placement_type, CAST(available_slots + 1 AS INT), "date" FROM sraw, f WHERE "date" = first"""

    # Streams
    q["kpi_5min"] = q["stream_kpi_5min"] = windowed_kpis(5)
    q["kpi_alerts_consecutive"] = q["stream_alerts_consecutive"] = q["stream_alerts_live"] = consecutive_alerts(5)
    q["stream_bid_scores"] = q["bid_anomaly_scores"]

    # Quality and dimensions
    derived = f"""WITH {RAW}, {SUPPLY_RAW}, {ADVERTISER}, {CAMPAIGN},
kd AS (SELECT DISTINCT "date", placement_type, device_type, ad_format FROM raw),
kh AS (SELECT DISTINCT "date", "hour", placement_type FROM raw),
dd AS (SELECT d AS date_key, year(d) AS "year", quarter(d) AS "quarter", month(d) AS "month", week(d) AS week,
  dayname(d) AS day_of_week, CAST(isodow(d) >= 6 AS INT) AS is_weekend, 0 AS is_holiday FROM (
  SELECT CAST(unnest(generate_series((SELECT min("date") FROM raw), (SELECT max("date") FROM raw), INTERVAL 1 DAY)) AS DATE) AS d)),
dp AS (SELECT DISTINCT placement_type || '|' || device_type AS placement_key, placement_type, device_type FROM raw) """
    q["dq_checks"] = derived + DQ_RULES
    q["dq_keys_after_append"] = q["dq_append_by_filters"] = derived + primary_key(
        "kpi_daily",
        """(SELECT * FROM kd UNION ALL SELECT * FROM kd WHERE "date" < DATE '2024-01-08')""",
        ["date", "placement_type", "device_type", "ad_format"],
    )
    # Only keys of the append are reported, so a key counts where the append has it.
    q["dq_fact_append_by_filters"] = f"""WITH {RAW},
old AS (SELECT auction_id, count(*) AS held FROM raw GROUP BY 1),
new AS (SELECT CASE WHEN "date" < DATE '2024-01-08' THEN auction_id WHEN "hour" > 0 THEN 'new-' || auction_id END AS auction_id FROM raw),
n AS (SELECT auction_id, count(*) AS n FROM new GROUP BY 1),
b AS (SELECT n.auction_id, n.n, n.n + coalesce(held, 0) AS total FROM n LEFT JOIN old ON n.auction_id = old.auction_id)
SELECT 'fact_auctions' AS table_name, 'auction_id' AS key_columns,
  count(*) FILTER (auction_id IS NOT NULL AND total > 1) AS repeated_keys,
  CAST(coalesce(sum(total) FILTER (auction_id IS NOT NULL AND total > 1), 0) AS BIGINT) AS rows_with_repeated_key,
  CAST(coalesce(sum(n) FILTER (auction_id IS NULL), 0) AS BIGINT) AS rows_without_key FROM b"""
    q["dq_primary_keys"] = derived + " UNION ALL ".join(
        [
            primary_key("dim_advertiser", "dim_advertiser", ["advertiser_id"]),
            primary_key("dim_campaign", "dim_campaign", ["campaign_id"]),
            primary_key("dim_date", "dd", ["date_key"]),
            primary_key("dim_placement", "dp", ["placement_key"]),
            primary_key("fact_auctions", "raw", ["auction_id"]),
            primary_key("fact_supply", "sraw", ["supply_event_id"]),
            primary_key("kpi_daily", "kd", ["date", "placement_type", "device_type", "ad_format"]),
            primary_key("kpi_hourly", "kh", ["date", "hour", "placement_type"]),
        ]
    )
    q["dq_orphans"] = f"WITH {RAW}, {ADVERTISER}, {CAMPAIGN} " + " UNION ALL ".join(
        [
            orphans("dim_campaign", "dim_campaign", "advertiser_id", "dim_advertiser"),
            orphans("fact_auctions", "raw", "campaign_id", "dim_campaign"),
            orphans("fact_auctions", "raw", "advertiser_id", "dim_advertiser"),
        ]
    )
    q["dim_date"] = f"""WITH {RAW},
d AS (SELECT CAST(unnest(generate_series((SELECT min("date") FROM raw), (SELECT max("date") FROM raw), INTERVAL 1 DAY)) AS DATE) AS d)
SELECT d AS date_key, CAST(year(d) AS INT) AS "year", CAST(quarter(d) AS INT) AS "quarter", CAST(month(d) AS INT) AS "month",
  CAST(week(d) AS INT) AS week, dayname(d) AS day_of_week, CAST(isodow(d) >= 6 AS INT) AS is_weekend, 0 AS is_holiday FROM d"""
    q["dim_placement"] = f"""WITH {RAW}
SELECT placement_type || '|' || device_type AS placement_key, placement_type, device_type,
  round(avg(bid_floor_usd),4) AS floor_price_usd,
  CAST(to_json(list_sort(list(DISTINCT ad_format))) AS VARCHAR) AS ad_formats_allowed FROM raw GROUP BY 2,3"""
    q["dim_advertiser"] = f"""WITH {ADVERTISER}
SELECT advertiser_id, tier, category, round(daily_budget_usd,9) AS daily_budget_usd, bidding_strategy,
  round(target_cpc_usd,9) AS target_cpc_usd, round(quality_score,9) AS quality_score,
  round(identity_match_rate,9) AS identity_match_rate FROM dim_advertiser"""
    q["dim_campaign"] = f"""WITH {CAMPAIGN}
SELECT campaign_id, advertiser_id, ad_format, category, round(daily_budget_usd,9) AS daily_budget_usd,
  round(target_bid_usd,9) AS target_bid_usd, round(quality_score,9) AS quality_score,
  round(relevance_score,9) AS relevance_score FROM dim_campaign"""
    return q
