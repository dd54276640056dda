"""DuckDB text for every registered query, written as plain joins over the daily rows.

``BODIES`` reads the six campaign tables by name; ``star_sql`` puts the star-schema shapes of
these tables in front. Money comes back as DOUBLE and dates as text, like the registered queries.
"""

from __future__ import annotations

from promolens.plans.performance import BUDGET_BANDS, TOP_BUDGET_BAND
from promolens.schemas import SPECS

TABLES = {
    "creators": """
        SELECT c_custkey AS creator_id, c_name AS name,
               'u' || (c_custkey - CASE WHEN c_custkey % 50 = 49 THEN 1 ELSE 0 END)
                   || '@example.com' AS email,
               CAST(NULL AS VARCHAR) AS channel_category, 'India' AS country,
               repeat('ab', c_nationkey + 2) AS city,
               DATE '1994-07-01' + CAST(c_custkey % 600 AS INTEGER) AS signup_date,
               c_mktsegment AS plan_type,
               CAST(c_acctbal AS DECIMAL(10,2)) AS monthly_revenue,
               c_acctbal >= 0 AS is_active
        FROM customer""",
    "videos": """
        SELECT p_partkey AS video_id, p_partkey * 3 // 4 + 1 AS creator_id, p_name AS title,
               p_type AS category,
               CASE WHEN p_size < 50 THEN DATE '1994-01-01' + CAST(p_size AS INTEGER) END
                   AS upload_date,
               p_size * 60 AS duration_seconds, (p_size - 1) * 10000 AS baseline_views
        FROM part""",
    "campaigns": """
        SELECT o_orderkey AS campaign_id,
               CASE WHEN o_orderkey % 400 = 33 THEN -o_custkey ELSE o_custkey END AS creator_id,
               CASE WHEN o_orderkey % 300 = 7 THEN -o_orderkey ELSE o_orderkey * 2 // 15 END
                   AS video_id, CAST(o_orderdate AS DATE) AS start_date,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 14 END AS end_date,
               CAST(CAST(FLOOR(o_totalprice / 2) AS BIGINT) * 0.01 AS DECIMAL(10,2)) AS budget_usd,
               o_orderpriority AS campaign_type, CAST(NULL AS VARCHAR) AS target_country,
               o_orderstatus AS target_age_group, 'Active' AS status
        FROM orders""",
    "campaign_daily_metrics": """
        SELECT l_orderkey * 8 + l_linenumber AS metric_id,
               CASE WHEN l_orderkey % 500 = 5 THEN -l_orderkey ELSE l_orderkey END AS campaign_id,
               CAST(o_orderdate AS DATE) + CAST((l_linenumber - 1) * 3 AS INTEGER) AS metric_date,
               CAST(l_quantity AS INTEGER) * (8000 + 500 * l_linenumber) AS impressions,
               CAST(l_quantity AS INTEGER) * 1000 AS views,
               CAST(l_quantity AS INTEGER) * 500 AS clicks,
               CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END
                   AS new_subscribers,
               CAST(l_quantity AS INTEGER) * 150 AS likes,
               CASE WHEN l_discount = 0 THEN CAST(0 AS DECIMAL(10,2))
                    ELSE CAST(CAST(FLOOR(l_extendedprice / 10) AS BIGINT) * 0.01
                              AS DECIMAL(10,2)) END AS spend_usd,
               CAST(l_quantity * 1500 AS DECIMAL(10,2)) AS watch_time_mins
        FROM lineitem LEFT JOIN orders ON o_orderkey =
             CASE WHEN l_orderkey % 500 = 5 THEN -l_orderkey ELSE l_orderkey END""",
    "competitor_benchmarks": """
        SELECT any_value(r_regionkey) * 10000 + ascii(p_type) * 100 + ascii(substr(p_type, 2, 1))
                   AS bench_id,
               r_name AS competitor_name, p_type AS category,
               CAST(ROUND(CAST(CAST(SUM(spend) * 1000000 AS DOUBLE) / SUM(q * (8000 + 500 * ln))
                   AS DECIMAL(24,6)), 2) AS DECIMAL(8,2)) AS avg_cpm_usd,
               CAST(ROUND(CAST(CAST(SUM(q) * 50000 AS DOUBLE) / SUM(q * (8000 + 500 * ln))
                   AS DECIMAL(24,6)), 2) AS DECIMAL(5,2)) AS avg_ctr_pct,
               CAST(ROUND(CAST(CAST(SUM(CASE WHEN flag = 'R' THEN q ELSE 0 END) AS DOUBLE)
                   / (SUM(q) * 10) AS DECIMAL(24,6)), 2) AS DECIMAL(5,2)) AS avg_cvr_pct,
               CAST(ROUND(CAST(CAST(SUM(q) * 50 AS DOUBLE) / CAST(SUM(spend) AS DOUBLE)
                   AS DECIMAL(24,6)), 2) AS DECIMAL(6,2)) AS avg_roas,
               CAST(NULL AS DECIMAL(5,2)) AS market_share_pct,
               DATE '2024-01-01' AS benchmark_month
        FROM (SELECT r_regionkey, r_name, p_type, CAST(l_quantity AS INTEGER) AS q,
                     l_linenumber AS ln, l_returnflag AS flag,
                     CASE WHEN l_discount = 0 THEN CAST(0 AS DECIMAL(10,2))
                          ELSE CAST(CAST(FLOOR(l_extendedprice / 10) AS BIGINT) * 0.01
                                    AS DECIMAL(10,2)) END AS spend
              FROM lineitem JOIN part ON l_partkey = p_partkey
              JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey) sold
        GROUP BY r_name, p_type""",
    "creator_events": """
        SELECT event_id,
               CASE WHEN event_id % 300 = 11 THEN -user_id ELSE user_id END AS creator_id,
               CASE WHEN event_type = 'error' THEN 'churn' ELSE event_type END AS event_type,
               CAST(ts AS DATE) AS event_date, props AS notes
        FROM events""",
}


def _rnd(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(24,6)), {digits}) AS DOUBLE)"


def _div(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


def _pct(num: str, den: str, digits: int = 1) -> str:
    return _rnd(_div(f"({num}) * 100", den), digits)


def _big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def _usd(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def _months(a: str, b: str) -> str:
    whole = f"((year({b}) - year({a})) * 12 + month({b}) - month({a}))"
    return (
        f"CASE WHEN {b} >= {a} THEN {whole} - CASE WHEN day({b}) < day({a}) THEN 1 ELSE 0 END "
        f"ELSE {whole} + CASE WHEN day({b}) > day({a}) THEN 1 ELSE 0 END END"
    )


_PROMOTED = "campaigns AS c JOIN campaign_daily_metrics AS m ON m.campaign_id = c.campaign_id"
_VTR = _rnd("AVG(CAST(m.views AS DOUBLE) / NULLIF(m.impressions, 0) * 100)", 2)
_CPM3 = _rnd(f"{_div('SUM(m.spend_usd)', 'SUM(m.views)')} * 1000", 3)
_CPS = _rnd(_div("SUM(m.spend_usd)", "SUM(m.new_subscribers)"), 2)
_ROW_BUDGET = _rnd(_div("SUM(c.budget_usd)", "COUNT(c.budget_usd)"), 2)


def _q01(upgraded: tuple[str, ...]) -> str:
    plans = ", ".join(f"'{p}'" for p in upgraded)
    return f"""
        SELECT total_signups, ran_one_campaign,
               {_pct('ran_one_campaign', 'total_signups')} AS pct_activated,
               ran_multiple_campaigns,
               {_pct('ran_multiple_campaigns', 'total_signups')} AS pct_repeat,
               upgraded_plan, {_pct('upgraded_plan', 'total_signups')} AS pct_upgraded
        FROM (SELECT
            (SELECT COUNT(DISTINCT creator_id) FROM creators) AS total_signups,
            (SELECT COUNT(DISTINCT creator_id) FROM campaigns) AS ran_one_campaign,
            (SELECT COUNT(*) FROM (SELECT creator_id FROM campaigns
                                   WHERE creator_id IS NOT NULL GROUP BY creator_id
                                   HAVING COUNT(campaign_id) >= 2) AS again)
                AS ran_multiple_campaigns,
            (SELECT COUNT(DISTINCT creator_id) FROM creators WHERE plan_type IN ({plans}))
                AS upgraded_plan) AS stages"""


_Q02 = f"""
    SELECT v.category, COUNT(DISTINCT m.campaign_id) AS total_campaigns,
           {_usd('SUM(m.spend_usd)')} AS total_spend_usd, {_big('SUM(m.views)')} AS total_views,
           {_big('SUM(m.new_subscribers)')} AS total_subscribers,
           {_rnd(f"{_div('SUM(m.spend_usd)', 'SUM(m.views)')} * 1000", 2)} AS cost_per_1000_views,
           {_rnd('CAST(SUM(m.watch_time_mins) AS DOUBLE) / 60', 0)} AS total_watch_hours,
           {_VTR} AS avg_vtr_pct
    FROM {_PROMOTED} JOIN videos AS v ON v.video_id = c.video_id
    GROUP BY v.category"""

def _within(months: int) -> str:
    return f"COUNT(DISTINCT CASE WHEN gap <= {months} THEN creator_id END)"


_Q03 = f"""
    WITH started AS (
        SELECT creator_id, MIN(start_date) AS first_day FROM campaigns GROUP BY creator_id),
    gaps AS (
        SELECT cr.creator_id, strftime(cr.signup_date, '%Y-%m') AS cohort_month,
               {_months('cr.signup_date', 's.first_day')} AS gap
        FROM creators AS cr LEFT JOIN started AS s ON s.creator_id = cr.creator_id)
    SELECT cohort_month, COUNT(DISTINCT creator_id) AS cohort_size,
           {_within(1)} AS retained_m1, {_within(2)} AS retained_m2,
           {_within(3)} AS retained_m3, {_within(6)} AS retained_m6,
           {_pct(_within(1), 'COUNT(DISTINCT creator_id)')} AS pct_m1,
           {_pct(_within(3), 'COUNT(DISTINCT creator_id)')} AS pct_m3
    FROM gaps GROUP BY cohort_month"""

_Q04 = f"""
    WITH scored AS (
        SELECT c.campaign_id, cr.name AS creator_name, v.category, c.campaign_type,
               {_usd('SUM(m.spend_usd)')} AS total_spend_usd,
               {_big('SUM(m.views)')} AS total_views,
               {_big('SUM(m.new_subscribers)')} AS subscribers_gained,
               {_rnd('CAST(SUM(m.views) AS DOUBLE) * CAST(0.0005 AS DOUBLE)', 2)}
                   AS estimated_value_usd,
               {_rnd(_div('CAST(SUM(m.views) AS DOUBLE) * CAST(0.0005 AS DOUBLE)',
                          'SUM(m.spend_usd)'), 2)} AS roas,
               {_CPS} AS cost_per_subscriber_usd
        FROM {_PROMOTED} JOIN creators AS cr ON cr.creator_id = c.creator_id
        JOIN videos AS v ON v.video_id = c.video_id
        GROUP BY c.campaign_id, cr.name, v.category, c.campaign_type)
    SELECT * FROM scored ORDER BY roas DESC NULLS LAST, campaign_id LIMIT 10"""


def _q05(as_of: str) -> str:
    mrr = _div("SUM(monthly_revenue)", "COUNT(monthly_revenue)")
    tenure = _div("SUM(tenure)", "COUNT(tenure)")
    return f"""
        WITH lived AS (
            SELECT plan_type, monthly_revenue,
                   {_months('signup_date', 'last_day')} AS tenure
            FROM (SELECT cr.plan_type, cr.monthly_revenue, cr.signup_date,
                         CASE WHEN cr.is_active THEN DATE '{as_of}'
                              ELSE (SELECT MIN(e.event_date) FROM creator_events AS e
                                    WHERE e.creator_id = cr.creator_id
                                      AND e.event_type = 'churn') END AS last_day
                  FROM creators AS cr) AS spans)
        SELECT plan_type, COUNT(*) AS creator_count,
               {_rnd(mrr, 2)} AS avg_monthly_revenue_usd, {_rnd(tenure, 1)} AS avg_tenure_months,
               {_rnd(f'({mrr}) * ({tenure})', 2)} AS estimated_ltv_usd,
               {_rnd(f'({mrr}) * 12', 2)} AS annualised_arpu_usd
        FROM lived GROUP BY plan_type"""


def _churn(as_of: str, placeholder: bool, as_row: bool = False) -> str:
    latest = "SELECT creator_id, MAX(start_date) AS last_day, MAX(campaign_id) AS last_id FROM campaigns GROUP BY creator_id"
    if as_row:
        latest = """
            SELECT creator_id, start_date AS last_day, campaign_id AS last_id FROM campaigns
            QUALIFY ROW_NUMBER() OVER (
                PARTITION BY creator_id ORDER BY start_date DESC NULLS LAST, campaign_id DESC) = 1"""
    lower = "" if placeholder else "m.metric_date >= l.last_day AND"
    mark = " RISK" if placeholder else ""
    age = "days_since_last_campaign" if placeholder else "days_since_last"
    extra = (
        f"{_big('early')} AS first_week_views, {_big('late')} AS latter_views,"
        if placeholder
        else ""
    )
    return f"""
        WITH latest AS ({latest}),
        seen AS (
            SELECT l.creator_id, date_diff('day', l.last_day, DATE '{as_of}') AS age,
                   SUM(CASE WHEN {lower} m.metric_date <= l.last_day + 7
                            THEN m.views ELSE 0 END) AS early,
                   SUM(CASE WHEN m.metric_date > l.last_day + 7 THEN m.views ELSE 0 END) AS late
            FROM latest AS l JOIN campaign_daily_metrics AS m ON m.campaign_id = l.last_id
            GROUP BY l.creator_id, l.last_day)
        SELECT cr.creator_id, cr.name, cr.plan_type, {_usd('cr.monthly_revenue')} AS mrr_usd,
               {_big('age')} AS {age}, {extra}
               CASE WHEN late * 10 < early * 7 THEN 'Declining' ELSE 'Stable' END AS view_trend,
               CASE WHEN age > 60 AND late * 10 < early * 7 THEN 'HIGH{mark}'
                    WHEN age > 60 THEN 'MEDIUM{mark}'
                    ELSE 'LOW{mark}' END AS churn_risk
        FROM seen JOIN creators AS cr ON cr.creator_id = seen.creator_id AND cr.is_active"""


_Q07 = f"""
    WITH joined AS (
        SELECT strftime(signup_date, '%Y-%m') AS month, COUNT(*) AS new_creators
        FROM creators GROUP BY 1),
    launched AS (
        SELECT strftime(start_date, '%Y-%m') AS month, COUNT(*) AS new_campaigns,
               SUM(budget_usd) AS gmv
        FROM campaigns GROUP BY 1),
    paired AS (
        SELECT j.month, new_creators, new_campaigns, gmv,
               LAG(new_creators) OVER (ORDER BY j.month) AS creators_before,
               LAG(gmv) OVER (ORDER BY j.month) AS gmv_before
        FROM joined AS j LEFT JOIN launched AS l ON l.month = j.month)
    SELECT month, new_creators, CAST(new_campaigns AS DOUBLE) AS new_campaigns,
           {_usd('gmv')} AS gmv_usd,
           {_rnd(_div('gmv', 'new_creators'), 2)} AS arpu_usd,
           CAST(creators_before AS DOUBLE) AS prev_signups,
           {_pct('new_creators - creators_before', 'creators_before')} AS signup_growth_pct,
           {_pct('gmv - gmv_before', 'gmv_before')} AS gmv_growth_pct
    FROM paired"""


def _q08(average_budget: str, extra_join: str = "") -> str:
    return f"""
        SELECT c.campaign_type, COUNT(DISTINCT c.campaign_id) AS num_campaigns,
               {average_budget} AS avg_budget_usd,
               {_usd('SUM(m.spend_usd)')} AS total_spend_usd,
               {_big('SUM(m.views)')} AS total_views,
               {_big('SUM(m.new_subscribers)')} AS total_subscribers,
               {_big('SUM(m.likes + m.clicks)')} AS total_engagements,
               {_CPM3} AS cpv_per_1000, {_CPS} AS cost_per_subscriber,
               {_rnd(_div('SUM(m.spend_usd)', 'SUM(m.likes + m.clicks)'), 2)}
                   AS cost_per_engagement
        FROM {_PROMOTED} {extra_join}
        GROUP BY c.campaign_type"""


_BAND = (
    "CASE "
    + " ".join(f"WHEN budget_usd < {bound} THEN '{label}'" for bound, label in BUDGET_BANDS)
    + f" ELSE '{TOP_BUDGET_BAND}' END"
)


def _q15(average_budget: str, extra_join: str = "") -> str:
    return f"""
        SELECT c.band AS budget_bucket, COUNT(DISTINCT c.campaign_id) AS campaigns,
               {average_budget} AS avg_budget_usd, {_CPM3} AS cost_per_1000_views,
               {_CPS} AS cost_per_subscriber, {_VTR} AS avg_vtr_pct
        FROM (SELECT *, {_BAND} AS band FROM campaigns) AS c
        JOIN campaign_daily_metrics AS m ON m.campaign_id = c.campaign_id {extra_join}
        GROUP BY c.band"""


def _once(label: str) -> str:
    """Average budget per group over the campaigns that have metrics, joined back by label."""
    return f"""
        JOIN (SELECT {label} AS label,
                     {_rnd(_div('SUM(budget_usd)', 'COUNT(budget_usd)'), 2)} AS budget
              FROM campaigns
              WHERE campaign_id IN (SELECT campaign_id FROM campaign_daily_metrics)
              GROUP BY 1) AS b"""


_Q09 = f"""
    SELECT c.target_age_group, COUNT(DISTINCT c.campaign_id) AS campaigns,
           {_big('SUM(m.impressions)')} AS total_impressions,
           {_big('SUM(m.views)')} AS total_views,
           {_big('SUM(m.new_subscribers)')} AS subscribers,
           {_pct('SUM(m.views)', 'SUM(m.impressions)', 2)} AS vtr_pct,
           {_pct('SUM(m.new_subscribers)', 'SUM(m.views)', 2)} AS sub_cvr_pct,
           {_rnd(_div('SUM(m.watch_time_mins)', 'SUM(m.views)'), 2)} AS avg_watch_min_per_view
    FROM {_PROMOTED} GROUP BY c.target_age_group"""


def _q10(home: str) -> str:
    def lead(column: str) -> str:
        return _rnd(f"ours.{column} - peer.{column}", 2)

    return f"""
        SELECT ours.category, {_usd('ours.avg_cpm_usd')} AS home_cpm,
               {_usd('peer.avg_cpm_usd')} AS competitor_cpm, peer.competitor_name,
               {lead('avg_cpm_usd')} AS cpm_diff,
               {_usd('ours.avg_ctr_pct')} AS home_ctr, {_usd('peer.avg_ctr_pct')} AS competitor_ctr,
               {lead('avg_ctr_pct')} AS ctr_diff,
               {_usd('ours.avg_roas')} AS home_roas, {_usd('peer.avg_roas')} AS competitor_roas,
               {lead('avg_roas')} AS roas_advantage,
               CASE WHEN ours.avg_roas > peer.avg_roas AND ours.avg_cpm_usd < peer.avg_cpm_usd
                        THEN 'Strong Advantage'
                    WHEN ours.avg_roas > peer.avg_roas THEN 'Partial Advantage'
                    ELSE 'Disadvantage' END AS competitive_position
        FROM competitor_benchmarks AS ours, competitor_benchmarks AS peer
        WHERE ours.competitor_name = '{home}' AND peer.competitor_name <> '{home}'
          AND peer.category = ours.category"""


_Q11 = f"""
    WITH pairs AS (
        SELECT cr.creator_id, cr.name, cr.plan_type, v.category AS primary_category,
               COUNT(DISTINCT c.campaign_id) AS total_campaigns, SUM(m.spend_usd) AS spend,
               {_big('SUM(m.views)')} AS lifetime_views,
               {_big('SUM(m.new_subscribers)')} AS lifetime_subscribers
        FROM {_PROMOTED} JOIN videos AS v ON v.video_id = c.video_id
        JOIN creators AS cr ON cr.creator_id = c.creator_id
        GROUP BY ALL)
    SELECT creator_id, name, plan_type, primary_category, total_campaigns,
           {_usd('spend')} AS lifetime_spend_usd, lifetime_views, lifetime_subscribers,
           {_rnd(_div('spend', 'total_campaigns'), 2)} AS avg_campaign_value_usd,
           DENSE_RANK() OVER (ORDER BY spend DESC NULLS LAST) AS spend_rank
    FROM pairs ORDER BY spend DESC NULLS LAST, creator_id, primary_category LIMIT 10"""

_Q12 = f"""
    SELECT plan_type, COUNT(*) AS creators,
           {_rnd(_div('SUM(days)', 'COUNT(days)'), 0)} AS avg_days_to_activation,
           {_big('MIN(days)')} AS min_days, {_big('MAX(days)')} AS max_days,
           {_rnd('STDDEV_POP(days)', 0)} AS stddev_days
    FROM (SELECT cr.plan_type, cr.creator_id,
                 date_diff('day', cr.signup_date, MIN(c.start_date)) AS days
          FROM creators AS cr JOIN campaigns AS c ON c.creator_id = cr.creator_id
          GROUP BY cr.plan_type, cr.creator_id, cr.signup_date) AS waits
    GROUP BY plan_type"""

_Q13 = f"""
    WITH shown AS (
        SELECT v.video_id, v.title, v.category, cr.name AS creator_name, v.baseline_views,
               SUM(m.views) AS got, SUM(m.new_subscribers) AS subs, SUM(m.spend_usd) AS spend
        FROM {_PROMOTED} JOIN videos AS v ON v.video_id = c.video_id
        JOIN creators AS cr ON cr.creator_id = v.creator_id
        GROUP BY ALL)
    SELECT video_id, title, category, creator_name, {_big('baseline_views')} AS baseline_views,
           {_big('got')} AS promoted_views,
           {_pct('got - baseline_views', 'baseline_views')} AS view_uplift_pct,
           {_big('subs')} AS subscribers_from_campaign, {_usd('spend')} AS total_spend_usd,
           {_rnd(f"{_div('spend', 'got - baseline_views')} * 1000", 2)}
               AS cost_per_incremental_1000_views
    FROM shown"""

_Q14 = f"""
    WITH spenders AS (
        SELECT cr.creator_id, SUM(m.spend_usd) AS spend
        FROM {_PROMOTED} JOIN creators AS cr ON cr.creator_id = c.creator_id
        GROUP BY cr.creator_id),
    tiled AS (
        SELECT spend, NTILE(5) OVER (ORDER BY spend DESC NULLS LAST, creator_id) AS tile
        FROM spenders),
    sums AS (SELECT tile, COUNT(*) AS n, SUM(spend) AS spend FROM tiled GROUP BY tile)
    SELECT {_big('tile')} AS spend_quintile, n AS creator_count,
           {_usd('spend')} AS quintile_spend,
           {_pct('spend', '(SELECT SUM(spend) FROM sums)')} AS pct_of_total_gmv,
           {_pct('(SELECT SUM(i.spend) FROM sums AS i WHERE i.tile <= o.tile)',
                 '(SELECT SUM(spend) FROM sums)')} AS cumulative_pct
    FROM sums AS o"""


def _scorecard(source: str) -> str:
    return f"""
        SELECT {_big('creators_n')} AS total_creators, {_big('active_n')} AS active_creators,
               {_pct('active_n', 'creators_n')} AS active_rate_pct,
               {_big('campaigns_n')} AS total_campaigns,
               {_usd('budget')} AS total_platform_gmv_usd,
               {_rnd('CAST(views AS DOUBLE) / 1000000', 2)} AS total_views_millions,
               {_big('subs')} AS total_subscribers_delivered,
               {_rnd(f"{_div('spend', 'views')} * 1000", 3)} AS blended_cpv,
               {_rnd(_div('spend', 'subs'), 2)} AS blended_cost_per_subscriber,
               {_rnd(_div('mrr', 'mrr_n'), 2)} AS avg_mrr_per_creator_usd,
               {_usd('mrr * 12')} AS annualised_platform_revenue_usd
        FROM ({source}) AS totals"""


_Q16 = _scorecard("""
    SELECT COUNT(DISTINCT cr.creator_id) AS creators_n,
           SUM(CASE WHEN cr.is_active THEN 1 ELSE 0 END) AS active_n,
           COUNT(DISTINCT c.campaign_id) AS campaigns_n, SUM(c.budget_usd) AS budget,
           SUM(m.views) AS views, SUM(m.new_subscribers) AS subs, SUM(m.spend_usd) AS spend,
           SUM(cr.monthly_revenue) AS mrr, COUNT(cr.monthly_revenue) AS mrr_n
    FROM creators AS cr LEFT JOIN campaigns AS c ON c.creator_id = cr.creator_id
    LEFT JOIN campaign_daily_metrics AS m ON m.campaign_id = c.campaign_id""")

_Q16_GS = _scorecard("""
    SELECT (SELECT COUNT(*) FROM creators) AS creators_n,
           (SELECT COUNT(*) FROM creators WHERE is_active) AS active_n,
           (SELECT COUNT(*) FROM campaigns) AS campaigns_n,
           (SELECT SUM(budget_usd) FROM campaigns) AS budget,
           (SELECT SUM(views) FROM campaign_daily_metrics) AS views,
           (SELECT SUM(new_subscribers) FROM campaign_daily_metrics) AS subs,
           (SELECT SUM(spend_usd) FROM campaign_daily_metrics) AS spend,
           (SELECT SUM(monthly_revenue) FROM creators) AS mrr,
           (SELECT COUNT(monthly_revenue) FROM creators) AS mrr_n""")


def _ingest(table: str) -> str:
    kinds = {"decimal": "DOUBLE", "date": "VARCHAR", "integer": "BIGINT", "long": "BIGINT"}
    columns = []
    for f in SPECS[table].schema:
        kind = kinds.get(f.dataType.typeName())
        columns.append(f"CAST({f.name} AS {kind}) AS {f.name}" if kind else f.name)
    return f"SELECT {', '.join(columns)} FROM {table}"


def _per_column(pick, select) -> str:
    return " UNION ALL ".join(
        select(spec, column) for spec in SPECS.values() for column in pick(spec)
    )


_NOT_NULL = _per_column(
    lambda spec: spec.not_null,
    lambda spec, c: f"""
        SELECT '{spec.name}' AS table_name, '{c}' AS column_name,
               CAST({spec.primary_key} AS VARCHAR) AS row_key
        FROM {spec.name} WHERE {c} IS NULL""",
)
_LENGTH = _per_column(
    lambda spec: spec.max_length,
    lambda spec, c: f"""
        SELECT '{spec.name}' AS table_name, '{c}' AS column_name,
               CAST({spec.primary_key} AS VARCHAR) AS row_key, length({c}) AS length
        FROM {spec.name} WHERE length({c}) > {spec.max_length[c]}""",
)
_DOMAIN = _per_column(
    lambda spec: spec.domains,
    lambda spec, c: f"""
        SELECT '{spec.name}' AS table_name, '{c}' AS column_name, {c} AS value,
               COUNT(*) AS row_count
        FROM {spec.name} WHERE {c} NOT IN ({', '.join(f"'{v}'" for v in spec.domains[c])})
        GROUP BY {c}""",
)
_KEYS = _per_column(
    lambda spec: (spec.primary_key,),
    lambda spec, c: f"""
        SELECT '{spec.name}' AS table_name, '{c}' AS column_name,
               CAST({c} AS VARCHAR) AS key_value, COUNT(*) AS copies
        FROM {spec.name} GROUP BY {c} HAVING COUNT(*) > 1 OR {c} IS NULL""",
)
_UNIQUE = _per_column(
    lambda spec: spec.unique,
    lambda spec, c: f"""
        SELECT '{spec.name}' AS table_name, '{c}' AS column_name, {c} AS key_value,
               COUNT(*) AS copies
        FROM {spec.name} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1""",
)
_ORPHANS = _per_column(
    lambda spec: spec.foreign_keys,
    lambda spec, fk: f"""
        SELECT '{spec.name}' AS child_table, '{fk.column}' AS fk_column,
               '{fk.parent}' AS parent_table, {fk.column} AS key_value, COUNT(*) AS child_rows
        FROM {spec.name} AS child
        WHERE {fk.column} IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM {fk.parent} AS parent WHERE parent.{fk.parent_key} = child.{fk.column})
        GROUP BY {fk.column}""",
)
_FLIGHT = """
    SELECT m.campaign_id, CAST(m.metric_date AS VARCHAR) AS metric_date,
           CAST(c.start_date AS VARCHAR) AS start_date, CAST(c.end_date AS VARCHAR) AS end_date,
           COUNT(*) AS metric_rows, MIN(m.metric_id) AS first_metric_id
    FROM campaign_daily_metrics AS m JOIN campaigns AS c ON c.campaign_id = m.campaign_id
    WHERE m.metric_date < c.start_date OR m.metric_date > c.end_date
    GROUP BY ALL"""

_ONE_ROW = """
    SELECT CAST(metric_id AS BIGINT) AS metric_id, campaign_id, CAST(NULL AS VARCHAR) AS metric_date, impressions,
           views, clicks, new_subscribers, likes, CAST(spend_usd AS DOUBLE) AS spend_usd,
           CAST(watch_time_mins AS DOUBLE) AS watch_time_mins
    FROM campaign_daily_metrics
    QUALIFY ROW_NUMBER() OVER (
        PARTITION BY metric_id
        ORDER BY campaign_id DESC, impressions DESC, views DESC, clicks DESC, new_subscribers DESC, likes DESC,
                 spend_usd DESC, watch_time_mins DESC) = 1"""
_TOTALS = f"""
    SELECT campaign_id, COUNT(*) AS metric_rows, {_big('SUM(impressions)')} AS impressions,
           {_big('SUM(views)')} AS views, {_big('SUM(clicks)')} AS clicks,
           {_big('SUM(new_subscribers)')} AS new_subscribers, {_big('SUM(likes)')} AS likes,
           {_big('SUM(likes + clicks)')} AS engagements, {_usd('SUM(spend_usd)')} AS spend_usd,
           {_usd('SUM(watch_time_mins)')} AS watch_time_mins, COUNT(views * 100 / NULLIF(impressions, 0)) AS vtr_rows
    FROM campaign_daily_metrics GROUP BY campaign_id"""


def bodies(upgraded: tuple[str, ...], home: str, tenure_as_of: str, churn_as_of: str):
    """Query name to SQL over the six campaign tables."""
    once_by_type = _once("campaign_type") + " ON b.label IS NOT DISTINCT FROM c.campaign_type"
    once_by_band = _once(_BAND) + " ON b.label = c.band"
    return {
        "q01_acquisition_funnel": _q01(upgraded),
        "q02_roi_by_category": _Q02,
        "q03_cohort_activation": _Q03,
        "q04_top_campaigns_roas": _Q04,
        "q05_ltv_by_plan": _q05(tenure_as_of),
        "q06_churn_risk": _churn(churn_as_of, placeholder=False),
        "q06a_churn_risk_placeholder": _churn(churn_as_of, placeholder=True),
        "q06_latest_as_row": _churn(churn_as_of, placeholder=False, as_row=True),
        "q07_monthly_growth": _Q07,
        "q08_campaign_type_effectiveness": _q08(_ROW_BUDGET),
        "q08_gs": _q08("any_value(b.budget)", once_by_type),
        "q09_age_group_targeting": _Q09,
        "q10_competitor_benchmark": _q10(home),
        "q11_top_creators_by_spend": _Q11,
        "q12_time_to_first_campaign": _Q12,
        "q13_organic_vs_promoted_uplift": _Q13,
        "q14_revenue_concentration": _Q14,
        "q15_budget_sweet_spot": _q15(_ROW_BUDGET),
        "q15_gs": _q15("any_value(b.budget)", once_by_band),
        "q16_health_scorecard": _Q16,
        "q16_gs": _Q16_GS,
        **{f"ingest_{name}": _ingest(name) for name in SPECS},
        "dq_not_null": _NOT_NULL,
        "dq_primary_key": _KEYS,
        "dq_unique_email": _UNIQUE,
        "dq_foreign_key": _ORPHANS,
        "dq_domain": _DOMAIN,
        "dq_varchar_length": _LENGTH,
        "dq_metric_in_flight": _FLIGHT,
        "one_row_per_metric_id": _ONE_ROW,
        "campaign_totals_by_batch": _TOTALS,
    }


def star_sql(body: str) -> str:
    """``body`` with the campaign tables it names derived from the star-schema tables."""
    used = [name for name in TABLES if name in body]
    shapes = ",\n".join(f"{name} AS ({TABLES[name]})" for name in used)
    return f"WITH {shapes}\nSELECT * FROM ({body}) AS answer"
