"""What each registered query must return, as DuckDB SQL over the raw tables.

Deliberately a different calculation: money is counted in whole pennies and percentages in
whole tenths or hundredths, with integer rounding throughout, where the Spark side uses
decimals. Constants (thresholds, labels, texts) are its own.
"""

from __future__ import annotations

from types import SimpleNamespace

from verification import constants as c

CFG, EVENTS = c.STAR, c.EVENTS
S = CFG.snapshot_date


def _half_up(numerator: str, denominator: str) -> str:
    """Integer division rounded half away from zero."""
    return (
        f"(CASE WHEN {numerator} < 0 THEN -1 ELSE 1 END"
        f" * ((2 * abs(CAST({numerator} AS HUGEINT)) + {denominator}) // (2 * {denominator})))"
    )


def _pct(part: str, whole: str, digits: int) -> str:
    """Percentage in units of 10^-digits; NULL on a zero whole."""
    scaled = _half_up(f"(({part}) * {100 * 10**digits})", f"nullif({whole}, 0)")
    return f"CAST({scaled} AS BIGINT)"


def _units(expression: str, digits: int) -> str:
    return f"CAST({expression} AS DOUBLE) / {10**digits}"


def _scale(value: str, scale: SimpleNamespace, factor: int = 1) -> str:
    ops = {"==": "="}
    arms = " ".join(
        f"WHEN {value} {ops.get(s.op, s.op)} {int(s.bound * factor)} THEN {_lit(s.result)}"
        for s in scale.steps
    )
    return f"(CASE {arms} ELSE {_lit(scale.otherwise)} END)"


def _lit(value) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_lit(v) for v in values) + ")"


def _day(day) -> str:
    return f"DATE '{day.isoformat()}'"


_A, _X = c.ACTION_TEXTS, c.EXCEPTION_TEXTS

_DECISION_ROWS = ", ".join(
    f"('{segment}', '{state}', '{action}')"
    for segment, actions in (
        ("Dormant", ("Reactivate", "Reactivate", "Reactivate", "Reactivate")),
        ("VIP", ("Retain", "Retain", "Cross-Sell", "Cross-Sell")),
        ("Growth", ("Retain", "Retain", "Cross-Sell", "Cross-Sell")),
        ("At-Risk", ("Retain", "Retain", "Review", "Review")),
        ("Regular", ("Retain", "Review", "Cross-Sell", "Monitor")),
    )
    for state, action in zip(("critical", "fading", "thriving", "steady"), actions)
)


def _filled(template: str, **values: str) -> str:
    text = _lit(template)
    for name, expression in values.items():
        text = text.replace("{" + name + "}", f"' || CAST({expression} AS VARCHAR) || '")
    return text


def _alert(name: str, where: str, severity: str, description: str, todo: str) -> str:
    return (
        f"SELECT *, '{name}' AS exception_type, '{c.EXCEPTION_PREFIX[name]}' || customer_id AS exception_id,"
        f" {severity} AS severity, {description} AS description, {_lit(todo)} AS recommended_action"
        f" FROM acted WHERE {where}"
    )


_ALERTS = " UNION ALL ".join(
    [
        _alert(
            "CRITICAL CUSTOMER",
            "health_category = 'Critical'",
            "if(key_client, 'P1', 'P2')",
            _lit(_X.critical),
            _X.critical_todo,
        ),
        _alert(
            "VIP DETERIORATING",
            "key_client AND worse AND NOT lost",
            "if(vip, 'P1', 'P2')",
            _filled(_X.vip_deteriorating, segment="segment"),
            _X.vip_deteriorating_todo,
        ),
        _alert(
            "REVENUE DECLINE",
            f"delta2 <= {CFG.revenue_decline_pct * 100} AND prior_p > 0 AND NOT lost",
            f"if(vip, 'P1', if(segment = 'Growth' OR delta2 <= {CFG.revenue_decline_severe_pct * 100}, 'P2', 'P3'))",
            _filled(
                _X.revenue_decline,
                drop=f"abs({_half_up('delta2', '100')})",
                revenue=_half_up("current_p", "100"),
            ),
            _X.revenue_decline_todo,
        ),
        _alert(
            "ACTIVITY CLIFF",
            f"txn_delta2 <= {CFG.activity_cliff_pct * 100} AND n_prior >= {CFG.activity_cliff_min_prior} AND NOT lost",
            "if(vip, 'P1', if(segment = 'Growth', 'P2', 'P3'))",
            _filled(
                _X.activity_cliff,
                drop=f"abs({_half_up('txn_delta2', '100')})",
                before="n_prior",
                after="n_current",
            ),
            _X.activity_cliff_todo,
        ),
        _alert(
            "SEGMENT DOWNGRADE",
            "segment_change = 'Downgraded' AND (segment = 'Dormant' OR segment = 'At-Risk' AND worse)",
            "if(segment = 'Dormant' AND prior_segment IN ('VIP', 'Growth'), 'P1', 'P2')",
            _filled(_X.segment_downgrade, before="prior_segment", after="segment"),
            _X.segment_downgrade_todo,
        ),
    ]
)

_EARLY_WARNING = """SELECT *, 'HEALTHY DETERIORATING' AS exception_type, 'EXC_HLTDET_' || customer_id AS exception_id,
 if(key_client OR ltm_p >= 200000, 'P2', 'P3') AS severity,
 'Health score ' || CAST(CAST(score1 AS DECIMAL(5,0)) / 10 AS DECIMAL(5,1)) || ', still 70 or more, but 5 or more points down.' AS description,
 'Act before the score passes 70: compare counts and revenue of both periods.' AS recommended_action
 FROM acted WHERE health_category = 'Healthy' AND worse"""

_STAR_INPUTS = """
WITH people AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type,
         'RM' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS relationship_manager, r_name AS region
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
),
txn AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         o_custkey AS customer_id, p_type AS product_id, CAST(o_orderdate AS DATE) AS day,
         l_returnflag AS transaction_type, o_orderpriority AS channel,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * 100 AS BIGINT) AS value_p,
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) * 0.20, 2) * 100 AS BIGINT) AS fee_p
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey
),
"""


def _measures(cfg) -> str:
    """Totals per customer and one row per listed customer (``base``)."""
    current = f"day BETWEEN {_day(cfg.current_start)} AND {_day(cfg.snapshot_date)}"
    prior = f"day BETWEEN {_day(cfg.prior_start)} AND {_day(cfg.prior_end)}"
    ltm = f"day BETWEEN {_day(cfg.ltm_start)} AND {_day(cfg.snapshot_date)}"
    return f"""
seen AS (SELECT * FROM txn WHERE day <= {_day(cfg.snapshot_date)}),
totals AS (
  SELECT customer_id,
    CAST(coalesce(sum(fee_p) FILTER ({ltm}), 0) AS BIGINT) AS ltm_p,
    count(*) FILTER ({ltm}) AS n_ltm,
    CAST(coalesce(sum(fee_p) FILTER ({current}), 0) AS BIGINT) AS current_p,
    CAST(coalesce(sum(fee_p) FILTER ({prior}), 0) AS BIGINT) AS prior_p,
    CAST(coalesce(sum(value_p) FILTER ({current}), 0) AS BIGINT) AS volume_p,
    count(*) FILTER ({current}) AS n_current,
    count(*) FILTER ({prior}) AS n_prior,
    count(DISTINCT product_id) FILTER ({current}) AS n_products,
    count(*) FILTER ({current} AND channel IN {_in(cfg.digital_channels)}) AS n_digital,
    max(day) AS last_day
  FROM seen GROUP BY customer_id
),
favourite AS (
  SELECT customer_id, channel FROM seen WHERE {current} GROUP BY customer_id, channel
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, channel) = 1
),
base AS (
  SELECT p.*, coalesce(ltm_p, 0) AS ltm_p, coalesce(n_ltm, 0) AS n_ltm, coalesce(current_p, 0) AS current_p,
    coalesce(prior_p, 0) AS prior_p, coalesce(volume_p, 0) AS volume_p, coalesce(n_current, 0) AS n_current,
    coalesce(n_prior, 0) AS n_prior, coalesce(n_products, 0) AS n_products, coalesce(n_digital, 0) AS n_digital,
    coalesce(f.channel, 'None') AS primary_channel,
    coalesce(date_diff('day', last_day, {_day(cfg.snapshot_date)}), 999) AS days_since_last_txn
  FROM people p LEFT JOIN totals USING (customer_id) LEFT JOIN favourite f USING (customer_id)
),
"""


def _scores(cfg) -> str:
    """From ``base`` rows of any date to segments and health (``scored``)."""
    return f"""
measured AS (
  SELECT *,
    coalesce({_pct('current_p - prior_p', 'prior_p', 2)}, 0) AS delta2,
    coalesce({_pct('n_current - n_prior', 'n_prior', 2)}, 0) AS txn_delta2,
    {_pct('n_products', str(cfg.products_total), 1)} AS depth1,
    coalesce({_pct('n_digital', 'n_current', 1)}, 0) AS digital1,
    {_scale('days_since_last_txn', cfg.recency_score)} AS rfm_recency_score,
    {_scale('n_current', c.FREQUENCY_SCORE)} AS rfm_frequency_score,
    {_scale('ltm_p', c.MONETARY_SCORE, 100)} AS rfm_monetary_score,
    if(n_current = 0, 'Inactive', if(n_prior = 0, 'New', if(n_current * 100 >= n_prior * {round(cfg.growing_ratio * 100)}, 'Growing',
      if(n_prior >= {cfg.declining_min_prior} AND n_current * 100 <= n_prior * {round(cfg.declining_ratio * 100)}, 'Declining', 'Stable')))) AS activity_trend
  FROM base
),
segmented AS (
  SELECT *,
    if(n_current = 0, 'Dormant', if(ltm_p >= {cfg.vip_revenue * 100} AND n_current >= {cfg.vip_txns}, 'VIP',
      if(activity_trend = 'Declining' AND n_prior >= {cfg.at_risk_min_prior}, 'At-Risk',
      if(activity_trend = 'Growing' AND ltm_p >= {cfg.growth_revenue * 100}, 'Growth', 'Regular')))) AS segment,
    if(n_prior = 0, 'Dormant', if(prior_p * {cfg.prior_annualiser} >= {cfg.vip_revenue * 100} AND n_prior >= {cfg.vip_txns}, 'VIP',
      if(n_prior IN (1, 2), 'At-Risk', 'Regular'))) AS prior_segment
  FROM measured
),
moved AS (
  SELECT s.*, coalesce(change, 'Stable') AS segment_change
  FROM segmented s LEFT JOIN (VALUES
    ('VIP', 'Regular', 'Upgraded'), ('VIP', 'At-Risk', 'Upgraded'), ('VIP', 'Dormant', 'Upgraded'),
    ('Growth', 'Regular', 'Upgraded'), ('Growth', 'At-Risk', 'Upgraded'), ('Growth', 'Dormant', 'Upgraded'),
    ('Regular', 'At-Risk', 'Upgraded'), ('Regular', 'Dormant', 'Upgraded'),
    ('At-Risk', 'VIP', 'Downgraded'), ('At-Risk', 'Regular', 'Downgraded'),
    ('Dormant', 'VIP', 'Downgraded'), ('Dormant', 'Regular', 'Downgraded'),
    ('Regular', 'VIP', 'Downgraded'), ('Regular', 'Growth', 'Downgraded')
  ) AS m(now, before, change) ON m.now = segment AND m.before = prior_segment
),
dims AS (
  SELECT *,
    {_scale('n_current', c.ACTIVITY_HEALTH)} AS activity_health,
    {_scale('current_p', c.REVENUE_HEALTH, 100)} AS revenue_health,
    {_scale('days_since_last_txn', cfg.recency_health)} AS recency_health,
    {_half_up('(depth1 + digital1)', '2')} AS engagement1,
    {_scale('n_prior', c.ACTIVITY_HEALTH)} AS prior_activity,
    {_scale('prior_p', c.REVENUE_HEALTH, 100)} AS prior_revenue,
    {_scale('n_prior', c.PRIOR_RECENCY_HEALTH)} AS prior_recency
  FROM moved
),
composed AS (
  SELECT *,
    CAST({_half_up('(300 * activity_health + 350 * revenue_health + 250 * recency_health + 10 * engagement1)', '100')} AS BIGINT) AS score1,
    CAST({_half_up('(300 * prior_activity + 350 * prior_revenue + 250 * prior_recency + 10 * engagement1)', '100')} AS BIGINT) AS prior_score1
  FROM dims
),
scored AS (
  SELECT *,
    {_scale('score1', c.HEALTH_CATEGORY, 10)} AS health_category,
    if(score1 - prior_score1 >= 50, 'Improving', if(prior_score1 - score1 >= 50, 'Deteriorating', 'Stable')) AS health_trend
  FROM composed
),
"""


def _decisions(cfg) -> str:
    """Actions, alerts and concentration."""
    return f"""
flagged AS (
  SELECT *, segment = 'VIP' AS vip, segment IN ('VIP', 'Growth') AS key_client,
    health_trend = 'Deteriorating' AS worse, health_category = 'Critical' AS lost,
    if(health_category = 'Critical', 'critical', if(health_category = 'At-Risk' OR health_trend = 'Deteriorating', 'fading',
      if(health_category = 'Healthy' AND health_trend = 'Improving', 'thriving', 'steady'))) AS state
  FROM scored
),
decided AS (
  SELECT f.*, d.action_type FROM flagged f
  JOIN (VALUES {_DECISION_ROWS}) AS d(segment, state, action_type) USING (segment, state)
),
ranked_actions AS (
  SELECT *,
    if(action_type = 'Monitor', 'P4',
      if(action_type = 'Retain', if(vip OR (worse AND (lost OR segment = 'Growth')), 'P1', 'P2'),
      if((action_type = 'Cross-Sell' AND vip) OR (action_type = 'Review' AND key_client), 'P2', 'P3'))) AS priority,
    if(action_type = 'Retain',
        if(vip, {_lit(_A.retain_vip)}, if(segment = 'Growth', {_lit(_A.retain_growth)}, if(lost, {_lit(_A.retain_critical)}, {_lit(_A.retain)}))),
      if(action_type = 'Cross-Sell', if(vip, {_lit(_A.cross_sell_vip)}, {_lit(_A.cross_sell)}),
      if(action_type = 'Reactivate', {_lit(_A.reactivate)}, if(action_type = 'Review', {_lit(_A.review)}, {_lit(_A.monitor)})))) AS action_description
  FROM decided
),
acted AS (
  SELECT *, {_day(cfg.snapshot_date)} AS snapshot_date, CAST(customer_id AS VARCHAR) || '_{cfg.snapshot_date.isoformat()}' AS action_id,
    list_extract([1, 3, 7, 30], CAST(substr(priority, 2) AS INT)) AS sla_days, relationship_manager AS assigned_rm, 'OPEN' AS status
  FROM ranked_actions
),
alerts AS ({_ALERTS}),
earning AS (SELECT customer_id, ltm_p FROM totals WHERE n_ltm > 0),
tiers AS (
  SELECT (SELECT CAST(sum(ltm_p) AS BIGINT) FROM earning) AS total_p,
    (SELECT CAST(coalesce(sum(ltm_p), 0) AS BIGINT) FROM (SELECT ltm_p FROM earning ORDER BY ltm_p DESC LIMIT 10)) AS top10,
    (SELECT CAST(coalesce(sum(ltm_p), 0) AS BIGINT) FROM (SELECT ltm_p FROM earning ORDER BY ltm_p DESC LIMIT 20)) AS top20,
    (SELECT CAST(coalesce(sum(ltm_p), 0) AS BIGINT) FROM (SELECT ltm_p FROM earning ORDER BY ltm_p DESC LIMIT 50)) AS top50,
    (SELECT CAST(coalesce(sum(ltm_p), 0) AS BIGINT) FROM scored WHERE n_ltm > 0 AND health_category = 'Critical') AS critical_p
),
rungs AS (
  SELECT customer_id, CAST({_half_up('ltm_p', '100')} AS BIGINT) AS pounds FROM earning
),
climbed AS (
  SELECT customer_id, pounds, row_number() OVER w AS revenue_rank, CAST(sum(pounds) OVER w AS BIGINT) AS so_far,
    (SELECT CAST(sum(pounds) AS BIGINT) FROM rungs) AS all_pounds
  FROM rungs WINDOW w AS (ORDER BY pounds DESC, customer_id ROWS UNBOUNDED PRECEDING)
)
"""


def chain(cfg, inputs: str = _STAR_INPUTS) -> str:
    """All intermediate results of one snapshot; ``inputs`` begins with ``WITH`` and defines people and txn."""
    return inputs + _measures(cfg) + _scores(cfg) + _decisions(cfg)


PREFIX = chain(CFG)

_EVENT_INPUTS = """
WITH feed AS (SELECT DISTINCT ON (event_id) * FROM events),
people AS (
  SELECT DISTINCT user_id AS customer_id, 'User ' || CAST(user_id AS VARCHAR) AS customer_name, CAST(NULL AS VARCHAR) AS customer_type,
         'RM' || lpad(CAST(user_id % 25 AS VARCHAR), 3, '0') AS relationship_manager, CAST(NULL AS VARCHAR) AS region FROM feed
),
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id AS customer_id, CAST(NULL AS VARCHAR) AS product_id, CAST(ts AS DATE) AS day,
         event_type AS channel, CAST(floor(value * 100 + 0.5) AS BIGINT) AS value_p, CAST(floor(value * 100 + 0.5) AS BIGINT) AS fee_p
  FROM feed
),
"""
EVENT_PREFIX = chain(EVENTS, _EVENT_INPUTS)


_SUFFIX = {"#": "BIGINT", "~": "DOUBLE", "@": "VARCHAR"}


def _select(source: str, columns: str, where: str = "", tail: str = "", prefix: str | None = None) -> str:
    """``columns``: ``expression > name`` or ``name``, with an optional type mark at the end
    (``#`` whole number, ``~`` double, ``@`` text)."""
    items = []
    for item in columns.split(";"):
        item = item.strip()
        if not item:
            continue
        mark = _SUFFIX.get(item[-1])
        if mark:
            item = item[:-1].strip()
        expression, _, name = item.rpartition(" > ")
        expression = expression or name
        items.append(f"CAST({expression} AS {mark}) AS {name}" if mark else f"{expression} AS {name}")
    where = f" WHERE {where}" if where else ""
    return f"{prefix or PREFIX} SELECT {', '.join(items)} FROM {source}{where}{tail}"


_LTM_POUNDS, _NOW_POUNDS = _half_up("ltm_p", "100"), _half_up("current_p", "100")
_DELTA1 = _units(_half_up("delta2", "10"), 1)

_ID = "customer_id#; snapshot_date@;"
def _profile_row(cfg) -> str:
    return f"""{_ID} {_units('ltm_p', 2)} > revenue_ltm~; {_units('current_p', 2)} > revenue_90d~; {_units('prior_p', 2)} > revenue_prior_90d~;
 {_units('delta2', 2)} > revenue_delta_pct~; n_current > txn_count_90d#; n_prior > txn_count_prior_90d#; {_units('volume_p', 2)} > txn_volume_90d~;
 {_units('txn_delta2', 2)} > txn_delta_pct~; n_products > products_active#; {cfg.products_total} > products_total#; {_units('depth1', 1)} > product_depth_pct~;
 primary_channel; {_units('digital1', 1)} > digital_txn_pct~; rfm_recency_score#; rfm_frequency_score#; rfm_monetary_score#; days_since_last_txn#; activity_trend"""


_360 = _profile_row(CFG)
_ACTION = f"action_id; {_ID} segment; health_category; action_type; action_description; priority; sla_days#; assigned_rm; status"
_ALERT = "exception_id; customer_id#; snapshot_date > detected_date@; exception_type; description; severity; recommended_action; assigned_rm; status"
_WATCH = f"""priority; sla_days#; action_type; customer_name; customer_id#; segment; health_category; health_trend;
 {_half_up('score1', '10')} > health_score~; {_LTM_POUNDS} > revenue_ltm~; {_NOW_POUNDS} > revenue_90d~; {_DELTA1} > revenue_delta_pct~;
 n_current > txn_count_90d#; action_description; assigned_rm; region"""
_FEED = f"""severity; exception_type; customer_id#; customer_name; segment; health_category; health_trend; {_LTM_POUNDS} > revenue_ltm~;
 {_NOW_POUNDS} > revenue_90d~; {_DELTA1} > revenue_delta_pct~; description; recommended_action; assigned_rm; snapshot_date > detected_date@; status"""
_EXPLORE = f"""customer_name; customer_id#; segment; health_category; health_trend; {_half_up('score1', '10')} > health_score~; {_LTM_POUNDS} > revenue_ltm~;
 {_NOW_POUNDS} > revenue_90d~; {_DELTA1} > revenue_qoq_pct~; n_current > txn_count_90d#; n_products > products_active#; action_type; priority; assigned_rm; region; segment_change"""
_LADDER = f"""revenue_rank#; customer_name; customer_id#; segment; health_category; health_trend; pounds > revenue_ltm~;
 {_units(_pct('pounds', 'all_pounds', 2), 2)} > pct_of_portfolio~; {_units(_pct('so_far', 'all_pounds', 1), 1)} > cumulative_pct~; n_current > txn_count_90d#; n_products > products_active#"""
_CONC = f"""{_day(S)} > snapshot_date@; {_units('total_p', 2)} > total_portfolio_revenue~;
 {_units('top10', 2)} > top_10_revenue~; {_units(_pct('top10', 'total_p', 1), 1)} > top_10_pct~; {_units('top20', 2)} > top_20_revenue~;
 {_units(_pct('top20', 'total_p', 1), 1)} > top_20_pct~; {_units('top50', 2)} > top_50_revenue~; {_units(_pct('top50', 'total_p', 1), 1)} > top_50_pct~;
 if(top10 * 2 >= total_p, 'CRITICAL', if(top10 * 10 >= total_p * 4, 'HIGH', if(top10 * 10 >= total_p * 3, 'MEDIUM', 'LOW'))) > revenue_dependency_score;
 {_units('top10', 2)} > scenario_top10_exit_risk~; {_units('critical_p', 2)} > scenario_critical_exit_risk~"""

_BOARD = f"""(SELECT count(*) AS total_customers, count(*) FILTER (segment <> 'Dormant') AS active_customers,
   count(*) FILTER (segment = 'Dormant') AS dormant_customers, count(*) FILTER (health_category = 'Healthy') AS n_healthy,
   count(*) FILTER (lost) AS n_lost, count(*) FILTER (lost OR health_category = 'At-Risk') AS customers_at_risk,
   count(*) FILTER (action_type = 'Retain') AS open_retain_actions, count(*) FILTER (action_type = 'Cross-Sell') AS open_crosssell_actions,
   count(*) FILTER (action_type = 'Reactivate') AS open_reactivation_actions, CAST(sum(current_p) AS BIGINT) AS now_p, CAST(sum(prior_p) AS BIGINT) AS before_p
   FROM acted) CROSS JOIN tiers CROSS JOIN (SELECT count(*) AS open_exceptions, count(*) FILTER (severity = 'P1') AS open_p1_exceptions FROM alerts)"""
_HEALTHY1, _LOST1 = _pct("n_healthy", "total_customers", 1), _pct("n_lost", "total_customers", 1)
_KPI = f"""{_day(S)} > snapshot_date@; total_customers#; active_customers#; dormant_customers#; {_units(_HEALTHY1, 1)} > healthy_pct~; {_units(_LOST1, 1)} > critical_pct~;
 {_units(_pct('top10', 'total_p', 1), 1)} > revenue_concentration_pct~; open_retain_actions#; open_crosssell_actions#; open_reactivation_actions#; customers_at_risk#;
 {_units('top10', 2)} > revenue_at_risk~; open_exceptions#; open_p1_exceptions#"""
_SUMMARY = f"""{_day(S)} > snapshot_date@; total_customers#; active_customers#; dormant_customers#; {_units(_pct('dormant_customers', 'total_customers', 1), 1)} > dormant_rate_pct~;
 {_units(_HEALTHY1, 1)} > healthy_pct~; {_units(_LOST1, 1)} > critical_pct~;
 if({_HEALTHY1} >= 500, 'Strong', if({_HEALTHY1} >= 300, 'Moderate', 'Weak')) > portfolio_health_rating; {_units(_pct('top10', 'total_p', 1), 1)} > revenue_concentration_pct~;
 if(top10 * 2 >= total_p, 'CRITICAL', if(top10 * 10 >= total_p * 4, 'HIGH', if(top10 * 10 >= total_p * 3, 'MEDIUM', 'LOW'))) > revenue_dependency_score;
 {_half_up('total_p', '100')} > portfolio_revenue_ltm~; {_half_up('top10', '100')} > revenue_at_risk~; {_half_up('now_p', '100')} > revenue_current_90d~;
 {_half_up('before_p', '100')} > revenue_prior_90d~; {_units(_pct('now_p - before_p', 'before_p', 1), 1)} > revenue_qoq_pct~; {_units('abs(now_p - before_p)', 2)} > revenue_change~;
 open_retain_actions#; open_crosssell_actions#; open_reactivation_actions#; open_retain_actions + open_crosssell_actions + open_reactivation_actions > total_active_actions#;
 open_exceptions#; open_p1_exceptions#; customers_at_risk#"""


def _counts(source: str, *keys: str, n: str = "n", where: str = "", extra: str = "") -> str:
    columns = "; ".join(keys) + f"; count(*) > {n}#" + extra
    return _select(source, columns, where, f" GROUP BY {', '.join(keys)}")


def _shared(*keys: str) -> str:
    share = _units(_pct("count(*)", "CAST(sum(count(*)) OVER () AS BIGINT)", 1), 1)
    return _counts("acted", *keys, n="customers", extra=f"; {share} > pct_of_customers~")


def _explorer_kpis(chosen: str) -> str:
    score, pounds = _half_up("score1", "10"), _LTM_POUNDS
    picked = f"count(*) FILTER ({chosen})"
    return _select(
        "acted",
        f"""{picked} > customers#; {_units(_pct(picked, 'count(*)', 1), 1)} > pct_of_customers~;
 {_units(_half_up(f'(10 * coalesce(sum({score}) FILTER ({chosen}), 0))', f'greatest({picked}, 1)'), 1)} > avg_health_score~;
 coalesce(sum({pounds}) FILTER ({chosen}), 0) > total_revenue#; {_units(_pct(f'coalesce(sum({pounds}) FILTER ({chosen}), 0)', f'sum({pounds})', 1), 1)} > pct_of_revenue~;
 coalesce({_units(_pct(f'count(*) FILTER (worse AND {chosen})', picked, 1), 1)}, 0) > deteriorating_pct~;
 {_units(_pct('count(*) FILTER (worse)', 'count(*)', 1), 1)} > portfolio_deteriorating_pct~; count(*) FILTER (action_type = 'Retain' AND {chosen}) > retain_customers#""",
    )


def _keys_checked(table: str, source: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, count(*) FILTER (k IS NOT NULL AND n > 1) AS duplicate_keys,"
        f" CAST(coalesce(sum(n - 1) FILTER (k IS NOT NULL AND n > 1), 0) AS BIGINT) AS surplus_rows,"
        f" CAST(coalesce(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS null_keys"
        f" FROM (SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY 1)"
    )


def _counted(label: str, source: str, name: str = "table_name", extra: str = "") -> str:
    return f"SELECT '{label}' AS {name}, count(*) AS row_count{extra} FROM {source}"


_INPUTS = {
    "dim_relationship_managers": "nation",
    "dim_products": "(SELECT DISTINCT p_type FROM part)",
    "dim_customers": "people",
    "stg_transactions": "txn",
}
_KEY_CHECKS = [
    ("dim_relationship_managers", "nation", "n_nationkey"),
    ("dim_products", "(SELECT DISTINCT p_type FROM part)", "p_type"),
    ("dim_customers", "people", "customer_id"),
    ("stg_transactions", "txn", "transaction_id"),
    ("fct_customer_360", "acted", "customer_id"),
    ("fct_customer_segments", "acted", "customer_id"),
    ("fct_customer_health", "acted", "customer_id"),
    ("fct_rm_actions", "acted", "action_id"),
    ("fct_exceptions", "alerts", "exception_id"),
    ("fct_concentration", "tiers", "'one day'"),
    ("fct_executive_kpis", "tiers", "'one day'"),
]
_OK = ", CAST(count(*) > 0 AS BIGINT) AS is_ok"


def _per_category(category: str) -> str:
    return f'count(customer_id) FILTER (health_category = \'{category}\') > "{category}"#'


_AGENDA = """(SELECT 1 AS position, 'P1' AS priority, 1 AS sla_days, 'Retain' AS action, count(*) AS customers, 'Senior RM' AS owner FROM acted WHERE action_type = 'Retain' AND priority = 'P1'
 UNION ALL SELECT 2, 'P2', 3, 'Retain', count(*), 'RM Team' FROM acted WHERE action_type = 'Retain' AND priority = 'P2'
 UNION ALL SELECT 3, 'P2', 3, 'Exceptions', count(*), 'RM Ops' FROM alerts WHERE exception_type = 'SEGMENT DOWNGRADE'
 UNION ALL SELECT 4, 'P3', 7, 'Reactivate', count(*), 'RM Team' FROM acted WHERE action_type = 'Reactivate'
 UNION ALL SELECT 5, 'P3', 7, 'Review', count(*), 'RM Team' FROM acted WHERE action_type = 'Review'
 UNION ALL SELECT 6, 'P3', 7, 'Cross-Sell', count(*), 'RM Team' FROM acted WHERE action_type = 'Cross-Sell')"""


def _history(cfg, months: int) -> str:
    """``scored`` for each customer and each of the last months, every period counted from the raw rows."""
    return _STAR_INPUTS + f"""
spine AS (
  SELECT CAST({_day(cfg.snapshot_date)} - to_months(CAST(m AS INTEGER)) AS DATE) AS on_day FROM range({months}) r(m)
),
base AS (
  SELECT p.customer_id, d.on_day,
    CAST(coalesce(sum(fee_p) FILTER (day > on_day - {cfg.ltm_days}), 0) AS BIGINT) AS ltm_p,
    count(transaction_id) FILTER (day > on_day - {cfg.ltm_days}) AS n_ltm,
    CAST(coalesce(sum(fee_p) FILTER (day > on_day - {cfg.window_days}), 0) AS BIGINT) AS current_p,
    CAST(coalesce(sum(fee_p) FILTER (day > on_day - {2 * cfg.window_days} AND day <= on_day - {cfg.window_days}), 0) AS BIGINT) AS prior_p,
    count(transaction_id) FILTER (day > on_day - {cfg.window_days}) AS n_current,
    count(transaction_id) FILTER (day > on_day - {2 * cfg.window_days} AND day <= on_day - {cfg.window_days}) AS n_prior,
    count(DISTINCT product_id) FILTER (day > on_day - {cfg.window_days}) AS n_products,
    count(*) FILTER (day > on_day - {cfg.window_days} AND channel IN {_in(cfg.digital_channels)}) AS n_digital,
    coalesce(date_diff('day', max(day), on_day), 999) AS days_since_last_txn
  FROM people p CROSS JOIN spine d LEFT JOIN txn t ON t.customer_id = p.customer_id AND t.day <= d.on_day
  GROUP BY p.customer_id, d.on_day
),
""" + _scores(cfg).rstrip().rstrip(",") + "\n"


_TREND = """,
points AS (
  SELECT customer_id, on_day, score1 AS y, row_number() OVER w - 1 AS x, count(*) OVER c AS n, sum(score1) OVER c AS sy,
    sum(score1) OVER w - score1 AS head
  FROM scored WINDOW w AS (PARTITION BY customer_id ORDER BY on_day), c AS (PARTITION BY customer_id)
),
parted AS (
  SELECT *, CASE WHEN x > 0 THEN CAST((n * head - x * sy) * (n * head - x * sy) AS DOUBLE) / CAST(x * (n - x) AS DOUBLE) END AS explained FROM points
),
best AS (
  SELECT * FROM parted WHERE x > 0 QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY explained DESC, x) = 1
),
lines AS (
  SELECT customer_id, count(*) AS n, max(on_day) AS on_day, arg_max(y, on_day) AS latest,
    CAST(count(*) * sum(x * y) - sum(x) * sum(y) AS DOUBLE) / CAST(count(*) * sum(x * x) - sum(x) * sum(x) AS DOUBLE) / 10 AS slope
  FROM points GROUP BY customer_id
)
"""


def oracle_sql() -> dict[str, str]:
    sums = f"customer_id#; {_units('ltm_p', 2)} > revenue_ltm~"
    ordered = "(SELECT *, row_number() OVER (ORDER BY ltm_p DESC, customer_id) AS r FROM earning)"
    following = "(SELECT *, row_number() OVER w AS r, lead(ltm_p) OVER w AS nxt FROM earning WINDOW w AS (ORDER BY ltm_p DESC, customer_id))"
    ladder = "climbed JOIN acted USING (customer_id)"
    sql = {
        # inputs
        "ingest_customers": _select(
            "people LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1) ON o_custkey = customer_id",
            "customer_id#; customer_name; customer_type; CAST(first_order AS DATE) > onboarding_date@; relationship_manager; region; 1 > is_active#",
        ),
        "ingest_transactions": _select(
            "txn",
            f"transaction_id; customer_id#; product_id; day > transaction_date@; transaction_type; channel; {_units('value_p', 2)} > transaction_value~; {_units('fee_p', 2)} > fee_revenue~",
        ),
        "ingest_products": "SELECT DISTINCT p_type AS product_id, p_type AS product_name, CAST(1 AS BIGINT) AS is_core_product FROM part",
        "ingest_relationship_managers": "SELECT 'RM' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS rm_id, n_name AS rm_name, r_name AS team FROM nation LEFT JOIN region ON r_regionkey = n_regionkey",
        "validate_inputs": PREFIX + " UNION ALL ".join(_counted(t, s) for t, s in _INPUTS.items()),
        "input_presence": " UNION ALL ".join(
            _counted(t, t, extra=", CAST(1 AS BIGINT) AS is_present") for t in ("region", "nation", "customer", "part", "orders", "lineitem")
        )
        + " UNION ALL SELECT 'campaign', 0, 0",
        "ingest_csv": _select(
            "txn",
            f"transaction_id; customer_id#; product_id; day > transaction_date@; transaction_type; channel; {_units('value_p', 2)} > transaction_value~; {_units('fee_p', 2)} > fee_revenue~",
            "CAST(split_part(transaction_id, '-', 1) AS BIGINT) % 97 > 1",
        ),
        "ingest_rejects": PREFIX
        + """ SELECT 'stg_transactions' AS table_name, CASE WHEN o = 0 THEN 'transaction_date' ELSE 'fee_revenue' END AS fault, count(*) AS records
 FROM (SELECT CAST(split_part(transaction_id, '-', 1) AS BIGINT) % 97 AS o FROM txn) WHERE o < 2 GROUP BY o
 UNION ALL SELECT 'dim_customers', 'is_active', count(*) FROM people WHERE customer_id % 97 = 2 HAVING count(*) > 0""",
        "bucketed_customer_360": _select("acted", _360),
        "pipeline_summary": PREFIX
        + " UNION ALL ".join(
            _counted(label, source, "item")
            for label, source in (
                ("Transactions loaded", "txn"),
                ("Customers loaded", "people"),
                ("Customer 360 records", "acted"),
                ("Health-scored customers", "scored"),
                ("RM actions generated", "acted"),
                ("Exceptions detected", "alerts"),
                ("Executive KPI snapshots", "tiers"),
            )
        ),
        "dq_primary_keys": PREFIX + " UNION ALL ".join(_keys_checked(*check) for check in _KEY_CHECKS),
        "dq_non_empty": PREFIX
        + " UNION ALL ".join(
            _counted(t, s, extra=_OK)
            for t, s in (
                ("fct_customer_360", "acted"),
                ("fct_customer_segments", "moved"),
                ("fct_customer_health", "scored"),
                ("fct_rm_actions", "acted"),
                ("fct_exceptions", "alerts"),
                ("fct_concentration", "tiers"),
                ("fct_executive_kpis", "tiers"),
            )
        ),
        "publish": _select("acted", _360),
        "publish_rerun": _select("acted", _360),
        "publish_incremental": _select("acted", _360),
        "dormancy_tiers": _select(
            f"""(SELECT *, if(days_since_last_txn = 999, 'Never active', if(days_since_last_txn <= {CFG.window_days + 29}, 'Newly dormant',
 if(days_since_last_txn < {2 * CFG.window_days}, 'Recently dormant', 'Long-term dormant'))) AS tier FROM acted WHERE segment = 'Dormant')""",
            f"tier; count(*) > customers#; min(days_since_last_txn) > least_days#; max(days_since_last_txn) > most_days#; {_units('sum(ltm_p)', 2)} > revenue_ltm~",
            tail=" GROUP BY tier",
        ),
        "exc_healthy_deteriorating": _select(f"({_EARLY_WARNING})", _ALERT),
        "exceptions_with_early_warning": _select(f"(FROM alerts UNION ALL BY NAME {_EARLY_WARNING})", _ALERT),
        "explorer_by_manager": _select("acted", _EXPLORE, "assigned_rm IN ('RM003', 'RM007')"),
        "explorer_kpis_by_manager": _explorer_kpis("assigned_rm IN ('RM003', 'RM007')"),
        "feed_by_manager": _select("alerts", _FEED, "assigned_rm IN ('RM003', 'RM007')"),
        # history
        "health_history": _select(
            "scored",
            f"""customer_id#; on_day > snapshot_date@; {_units('score1', 1)} > health_score~; health_category; health_trend; segment; segment_change;
 {_units('current_p', 2)} > revenue_90d~; n_current > txn_count_90d#; days_since_last_txn#""",
            prefix=_history(CFG, 12),
        ),
        "health_trend_6m": _select(
            "lines l LEFT JOIN best b USING (customer_id)",
            """customer_id#; l.n > dates#; l.on_day > snapshot_date@; latest / 10.0 > health_score~; round(slope, 4) > slope~;
 CASE WHEN explained > 0 THEN b.on_day END > change_date@; CASE WHEN explained > 0 THEN round(CAST(head AS DOUBLE) / x / 10, 4) END > mean_before~;
 CASE WHEN explained > 0 THEN round(CAST(sy - head AS DOUBLE) / (b.n - x) / 10, 4) END > mean_after~""",
            prefix=_history(CFG, 6) + _TREND,
        ),
        # event stream
        "stream_daily_activity": _select(
            "txn", "customer_id#; channel; day@; count(*) > txns#; sum(fee_p) > fee_pennies#", tail=" GROUP BY customer_id, channel, day", prefix=EVENT_PREFIX
        ),
        "stream_customer_360": _select("acted", _profile_row(EVENTS), prefix=EVENT_PREFIX),
        "stream_activity_cliff": _select(
            "alerts",
            f"customer_id#; snapshot_date@; n_current > txn_count_90d#; n_prior > txn_count_prior_90d#; {_units('txn_delta2', 2)} > txn_delta_pct~",
            "exception_type = 'ACTIVITY CLIFF'",
            prefix=EVENT_PREFIX,
        ),
        # customer 360
        "customer_360": _select("acted", _360),
        "revenue_by_period": _select(
            "totals",
            sums + f"; {_units('current_p', 2)} > revenue_90d~; {_units('prior_p', 2)} > revenue_prior_90d~",
        ),
        "activity_by_period": _select(
            "totals",
            f"customer_id#; n_current > txn_count_90d#; n_prior > txn_count_prior_90d#; {_units('volume_p', 2)} > txn_volume_90d~; last_day > last_txn_date@",
        ),
        "product_usage": _select("totals", "customer_id#; n_products > products_active#", "n_current > 0"),
        "channel_usage": _select(
            "totals JOIN favourite USING (customer_id)",
            "customer_id#; n_current > total_txns_90d#; n_digital > digital_txns_90d#; channel > primary_channel",
        ),
        "period_deltas": _select(
            "acted",
            f"customer_id#; {_units('delta2', 2)} > revenue_delta_pct~; {_units('txn_delta2', 2)} > txn_delta_pct~",
        ),
        "engagement_inputs": _select(
            "acted",
            f"customer_id#; n_products > products_active#; {_units('depth1', 1)} > product_depth_pct~; primary_channel; {_units('digital1', 1)} > digital_txn_pct~",
        ),
        "recency": _select("acted", "customer_id#; days_since_last_txn#"),
        "activity_trend": _select("acted", "customer_id#; activity_trend"),
        "rfm_scores": _select("acted", "customer_id#; rfm_recency_score#; rfm_frequency_score#; rfm_monetary_score#"),
        # segments and health
        "customer_segments": _select("acted", _ID + "segment; prior_segment; segment_change"),
        "customer_health": _select(
            "acted",
            _ID
            + f"activity_health~; revenue_health~; recency_health~; {_units('engagement1', 1)} > engagement_health~; {_units('score1', 1)} > health_score~; health_category; health_trend",
        ),
        "prior_health": _select("acted", f"customer_id#; {_units('prior_score1', 1)} > prior_health_score~"),
        # concentration
        "ltm_revenue": _select("earning", sums),
        "revenue_rank": _select(ordered, f"r > revenue_rank#; {sums}"),
        "concentration": _select("tiers", _CONC),
        "exit_scenarios": _select(
            "tiers",
            f"{_day(S)} > snapshot_date@; {_units('top10', 2)} > scenario_top10_exit_risk~; {_units('critical_p', 2)} > scenario_critical_exit_risk~",
        ),
        "portfolio_headline": _select(
            "tiers",
            f"""{_day(S)} > snapshot_date@; {_units(_pct('top10', 'total_p', 1), 1)} > top_10_pct~; {_units('(1000 - ' + _pct('top10', 'total_p', 1) + ')', 1)} > remaining_pct~;
 if(top10 * 2 >= total_p, 'CRITICAL', if(top10 * 10 >= total_p * 4, 'HIGH', if(top10 * 10 >= total_p * 3, 'MEDIUM', 'LOW'))) > revenue_dependency_score""",
        ),
        "concentration_ladder": _select(ladder, _LADDER),
        "top_customers": _select(ladder, _LADDER, "revenue_rank <= 20"),
        "top_customers_chart": _select(
            ladder,
            "revenue_rank#; customer_name[:28] > label; pounds > revenue_ltm~; health_category",
            "revenue_rank <= 10",
        ),
        "rank_cliff": _select(
            following,
            f"r > revenue_rank#; {sums}; {_units('nxt', 2)} > next_revenue~; {_units(_half_up('(ltm_p * 100)', 'nullif(nxt, 0)'), 2)} > drop_factor~",
            "nxt IS NOT NULL",
        ),
        # actions
        "rm_actions": _select("acted", _ACTION),
        "customer_watchlist": _select("acted", _WATCH, "action_type <> 'Monitor'"),
        "rm_workbook": _select(
            "acted", _WATCH, "action_type IN ('Retain', 'Review') AND priority IN ('P1', 'P2', 'P3') AND segment IN ('VIP', 'Growth', 'At-Risk')"
        ),
        "rm_workbook_by_manager": _select(
            "acted", _WATCH, "action_type <> 'Monitor' AND assigned_rm IN ('RM003', 'RM007')"
        ),
        "workbook_counts": _counts(
            "acted", "action_type", where="action_type <> 'Monitor' AND priority IN ('P1', 'P2', 'P3')"
        ),
        "action_breakdown": _counts("acted", "action_type", "priority"),
        "priority_counts": _counts("acted", "priority"),
        "action_matrix": _select(
            "acted",
            "action_type; " + "; ".join(f"count(*) FILTER (priority = '{p}') > \"{p}\"#" for p in c.PRIORITIES) + "; count(*) > total#",
            tail=" GROUP BY action_type",
        ),
        "priority_agenda": _select(_AGENDA, "position#; priority; sla_days#; action; customers#; owner"),
        # exceptions
        "exceptions": _select("alerts", _ALERT),
        **{
            key: _select("alerts", _ALERT, f"exception_type = '{name}'")
            for key, name in (
                ("exc_critical", "CRITICAL CUSTOMER"),
                ("exc_vip_deteriorating", "VIP DETERIORATING"),
                ("exc_revenue_decline", "REVENUE DECLINE"),
                ("exc_activity_cliff", "ACTIVITY CLIFF"),
                ("exc_segment_downgrade", "SEGMENT DOWNGRADE"),
            )
        },
        "exception_feed": _select("alerts", _FEED),
        "exception_feed_p1": _select("alerts", _FEED, "severity = 'P1'"),
        "exception_feed_filtered": _select(
            "alerts", _FEED, "severity IN ('P2', 'P3') AND exception_type IN ('REVENUE DECLINE', 'ACTIVITY CLIFF')"
        ),
        "exception_breakdown": _counts("alerts", "exception_type", "severity"),
        "severity_counts": _counts("alerts", "severity"),
        "exception_types": _select("(SELECT DISTINCT exception_type FROM alerts)", "exception_type"),
        # KPIs
        "executive_kpis": _select(_BOARD, _KPI),
        "executive_summary": _select(_BOARD, _SUMMARY),
        # distributions and explorer
        "health_distribution": _counts("acted", "health_category"),
        "trend_distribution": _counts("acted", "health_trend"),
        "segment_distribution": _counts("acted", "segment"),
        "health_heatmap": _select(
            "acted",
            f"""segment; health_category; health_trend; count(*) > customer_count#; {_units(_pct('count(*)', 'CAST(sum(count(*)) OVER (PARTITION BY segment) AS BIGINT)', 1), 1)} > pct_of_segment~;
 {_units(_half_up('sum(score1)', 'count(*)'), 1)} > avg_health_score~; {_half_up('sum(ltm_p)', '100')} > segment_revenue~""",
            tail=" GROUP BY segment, health_category, health_trend",
        ),
        "health_heatmap_pivot": _select(
            "(SELECT unnest(['VIP', 'Growth', 'Regular', 'At-Risk', 'Dormant']) AS segment) LEFT JOIN acted USING (segment)",
            "segment; " + "; ".join(_per_category(category) for category in c.HEALTH_CATEGORIES),
            tail=" GROUP BY segment",
        ),
        "customer_explorer": _select("acted", _EXPLORE),
        "customer_explorer_filtered": _select(
            "acted",
            _EXPLORE,
            "segment IN ('VIP', 'Growth') AND health_category IN ('Healthy', 'Watchlist') AND health_trend IN ('Improving', 'Deteriorating') AND action_type IN ('Retain', 'Cross-Sell')",
        ),
        "explorer_table": _select(
            "acted",
            f"""customer_name; segment; health_category; health_trend; {_half_up('score1', '10')} > health_score~; {_LTM_POUNDS} > revenue_ltm~;
 {_DELTA1} > revenue_qoq_pct~; n_current > txn_count_90d#; n_products > products_active#; action_type; priority; assigned_rm""",
        ),
        "feed_table": _select(
            "alerts",
            f"severity; exception_type; customer_name; segment; health_category; {_LTM_POUNDS} > revenue_ltm~; {_DELTA1} > revenue_delta_pct~; description; recommended_action; assigned_rm",
        ),
        "workbook_table": _select(
            "acted",
            f"priority; sla_days#; customer_name; segment; health_category; health_trend; {_LTM_POUNDS} > revenue_ltm~; {_DELTA1} > revenue_delta_pct~; action_type; action_description; assigned_rm",
            "action_type <> 'Monitor' AND priority <> 'P4'",
        ),
        "explorer_kpis": _explorer_kpis("true"),
        "explorer_kpis_filtered": _explorer_kpis("segment IN ('VIP', 'Growth')"),
        # findings
        "decline_by_segment": _select(
            "acted",
            f"segment; count(*) > customers#; {_units(_half_up('sum(delta2)', '(10 * count(*))'), 1)} > avg_decline_pct~; {_units(_half_up('min(delta2)', '10'), 1)} > worst_decline_pct~",
            f"delta2 <= {CFG.revenue_decline_pct * 100}",
            " GROUP BY segment",
        ),
        "health_by_segment": _select(
            "acted",
            f"segment; count(*) > customers#; {_units(_half_up('sum(score1)', 'count(*)'), 1)} > avg_health_score~; count(*) FILTER (worse) > deteriorating#",
            tail=" GROUP BY segment",
        ),
        "early_warning": _select(
            "acted",
            f"segment; count(*) > customers#; {_half_up('sum(ltm_p)', '(100 * count(*))')} > avg_revenue_ltm~",
            "health_category = 'Healthy' AND worse",
            " GROUP BY segment",
        ),
        "segment_transitions": _shared("prior_segment", "segment", "segment_change"),
        "segment_change_summary": _shared("segment_change"),
        "trend_shares": _shared("health_trend"),
        "p1_shortfall": _select(
            "(SELECT count(*) AS k, CAST(coalesce(sum(current_p), 0) AS BIGINT) AS now_p, CAST(coalesce(sum(prior_p), 0) AS BIGINT) AS before_p FROM acted WHERE customer_id IN (SELECT customer_id FROM alerts WHERE severity = 'P1'))",
            f"k > customers#; {_units('now_p', 2)} > revenue_current~; {_units('before_p', 2)} > revenue_prior~; {_units('(now_p - before_p)', 2)} > change~; {_units(_pct('now_p - before_p', 'before_p', 1), 1)} > change_pct~",
        ),
    }
    return sql
