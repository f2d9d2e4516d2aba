"""Event patterns per key over the given tables.

The tables hold about 67 events per user in 30 days, so the limits are wider than
a live system's; edge cases at the usual limits are in the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query, us
from tidemark.operators import ordered, patterns
from tidemark.plans import automaton
from tidemark.sources import tables

ev = tables.events
HOUR = 3600 * 1000000


JUMP_SQL = """SELECT event_id, last, current FROM (SELECT event_id, temperature AS current,
    lag(temperature{default}) OVER (PARTITION BY id ORDER BY us, event_id) AS last FROM sensor) WHERE abs(last - current) > 10.0"""


@query("g2_jump_alert", JUMP_SQL.format(default=""))
def _(spark, sf):
    s = tables.sensor(ev(spark, sf))
    return ordered.jump_alerts(s, "id", "ts", "event_id", "temperature", 10.0).drop("id")


@query("g3_jump_alert_from_zero", JUMP_SQL.format(default=", 1, 0.0"))
def _(spark, sf):
    s = tables.sensor(ev(spark, sf))
    return ordered.jump_alerts(s, "id", "ts", "event_id", "temperature", 10.0, True).drop("id")


# The next start is the first open after the deadline, or after a cancel; a
# recursive walk along those links gives every timer.
TIMER_SQL = """
    WITH RECURSIVE m AS ({events}),
    o AS (SELECT *, (SELECT MIN(x.us) FROM m x WHERE x.key = m.key AND x.kind = 'c' AND (x.us, x.event_id) > (m.us, m.event_id)) AS cancel_us
          FROM m WHERE kind = 'o'),
    l AS (SELECT key, us, event_id, cancel_us,
          (SELECT MIN(n.event_id) FROM o n WHERE n.key = o.key AND n.event_id > o.event_id
             AND (n.us > o.us + {span} OR n.us > o.cancel_us)) AS nxt FROM o),
    w AS (SELECT l.* FROM l JOIN (SELECT key, MIN(event_id) AS event_id FROM o GROUP BY key) f USING (key, event_id)
          UNION ALL SELECT l.* FROM w JOIN l ON l.event_id = w.nxt)
    SELECT w.key, w.us AS start, {select} FROM w JOIN o ON o.key = w.key AND o.us BETWEEN w.us AND w.us + {span}
    WHERE w.cancel_us IS NULL OR w.cancel_us > w.us + {span} GROUP BY w.key, w.us {having}"""

RISE_SQL = TIMER_SQL.format(
    span=6 * HOUR,
    events="SELECT id AS key, us, event_id, CASE WHEN temperature > last THEN 'o' ELSE 'c' END AS kind FROM (SELECT *, "
    "lag(temperature, 1, 0.0) OVER (PARTITION BY id ORDER BY us, event_id) AS last FROM sensor) WHERE temperature <> last",
    select=f"w.us + {6 * HOUR} AS alert_at", having="",
)
BURST_SQL = TIMER_SQL.format(
    span=48 * HOUR,
    events="SELECT user_id AS key, us, event_id, CASE WHEN event_type = 'fail' THEN 'o' ELSE 'c' END AS kind FROM login",
    select="MAX(o.us) AS last_fail, COUNT(*) AS fails", having="HAVING COUNT(*) > 1",
)


@query("g4_rise_alert", RISE_SQL)
def _(spark, sf):
    s = tables.sensor(ev(spark, sf))
    out = patterns.rise_alerts(s, "id", "ts", "event_id", "temperature", "6 hours")
    return out.select(F.col("id").alias("key"), us("start"), us("alert_at"))


@query("g5_login_burst", BURST_SQL)
def _(spark, sf):
    out = patterns.login_bursts(
        tables.logins(ev(spark, sf)), "user_id", "ts", "event_id", "event_type", 1, "48 hours"
    )
    return out.select(
        F.col("user_id").alias("key"), us("first_fail", "start"), us("last_fail"), "fails"
    )


PAIR_SQL = f"""
    SELECT user_id, p AS first_at, us AS last_at FROM (SELECT *, lag(us) OVER w AS p, lag(event_type) OVER w AS pt
    FROM login WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
    WHERE event_type = 'fail' AND pt = 'fail' AND us - p < {12 * HOUR}"""


@query("g6_login_pair", PAIR_SQL)
def _(spark, sf):
    out = patterns.login_pairs(
        tables.logins(ev(spark, sf)), "user_id", "ts", "event_id", "event_type", "12 hours"
    )
    return out.select("user_id", us("first_at"), us("last_at"))


TRIPLE_SQL = f"""
    SELECT user_id, p AS first_at, us AS last_at FROM (SELECT *, lag(us, 2) OVER w AS p, lag(event_type) OVER w AS t1,
    lag(event_type, 2) OVER w AS t2 FROM login WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
    WHERE event_type = 'fail' AND t1 = 'fail' AND t2 = 'fail' AND us - p < {24 * HOUR}"""


@query("g7_strict_sequence", TRIPLE_SQL)
def _(spark, sf):
    out = patterns.adjacent_run(
        tables.logins(ev(spark, sf)), "user_id", "ts", "event_id", "event_type", ["fail"] * 3, "24 hours"
    )
    return out.select("user_id", us("first_at"), us("last_at"))


FOLLOWED_SQL = f"""
    SELECT event_id, CASE WHEN e - us < {24 * HOUR} THEN e END AS end_at,
           CASE WHEN e - us < {24 * HOUR} THEN 'pay success' ELSE 'timeout' END AS status FROM
    (SELECT *, MIN(CASE WHEN event_type = 'pay' THEN us END) OVER (PARTITION BY order_id ORDER BY us, event_id
       ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS e FROM order_event) WHERE event_type = 'create'"""


@query("g8_relaxed_sequence", FOLLOWED_SQL)
def _(spark, sf):
    out = patterns.followed_by(
        tables.order_events(ev(spark, sf)), "order_id", "ts", "event_id", "event_type", "create", "pay", "24 hours"
    )
    return out.select("event_id", us("end_at"), "status")


OUTCOME_SQL = f"""
    SELECT event_id, CASE WHEN event_type = 'pay' AND COALESCE(pt, '') <> 'create' THEN 'paid without create'
      WHEN event_type = 'pay' AND us - p < {24 * HOUR} THEN 'pay successfully'
      WHEN event_type = 'pay' THEN 'paid but timed out' ELSE 'pay timeout' END AS status
    FROM (SELECT *, lag(us) OVER w AS p, lag(event_type) OVER w AS pt, lead(us) OVER w AS n, lead(event_type) OVER w AS nt
          FROM order_event WINDOW w AS (PARTITION BY order_id ORDER BY us, event_id))
    WHERE event_type = 'pay' OR COALESCE(nt, '') <> 'pay' OR n - us >= {24 * HOUR}"""


@query("g9_order_outcomes", OUTCOME_SQL)
def _(spark, sf):
    return patterns.order_outcomes(
        tables.order_events(ev(spark, sf)), "order_id", "ts", "event_id", "event_type", "24 hours"
    ).select("event_id", "status")


FILTER_SQL = """
    SELECT event_id, CASE WHEN rn <= 1 THEN 'pass' ELSE 'warning' END AS tag FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id, ad_id, us // 86400000000 ORDER BY us, event_id) AS rn FROM ad_click) WHERE rn <= 2"""


@query("g10_click_filter", FILTER_SQL)
def _(spark, sf):
    return patterns.click_filter(
        tables.ad_clicks(ev(spark, sf)), ["user_id", "ad_id"], "ts", "event_id", 1
    ).select("event_id", "tag")


# a view, a click right after it, two purchases later on, and at last a sign-up or an error
MIXED = [
    automaton.step("view"), automaton.step("click"), automaton.step("purchase", times=2, relaxed=True),
    automaton.step("signup", "error", relaxed=True),
]
MIXED_DAYS = 10
MIXED_SQL = f"""
    WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS i FROM ev),
    n AS (SELECT *, MIN(CASE WHEN event_type = 'purchase' THEN i END) OVER w AS np,
            MIN(CASE WHEN event_type IN ('signup', 'error') THEN i END) OVER w AS ns
          FROM e WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
    SELECT a.user_id, a.event_id, a.us AS first_at, d.us AS last_at FROM n a
    JOIN n b ON b.user_id = a.user_id AND b.i = a.i + 1 AND b.event_type = 'click'
    JOIN n c ON c.user_id = a.user_id AND c.i = b.np JOIN n c2 ON c2.user_id = a.user_id AND c2.i = c.np
    JOIN n d ON d.user_id = a.user_id AND d.i = c2.ns
    WHERE a.event_type = 'view' AND d.us - a.us < {MIXED_DAYS * 24 * HOUR}"""


@query("g8_mixed_pattern", MIXED_SQL)
def _(spark, sf):
    out = automaton.find_sequences(ev(spark, sf), ["user_id"], "ts", "event_id", "event_type", MIXED, f"{MIXED_DAYS} days")
    return out.select("user_id", F.col("first_tie").alias("event_id"), us("first_at"), us("last_at"))
