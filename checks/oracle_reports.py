"""DuckDB SQL for the reports, written over the same derived roles."""

from __future__ import annotations

from farelane.functions import labels

SPAN = "event_time >= TIMESTAMP '1994-12-31 17:00:00' AND event_time < TIMESTAMP '2001-12-31 17:00:00'"
PARTS = (
    "strftime(event_time, '%Y') AS year, strftime(event_time, '%m') AS month, strftime(event_time, '%d') AS day, "
    "strftime(event_time, '%H') AS hour, CAST(event_time + INTERVAL 7 HOUR AS DATE) AS local_day"
)
TICKET4 = "['L', 'T', 'Q', 'N']"

# name -> (roles it needs, SQL)
ROLES: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": ((), "SELECT *, l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS event_time FROM lineitem"),
    "detail_all": (("lines",), f"""
        SELECT l_orderkey AS transport_trans_id, l_suppkey AS stage_id, l_partkey AS price_id,
               CASE WHEN l_returnflag = 'N' THEN 'L' WHEN l_returnflag = 'A' THEN 'T'
                    WHEN l_linestatus = 'F' THEN 'Q' ELSE 'N' END AS price_type,
               CAST(l_linenumber % 3 AS VARCHAR) AS price_ticket_type,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price_amount,
               CAST((l_partkey // 25) % 5 + 1 AS VARCHAR) AS vehicle_type,
               event_time, event_time AS checkin_datetime, {PARTS}
        FROM lines"""),
    "detail": (("detail_all",), f"SELECT * FROM detail_all WHERE {SPAN}"),
    "toll": ((), """
        SELECT CAST(n_nationkey AS BIGINT) AS toll_id, n_name || ' - ' || r_name AS toll_name,
               CASE WHEN n_nationkey % 2 = 0 THEN 'OPEN' ELSE 'CLOSED' END AS toll_type,
               CAST(n_regionkey AS BIGINT) AS cycle_id, r_name AS cycle_name
        FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "txn_all": (("toll",), f"""
        SELECT o_orderkey AS transport_trans_id, 'FE' || o_orderkey AS fe_trans_id, o_custkey AS vehicle_id,
               o_custkey AS account_id, c_name AS account_number, CAST(o_custkey % 5 + 1 AS VARCHAR) AS vehicle_type,
               i.toll_id AS checkin_toll_id, x.toll_id AS checkout_toll_id,
               i.toll_name AS checkin_toll_name, x.toll_name AS checkout_toll_name,
               x.toll_type, x.cycle_id, x.cycle_name,
               i.toll_id * 2 + 2 - o_orderkey % 2 AS checkin_lane_id, x.toll_id * 2 + 1 + o_orderkey % 2 AS checkout_lane_id,
               'Lane ' || (2 - o_orderkey % 2) AS checkin_lane_name, 'Lane ' || (1 + o_orderkey % 2) AS checkout_lane_name,
               o_orderpriority AS checkout_channel,
               CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'P' THEN 'ROLL' ELSE 'SUCCESS' END AS charge_status,
               CASE o_orderstatus WHEN 'F' THEN '{labels.FAILED}' WHEN 'P' THEN '{labels.CANCELLED}' ELSE 'Thành công' END AS charge_in_status,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
               CASE WHEN o_orderkey % 10 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2))
                    ELSE CAST(0 AS DECIMAL(18,2)) END AS voucher_used_amount,
               CAST(c_nationkey AS BIGINT) AS boo, 'E' || o_custkey AS etag_number, 'P' || o_custkey AS plate,
               c_mktsegment AS vehicle_group, event_time - INTERVAL 1 HOUR AS checkin_datetime,
               event_time AS checkout_datetime, event_time, {PARTS}
        FROM (SELECT *, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS event_time FROM orders)
        JOIN customer ON o_custkey = c_custkey
        JOIN toll x ON x.toll_id = c_nationkey JOIN toll i ON i.toll_id = (c_nationkey + 1) % 25"""),
    "txn": (("txn_all",), f"SELECT * FROM txn_all WHERE {SPAN}"),
    "subscription": ((), f"""
        SELECT * FROM (
            SELECT user_id % 25 AS boo, CAST(user_id % 5 + 1 AS VARCHAR) AS vehicle_type,
                   {TICKET4}[CAST(event_id % 4 + 1 AS INTEGER)] AS price_type, CAST(value AS DECIMAL(18,2)) AS price_amount,
                   user_id % 25 AS toll_id, (user_id + 1) % 25 AS toll_in_id, event_time, {PARTS}
            FROM (SELECT *, ts - INTERVAL 9588 DAY AS event_time FROM events WHERE event_type = 'purchase'))
        WHERE {SPAN}"""),
    "mediation": ((), """
        SELECT l_orderkey AS transport_trans_id, 'P' || l_orderkey AS plate,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS price
        FROM lineitem GROUP BY l_orderkey"""),
    "violation": ((), f"""
        SELECT l_orderkey AS transport_trans_id, CAST(MAX(l_linenumber) % 5 + 1 AS VARCHAR) AS vehicle_type,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS price_amount,
               '{labels.TO_BE_COLLECTED}' AS status
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey"""),
    "before_adj": (("lines",), f"""
        SELECT l_orderkey AS id, l_suppkey % 25 AS fromtollid, (l_suppkey + 1) % 25 AS totollid,
               CASE l_returnflag WHEN 'N' THEN 'L' WHEN 'A' THEN 'T' ELSE 'Q' END AS tickettype,
               l_linenumber % 4 AS prioritytype, CAST(l_extendedprice AS DECIMAL(18,2)) AS paidamount,
               l_linestatus, event_time, {PARTS}
        FROM lines WHERE {SPAN}"""),
    "stage": (("toll",), """
        SELECT s_suppkey AS stage_id, 'ST' || s_suppkey AS stage_code, s_name AS stage_name, a.cycle_id, a.cycle_name,
               a.toll_id AS checkin_toll_id, a.toll_name AS checkin_toll_name,
               b.toll_id AS checkout_toll_id, b.toll_name AS checkout_toll_name, b.toll_type,
               CASE WHEN s_suppkey % 10 = 9 THEN 'false' ELSE 'true' END AS status, a.toll_id AS boo
        FROM supplier JOIN toll a ON a.toll_id = s_nationkey JOIN toll b ON b.toll_id = (s_nationkey + 1) % 25"""),
    "stage_closed": (("stage",), "SELECT * FROM stage WHERE status = 'true'"),
    "lane": ((), """
        SELECT CAST(n_nationkey * 2 + k AS BIGINT) AS toll_lane_id, CAST(n_nationkey AS BIGINT) AS toll_id,
               CAST(k AS BIGINT) AS lane_code, 'Lane ' || k AS lane_name
        FROM nation, (VALUES (1), (2)) t(k)"""),
    "price": ((), f"""
        SELECT p_partkey AS price_id, p_partkey % 25 AS toll_id, CAST((p_partkey // 25) % 5 + 1 AS VARCHAR) AS vehicle_type,
               {TICKET4}[CAST(p_size % 4 + 1 AS INTEGER)] AS price_type, CAST(p_size % 3 AS VARCHAR) AS price_ticket_type,
               CAST(p_retailprice AS DECIMAL(18,2)) AS price_amount
        FROM part"""),
    "tariff": (("price",), "SELECT * FROM price QUALIFY row_number() OVER (PARTITION BY toll_id, vehicle_type ORDER BY price_id) = 1"),
    "vehicle_class": ((), "SELECT * FROM (VALUES ('1', 'Class 1'), ('2', 'Class 2'), ('3', 'Class 3'), ('4', 'Class 4'), ('5', 'Class 5')) t(code, name)"),
    "ticket_class": ((), "SELECT * FROM (VALUES ('0', 'Normal'), ('1', 'Reduced'), ('2', 'Priority')) t(code, name)"),
    "share": ((), f"""
        SELECT CAST(vt AS VARCHAR) AS vehicle_type, pt AS price_type, CAST(n_nationkey AS BIGINT) AS boo,
               CASE WHEN (vt + n_nationkey) % 3 = 0 THEN 'FIXED' ELSE 'PERCENT' END AS distribution_type,
               CAST(n_nationkey % 20 + 1 AS DECIMAL(9,2)) AS boo_split_value,
               CASE WHEN n_nationkey % 2 = 1 THEN DATE '1998-01-01' ELSE DATE '1995-01-01' END AS effective_date,
               CASE WHEN n_nationkey % 2 = 1 THEN DATE '2001-12-31' ELSE DATE '1999-12-31' END AS expiry_date
        FROM nation, (VALUES (1), (2), (3), (4), (5)) v(vt), (VALUES ('L'), ('T'), ('Q'), ('N')) p(pt)"""),
}


def with_roles(roles: str, body: str) -> str:
    """``body`` below the CTEs of the named roles and of the roles they need."""
    chosen: dict[str, str] = {}

    def add(name: str) -> None:
        needs, text = ROLES[name]
        for need in needs:
            add(need)
        chosen.setdefault(name, text)

    for name in roles.split():
        add(name)
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in chosen.items()) + "\n" + body


def label(level: str, day: str = "local_day") -> dict[str, str]:
    """Label expressions of a level."""
    return {
        "day": {"datetime_id": f"strftime({day}, '%Y%m%d') || '00'", "date": f"strftime({day}, '%Y-%m-%d')"},
        "month": {"month_id": f"strftime({day}, '%Y-%m')"},
        "quarter": {"quarter_id": f"strftime({day}, '%Y') || '-Q' || quarter({day})"},
        "year": {"year_id": f"strftime({day}, '%Y')"},
    }[level]


def labelled(level: str) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in label(level).items())


def total(expr: str, name: str) -> str:
    """Exact decimal sum, handed over as a double like every money column of a result."""
    return f"CAST(SUM({expr}) AS DOUBLE) AS {name}"


def money(expr: str, name: str | None = None) -> str:
    """A money column of a result."""
    return f"CAST({expr} AS DOUBLE) AS {name or expr.split('.')[-1]}"


def nulls(*names: str, kind: str = "DOUBLE") -> str:
    return ", ".join(f"CAST(NULL AS {kind}) AS {n}" for n in names)


def pivot() -> str:
    parts = []
    for code, name in labels.PRICE_TYPES.items():
        parts.append(f"CAST(SUM(CASE WHEN price_type = '{code}' THEN quantity END) AS DOUBLE) AS {name}_pass_count")
        parts.append(total(f"CASE WHEN price_type = '{code}' THEN amount END", f"{name}_pass_revenue"))
    return ", ".join([*parts, "CAST(SUM(quantity) AS BIGINT) AS total_pass_count", total("amount", "total_revenue")])


VEHICLE_CASE = "CASE vehicle_type " + " ".join(
    f"WHEN '{code}' THEN '{text}'" for code, text in labels.VEHICLE_TYPE_LABELS.items()
) + f" ELSE '{labels.UNKNOWN_VEHICLE_TYPE}' END"
ROUTE = r"string_split_regex(checkout_toll_name, '\s*-\s*')[2]"
NO_TAX = nulls("tax_amount", "investment_amount", "net_revenue")
PUBLIC = f"'{labels.PUBLIC_INVESTMENT}' AS cycle_type"
PRIVATE = f"'{labels.PRIVATE_INVESTMENT}' AS cycle_type"


def summary_by_stage() -> str:
    return with_roles("detail stage_closed ticket_class price", f"""
        SELECT datetime_id, date, vehicle_type, fare_category, {pivot()}, cycle_name AS route,
               checkin_toll_name AS entry_plaza, checkout_toll_name AS exit_plaza, 'ETC' AS toll_channel,
               {nulls('entry_lane', 'exit_lane', kind='VARCHAR')}
        FROM (SELECT {labelled('day')}, p.vehicle_type, c.name AS fare_category, d.price_type, s.cycle_name,
                     s.checkin_toll_name, s.checkout_toll_name,
                     COUNT(DISTINCT transport_trans_id) AS quantity, SUM(d.price_amount) AS amount
              FROM detail d JOIN stage_closed s ON d.stage_id = s.stage_id
              JOIN ticket_class c ON c.code = d.price_ticket_type JOIN price p ON d.price_id = p.price_id
              WHERE d.price_type = 'L' GROUP BY ALL)
        GROUP BY datetime_id, date, vehicle_type, fare_category, cycle_name, checkin_toll_name, checkout_toll_name""")


def summary_by_price() -> str:
    return with_roles("txn price", f"""
        SELECT date, vehicle_type, fare_category, {pivot()}, route, entry_plaza, exit_plaza, 'ETC' AS toll_channel
        FROM (SELECT t.checkout_datetime AS date, t.vehicle_type, p.price_ticket_type AS fare_category, p.price_type,
                     t.cycle_name AS route, t.checkin_toll_id AS entry_plaza, t.checkout_toll_id AS exit_plaza,
                     COUNT(*) AS quantity, SUM(t.total_amount) AS amount
              FROM txn t JOIN price p ON t.checkout_toll_id = p.toll_id AND t.vehicle_type = p.vehicle_type
              GROUP BY ALL)
        GROUP BY date, vehicle_type, fare_category, route, entry_plaza, exit_plaza""")


def summary_by_lane(level: str) -> str:
    names = ", ".join(label(level))
    return with_roles("txn detail_all", f"""
        SELECT {names}, vehicle_type, fare_category, {pivot()}, route, entry_plaza, exit_plaza, 'ETC' AS toll_channel,
               entry_lane, exit_lane
        FROM (SELECT {', '.join(f'{e} AS {n}' for n, e in label(level, 't.local_day').items())}, t.vehicle_type,
                     d.price_ticket_type AS fare_category, d.price_type, {ROUTE} AS route,
                     t.checkin_toll_name AS entry_plaza, t.checkout_toll_name AS exit_plaza,
                     t.checkin_lane_name AS entry_lane, t.checkout_lane_name AS exit_lane,
                     COUNT(*) AS quantity, SUM(t.total_amount) AS amount
              FROM txn t JOIN detail_all d ON t.transport_trans_id = d.transport_trans_id GROUP BY ALL)
        GROUP BY {names}, vehicle_type, fare_category, route, entry_plaza, exit_plaza, entry_lane, exit_lane""")


def txn_revenue(level: str, by: str) -> str:
    keys = {"lane": "route, plaza_name, lane_name", "plaza": "route, plaza_name", "route": "route"}[by]
    base = f"(SELECT *, {ROUTE} AS route, checkout_toll_name AS plaza_name, checkout_lane_name AS lane_name FROM txn)"
    group = f"{', '.join(label(level).values())}, {keys}, vehicle_group"

    def branch(vehicle: str, kind: str, extra: str) -> str:
        return f"""
        SELECT {labelled(level)}, {keys}, {vehicle} AS vehicle_transaction_type, vehicle_group AS revenue_group,
               COUNT(*) AS transaction_count, {total('total_amount', 'gross_revenue')},
               {total('voucher_used_amount', 'discount_amount')}, {NO_TAX}, '{kind}' AS type, {PUBLIC}
        FROM {base} GROUP BY {group}{extra}"""

    return with_roles("txn", branch(VEHICLE_CASE, labels.BY_VEHICLE, ", vehicle_type") + " UNION ALL " + branch("'ETC'", labels.BY_CHANNEL, ""))


def detail_revenue(by: str, level: str = "day") -> str:
    keys = {"plaza": "s.cycle_name AS route, s.checkout_toll_name AS plaza_name", "route": "s.cycle_name AS route"}[by]
    priced = "JOIN price p ON d.price_id = p.price_id JOIN vehicle_class c ON c.code = p.vehicle_type"

    def branch(vehicle: str, kind: str, joins: str) -> str:
        return f"""
        SELECT {labelled(level)}, {keys}, {vehicle} AS vehicle_transaction_type, v.c_mktsegment AS revenue_group,
               COUNT(DISTINCT d.transport_trans_id) AS transaction_count, {total('d.price_amount', 'gross_revenue')},
               {nulls('discount_amount')}, {NO_TAX}, '{kind}' AS type, {PUBLIC}
        FROM detail d JOIN stage_closed s ON d.stage_id = s.stage_id JOIN orders o ON o.o_orderkey = d.transport_trans_id
        JOIN customer v ON v.c_custkey = o.o_custkey {joins} GROUP BY ALL"""

    channel = branch("'ETC'", labels.BY_CHANNEL, priced if by == "plaza" else "")
    return with_roles("detail stage_closed price vehicle_class", branch("c.name", labels.BY_VEHICLE, priced) + " UNION ALL " + channel)


def share_daily() -> str:
    return with_roles("detail stage_closed", f"""
        SELECT datetime_id, date, route, plaza_name, cycle_type, gross_revenue,
               {nulls('investment_amount', 'discount_amount', 'tax_amount', 'pre_allocation_revenue', 'bot1_revenue',
                      'boo1_revenue', 'nsnn_revenue', 'dbvn_revenue', 'dvvh_revenue')}
        FROM (SELECT {labelled('day')}, s.cycle_name AS route, s.checkout_toll_name AS plaza_name,
                     {total('d.price_amount', 'gross_revenue')}
              FROM detail d JOIN stage_closed s ON d.stage_id = s.stage_id WHERE d.price_type = 'L' GROUP BY ALL),
             (VALUES ('{labels.PRIVATE_INVESTMENT}'), ('{labels.PUBLIC_INVESTMENT}')) k(cycle_type)""")


def share_period(level: str) -> str:
    d_label = ", ".join(f"{e} AS {n}" for n, e in label(level, "d.local_day").items())
    a_label = ", ".join(f"{e} AS {n}" for n, e in label(level, "a.local_day").items())
    names = ", ".join(label(level))
    return with_roles("detail txn_all subscription", f"""
        SELECT {names}, route, plaza_name, {PRIVATE}, {total('revenue', 'gross_revenue')},
               {nulls('investment_amount', 'discount_amount', 'tax_amount', 'pre_allocation_revenue', 'bot1_revenue',
                      'bot2_revenue', 'boo1_revenue', 'nsnn_revenue', 'dbvn_revenue', 'dvvh_revenue')}
        FROM (SELECT {d_label}, i.cycle_name AS route, t.checkout_toll_name AS plaza_name, d.price_amount AS revenue
              FROM detail d JOIN txn_all t ON d.transport_trans_id = t.transport_trans_id
              LEFT JOIN toll i ON i.toll_id = t.checkin_toll_id
              UNION ALL
              SELECT {a_label}, b.cycle_name, e.toll_name, a.price_amount
              FROM subscription a JOIN toll b ON a.toll_id = b.toll_id JOIN toll e ON a.toll_in_id = e.toll_id
              WHERE a.price_type = 'L')
        GROUP BY {names}, route, plaza_name""")


SPLIT = """CAST(CASE WHEN s.distribution_type = 'PERCENT' THEN x.price_amount * coalesce(s.boo_split_value, 0) * 0.01
                     WHEN s.distribution_type = 'FIXED' THEN coalesce(s.boo_split_value, 0) ELSE 0 END AS DECIMAL(30,6))"""


def split_rows(select: str, rows: str, rule_day: str) -> str:
    """Fact rows (alias x) with their split rule and the split amount, row by row."""
    return f"""
        SELECT {select}, x.price_amount, {SPLIT} AS split
        FROM ({rows}) x LEFT JOIN share s ON x.vehicle_type = s.vehicle_type AND x.price_type = s.price_type
             AND x.boo = s.boo AND {rule_day} BETWEEN s.effective_date AND s.expiry_date"""


TRIPS = """SELECT d.local_day, d.vehicle_type, d.price_type, d.price_amount, t.boo, t.checkout_toll_id AS toll_id
           FROM detail d JOIN txn_all t ON d.transport_trans_id = t.transport_trans_id WHERE d.price_type = 'L'"""
PASSES = "SELECT local_day, vehicle_type, price_type, price_amount, boo, toll_id FROM subscription"


def share_split() -> str:
    rows = split_rows("x.local_day, x.toll_id", f"{TRIPS} UNION ALL {PASSES}", "CAST(date_trunc('month', x.local_day) AS DATE)")
    return with_roles("detail txn_all subscription share", f"""
        SELECT month_id, route, plaza_name, {PRIVATE}, gross_revenue, {nulls('investment_amount', 'discount_amount', 'tax_amount')},
               gross_revenue AS pre_allocation_revenue, {nulls('bot1_revenue', 'bot2_revenue')}, boo1_revenue,
               {nulls('nsnn_revenue', 'dbvn_revenue', 'dvvh_revenue')}
        FROM (SELECT {labelled('month')}, toll.cycle_name AS route, toll.toll_name AS plaza_name,
                     {total('price_amount', 'gross_revenue')}, CAST(SUM(split) AS DOUBLE) AS boo1_revenue
              FROM ({rows}) r JOIN toll ON toll.toll_id = r.toll_id GROUP BY ALL)""")


def operator_pairs(with_passes: bool) -> str:
    source = f"{TRIPS} UNION ALL {PASSES}" if with_passes else TRIPS
    rows = split_rows("x.local_day, x.boo", source, "x.local_day")
    one, two = ("a.boo", "b.boo") if with_passes else ("na.n_name", "nb.n_name")
    date = "" if with_passes else "strftime(a.local_day, '%Y-%m-%d') AS date,"
    names = "" if with_passes else "LEFT JOIN nation na ON na.n_nationkey = a.boo LEFT JOIN nation nb ON nb.n_nationkey = b.boo"
    gap = "difference" if with_passes else "differ"
    return with_roles("detail txn_all subscription share", f""",
        revenue AS (SELECT local_day, boo, CAST(SUM(split) AS DECIMAL(38,6)) AS amount FROM ({rows}) GROUP BY local_day, boo)
        SELECT strftime(a.local_day, '%Y%m%d') || '00' AS datetime_id, {date} {one} AS boo1, {money('a.amount', 'boo1_revenue')},
               {two} AS boo2, {money('b.amount', 'boo2_revenue')}, {money('abs(a.amount - b.amount)', gap)}
        FROM revenue a JOIN revenue b ON a.local_day = b.local_day AND a.boo < b.boo {names}""")


def adjusted(kind: str, condition: str) -> str:
    return f"""
    SELECT {labelled('day')}, s.toll_type, s.boo, s.cycle_id, s.cycle_name, tickettype AS ticket_type,
           prioritytype AS price_ticket_type, COUNT(DISTINCT id) AS qty, {total('paidamount', 'amount')}, '{kind}' AS type
    FROM before_adj f JOIN (SELECT DISTINCT checkin_toll_id, checkout_toll_id, toll_type, boo, cycle_id, cycle_name FROM stage_closed) s
         ON f.fromtollid = s.checkin_toll_id AND f.totollid = s.checkout_toll_id WHERE {condition} GROUP BY ALL"""


def failed(by_plaza: bool, ticket: str, level: str = "day") -> str:
    plaza = "s.checkout_toll_name AS toll_name," if by_plaza else ""
    return with_roles("detail txn_all stage_closed price vehicle_class", f"""
        SELECT {', '.join(f'{e} AS {n}' for n, e in label(level, 'd.local_day').items())}, s.cycle_name, {plaza}
               c.name AS vehicle_type, p.{ticket}, COUNT(DISTINCT d.transport_trans_id) AS quantity, {total('d.price_amount', 'amount')}
        FROM detail d JOIN txn_all t ON d.transport_trans_id = t.transport_trans_id JOIN stage_closed s ON d.stage_id = s.stage_id
        JOIN price p ON d.price_id = p.price_id JOIN vehicle_class c ON c.code = p.vehicle_type
        WHERE t.charge_in_status IN ('{labels.CANCELLED}', '{labels.FAILED}') AND d.price_type = 'L' GROUP BY ALL""")


def payment(select: str, joins: str = "", level: str = "day") -> str:
    return with_roles("txn", f"""
        SELECT *, round(CAST(successful_transactions AS DOUBLE) / total_transactions, 6) AS success_rate
        FROM (SELECT {labelled(level)}, {select}, COUNT(*) AS total_transactions, {total('total_amount', 'total_amount')},
                     COUNT(*) FILTER (charge_status = 'SUCCESS') AS successful_transactions,
                     COUNT(*) FILTER (charge_status = 'FAILED') AS failed_transactions,
                     {total("CASE WHEN charge_status = 'ROLL' THEN total_amount ELSE 0 END", 'refund_amount')},
                     {total("CASE WHEN charge_status = 'ROLL' THEN 0 ELSE total_amount END", 'net_amount')}
              FROM txn {joins} GROUP BY ALL)""")


def _texts(*names: str) -> str:
    return nulls(*names, kind="VARCHAR")


PRICED = "txn t JOIN tariff p ON t.checkout_toll_id = p.toll_id AND t.vehicle_type = p.vehicle_type"
OPEN_MEASURES = (
    "bot_price_increase", "bot_amount_increase", "interoperable_price_increase", "interoperable_amount_increase",
    "increase_adjustment", "bot_amount_decrease", "interoperable_amount_decrease", "decrease",
    "bot_amount_total", "interoperable_amount_total", "total", "bot_amount_total_all", "interoperable_amount_total_all",
)


def report_sql() -> dict[str, str]:
    """SQL per report query."""
    out = {
        "transaction_summary_day": summary_by_stage(),
        "transaction_summary": summary_by_price(),
        "transaction_summary_month": summary_by_lane("month"),
        "transaction_summary_year": summary_by_lane("year"),
        "plaza_revenue_day": detail_revenue("plaza"),
        "route_revenue_day": detail_revenue("route"),
        "plaza_route_share_day": share_daily(),
        "plaza_route_share_split": share_split(),
        "operator_pair_comparison": operator_pairs(False),
        "operator_pair_comparison_all": operator_pairs(True),
        "lane_revenue_day": txn_revenue("day", "lane"),
        "backfill_daily": txn_revenue("day", "lane"),
    }
    for level in ("month", "quarter", "year"):
        for by in ("lane", "plaza", "route"):
            out[f"{by}_revenue_{level}"] = txn_revenue(level, by)
        out[f"plaza_route_share_{level}"] = share_period(level)
    out["transaction_summary_one_month"] = f"SELECT * FROM ({out['transaction_summary_month']}) WHERE month_id = '1997-06'"
    out["plaza_route_share_one_month"] = f"SELECT * FROM ({out['plaza_route_share_month']}) WHERE month_id = '1997-06'"
    for level in ("day", "month", "year"):
        out[f"route_revenue_rollup_{level}"] = detail_revenue("route", level)
    out["second_fact_reach"] = with_roles("detail txn_all", """
        SELECT COUNT(*) AS pairs, max(date_diff('day', t.local_day, d.local_day)) AS days_before, max(date_diff('day', d.local_day, t.local_day)) AS days_after
        FROM detail d JOIN txn_all t ON d.transport_trans_id = t.transport_trans_id""")
    out["plaza_traffic"] = with_roles("detail txn_all stage", f"""
        SELECT date, plaza_name, vehicle_type_profile, n AS data_a_tickets_sold, revenue AS data_a_revenue, n AS data_a_traffic,
               CAST(0 AS BIGINT) AS data_b_tickets_sold, CAST(0 AS DOUBLE) AS data_b_revenue, CAST(0 AS BIGINT) AS data_b_traffic,
               n AS total_diff_tickets_sold, revenue AS total_diff_revenue, n AS total_diff_traffic
        FROM (SELECT strftime(d.local_day, '%Y-%m-%d') AS date, s.stage_name AS plaza_name, d.vehicle_type AS vehicle_type_profile,
                     COUNT(*) AS n, {total('d.price_amount', 'revenue')}
              FROM detail d JOIN txn_all t ON d.transport_trans_id = t.transport_trans_id JOIN stage s ON d.stage_id = s.stage_id
              WHERE d.price_type = 'L' GROUP BY ALL)""")
    out["fare_sales_monitoring"] = with_roles("detail stage_closed price vehicle_class", f"""
        SELECT {labelled('day')}, '{labels.SINGLE_TICKET}' AS price_name, c.name AS vehicle_type, {money('d.price_amount')},
               s.checkout_toll_name AS plaza_name, COUNT(DISTINCT transport_trans_id) AS ticket_count, {total('d.price_amount', 'revenue')}
        FROM detail d JOIN stage_closed s ON d.stage_id = s.stage_id JOIN price p ON d.price_id = p.price_id
        JOIN vehicle_class c ON c.code = p.vehicle_type WHERE d.price_type = 'L' GROUP BY ALL""")
    out["frontend_backend_amounts"] = with_roles("txn", f"""
        SELECT *, frontend_amount AS backend_amount, frontend_amount AS difference_amount, 1 AS processing_status
        FROM (SELECT fe_trans_id AS transaction_code, checkout_datetime AS date, cycle_name AS route,
                     checkout_toll_name AS plaza_name, {total('total_amount', 'frontend_amount')} FROM txn GROUP BY ALL)""")
    out["reconcile_front_back"] = with_roles("txn mediation", f"""
        SELECT t.transport_trans_id AS transaction_code, {labelled('day')}, {ROUTE} AS route, checkout_toll_name AS plaza_name,
               etag_number, t.plate AS checkout_plate, m.plate, {money('total_amount', 'frontend_amount')}, {money('m.price', 'backend_amount')},
               {money('abs(total_amount - m.price)', 'difference_amount')}
        FROM txn t JOIN mediation m ON t.transport_trans_id = m.transport_trans_id""")
    out["revenue_simulation"] = with_roles("detail txn stage", f"""
        SELECT {', '.join(f'{e} AS {n}' for n, e in label('day', 'd.local_day').items())}, s.stage_name AS toll_name,
               {ROUTE.replace('checkout_toll_name', 't.checkout_toll_name')} AS cycle_name, t.vehicle_group AS revenue_group,
               d.price_type AS ticket_type, COUNT(*) AS transaction_count, {total('t.total_amount', 'gross_revenue')},
               {total('t.voucher_used_amount', 'discount_amount')}, {PUBLIC}, {NO_TAX}, '{labels.BY_VEHICLE}' AS type
        FROM detail d JOIN txn t ON d.transport_trans_id = t.transport_trans_id AND d.year = t.year AND d.month = t.month
             AND d.day = t.day AND d.hour = t.hour JOIN stage s ON d.stage_id = s.stage_id GROUP BY ALL""")
    out["surcharge_list"] = with_roles("txn violation", f"""
        SELECT {labelled('day')}, checkout_datetime AS pass_time, t.transport_trans_id AS transaction_code,
               checkout_toll_name AS plaza_name, checkout_channel AS transaction_type, plate AS license_plate,
               t.vehicle_type AS collected_vehicle_type, {money('total_amount', 'collected_amount')},
               v.vehicle_type AS reconciled_vehicle_type, {money('v.price_amount', 'reconciled_collected_amount')},
               {_texts('surcharge_reason')}, {money('abs(total_amount - v.price_amount)', 'amount_difference')}
        FROM txn t JOIN violation v ON t.transport_trans_id = v.transport_trans_id WHERE v.status = '{labels.TO_BE_COLLECTED}'""")
    out["operator_revenue_adjusted"] = with_roles("before_adj stage_closed", " UNION ALL ".join([
        adjusted("before_adj_amount", "true"),
        adjusted("adjustment_amount", "EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P' AND o_orderkey = f.id)"),
        adjusted("after_adj_amount", "l_linestatus = 'F'"),
    ]))
    seen = "before_adj JOIN orders ON o_orderkey = id JOIN customer ON c_custkey = o_custkey WHERE l_linestatus = 'F'"
    columns = ", ".join(f"CAST(SUM(n) FILTER (vt = {k}) AS DOUBLE) AS loai_{k}" for k in range(1, 6))
    zeros = ", ".join(f"CAST(0 AS DOUBLE) AS loai_{k}" for k in range(1, 6))
    passes = "CASE WHEN prioritytype IN (2, 3) THEN CAST(COUNT(DISTINCT o_custkey) AS DOUBLE) END"
    out["station_traffic_by_class"] = with_roles("before_adj", f"""
        SELECT datetime_id, date, {columns}, CAST(0 AS DOUBLE) AS monthly_quarterly_pass, CAST(0 AS DOUBLE) AS priority_vehicle
        FROM (SELECT {labelled('day')}, event_time, o_custkey % 5 + 1 AS vt, COUNT(DISTINCT o_custkey) AS n FROM {seen} GROUP BY ALL)
        GROUP BY datetime_id, date
        UNION ALL
        SELECT {labelled('day')}, {zeros}, {passes}, {passes} FROM {seen} GROUP BY {', '.join(label('day').values())}, prioritytype""")
    out["failed_charge_route"] = failed(False, "price_ticket_type")
    out["failed_charge_route_detail"] = failed(False, "price_type")
    out["failed_charge_plaza"] = failed(True, "price_ticket_type")
    out["failed_charge_plaza_detail"] = failed(True, "price_type")
    out["failed_charge_plaza_one_month"] = f"SELECT * FROM ({failed(True, 'price_type', 'month')}) WHERE month_id = '1997-06'"
    out["suspicious_summary"] = with_roles("txn", f"""
        SELECT checkout_datetime AS date, checkout_toll_name AS toll_id, toll_type, checkin_lane_name AS entry_lane_id,
               checkout_lane_name AS exit_lane_id, charge_status AS transaction_type_id, boo AS boo_id, COUNT(*) AS quantity,
               {_texts('transaction_source', 'reconciliation_request_source', 'status', 'station_id', 'station_name',
                       'transaction_source_name', 'reconciliation_request_source_name', 'total')}
        FROM txn GROUP BY ALL""")
    out["suspicious_detail"] = with_roles("txn", f"""
        SELECT DISTINCT checkout_datetime AS date, checkout_toll_name AS toll_id, toll_type, checkin_lane_name AS entry_lane_id,
               checkout_lane_name AS exit_lane_id, charge_status AS unusual_transaction_type, boo AS boo_id,
               plate AS license_plate, vehicle_type, {money('total_amount', 'price')},
               {_texts('transaction_source', 'reconciliation_request_source', 'post_audit_status', 'explanation_status',
                       'attribution_source', 'reconciliation_status', 'station_id', 'station_name', 'transaction_source_id',
                       'transaction_source_name', 'reconciliation_request_source_id', 'reconciliation_request_source_name',
                       'transaction_type_id', 'transaction_type_name', 'rfid', 'status', 'status_name', 'deduction_count',
                       'boo_name', 'requester', 'request_date', 'processor')}
        FROM txn""")
    out["error_statistics"] = with_roles("txn tariff", f"""
        SELECT DISTINCT checkout_datetime AS date, checkin_toll_id AS entry_toll_id, checkout_toll_id AS exit_toll_id,
               charge_status AS transaction_type_id, account_number AS account_code,
               {_texts('transaction_error', 'service_id', 'code', 'transaction_type', 'transaction_type_name',
                       'transaction_error_type', 'entry_toll_name', 'exit_toll_name', 'service_name')}
        FROM {PRICED}""")
    window = "checkout_datetime BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2001-06-01'"
    out["vehicle_trans_detail"] = with_roles("txn_all detail_all stage_closed", f"""
        SELECT CAST(strftime(checkout_datetime, '%Y%m%d%H') AS BIGINT) AS datetime_id, d.transport_trans_id, t.checkin_datetime,
               t.checkout_datetime, plate, etag_number, t.vehicle_type, s.checkin_toll_name, s.checkout_toll_name, d.price_type,
               d.price_ticket_type, charge_status, {money('d.price_amount')}, {money('d.price_amount', 'price_amount_tax')}, {money('total_amount')}, s.cycle_name,
               {nulls('price_bot')}, 'E' AS source_trans, s.stage_name, s.boo, {_texts('boo_type')}, checkin_lane_id, checkout_lane_id
        FROM detail_all d JOIN txn_all t ON d.transport_trans_id = t.transport_trans_id JOIN stage_closed s ON d.stage_id = s.stage_id
        WHERE {window}""")
    out["vehicle_trans_report"] = with_roles("detail_all stage_closed", f"""
        SELECT price_type, price_ticket_type, checkin_toll_name, checkout_toll_name, stage_name,
               COUNT(DISTINCT transport_trans_id) AS quantity, {nulls(*OPEN_MEASURES)}
        FROM detail_all d JOIN stage_closed s ON d.stage_id = s.stage_id
        WHERE {window.replace('checkout_datetime', 'checkin_datetime')} GROUP BY ALL""")
    boos = ", ".join(
        total(f"CASE WHEN boo = {b} THEN total_amount ELSE 0 END", f"boo{i}_revenue") for i, b in enumerate((1, 2, 3), start=1)
    )
    out["card_report"] = with_roles("txn tariff", f"""
        SELECT *, round(CAST(total_revenue AS DOUBLE) / CAST(SUM(total_revenue) OVER (PARTITION BY date) AS DOUBLE), 6) AS card_revenue_rate
        FROM (SELECT {labelled('day')}, p.price_ticket_type AS card_type, COUNT(*) AS total_transactions, {boos},
                     {total('total_amount', 'total_revenue')} FROM {PRICED} GROUP BY ALL)""")
    out["payment_channel"] = payment("checkout_channel AS payment_channel")
    out["payment_provider"] = payment("n_name AS payment_provider", "JOIN nation ON n_nationkey = boo")
    out["station_activity"] = with_roles("txn tariff", f"""
        SELECT {labelled('day')}, checkout_toll_id AS station_id, price_ticket_type AS ticket_type_id, checkout_channel AS toll_channel_id,
               COUNT(*) AS total_transactions, COUNT(*) FILTER (charge_status = 'ROLL') AS abnormal_transactions,
               COUNT(*) FILTER (charge_status = 'FAILED') AS error_transactions,
               COUNT(*) FILTER (charge_status = 'SUCCESS') AS normal_transactions, COUNT(DISTINCT vehicle_id) AS total_vehicle_flow
        FROM {PRICED} GROUP BY ALL""")
    out["other_cases"] = with_roles("txn", f"""
        SELECT checkout_datetime AS date, toll_type, checkout_toll_id AS exit_toll_id, cycle_id AS closed_cycle_id,
               charge_status AS wb_type_id, fe_trans_id AS transaction_code, plate AS plate_number, etag_number AS etag, vehicle_type,
               charge_in_status AS wb_type_name, checkout_toll_name AS exit_toll_name, cycle_name AS closed_cycle_name,
               checkin_datetime AS time_check_in, checkout_datetime AS time_check_out, {money('total_amount', 'toll_total')}
        FROM txn WHERE charge_status <> 'SUCCESS'""")
    out["station_transactions"] = with_roles("txn", f"""
        SELECT {labelled('day')}, checkout_toll_id AS toll_id, toll_type, checkout_toll_name AS station_name,
               checkin_lane_name AS entry_lane_id, checkout_lane_name AS exit_lane_id, charge_status AS transaction_type_id,
               charge_in_status AS transaction_type_name, boo AS boo_id, COUNT(*) AS total_transactions, {total('total_amount', 'total')}
        FROM txn GROUP BY ALL""")
    out["transaction_detail"] = with_roles("txn tariff", f"""
        SELECT checkout_datetime AS date, fe_trans_id AS transaction_code, checkout_channel AS transaction_type,
               charge_status AS transaction_status, checkin_datetime AS entry_time, checkin_toll_name AS entry_station,
               checkout_datetime AS exit_time, checkout_toll_name AS exit_station, etag_number, t.vehicle_type, plate AS license_plate,
               account_number, boo, price_ticket_type AS ticket_type, {money('price_amount', 'standard_fee')},
               {money('total_amount', 'actual_fee')}, {money('total_amount - price_amount', 'adjustment_amount')}
        FROM {PRICED}""")
    out["transactions_by_station"] = with_roles("txn tariff", f"""
        SELECT checkout_datetime AS date, cycle_id AS station_id, checkin_toll_id AS toll_in_id, checkout_toll_id AS toll_out_id,
               boo AS bot_id, price_ticket_type AS ticket_type_id, fe_trans_id AS transaction_code, checkin_datetime AS toll_in_date,
               checkout_datetime AS toll_out_date, plate AS plate_number, etag_number AS etag, t.vehicle_type,
               checkout_toll_name AS toll_name, toll_type, price_type AS ticket_type, {money('price_amount', 'ticket_type_price')},
               account_number AS traffic_account, charge_status AS status
        FROM {PRICED}""")
    out["vehicle_violations"] = with_roles("txn violation", f"""
        SELECT {labelled('day')}, plate AS plate_number, etag_number AS etag, checkout_toll_id AS toll_id, status,
               charge_status AS violation_type, account_number AS traffic_account, COUNT(*) AS violation_count
        FROM txn t JOIN violation v ON t.transport_trans_id = v.transport_trans_id GROUP BY ALL""")
    return out
