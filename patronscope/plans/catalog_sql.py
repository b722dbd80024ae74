"""The SQL that checks each query, computed from the base tables without JSON parsing.

Money is summed as ``decimal(18,2)``, so that the order of addition does not show.
"""

from __future__ import annotations

from patronscope.operators import prompts
from patronscope.plans.catalog import AS_OF, CENTROIDS, END_TOKEN, NEAREST, SEGMENT_RULE
from patronscope.sources.star_tables import EVENTS_PER_RECORD, ITEMS_PER_RECORD

_PERSON = """
    c_custkey AS id,
    CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS gender,
    CASE WHEN c_custkey % 17 <> 0 THEN CAST(10 + c_custkey % 70 AS INTEGER) END AS age,
    CASE WHEN c_custkey % 5 >= 3 THEN c_acctbal END AS income,
    c_acctbal >= 0 AS is_active
"""

_AGE_GROUP = """CASE WHEN age < 18 THEN '<18' WHEN age < 25 THEN '18-25' WHEN age < 35 THEN '25-35'
    WHEN age < 50 THEN '35-50' ELSE '>50' END"""
_PERIOD = """CASE WHEN hour(ts) < 6 THEN '0-6clock' WHEN hour(ts) < 12 THEN '6-12clock'
    WHEN hour(ts) < 18 THEN '12-18clock' ELSE '18-24clock' END"""

_ORDER_JSON = """'{' || coalesce('"avg_price":' || CAST(price AS VARCHAR) || ',', '')
    || '"items":[' || array_to_string(list_transform(items, lambda x: '{"id":' || x || '}'), ',')
    || '],"payment_method":"' || o_orderpriority || '","payment_status":"' || o_orderstatus
    || '","purchase_date":"' || strftime(o_orderdate, '%Y-%m-%d') || '"}'"""

_RECORD_NO = f"event_id // {EVENTS_PER_RECORD}"

# Common table expressions, each with the ones it needs before it.
_CTES = {
    "people": f"SELECT {_PERSON} FROM customer",
    "people_country": f"""SELECT {_PERSON}, n_name AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "documents": f"""SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus, part,
            max(price) AS price, coalesce(list(l_partkey ORDER BY l_partkey)
                FILTER (WHERE l_partkey IS NOT NULL), []) AS items
        FROM (SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus, 0 AS part,
                o_totalprice AS price, NULL AS l_partkey FROM orders
            UNION ALL
            SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus,
                (l_partkey + l_suppkey + l_linenumber)
                    % ((count(*) OVER (PARTITION BY l_orderkey) + {ITEMS_PER_RECORD - 1}) // {ITEMS_PER_RECORD}),
                NULL, l_partkey
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        GROUP BY ALL""",
    "buyers": f"""SELECT p.*, d.*, {_ORDER_JSON} AS purchase_history
        FROM people_country p JOIN documents d ON id = o_custkey""",
    "login_records": f"""SELECT user_id, {_RECORD_NO} AS record_no, count(*) AS n,
            min(ts) AS first_ts, max(ts) AS last_ts, '{{"devices":['
            || string_agg(DISTINCT '"' || event_type || '"', ',' ORDER BY '"' || event_type || '"')
            || '],"first_login":"' || strftime(min(ts), '%Y-%m-%d %H:%M:%S')
            || '","login_count":' || count(*)
            || ',"timestamps":[' || string_agg('"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
            || 'Z"', ',' ORDER BY ts) || ']}}' AS login_history
        FROM events GROUP BY user_id, {_RECORD_NO}""",
    "user_records": """SELECT user_id, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_login, login_history,
            NULL AS purchase_history, NULL AS price, NULL AS o_orderpriority, NULL AS o_orderdate
            FROM login_records
        UNION ALL SELECT id, NULL, NULL, purchase_history, price, o_orderpriority, o_orderdate FROM buyers""",
    "users": """SELECT id, gender, age, income, is_active, country, last_login, login_history,
            purchase_history, price, o_orderpriority, o_orderdate
        FROM people_country LEFT JOIN user_records ON id = user_id""",
    "missing": """SELECT unnest(['id', 'gender', 'age', 'income', 'is_active', 'country',
                'last_login', 'login_history', 'purchase_history']) AS column_name,
            unnest([count(*) - count(id), count(*) - count(gender), count(*) - count(age),
                count(*) - count(income), count(*) - count(is_active),
                count(*) - count(country), count(*) - count(last_login),
                count(*) - count(login_history), count(*) - count(purchase_history)
            ]) AS missing_count,
            count(*) AS row_count
        FROM users""",
    "age_bins": "SELECT unnest(['<18', '18-25', '25-35', '35-50', '>50']) AS age_group",
    "periods": """SELECT unnest(['0-6clock', '6-12clock', '12-18clock', '18-24clock'])
        AS period""",
    "ages": f"""SELECT age_group, count(id) AS cnt
        FROM age_bins LEFT JOIN (SELECT id, {_AGE_GROUP} AS age_group FROM people) USING (age_group)
        GROUP BY age_group""",
    "countries": """SELECT country, count(*) AS cnt FROM people_country GROUP BY country
        ORDER BY cnt DESC, country LIMIT 10""",
    "user_logins": f"""SELECT user_id, ts, {_PERIOD} AS period,
            CASE WHEN age IS NOT NULL THEN {_AGE_GROUP} END AS age_group
        FROM events JOIN people ON user_id = id""",
    "login_cells": """SELECT b.age_group, p.period, count(l.user_id) AS cnt
        FROM age_bins b CROSS JOIN periods p LEFT JOIN user_logins l
            ON l.age_group = b.age_group AND l.period = p.period
        GROUP BY b.age_group, p.period""",
    "records": """SELECT o_custkey AS user_id, o_orderdate, CAST(len(items) AS BIGINT) AS frequency,
            price AS monetary
        FROM documents""",
    "merged": """SELECT user_id, max(o_orderdate) AS last_ts, CAST(sum(frequency) AS BIGINT) AS frequency,
            coalesce(CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE), 0) AS monetary
        FROM records GROUP BY user_id""",
    "features": f"""SELECT user_id,
            (epoch(TIMESTAMP '{AS_OF}') - epoch(last_ts)) / (30.44::DOUBLE * 86400) AS recency,
            frequency, monetary
        FROM merged""",
    "scaled": """SELECT user_id, {z} FROM features, (SELECT {stats} FROM features)""".format(
        z=", ".join(
            f"({n} - mean_{n}) / CASE WHEN sd_{n} > 0 THEN sd_{n} ELSE 1 END AS {n}"
            for n in ("recency", "frequency", "monetary")
        ),
        stats=", ".join(
            f"avg({n}) AS mean_{n}, stddev_pop({n}) AS sd_{n}"
            for n in ("recency", "frequency", "monetary")
        ),
    ),
    "assigned": """SELECT user_id, recency, frequency, monetary, cluster, distance FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY distance, cluster) AS rn
            FROM (SELECT s.*, c.cluster, sqrt(pow(s.recency - c.r, 2)
                    + pow(s.frequency - c.f, 2) + pow(s.monetary - c.m, 2)) AS distance
                FROM scaled s CROSS JOIN (VALUES {}) AS c(cluster, r, f, m)))
        WHERE rn = 1""".format(
        ", ".join(
            f"({i}, {r}::DOUBLE, {f}::DOUBLE, {m}::DOUBLE)" for i, (r, f, m) in enumerate(CENTROIDS)
        )
    ),
    "labelled": "SELECT f.*, a.cluster FROM features f JOIN assigned a USING (user_id)",
    "means": """SELECT cluster, avg(recency) AS r, avg(frequency) AS f, avg(monetary) AS m
        FROM labelled GROUP BY cluster""",
    "distances": """SELECT l.*, sqrt(pow(recency - r, 2) + pow(frequency - f, 2)
            + pow(monetary - m, 2)) AS distance
        FROM labelled l JOIN means USING (cluster)""",
    "nearest": """SELECT * FROM (SELECT *, CAST(row_number() OVER
            (PARTITION BY cluster ORDER BY distance, user_id) AS INTEGER) AS rank FROM distances)
        WHERE rank <= {}""".format(NEAREST),
    "segment_base": f"""SELECT user_id,
            (epoch(TIMESTAMP '{AS_OF}') - epoch(max(o_orderdate))) / (30.44::DOUBLE * 86400)
                AS recency,
            count(monetary) FILTER (WHERE o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL 12 MONTH)
                AS yearly_purchases,
            CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / count(monetary) AS mean_spend
        FROM records GROUP BY user_id""",
    "segmented": f"""SELECT *, CASE WHEN recency >= {SEGMENT_RULE.inactive_months} THEN 'at-risk'
            WHEN recency <= {SEGMENT_RULE.active_months}
                AND yearly_purchases >= {SEGMENT_RULE.yearly_purchases}
                AND mean_spend >= {SEGMENT_RULE.mean_spend} THEN 'high-value'
            ELSE 'potential' END AS segment
        FROM segment_base""",
    "examples": """SELECT t.conv_id, t.turn, t.text AS instruction,
            coalesce(s.text, '') AS input, t.next_text AS output
        FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
            FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) t
        LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS text FROM conversations
            WHERE role = 'system' GROUP BY conv_id) s ON s.conv_id = t.conv_id
        WHERE t.role = 'user' AND t.next_role = 'assistant'""",
}
_NEEDS = {
    "buyers": ["people_country", "documents"],
    "user_records": ["login_records", "buyers"],
    "users": ["people_country", "user_records"],
    "records": ["documents"],
    "missing": ["users"],
    "ages": ["age_bins", "people"],
    "countries": ["people_country"],
    "user_logins": ["people"],
    "login_cells": ["age_bins", "periods", "user_logins"],
    "merged": ["records"],
    "features": ["merged"],
    "scaled": ["features"],
    "assigned": ["scaled"],
    "labelled": ["features", "assigned"],
    "means": ["labelled"],
    "distances": ["labelled", "means"],
    "nearest": ["distances"],
    "segment_base": ["records"],
    "segmented": ["segment_base"],
}


_STEPS = 15


def _add_fit() -> None:
    """Lloyd steps from the start centres, numbered at the end as the fitted clusters are."""
    values = ", ".join(
        f"({i}, {r}::DOUBLE, {f}::DOUBLE, {m}::DOUBLE)" for i, (r, f, m) in enumerate(CENTROIDS)
    )
    _CTES["c0"] = f"SELECT * FROM (VALUES {values}) AS c(cluster, r, f, m)"
    near = """SELECT s.*, c.cluster, pow(s.recency - c.r, 2) + pow(s.frequency - c.f, 2)
            + pow(s.monetary - c.m, 2) AS d FROM scaled s CROSS JOIN {} c"""
    for i in range(1, _STEPS + 1):
        before = f"c{i - 1}"
        _CTES[f"c{i}"] = f"""SELECT c.cluster, coalesce(avg(a.recency), any_value(c.r)) AS r,
                coalesce(avg(a.frequency), any_value(c.f)) AS f,
                coalesce(avg(a.monetary), any_value(c.m)) AS m
            FROM {before} c LEFT JOIN (SELECT user_id, any_value(recency) AS recency,
                any_value(frequency) AS frequency, any_value(monetary) AS monetary,
                arg_min(cluster, d) AS cluster FROM ({near.format(before)}) GROUP BY user_id) a
                ON a.cluster = c.cluster GROUP BY c.cluster"""
        _NEEDS[f"c{i}"] = ["scaled", before]
    _CTES["centers"] = f"""SELECT CAST(row_number() OVER (ORDER BY r, f DESC, m) - 1 AS INTEGER)
        AS cluster, r, f, m FROM c{_STEPS}"""
    _CTES["fitted"] = f"""SELECT user_id, any_value(recency) AS recency,
            any_value(frequency) AS frequency, any_value(monetary) AS monetary,
            arg_min(cluster, d) AS cluster FROM ({near.format("centers")}) GROUP BY user_id"""
    # sums of squared distances from a point to a cluster, from the cluster's sums alone
    _CTES["sums"] = """SELECT cluster, count(*) AS n, sum(recency) AS r, sum(frequency) AS f,
            sum(monetary) AS m, sum(pow(recency, 2) + pow(frequency, 2) + pow(monetary, 2)) AS sq
        FROM fitted GROUP BY cluster"""
    _CTES["apart"] = """SELECT p.user_id, p.cluster = s.cluster AS own, s.n,
            s.n * (pow(p.recency, 2) + pow(p.frequency, 2) + pow(p.monetary, 2)) + s.sq
            - 2 * (p.recency * s.r + p.frequency * s.f + p.monetary * s.m) AS total
        FROM fitted p CROSS JOIN sums s"""
    _CTES["widths"] = """SELECT user_id, max(n) FILTER (WHERE own) AS n,
            max(total) FILTER (WHERE own) / greatest(max(n) FILTER (WHERE own) - 1, 1) AS a,
            min(total / n) FILTER (WHERE NOT own) AS b
        FROM apart GROUP BY user_id"""
    _NEEDS.update(
        centers=[f"c{_STEPS}"], fitted=["centers"], sums=["fitted"], apart=["sums"], widths=["apart"]
    )


_add_fit()


def _with(name: str, select: str) -> str:
    """``select`` behind the common table expression ``name`` and all it needs."""
    ordered: list[str] = []

    def add(cte: str) -> None:
        for needed in _NEEDS.get(cte, []):
            add(needed)
        if cte not in ordered:
            ordered.append(cte)

    for wanted in name.split():
        add(wanted)
    ctes = ",\n".join(f"{cte} AS MATERIALIZED ({_CTES[cte]})" for cte in ordered)
    return f"WITH {ctes}\n{select}"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _prompt(output: str, end: str) -> str:
    parts = [
        _quoted(prompts.INSTRUCTION_PREFIX),
        "instruction",
        _quoted(prompts.INPUT_PREFIX),
        "input",
        _quoted(prompts.RESPONSE_PREFIX),
        output,
        _quoted(end),
    ]
    return " || ".join(parts)


def oracle_sql() -> dict[str, str]:
    return {
        "scan_users": f"SELECT {_PERSON} FROM customer",
        "scan_part_glob": "SELECT c_custkey, c_name, c_nationkey FROM customer",
        "rows_per_file": "SELECT 'customer.parquet' AS file_name, count(*) AS row_count FROM customer",
        "preview_columns": _with(
            "users",
            """SELECT id, last_login, income, login_history, price AS avg_price,
                o_orderpriority AS payment_method, strftime(o_orderdate, '%Y-%m-%d') AS purchase_date
            FROM users ORDER BY id NULLS FIRST, last_login NULLS FIRST, income NULLS FIRST,
                login_history NULLS FIRST, price NULLS FIRST, o_orderpriority NULLS FIRST,
                o_orderdate NULLS FIRST LIMIT 40""",
        ),
        "missing_counts": _with("missing", "SELECT * FROM missing"),
        "missing_percent": _with(
            "missing",
            "SELECT *, round(missing_count / row_count * 100, 4) AS missing_percent FROM missing",
        ),
        "quality_report": _with(
            "missing",
            """SELECT column_name, missing_count,
                round(missing_count / row_count * 100, 2) AS missing_percent FROM missing""",
        ),
        "drop_sparse_columns": _with(
            "users", "SELECT id, gender, age, is_active, country, purchase_history FROM users"
        ),
        "unique_id_check": """SELECT count(*) AS total_count,
            count(DISTINCT c_custkey) AS unique_count,
            count(*) = count(DISTINCT c_custkey) AS is_unique FROM customer""",
        "duplicate_ids": _with(
            "records",
            """SELECT user_id AS id, count(*) AS row_count FROM records GROUP BY user_id
            HAVING count(*) > 1""",
        ),
        "total_users": "SELECT count(*) AS total_users FROM customer",
        "gender_dist": _with(
            "people", "SELECT gender, count(*) AS cnt FROM people GROUP BY gender"
        ),
        "age_group": _with("people", f"SELECT id, age, {_AGE_GROUP} AS age_group FROM people"),
        "age_dist": _with("ages", "SELECT age_group, cnt FROM ages"),
        "age_share": _with(
            "ages",
            """SELECT age_group, cnt, round(cnt / sum(cnt) OVER () * 100, 1) AS percent
            FROM ages""",
        ),
        "country_top10": _with("countries", "SELECT country, cnt FROM countries"),
        "country_share": _with(
            "countries",
            """SELECT country, cnt, round(cnt / sum(cnt) OVER () * 100, 1) AS percent
            FROM countries""",
        ),
        "per_file_country_topk": _with(
            "countries",
            """SELECT 'customer.parquet' AS file_name, country, cnt,
                CAST(row_number() OVER (ORDER BY cnt DESC, country) AS INTEGER) AS rank
            FROM countries""",
        ),
        "active_users": _with("buyers", "SELECT DISTINCT id FROM buyers WHERE is_active"),
        "total_spent": _with(
            "buyers",
            """SELECT CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
            FROM buyers""",
        ),
        "profile_summary": _with(
            "buyers",
            """SELECT *, round(total_active_users / total_users, 4) AS active_fraction,
                round(total_spent / total_users, 4) AS spent_per_user,
                round(total_spent / total_active_users, 4) AS spent_per_active_user
            FROM (SELECT (SELECT count(*) FROM customer) AS total_users,
                count(DISTINCT CASE WHEN is_active THEN id END) AS total_active_users,
                CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
                FROM buyers)""",
        ),
        "parse_login": _with(
            "people login_records",
            """SELECT id, n AS login_count, n AS timestamp_count,
                strftime(first_ts, '%Y-%m-%d %H:%M:%S') AS first_timestamp,
                strftime(first_ts, '%Y-%m-%d %H:%M:%S') AS first_login
            FROM login_records JOIN people ON user_id = id""",
        ),
        "login_times": _with(
            "user_logins",
            "SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS login_time FROM user_logins",
        ),
        "login_period": _with(
            "user_logins",
            """SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS login_time, period
            FROM user_logins""",
        ),
        "login_period_dist": _with(
            "periods user_logins",
            """SELECT p.period, count(l.user_id) AS cnt
            FROM periods p LEFT JOIN user_logins l ON l.period = p.period GROUP BY p.period""",
        ),
        "login_by_age_period": _with("login_cells", "SELECT age_group, period, cnt FROM login_cells"),
        "zero_filled_bins": """SELECT status, priority, count(o_orderkey) AS cnt
            FROM (SELECT unnest(['F', 'O', 'P', 'X', 'other']) AS status)
                CROSS JOIN (SELECT unnest(['1-URGENT', '2-HIGH', '9-NONE', 'other']) AS priority)
                LEFT JOIN (SELECT o_orderkey,
                    CASE WHEN o_orderstatus IN ('F', 'O', 'P', 'X') THEN o_orderstatus ELSE 'other' END AS s,
                    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '9-NONE') THEN o_orderpriority
                        ELSE 'other' END AS p FROM orders) ON s = status AND p = priority
            GROUP BY status, priority""",
        "login_heatmap": _with(
            "login_cells",
            "SELECT age_group, "
            + ", ".join(
                f"""CAST(sum(cnt) FILTER (WHERE period = '{p}') AS BIGINT) AS "{p}" """
                for p in ("0-6clock", "6-12clock", "12-18clock", "18-24clock")
            )
            + " FROM login_cells GROUP BY age_group",
        ),
        "parse_purchase": _with(
            "documents",
            """SELECT o_custkey AS id, price AS avg_price, CAST(len(items) AS BIGINT) AS item_count,
                strftime(o_orderdate, '%Y-%m-%d') AS purchase_date, o_orderpriority AS payment_method
            FROM documents""",
        ),
        "expand_purchase": _with(
            "documents",
            """SELECT o_custkey AS id, price AS avg_price, CAST(NULL AS VARCHAR) AS categories,
                o_orderpriority AS payment_method, o_orderstatus AS payment_status,
                strftime(o_orderdate, '%Y-%m-%d') AS purchase_date, items[1] AS first_item
            FROM documents""",
        ),
        "purchase_records": _with(
            "records",
            """SELECT user_id, strftime(o_orderdate, '%Y-%m-%d') AS purchase_time, frequency,
                monetary FROM records""",
        ),
        "rfm_merge_users": _with(
            "merged",
            """SELECT user_id, strftime(last_ts, '%Y-%m-%d') AS last_purchase, frequency,
                monetary FROM merged""",
        ),
        "recency_months": f"""SELECT o_orderkey AS order_id,
            strftime(o_orderdate, '%Y-%m-%d') AS order_day,
            round((epoch(TIMESTAMP '{AS_OF}') - epoch(o_orderdate)) / (30.44::DOUBLE * 86400), 4)
                AS recency
            FROM orders""",
        "rfm_features": _with(
            "features",
            """SELECT user_id, round(recency, 4) AS recency, frequency, monetary
            FROM features""",
        ),
        "rfm_user_count": "SELECT count(DISTINCT o_custkey) AS rfm_users FROM orders",
        "rfm_extent": _with(
            "features",
            """SELECT round(min(recency), 4) AS min_recency, round(max(recency), 4) AS max_recency,
                min(frequency) AS min_frequency, max(frequency) AS max_frequency,
                min(monetary) AS min_monetary, max(monetary) AS max_monetary
            FROM features""",
        ),
        "rfm_scaled": _with(
            "scaled",
            # Adding 0 turns a rounded -0.0 into 0.0, as Spark's round gives it.
            """SELECT user_id, round(recency, 4) + 0.0::DOUBLE AS recency,
                round(frequency, 4) + 0.0::DOUBLE AS frequency,
                round(monetary, 4) + 0.0::DOUBLE AS monetary FROM scaled""",
        ),
        "rfm_summary": _with(
            "merged",
            """SELECT 'missing' AS section, unnest(['id', 'purchase_history']) AS name,
                CAST(0 AS BIGINT) AS missing_count, CAST(0 AS DOUBLE) AS missing_percent,
                CAST(NULL AS VARCHAR) AS last_purchase, CAST(NULL AS BIGINT) AS frequency,
                CAST(NULL AS DOUBLE) AS monetary
            UNION ALL
            SELECT 'rfm', CAST(user_id AS VARCHAR), NULL, NULL,
                strftime(last_ts, '%Y-%m-%d'), frequency, monetary FROM merged""",
        ),
        "kmeans_assign": _with(
            "assigned", "SELECT user_id, cluster, round(distance, 4) AS distance FROM assigned"
        ),
        "kmeans_step": _with(
            "assigned",
            """SELECT cluster, count(*) AS members, round(avg(recency), 4) + 0.0::DOUBLE AS recency,
                round(avg(frequency), 4) + 0.0::DOUBLE AS frequency,
                round(avg(monetary), 4) + 0.0::DOUBLE AS monetary
            FROM assigned GROUP BY cluster""",
        ),
        "cluster_means": _with(
            "means",
            """SELECT cluster, round(r, 4) AS recency, round(f, 4) AS frequency,
                round(m, 2) AS monetary FROM means""",
        ),
        "cluster_sizes": _with(
            "assigned", "SELECT cluster, count(*) AS members FROM assigned GROUP BY cluster"
        ),
        "distance_to_center": _with(
            "distances",
            "SELECT user_id, cluster, round(distance, 2) AS distance FROM distances",
        ),
        "nearest_to_center": _with(
            "nearest",
            "SELECT cluster, rank, user_id, round(distance, 2) AS distance FROM nearest",
        ),
        "cluster_scatter": _with(
            "nearest",
            "SELECT round(recency, 4) AS recency, frequency, monetary, cluster FROM nearest",
        ),
        "rfm_clusters": _with(
            "features fitted",
            """SELECT f.user_id, round(f.recency, 4) AS recency, f.frequency, f.monetary, c.cluster
            FROM features f JOIN fitted c USING (user_id)""",
        ),
        "cluster_results": _with("fitted", "SELECT user_id, cluster FROM fitted"),
        "cluster_centers": _with(
            "features fitted",
            """SELECT c.cluster, round(avg(f.recency), 4) AS recency, round(avg(f.frequency), 4) AS frequency,
                round(avg(f.monetary), 2) AS monetary
            FROM features f JOIN fitted c USING (user_id) GROUP BY c.cluster""",
        ),
        "rfm_silhouette": _with(
            "widths",
            """SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
            FROM widths""",
        ),
        "rfm_segments": _with(
            "segmented",
            """SELECT user_id, round(recency, 4) AS recency, yearly_purchases,
                CAST(round(CAST(mean_spend AS DECIMAL(18,6)), 2) AS DOUBLE) AS mean_spend, segment
            FROM segmented""",
        ),
        "segment_actions": _with(
            "segmented",
            """SELECT user_id, segment, CASE segment WHEN 'high-value' THEN 'exclusive discount'
                WHEN 'potential' THEN 'promotion' ELSE 'time-limited offer' END AS action
            FROM segmented""",
        ),
        "instructions_scan": _with("examples", "SELECT instruction, input, output FROM examples"),
        "conversation_prompts": _with("examples", "SELECT * FROM examples"),
        "prompt_format": _with(
            "examples",
            f"SELECT conv_id, turn, {_prompt('output', END_TOKEN)} AS text FROM examples",
        ),
        "prompt_format_inference": _with(
            "examples", f"SELECT conv_id, turn, {_prompt(_quoted(''), '')} AS text FROM examples"
        ),
        "incremental_profile": _with(
            "people people_country user_logins buyers",
            f"""SELECT dimension, label, count(*) AS cnt, CAST(NULL AS DOUBLE) AS amount FROM (
                SELECT 'all' AS dimension, 'all' AS label FROM people
                UNION ALL SELECT 'gender', gender FROM people
                UNION ALL SELECT 'age_group', {_AGE_GROUP} FROM people
                UNION ALL SELECT 'country', country FROM people_country
                UNION ALL SELECT 'login', age_group || '|' || period FROM user_logins
                    WHERE age_group IS NOT NULL
                UNION ALL SELECT 'active_user', 'all' FROM (SELECT DISTINCT id FROM buyers WHERE is_active))
            GROUP BY dimension, label
            UNION ALL
            SELECT 'spent', 'all', count(*), CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE)
            FROM buyers""",
        ),
    }
