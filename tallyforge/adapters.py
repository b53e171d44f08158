"""The model's views over the given tables.

Each view is one SELECT that Spark and DuckDB read alike, so that queries and their oracles
stand on the same definition.  In Spark, `{table}` is replaced by a DataFrame.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tallyforge.sources.shared import dealt, slices

VIEWS = {
    "trades": """
SELECT o.o_custkey AS trader_id, concat('w', CAST(o.o_custkey AS STRING)) AS wallet, l.l_suppkey AS taker_id,
       CASE WHEN l.l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side,
       CAST(5 + CAST(round(l.l_discount * 100) AS INT) * 8 AS DOUBLE) / 100 AS price,
       l.l_quantity AS size, l.l_partkey AS market_id,
       l.l_partkey * 2 + CASE WHEN l.l_linestatus = 'O' THEN 0 ELSE 1 END AS token_id,
       CASE WHEN l.l_linestatus = 'O' THEN 'Yes' ELSE 'No' END AS outcome, l.l_shipdate AS ts
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "markets": """
SELECT p_partkey AS market_id, concat('c', CAST(p_partkey AS STRING)) AS condition_id, p_name AS question, p_brand AS description,
       p_type AS category, p_retailprice AS volume, p_retailprice / 4 AS liquidity, p_size % 4 <> 0 AS closed, p_size % 4 = 0 AS active,
       '["Yes","No"]' AS outcomes,
       CASE WHEN p_size % 4 = 0 THEN '["0.6","0.4"]' WHEN p_size % 2 = 0 THEN '["1","0"]' ELSE '["0","1"]' END AS outcome_prices,
       TIMESTAMP '1995-01-01 00:00:00' + p_size * INTERVAL '1' DAY AS start_ts,
       TIMESTAMP '1997-01-01 00:00:00' + p_size * INTERVAL '1' DAY AS end_ts
FROM {part}""",
    "market_tokens": """
SELECT p.p_partkey * 2 + s.i AS token_id, p.p_partkey AS market_id, CASE WHEN s.i = 0 THEN 'Yes' ELSE 'No' END AS outcome,
       CASE WHEN p.p_size % 4 = 0 THEN CASE WHEN s.i = 0 THEN CAST(0.6 AS DOUBLE) ELSE CAST(0.4 AS DOUBLE) END
            WHEN p.p_size % 2 = s.i THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS price,
       p.p_size % 4 <> 0 AND p.p_size % 2 = s.i AS winner
FROM {part} p, (SELECT 0 AS i UNION ALL SELECT 1 AS i) s""",
    "leaderboard": """
SELECT wallet, trader_id, month, pnl, n_orders, row_number() OVER (PARTITION BY month ORDER BY pnl DESC, trader_id) AS rank
FROM (SELECT concat('w', CAST(o_custkey AS STRING)) AS wallet, o_custkey AS trader_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS pnl, count(*) AS n_orders
      FROM {orders} GROUP BY o_custkey, date_trunc('month', o_orderdate)) x""",
    "prices": "SELECT user_id AS token_id, ts, value / 500 AS price, event_id FROM {events}",
    "tags": "SELECT n_nationkey AS tag_id, CASE n_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '[bad' WHEN 2 THEN '7' ELSE concat('[\"PROMO\",\"', n_name, '\"]') END AS categories, n_name AS name, concat('about ', n_name) AS description, n_regionkey <> 4 AS is_active, n_nationkey % 7 = 6 AS all_checked, n_nationkey * 3 AS last_checked FROM {nation}",
    "market_tags": "SELECT p_partkey AS market_id, p_size % 25 AS tag_id FROM {part} UNION SELECT p_partkey AS market_id, CAST(p_partkey % 25 AS INT) AS tag_id FROM {part}",
    "tag_examples": "SELECT s_suppkey AS example_id, s_nationkey AS tag_id, s_suppkey AS market_id, s_acctbal > 0 AS is_positive, TIMESTAMP '2024-01-01 00:00:00' + s_suppkey * 7 % 31 * INTERVAL '1' HOUR AS created_at FROM {supplier}",
    "judge_responses": """
SELECT d.doc_id % 25 AS tag_id, d.doc_id AS market_id, m.model,
       CASE m.model WHEN 'm1' THEN CASE WHEN l.quality = 1 THEN ' yes' WHEN l.quality = 0 THEN 'NO' ELSE 'not sure' END
                    WHEN 'm2' THEN CASE WHEN l.toxic = 0 THEN 'YES' WHEN l.toxic = 1 THEN 'No.' ELSE 'maybe' END
                    ELSE CASE WHEN d.n_chars > 1000 THEN 'Yes' ELSE 'no' END END AS response
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id,
     (SELECT 'm1' AS model UNION ALL SELECT 'm2' AS model UNION ALL SELECT 'm3' AS model) m""",
    "history": """
SELECT tag_id, market_id, yes, no,
       CASE WHEN yes >= 2 THEN TRUE WHEN no >= 2 THEN FALSE END AS consensus,
       CASE WHEN market_id % 7 = 0 THEN market_id % 2 = 0 END AS human_decision,
       CASE WHEN market_id % 7 = 0 THEN 'human' ELSE 'judges' END AS decided_by,
       TIMESTAMP '2024-01-01 00:00:00' + market_id * 13 % 97 * INTERVAL '1' HOUR AS updated_at
FROM (SELECT tag_id, market_id, count(CASE WHEN v THEN 1 END) AS yes, count(CASE WHEN NOT v THEN 1 END) AS no
      FROM (SELECT tag_id, market_id, CASE WHEN upper(trim(response)) LIKE '%YES%' THEN TRUE WHEN upper(trim(response)) LIKE '%NO%' THEN FALSE END AS v
            FROM {judge_responses}) r GROUP BY tag_id, market_id) x""",
    "traders": "SELECT c_custkey AS trader_id, concat('w', CAST(c_custkey AS STRING)) AS wallet, c_name AS name FROM {customer}",
}
#: Views that join large tables, and the keys by which these are dealt.
JOINED = {"trades": {"lineitem": "l_orderkey", "orders": "o_orderkey"}}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Lake:
    """Views and raw tables by attribute, read lazily from one directory: `Lake(spark, path).trades`."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            parts, keys = {n: getattr(self, n) for n in _names(VIEWS[name])}, JOINED.get(name)
            if keys:
                n = slices(*parts.values())
                parts = {table: dealt(n, frame, keys[table]) for table, frame in parts.items()}
            frame = self.spark.sql(VIEWS[name], **parts)
        elif name in TABLES:
            frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        else:
            raise AttributeError(name)
        setattr(self, name, frame)
        return frame


def oracle(sql: str) -> str:
    """`sql` for DuckDB, with the views it names (as `{view}` or bare) put before it as CTEs."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in VIEWS and name not in order:
            for n in _names(VIEWS[name]):
                need(n)
            order.append(name)

    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            need(name)
    ctes = [f"{n} AS ({re.sub(r'{(\w+)}', r'\1', VIEWS[n]).strip()})" for n in order]
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)
    if own:
        return f"WITH {own[1] or ''}{', '.join([*ctes, ''])}{sql[own.end():]}"
    return f"WITH {', '.join(ctes)} {sql}" if ctes else sql
