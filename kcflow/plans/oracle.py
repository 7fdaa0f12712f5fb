"""DuckDB twins of the registered queries.

Each entry is plain SQL over the driver's tables.  The fixture views are
written out here a second time, independently of the Spark code, so the
comparison checks the Spark plan rather than shared code.  Doubles that
come from different summation orders are rounded to 6 places on both
sides; integer sums are cast to BIGINT (DuckDB widens them otherwise).
"""

from __future__ import annotations

ITEM_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"

STEP_BASE = f"""
step_base AS (
  SELECT
    l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
    CASE WHEN o.o_orderstatus = 'P' OR o.o_custkey % 37 = 0 THEN 'test' ELSE 'train' END AS split,
    'S' || CAST(o.o_custkey AS VARCHAR) AS student,
    p.p_type || ', ' || p.p_brand AS hierarchy,
    'P' || CAST(l.l_partkey AS VARCHAR) AS problem,
    'T' || CAST(l.l_linenumber AS VARCHAR) || '_' || CAST(p.p_size AS VARCHAR) AS step,
    CASE WHEN l.l_tax = 0 THEN NULL ELSE o.o_orderdate END AS step_start,
    o.o_orderdate AS first_tx,
    l.l_shipdate AS step_end,
    l.l_extendedprice / 1000 AS price_s,
    CAST(CASE WHEN o.o_custkey % 50 = 0 THEN 0
              WHEN l.l_quantity + o.o_custkey % 20 < 45 THEN 1 ELSE 0 END AS INTEGER) AS truth,
    l.l_tax, l.l_discount, l.l_linestatus, p.p_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
step_cols AS (
  SELECT
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    split, student, hierarchy, problem, step, step_start, first_tx,
    CASE WHEN truth = 1 THEN step_end END AS correct_tx,
    step_end,
    CASE WHEN l_tax = 0 THEN NULL ELSE price_s END AS dur,
    CASE WHEN truth = 1 THEN price_s END AS correct_dur,
    CASE WHEN truth = 0 THEN price_s END AS error_dur,
    CAST(CASE WHEN split = 'test' AND l_linestatus = 'F' THEN NULL ELSE truth END AS INTEGER) AS cfa,
    CAST(1 - truth AS BIGINT) AS incorrects,
    CAST(l_linenumber % 3 AS BIGINT) AS hints,
    CAST(1 AS BIGINT) AS corrects,
    CASE WHEN l_tax = 0 THEN NULL
         WHEN l_discount < 0.05 THEN split_part(p_name, ' ', 1)
         ELSE replace(p_name, ' ', '~~') END AS kc,
    CASE WHEN l_tax = 0 THEN NULL
         WHEN l_discount < 0.05 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '~~' || CAST(l_linenumber AS VARCHAR)
    END AS opportunity,
    truth
  FROM step_base
),
step_log AS (
  SELECT
    CAST(row_number() OVER (PARTITION BY split ORDER BY {ITEM_ORDER}) AS BIGINT) AS row,
    CAST(row_number() OVER (PARTITION BY student, problem ORDER BY first_tx, {ITEM_ORDER}) AS BIGINT)
      AS problem_view,
    *
  FROM step_cols
),
train AS (SELECT * FROM step_log WHERE split = 'train'),
test AS (SELECT * FROM step_log WHERE split = 'test')"""

TRANSACTIONS = """
transactions AS (
  SELECT event_id AS tx_id, ts AS tx_time,
         'S' || CAST(user_id AS VARCHAR) AS student,
         'Q' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR) AS problem,
         'main' AS step,
         CASE event_type WHEN 'purchase' THEN 'correct' WHEN 'error' THEN 'incorrect'
                         WHEN 'view' THEN 'hint' ELSE 'other' END AS outcome,
         value AS tx_dur
  FROM events
)"""


def with_steps(body: str, *extra: str) -> str:
    """Prefix ``body`` with the step-log CTEs (and any extra CTEs)."""
    ctes = ",\n".join([STEP_BASE.strip(), *[e.strip() for e in extra]])
    return f"WITH {ctes}\n{body.strip()}"


def with_transactions(body: str, *extra: str) -> str:
    ctes = ",\n".join([TRANSACTIONS.strip(), *[e.strip() for e in extra]])
    return f"WITH {ctes}\n{body.strip()}"
