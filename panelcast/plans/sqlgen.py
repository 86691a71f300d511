"""DuckDB oracle SQL fragments shared by several registered queries.

These are the reference answers for the correctness gate; they mirror the
stand-in series of ``series.py`` in plain SQL.
"""

from __future__ import annotations

PERIOD = "strftime(l_shipdate, '%Y-%m')"

SERIES_CTES = {
    "gold": """gold AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold
  FROM orders GROUP BY 1, 2)""",
    "gold1": """gold AS (
  SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold
  FROM orders GROUP BY 1)""",
    "fx": f"""fx AS (
  SELECT CAST({PERIOD} || '-01' AS DATE) AS date, avg(l_discount) AS fx
  FROM lineitem GROUP BY {PERIOD})""",
    "cpi": f"""cpi AS (
  SELECT CAST({PERIOD} || '-01' AS DATE) AS date, avg(l_tax) AS cpi
  FROM lineitem GROUP BY {PERIOD})""",
    "oil": f"""oil_b AS (
  SELECT {PERIOD} AS period, p_brand AS series, sum(l_extendedprice) / count(l_extendedprice) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
oil AS (
  SELECT CAST(period || '-01' AS DATE) AS date, avg(value) AS oil FROM oil_b GROUP BY 1)""",
    "set": """sset AS (
  SELECT CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS "set"
  FROM lineitem GROUP BY 1)""",
    "btc": """btc AS (
  SELECT CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS btc
  FROM lineitem GROUP BY 1)""",
}
SERIES_TABLE = {"gold": "gold", "gold1": "gold", "fx": "fx", "cpi": "cpi", "oil": "oil", "set": "sset", "btc": "btc"}


def q(name: str) -> str:
    return f'"{name}"'


def R(expr: str, digits: int = 4) -> str:
    """Oracle side of ``stable_round``."""
    return f"(round(({expr}) * 1.000000000001, {digits}) + 0.0)"


def feature_store_sql(variables=("gold", "fx", "cpi", "oil", "set", "btc"), entity: bool = True,
                      daily: bool = False, backfill: bool = True, drop_subset=None,
                      bounds_vars=None, lags=(1, 3), roll=7, minp=3, digits=4, roll_name="roll7_mean") -> str:
    gkey = "gold" if entity else "gold1"
    ctes = [SERIES_CTES[gkey if v == "gold" else v] for v in variables]
    bounds_vars = bounds_vars or variables
    bounds = " UNION ALL ".join(f"SELECT date FROM {SERIES_TABLE[v]}" for v in bounds_vars)
    ctes.append(f"bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM ({bounds}))")
    part = "PARTITION BY o_orderpriority " if entity else ""
    ent_sel = "e.o_orderpriority, " if entity else ""
    ent_from = "(SELECT DISTINCT o_orderpriority FROM gold) e, " if entity else ""
    wd = "" if daily else "WHERE isodow(d) <= 5"
    ctes.append(f"""days AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
  FROM bounds)""")
    ctes.append(f"cal AS (SELECT {ent_sel}d AS date FROM {ent_from}days {wd})")
    joins = "cal"
    for v in variables:
        t = SERIES_TABLE[gkey if v == "gold" else v]
        using = "o_orderpriority, date" if (v == "gold" and entity) else "date"
        joins += f" LEFT JOIN {t} USING ({using})"
    w = f"OVER ({part}ORDER BY date"
    fills = []
    for v in variables:
        ff = f"last_value({q(v)} IGNORE NULLS) {w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        if backfill:
            bf = f"first_value({q(v)} IGNORE NULLS) {w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
            fills.append(f"coalesce({ff}, {bf}) AS {q(v)}")
        else:
            fills.append(f"{ff} AS {q(v)}")
    ent_col = "o_orderpriority, " if entity else ""
    ctes.append(f"panel AS (SELECT {ent_col}date, {', '.join(fills)} FROM {joins})")
    feats = [f"lead(gold) {w}) AS gold_next"]
    for v in variables:
        for k in lags:
            feats.append(f"lag({q(v)}, {k}) {w}) AS {v}_lag{k}")
        rw = f"{w} ROWS BETWEEN {roll - 1} PRECEDING AND CURRENT ROW)"
        feats.append(f"CASE WHEN count({q(v)}) {rw} >= {minp} THEN avg({q(v)}) {rw} END AS {v}_{roll_name}")
        feats.append(f"{q(v)} / NULLIF(lag({q(v)}) {w}), 0) - 1 AS {v}_pct_change")
    ctes.append(f"feats AS (SELECT *, {', '.join(feats)} FROM panel)")
    cols = ([("o_orderpriority", False)] if entity else []) + [("date", False)]
    cols += [(v, True) for v in variables] + [("gold_next", True)]
    for v in variables:
        cols += [(f"{v}_lag{k}", True) for k in lags] + [(f"{v}_{roll_name}", True), (f"{v}_pct_change", True)]
    subset = drop_subset if drop_subset is not None else [c for c, _ in cols]
    where = " AND ".join(f"{q(c)} IS NOT NULL" for c in subset)
    sel = ", ".join(f"{R(q(c), digits)} AS {q(c)}" if dbl else q(c) for c, dbl in cols)
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {sel} FROM feats WHERE {where}"
