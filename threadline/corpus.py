"""Program corpus, run log, rules and catalogue derived from the given tables.

The statements run unchanged in Spark SQL and in other ANSI engines, over the
whole of each table. Values come from the program itself, from includes (nested,
and named by values), and from arguments of macros. The dataset graph grows with ``orders`` and ``customer``:
staging datasets per order and per customer, hubs (priority tables, work and
mart datasets) that a large share of the programs touch, and feedback programs
that close a cycle per customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CODE_FILES = """
SELECT 'repo/d' || (o_orderkey % 7) || '/job_' || o_orderkey || '.sas' AS file_path,
  (CASE WHEN o_custkey % 7 = 0
        THEN '%let env=prod;' || chr(10) || '%let envx=&env._x;' || chr(10)
          || 'data &env..tmp_' || (o_orderkey % 30) || ';' || chr(10)
          || '  set &envx..src;' || chr(10) || 'run;' || chr(10) ELSE '' END)
  || (CASE WHEN o_custkey % 21 = 0
        THEN 'data &undef..q;' || chr(10) || 'run;' || chr(10) ELSE '' END)
  || (CASE WHEN o_custkey % 13 = 0
        THEN '%include "/inc/env_' || (o_custkey % 5) || '.sas";' || chr(10)
          || 'proc sort data=&lib..q_' || (o_orderkey % 30) || ' out=&lib..sorted;' || chr(10) || 'run;' || chr(10)
          || 'data &full..t;' || chr(10) || 'run;' || chr(10) ELSE '' END)
  || (CASE WHEN o_custkey % 17 = 0
        THEN '%let m=a;' || chr(10) || 'data out.&m.x;' || chr(10) || ' set lib.&m.x;' || chr(10) || 'run;' || chr(10)
          || '%let m=b_' || (o_custkey % 6) || ';' || chr(10) || 'data out.&m.x;' || chr(10) || ' set lib.&m.x;' || chr(10) || 'run;' || chr(10) ELSE '' END)
  || (CASE WHEN o_custkey % 19 = 0
        THEN '%let base=/inc;' || chr(10) || '%include "&base./env_' || (o_custkey % 5) || '.sas";' || chr(10)
          || '%include "&area./u.sas";' || chr(10) || 'data &unit..z_' || (o_orderkey % 30) || ';' || chr(10) || 'run;' || chr(10) ELSE '' END)
  || (CASE WHEN o_custkey % 23 = 0
        THEN '%load(cust_' || (o_custkey % 40) || ');' || chr(10) || '%twice(c_' || (o_custkey % 7) || ', t=x);' || chr(10) ELSE '' END)
  || (CASE WHEN o_custkey % 29 = 0
        THEN '%macro mine(lib);' || chr(10) || ' set &lib..x;' || chr(10) || '%mend;' || chr(10) || '%mine(prod);' || chr(10) ELSE '' END)
  || (CASE WHEN o_custkey % 31 = 0
        THEN 'proc sort data=lib.&nowhere out=fine;' || chr(10) || 'run;' || chr(10) ELSE '' END)
  || (CASE WHEN o_orderkey % 10 = 3
        THEN 'data raw.cust_' || o_custkey || ';' || chr(10)
          || ' merge stg.c_' || o_custkey || ';' || chr(10) || 'run;' || chr(10)
        WHEN o_orderkey % 50 = 4
        THEN 'data rpt.r_' || (o_custkey % 8) || ';' || chr(10)
          || ' set mart.m_' || (o_custkey % 40) || ' rpt.r_' || (o_custkey % 8) || ';' || chr(10) || 'run;' || chr(10)
        WHEN o_orderkey % 10 = 4
        THEN 'data rpt.r_' || (o_custkey % 8) || ';' || chr(10)
          || ' set mart.m_' || (o_custkey % 40) || ';' || chr(10) || 'run;' || chr(10)
        WHEN o_orderkey % 10 = 1 OR o_orderkey % 10 = 2
        THEN 'proc means data=Mart.M_' || (o_custkey % 40) || ';' || chr(10) || 'run;' || chr(10)
          || 'data mart.m_' || (o_custkey % 40) || ';' || chr(10)
          || ' merge stg.c_' || o_custkey || chr(10) || '   stg.s_' || (o_orderkey - 1) || ';' || chr(10) || 'run;' || chr(10)
        ELSE 'data stg.S_' || o_orderkey || chr(10)
          || '   work.t_' || (o_orderkey % 30) || ';' || chr(10)
          || '  set raw.cust_' || o_custkey || ' RAW.prio_' || substr(o_orderpriority, 1, 1) || ';' || chr(10) || 'run;' || chr(10)
          || 'proc sort data=stg.s_' || o_orderkey || ' out=stg.c_' || o_custkey || ';' || chr(10)
          || ' by id;' || chr(10) || 'run;' || chr(10) END)
  || (CASE WHEN o_orderkey % 3 = 0 THEN '%load_' || (o_custkey % 9) || '(x);' || chr(10) ELSE '' END)
  || (CASE WHEN o_custkey % 4 = 0 THEN '%include "/inc/f_' || (o_custkey % 25) || '.sas";' || chr(10) ELSE '' END)
  || (CASE WHEN o_custkey % 5 = 0 THEN '%include ''lib' || chr(92) || 'util_' || (o_orderkey % 6) || '.sas'';' || chr(10) ELSE '' END) AS code
FROM orders
UNION ALL
SELECT '/inc/f_' || n_nationkey || '.sas' AS file_path,
  'data inc.d_' || n_nationkey || ';' || chr(10) || ' set raw.inc_' || n_nationkey || ';' || chr(10) || 'run;' || chr(10)
  || (CASE WHEN n_nationkey % 3 <> 0 THEN '%include "/inc/f_' || ((n_nationkey * 2 + 1) % 20) || '.sas";' || chr(10) ELSE '' END) AS code
FROM nation
UNION ALL
SELECT 'repo/d' || r_regionkey || '/lib/util_' || r_regionkey || '.sas' AS file_path,
  '%macro util_' || r_regionkey || '(p);' || chr(10) || ' proc print data=inc.d_' || r_regionkey || ';' || chr(10) || 'run;' || chr(10) || '%mend;' || chr(10) AS code
FROM region
UNION ALL
SELECT '/inc/env_' || r_regionkey || '.sas' AS file_path,
  '%let lib=prod_' || r_regionkey || ';' || chr(10) || '%include "/inc/roots_' || r_regionkey || '.sas";' || chr(10) || '%let full=&root._f;' || chr(10) AS code
FROM region
UNION ALL
SELECT '/inc/roots_' || r_regionkey || '.sas' AS file_path,
  '%let root=base_' || r_regionkey || ';' || chr(10) || '%let area=/lib/area_' || r_regionkey || ';' || chr(10) AS code
FROM region
UNION ALL
SELECT '/lib/area_' || r_regionkey || '/u.sas' AS file_path, '%let unit=u_' || r_regionkey || ';' || chr(10) AS code
FROM region
UNION ALL
SELECT '/inc/macros.sas' AS file_path,
  '%macro load(src, t=def);' || chr(10) || 'data stage.&t;' || chr(10) || ' set raw.&src;' || chr(10) || 'run;' || chr(10) || '%mend;' || chr(10)
  || '%macro twice(a, t=none);' || chr(10) || '%load(&a.1);' || chr(10) || '%load(&a.2, t=&t);' || chr(10) || 'proc print data=seen.&a.;' || chr(10) || 'run;' || chr(10) || '%mend;' || chr(10) AS code
FROM region
WHERE r_regionkey = 0
"""

RUN_LOG = """
SELECT 'wf_' || user_id AS workflow_id,
  CASE event_id % 5 WHEN 0 THEN 'PARSE' WHEN 1 THEN 'RESOLVE' WHEN 2 THEN 'ENRICH' WHEN 3 THEN 'BUILD' ELSE 'VALIDATE' END AS stage,
  CASE event_id % 7 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'STARTED' WHEN 2 THEN 'SUCCESS' WHEN 3 THEN 'SUCCESS' WHEN 4 THEN 'FAILED' ELSE 'CHECKPOINT' END AS status,
  CASE WHEN event_id % 7 IN (0, 1) THEN ts END AS start_time,
  CASE WHEN event_id % 7 IN (2, 3, 4) THEN ts END AS end_time,
  CASE WHEN event_id % 7 = 4 THEN 'ValueError: ' || event_type END AS error_message,
  CASE WHEN event_id % 7 = 5 THEN props END AS checkpoint_data,
  ts AS created_at, event_id
FROM events
"""

CLASS_RULES = """
SELECT * FROM (VALUES
  (1, 'raw.cust%', 'Sales', 'Master', 'PII'),
  (2, 'raw.%', 'Sales', 'Reference', 'Internal'),
  (3, 'mart.%', 'Finance', 'Transactional', 'Confidential'),
  (4, '%.r__', 'Finance', 'Reference', 'Public'),
  (9, '%', 'Unknown', 'Unknown', 'Internal')
) AS r(priority, pattern, business_domain, data_category, sensitivity_level)
"""

CATALOG_TABLES = """
SELECT DISTINCT 'raw.cust_' || c_custkey AS table_name FROM customer
UNION ALL
SELECT DISTINCT 'mart.mm_' || (p_partkey % 40) AS table_name FROM part
UNION ALL
SELECT DISTINCT 'rptt.rr_' || s_suppkey AS table_name FROM supplier
"""

FIXTURES = {
    "code_files": CODE_FILES,
    "run_log": RUN_LOG,
    "class_rules": CLASS_RULES,
    "catalog_tables": CATALOG_TABLES,
}
TABLES_OF = {
    "code_files": ("orders", "nation", "region"),
    "run_log": ("events",),
    "class_rules": (),
    "catalog_tables": ("customer", "part", "supplier"),
}


# Split columns for a table that arrives in fewer pieces than there are cores.
SPLIT_BY = {"orders": "o_orderkey", "events": "event_id"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, split over the cores when it is a file too small to split itself.

    Text is built and searched after this point, so only keys are moved. Large
    tables come in enough pieces and are left as they are.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in SPLIT_BY and df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores, SPLIT_BY[name])
    return df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived input over the parquet tables in ``sf_dir``."""
    tables = {t: _table(spark, sf_dir, t) for t in TABLES_OF[name]}
    sql = FIXTURES[name]
    for t in tables:
        sql = sql.replace(f"FROM {t}\n", f"FROM {{{t}}}\n")
    return spark.sql(sql, **tables) if tables else spark.sql(sql)
