"""A wiki-shaped page table out of star-schema tables, for checks and benchmarks.

The statement runs unchanged on Spark and on other SQL engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CORPUS_SQL = """
SELECT k AS page_id, k * 10 + 1 AS rev_id,
  CASE WHEN ns = 10 THEN 'Template:Box ' || CAST(k % 100 AS STRING) ELSE 'Order ' || CAST(k AS STRING) END AS title,
  ns,
  CASE WHEN k % 10 = 7 THEN 'Order ' || CAST(k - 1 AS STRING) END AS redirect_to,
  CASE WHEN ns = 10 AND k % 20 = 19 THEN '<onlyinclude>only {{{1}}}</onlyinclude> rest'
       WHEN ns = 10 THEN '<noinclude>doc</noinclude><includeonly>Box {{{1|none}}} in {{{year|n/a}}}</includeonly>'
       WHEN k % 10 = 7 THEN '#REDIRECT [[Order ' || CAST(k - 1 AS STRING) || ']]'
       ELSE '{{Box ' || CAST((k % 50) * 2 + 1 AS STRING) || '|' || c_mktsegment || '|year=' || y || '|cite={{cite|' || y || '}}}}' || chr(10)
  || q3 || 'Order ' || CAST(k AS STRING) || q3 || ' is a ' || q2 || 'sale' || q2 || '&nbsp;of <b>note</b><ref>c ' || y || '</ref><!-- x -->.' || chr(10)
  || 'In ' || y || ' nothing happened. [[' || n_name || '|the land]]s hosted [[' || c_name || ']] in ' || y || ' and on ' || d || '.' || chr(10)
  || '{| class="t"' || chr(10) || '| cell' || chr(10) || '|}' || chr(10)
  || '== History ==' || chr(10)
  || '* [[' || o_orderpriority || ']] was set during ' || y || ' – ' || CAST(CAST(y AS INT) + 2 AS STRING) || chr(10) || chr(10)
  || CASE k % 4 WHEN 0 THEN 'See [[File:a.png|thumb|in 1999]] from the 1990s; [[' || c_mktsegment || ']] rose in the 19th century!'
                WHEN 1 THEN 'Old [[' || n_name || ']] began 44 BC, ended 476 AD.'
                WHEN 2 THEN 'No link in ' || y || '.'
                ELSE '[[A]] [[B]] 1970s? [[' || c_mktsegment || ']] no date.' END || chr(10)
  || '# first' || chr(10) || '# second' || chr(10) || chr(10)
  || 'External [http://ex.org/' || CAST(k AS STRING) || ' site] and [[2001: Film]] <br/> end <math>x+1</math> 5 &lt; 6.' || chr(10)
  || '__NOTOC__' || chr(10)
  || CASE WHEN k % 50 = 0 THEN '{{disambig}}' || chr(10) ELSE '' END
  || '[[Category:' || c_mktsegment || ']]' || chr(10) || '[[Category:' || n_name || ' in ' || y || '|key]]' END AS wikitext
FROM (SELECT *, o_orderkey AS k, CASE WHEN o_orderkey % 10 = 9 THEN 10 ELSE 0 END AS ns,
             CAST(year(o_orderdate) AS STRING) AS y, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d,
             repeat(chr(39), 2) AS q2, repeat(chr(39), 3) AS q3 FROM orders) o
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Give costly per-row work one task per core at least.

    A file of a single row group is read by a single task; where the scan has enough tasks already,
    as it has on large data, nothing is moved.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


def corpus(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """The page table over the given tables; ``orders`` may be a stream."""
    views = {"customer": table(spark, sf_dir, "customer"), "nation": table(spark, sf_dir, "nation")}
    if orders is None:
        orders = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    views["orders"] = orders
    for name, df in views.items():
        df.createOrReplaceTempView(f"chronolink_{name}")
    sql = CORPUS_SQL
    for name in views:
        sql = sql.replace(f"FROM {name})", f"FROM chronolink_{name})")
        sql = sql.replace(f"JOIN {name} ", f"JOIN chronolink_{name} ")
    return spark.sql(sql)
