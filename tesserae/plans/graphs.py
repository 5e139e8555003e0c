"""Trees, citations and ordered folds; sections come from document lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import branches, folds, tables, trees
from ..sources.tables import read
from .catalog import query

#: Each line is a section whose level follows its place and length.
_SECTIONS = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ord FROM documents),
s AS (SELECT doc_id, CAST(ord AS INTEGER) AS ord, CASE WHEN ord = 0 THEN 1 ELSE 1 + CAST((ord + length(line)) % 3 AS INTEGER) END AS level, length(line) AS n FROM l)
"""


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section for each line of each document."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "line"))
    level = F.when(F.col("ord") == 0, 1).otherwise(1 + (F.col("ord") + F.length("line")) % 3).cast("int")
    return lines.select("doc_id", "ord", level.alias("level"), F.length("line").cast("bigint").alias("n"))


@query("section_parents", _SECTIONS + "SELECT c.doc_id, c.ord, c.level, max(p.ord) AS parent FROM s c LEFT JOIN s p ON p.doc_id = c.doc_id AND p.ord < c.ord AND p.level < c.level GROUP BY ALL")
def section_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The section that each section stands under."""
    return trees.parents_by_level(sections(spark, sf_dir), "doc_id", 3).select("doc_id", "ord", "level", "parent")


@query("breadcrumbs", _SECTIONS + """, p AS (SELECT c.doc_id, c.ord, max(p.ord) AS parent FROM s c LEFT JOIN s p ON p.doc_id = c.doc_id AND p.ord < c.ord AND p.level < c.level GROUP BY ALL)
SELECT a.doc_id, a.ord, coalesce('s' || c.ord || ' > ', '') || coalesce('s' || b.ord || ' > ', '') || 's' || a.ord AS breadcrumb, CAST(1 + (b.ord IS NOT NULL)::INT + (c.ord IS NOT NULL)::INT AS INTEGER) AS depth
FROM p a LEFT JOIN p b ON b.doc_id = a.doc_id AND b.ord = a.parent LEFT JOIN p c ON c.doc_id = b.doc_id AND c.ord = b.parent
""")
def breadcrumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path of each section from the top: the levels that are open where it stands, by one window."""
    rows = branches.spans(sections(spark, sf_dir).withColumnRenamed("doc_id", "key"), 3)
    path = F.transform(F.concat("above", F.array("ord")), lambda o: F.concat(F.lit("s"), o.cast("string")))
    return rows.select(F.col("key").alias("doc_id"), "ord", F.array_join(path, " > ").alias("breadcrumb"), (F.size("above") + 1).alias("depth"))


@query("subtree_rows", _SECTIONS + ", u AS (SELECT a.doc_id, a.ord, coalesce(min(b.ord) - 1, (SELECT max(ord) FROM s z WHERE z.doc_id = a.doc_id)) AS until FROM s a LEFT JOIN s b ON b.doc_id = a.doc_id AND b.ord > a.ord AND b.level <= a.level GROUP BY a.doc_id, a.ord) SELECT u.doc_id, u.ord, CAST(until AS INTEGER) AS until, CAST(sum(t.n) AS BIGINT) AS n_chars FROM u JOIN s t ON t.doc_id = u.doc_id AND t.ord BETWEEN u.ord AND u.until GROUP BY ALL")
def subtree_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each section's subtree ends, and how long it is: a difference of running sums."""
    rows = trees.subtree_ends(sections(spark, sf_dir), "doc_id", 3)
    run = F.sum("n").over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("run", run)
    ends = rows.select("doc_id", F.col("ord").alias("until"), F.col("run").alias("last"))
    return rows.join(ends, ["doc_id", "until"]).select("doc_id", "ord", "until", (F.col("last") - F.col("run") + F.col("n")).alias("n_chars"))


@query("carry_forward_part", _SECTIONS + "SELECT doc_id, ord, max(CASE WHEN level = 1 THEN ord END) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS part FROM s")
def carry_forward_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last part seen applies to the sections that follow."""
    rows = sections(spark, sf_dir).withColumn("p", F.when(F.col("level") == 1, F.col("ord")))
    return tables.carry_forward(rows, ["doc_id"], ["ord"], "p", "part").select("doc_id", "ord", "part")


@query("section_lengths_over_own", _SECTIONS + "SELECT doc_id, ord, level, lead(ord) OVER (PARTITION BY doc_id, level ORDER BY ord) - ord AS to_next FROM s")
def section_lengths_over_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance to the next section of the same level."""
    w = Window.partitionBy("doc_id", "level").orderBy("ord")
    return sections(spark, sf_dir).select("doc_id", "ord", "level", (F.lead("ord").over(w) - F.col("ord")).alias("to_next"))


_EDGES = "WITH e AS (SELECT DISTINCT o_custkey AS src, (o_orderkey * 7) % 1500 AS dst FROM orders)\n"


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A citation graph over customers."""
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("src"), ((F.col("o_orderkey") * 7) % 1500).alias("dst")).distinct()


@query("citation_reverse", _EDGES + "SELECT dst AS key, src AS cited_by, count(*) OVER (PARTITION BY dst) AS n_cited_by FROM e WHERE src <> dst")
def citation_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who cites each key: a row for each, with their number; no list grows with a key's fame."""
    rows = edges(spark, sf_dir).where("src <> dst").select(F.col("dst").alias("key"), F.col("src").alias("cited_by"))
    return rows.join(rows.groupBy("key").agg(F.count("*").alias("n_cited_by")), "key")


@query("ego_neighbourhood", _EDGES + ", b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), h0 AS (SELECT CAST(7 AS BIGINT) AS node), h1 AS (SELECT DISTINCT dst AS node FROM b JOIN h0 ON src = node WHERE dst NOT IN (SELECT node FROM h0)), h2 AS (SELECT DISTINCT dst AS node FROM b JOIN h1 ON src = node WHERE dst NOT IN (SELECT node FROM h0) AND dst NOT IN (SELECT node FROM h1)) SELECT node, 0 AS hops FROM h0 UNION ALL SELECT node, 1 FROM h1 UNION ALL SELECT node, 2 FROM h2")
def ego_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes within two steps of one."""
    return trees.neighbourhood(edges(spark, sf_dir), spark.range(7, 8).select(F.col("id").alias("node")), 2)


@query("graph_summary", _EDGES + "SELECT 'node' AS what, c_mktsegment AS kind, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT 'edge', CASE WHEN src = dst THEN 'self' ELSE 'cites' END, count(*) FROM e GROUP BY 2")
def graph_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes by type, edges by relation."""
    nodes = read(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("kind")).agg(F.count("*").alias("n")).select(F.lit("node").alias("what"), "kind", "n")
    rel = F.when(F.col("src") == F.col("dst"), "self").otherwise("cites")
    return nodes.unionByName(edges(spark, sf_dir).groupBy(rel.alias("kind")).agg(F.count("*").alias("n")).select(F.lit("edge").alias("what"), "kind", "n"))


@query("siblings", _SECTIONS + ", p AS (SELECT c.doc_id, c.ord, c.level, max(p.ord) AS parent FROM s c LEFT JOIN s p ON p.doc_id = c.doc_id AND p.ord < c.ord AND p.level < c.level GROUP BY ALL) SELECT doc_id, ord, count(*) OVER (PARTITION BY doc_id, coalesce(parent, -1)) - 1 AS n_siblings FROM p")
def siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many sections share a parent: counted by group, no pairs are made."""
    rows = trees.parents_by_level(sections(spark, sf_dir), "doc_id", 3).withColumn("up", F.coalesce("parent", F.lit(-1)))
    return rows.select("doc_id", "ord", (F.count("*").over(Window.partitionBy("doc_id", "up")) - 1).alias("n_siblings"))


@query("version_chain_roots", "WITH RECURSIVE p AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_custkey - 1 END AS parent FROM customer), r AS (SELECT id, parent, id AS root, 0 AS d FROM p WHERE parent IS NULL OR parent NOT IN (SELECT id FROM p) UNION ALL SELECT p.id, p.parent, r.root, d + 1 FROM p JOIN r ON p.parent = r.id) SELECT id, root, CAST(d AS INTEGER) AS depth FROM r")
def version_chain_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root and depth of each parent chain, however long."""
    k = F.col("c_custkey")
    return trees.chain_roots(read(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 8 != 0, k - 1).alias("parent")))


@query("part_lexicon", "WITH u AS (SELECT p_name AS name, p_brand AS letter, count(DISTINCT p_partkey) AS n FROM part GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY name) AS total, row_number() OVER (PARTITION BY name ORDER BY n DESC, letter) AS rk FROM u) SELECT name, letter, n, round(n / total, 6) AS share FROM t WHERE rk = 1 AND n >= 3 AND n / total >= 0.05")
def part_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letter that a part's name usually has."""
    u = read(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name"), F.col("p_brand").alias("letter")).agg(F.count_distinct("p_partkey").alias("n"))
    top = u.groupBy("name").agg(F.sum("n").alias("total"), F.max_by(F.struct("letter", "n"), F.struct("n", F.lit(0))).alias("x"), F.max("n").alias("most"))
    best = u.join(top.select("name", "total", "most"), "name").where("n = most").groupBy("name", "n", "total").agg(F.min("letter").alias("letter"))
    return best.where("n >= 3 and n / total >= 0.05").select("name", "letter", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


@query("packed_chunks")
def packed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections packed in order into chunks of 512 tokens; an ordered fold that SQL doesn't have."""
    size = F.greatest(F.lit(1), F.floor(F.col("n") / 4)).cast("int")
    return folds.pack(sections(spark, sf_dir).select("doc_id", "ord", size.alias("size")), 512)


@query("legal_outline_levels", _SECTIONS + ", e AS (SELECT doc_id, ord, level * 2 - 1 AS level, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS i FROM s) SELECT doc_id, ord, CAST(least(i, min(level - i) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) + i) AS INTEGER) AS legal FROM e")
def legal_outline_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outline levels that never rise by more than one."""
    return folds.legal_levels(sections(spark, sf_dir).select("doc_id", "ord", (F.col("level") * 2 - 1).alias("level")))


@query("bullet_tiers")
def bullet_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indentation tiers of a document, each measured from the last one kept."""
    return folds.tiers(sections(spark, sf_dir).select("doc_id", (F.col("n") % 40).cast("double").alias("x")), 6.0)


@query("shard_assignment", """
WITH RECURSIVE j AS (SELECT doc_id AS job, CAST(ceil(n_chars / 500.0) AS BIGINT) AS pages FROM documents), o AS (SELECT *, greatest(coalesce(pages, 1), 1) AS size, row_number() OVER (ORDER BY greatest(coalesce(pages, 1), 1) DESC, job) AS i FROM j),
s(i, loads, shard) AS (SELECT 0::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], -1::BIGINT UNION ALL
SELECT o.i, list_transform(s.loads, lambda x, k: CASE WHEN k = list_position(s.loads, list_min(s.loads)) THEN x + o.size ELSE x END), list_position(s.loads, list_min(s.loads)) - 1 FROM s JOIN o ON o.i = s.i + 1)
SELECT job, pages, shard::INTEGER AS shard FROM o JOIN s USING (i)
""")
def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs to eight shards, the largest first, each to the one with the least to do."""
    jobs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("job"), F.ceil(F.col("n_chars") / 500).alias("pages"))
    return folds.assign_shards(jobs, 8)
