"""How the sources of a language differ in their terms: DuckDB over hash shards, merged by Spark (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table, text_slices

LEAST_DOCUMENTS = 3
#: Terms ranked for each group.
TOP = 200
#: One, in the fixed-point shares.
UNIT = 1_000_000_000
#: Counted rows that a task gathers before it hands them on or sums them up, and rows of a shard.
HELD, SHARD = 400_000, 500_000
MEMORY = "400MB"

#: Terms of the rows in ``texts``, by row first, for a document counts once. Everything that isn't part of a term parts them.
COUNT = r"""
SELECT lang, source, term, sum(n)::BIGINT AS n, count(*) AS docs
FROM (SELECT k, lang, source, term, count(*) AS n
      FROM (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts)
      GROUP BY ALL)
GROUP BY ALL
"""
SUM = "SELECT lang, source, term, sum(n)::BIGINT AS n, sum(docs)::BIGINT AS docs FROM {} GROUP BY ALL"
#: The terms that a language keeps, with their count in the whole language; one row a term leads.
KEEP = """
SELECT lang, source, term, n, (sum(n) OVER w)::BIGINT AS whole, row_number() OVER (PARTITION BY lang, term ORDER BY source) = 1 AS leads
FROM counts WINDOW w AS (PARTITION BY lang, term) QUALIFY sum(docs) OVER w >= {least}
"""
#: A shard's shares: of the group, of the group where it lacks a term, of the language.
SHARES = """
CREATE TEMP TABLE shares AS SELECT lang, source, term, n, p({unit}, n, n_group + v) AS p, p({unit}, 0, n_group + v) AS zero, p({unit}, whole, n_lang + v) AS q FROM counts
"""
#: What terms that both sources have add to the pair, beyond what each one's own terms and absent ones add.
PAIRS = """
SELECT a.lang, a.source, b.source AS item, sum(f(a.p, b.p) - f(a.p, b.zero) - f(a.zero, b.p) + f(a.zero, b.zero))::BIGINT AS value
FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
"""
TERMS = """
SELECT lang, source, term AS item, f(p, q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, term) <= {top}
"""
COUNTS = "lang string, source string, term string, n long, docs long"


def done(con: duckdb.DuckDBPyConnection, sql: str) -> list[tuple]:
    """Run a statement to its end."""
    return con.execute(sql).fetchall()


def engine() -> duckdb.DuckDBPyConnection:
    """An in-memory database for one task: one thread, bounded memory, no files."""
    con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": "", "preserve_insertion_order": False})
    done(con, "CREATE MACRO p(unit, n, total) AS 1 + unit::HUGEINT * (n + 1) // total")
    done(con, "CREATE MACRO f(p, q) AS (p - q) * (p - q) // q")
    return con


def gathered(con: duckdb.DuckDBPyConnection, batches: Iterator[pa.RecordBatch]) -> None:
    """Sum ``batches`` of counts into the table ``counts``, summing up whenever as many rows again have come."""
    done(con, "CREATE TEMP TABLE counts (lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, docs BIGINT)")
    limit = HELD
    for batch in batches:
        con.register("rows", pa.Table.from_batches([batch]))
        done(con, "INSERT INTO counts SELECT lang, source, term, n, docs FROM rows")
        if done(con, "SELECT count(*) FROM counts")[0][0] > limit:
            done(con, f"CREATE OR REPLACE TEMP TABLE counts AS {SUM.format('counts')}")
            limit = 2 * max(HELD, done(con, "SELECT count(*) FROM counts")[0][0])
    done(con, f"CREATE OR REPLACE TEMP TABLE counts AS {SUM.format('counts')}")


def term_counts(docs: DataFrame) -> DataFrame:
    """Counts by language, source and term, one row for each in a run of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with engine() as con:
            made = 0
            for batch in batches:
                for part in text_slices(batch, "text", 8 << 20):
                    con.register("texts", pa.Table.from_batches([part]).append_column("k", pa.array(range(part.num_rows), pa.int64())))
                    done(con, ("INSERT INTO counts " if made else "CREATE TEMP TABLE counts AS ") + COUNT)
                    made = done(con, "SELECT count(*) FROM counts")[0][0]
                    if made > HELD:
                        yield from con.sql(SUM.format("counts")).to_arrow_reader()
                        done(con, "DROP TABLE counts")
                        made = 0
            if made:
                yield from con.sql(SUM.format("counts")).to_arrow_reader()

    return docs.mapInArrow(count, COUNTS)


def kept_terms(counts: DataFrame, shards: int, least: int) -> DataFrame:
    """``(lang, source, term, n, whole, leads)`` of the terms in at least ``least`` documents of their language, by shards of language and term."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with engine() as con:
            gathered(con, batches)
            yield from con.sql(KEEP.format(least=least)).to_arrow_reader()

    return counts.repartition(shards, "lang", "term").mapInArrow(keep, "lang string, source string, term string, n long, whole long, leads boolean")


def compared(kept: DataFrame, shards: int, top: int) -> DataFrame:
    """Partial pair sums and each group's best terms of every shard: ``(part, lang, source, item, value)``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with engine() as con:
            done(con, "CREATE TEMP TABLE counts (lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, whole BIGINT, n_group BIGINT, n_lang BIGINT, v BIGINT)")
            for batch in batches:
                con.register("rows", pa.Table.from_batches([batch]))
                done(con, "INSERT INTO counts SELECT lang, source, term, n, whole, n_group, n_lang, v FROM rows")
            done(con, SHARES.format(unit=UNIT))
            done(con, "DROP TABLE counts")
            for part, sql in (("pair", PAIRS), ("term", TERMS.format(top=top))):
                for found in con.sql(sql).to_arrow_reader():
                    yield pa.RecordBatch.from_arrays([pa.array([part] * found.num_rows, pa.string()), *found.columns], ["part", *found.schema.names])

    return kept.repartition(shards, "lang", "term").mapInArrow(compare, "part string, lang string, source string, item string, value long")


def p_of(count, total):
    """The fixed-point share of ``count``, as the shards reckon it; 1 where nothing is kept."""
    wide = (count + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(12,0)")
    return F.when(total > 0, 1 + F.call_function("div", wide, total.cast("decimal(20,0)"))).otherwise(1)


def f_of(p: str, q: str):
    """The distance of share ``p`` from share ``q``."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source of a language is from the others, and which terms mark it.

    Tasks count terms in DuckDB as they read; counts shuffle by hash of
    language and term, so each shard has all of its terms and DuckDB keeps,
    compares and ranks them there. A term that only one of two sources has
    needs no pair: Spark takes those from each source's histogram of counts,
    and adds the shards' sums for terms in common. Null texts, languages and
    sources are read as empty; groups without a term have shares of their own;
    repeated rows are documents each; ties go by the item's bytes; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    text_, lang_, source_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, lang, source))
    rows = docs.select(lang_.alias("lang"), source_.alias("source"), text_.alias("text"))
    groups = cut(rows.select("lang", "source").distinct(), "divergence-groups")
    counts = cut(term_counts(rows), "divergence-counts")
    least_shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least_shards, -(-counts.count() // SHARD))
    kept = cut(kept_terms(counts, shards, least), "divergence-kept")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.count("*").alias("n_terms"))
    whole = kept.where("leads").groupBy("lang").agg(F.sum("whole").alias("n_lang"), F.count("*").alias("v"))
    totals = cut(groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left").na.fill(0), "divergence-totals")
    found = cut(compared(kept.join(totals, ["lang", "source"]), shards, top), "divergence-shards")

    totals = totals.withColumn("zero", p_of(F.lit(0), F.col("n_group") + F.col("v")))
    # how many terms of a group have the same count: the terms that the other source lacks are reckoned from these
    alike = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("m")).join(totals, ["lang", "source"])
    alike = alike.select("lang", "source", "m", "zero", p_of(F.col("n"), F.col("n_group") + F.col("v")).alias("p"))
    other = totals.select("lang", F.col("source").alias("item"), F.col("zero").alias("other"), "v")
    mine = alike.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.col("m") * (f_of("p", "other") - f_of("zero", "other"))).alias("value"))
    theirs = alike.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.col("m") * (f_of("other", "p") - f_of("other", "zero"))).alias("value"))
    theirs = theirs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    base = totals.join(other.drop("v"), "lang").where("source <> item").select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * f_of("zero", "other")).otherwise(0).alias("value"))
    both = found.where("part = 'pair'").select("lang", "source", "item", "value")
    pairs = base.unionByName(mine).unionByName(theirs).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    result = pairs.withColumn("part", F.lit("pair")).unionByName(found.where("part = 'term'"))
    by = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    ranked = result.withColumn("rank", F.row_number().over(by)).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: divergence of sources within each language of ``documents``, and the terms that mark each source.

    Nulls are read as empty; repeated rows are documents each; an empty table
    gives no rows; ties go by the item's bytes.
    """
    return divergence(table(spark, sf_dir, "documents"))


#: Every kept term of every pair of groups.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), t AS (
  SELECT k, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS whole FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 3
), groups AS (
  SELECT DISTINCT lang, source FROM d
), met AS (
  SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL
), cells AS (
  SELECT g.lang, g.source, k.term, k.whole, coalesce(m.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN met m ON m.lang = g.lang AND m.source = g.source AND m.term = k.term
), shares AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source))::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (whole + 1)) // (sum(whole) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source))::HUGEINT AS q FROM cells
), pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pairs LEFT JOIN sums USING (lang, source, item)
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found
QUALIFY part = 'pair' OR rank <= 200
"""
