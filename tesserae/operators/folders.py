"""Folder trees as document models, and parts inferred for trees that don't letter them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A name that states its part, one that is navigation, and a file that is its folder's own text.
LETTERED, NAVIGATION, OWN_FILE = r"^([A-Z])[-. ]", r"(?i)^(readme|glossary)", r"(?i)^(readme|00-.*)\.md$"
#: Trees that have to agree on a name's part, and the share of those that know it.
LEAST, SHARE = 3, 0.6


def plain(name: Column) -> Column:
    """A name without extension, letter or number in front, in lower case."""
    bare = F.regexp_replace(F.regexp_replace(name, r"(?i)\.md$", ""), r"^(?:[A-Z]|[0-9]+(?:\.[0-9]+)*)[-. ]+", "")
    return F.trim(F.regexp_replace(F.lower(bare), "[-_ ]+", "-"))


def natural(path: Column) -> Column:
    """A sort key: numbers in front of names count as numbers, names without one come last."""
    def padded(part: Column) -> Column:
        number = F.regexp_extract(part, r"^([0-9]+(?:\.[0-9]+)*)", 1)
        numbered = F.concat(F.array_join(F.transform(F.split(number, r"\."), lambda n: F.lpad(n, 9, "0")), "."), F.substring(part, F.length(number) + 1, F.length(part)))
        return F.when(number == "", F.concat(F.lit("~"), part)).otherwise(numbered)

    return F.array_join(F.transform(F.split(path, "/"), padded), "/")


def model(files: DataFrame) -> DataFrame:
    """``files(key, path, text)`` as sections: ``(key, node, parent, level, title, ord, text)``.

    Every folder is a section, whether a file of its own gives it a text or
    not; a file's section is called as its first heading says, else as its
    name. Sections stand in natural order of their paths, a folder before what
    is in it. Other extensions than ``.md`` aren't sections.
    """
    found = files.where(F.col("path").rlike(r"(?i)\.md$")).withColumn("parts", F.split("path", "/")).withColumn("name", F.element_at("parts", -1))
    folder = F.array_join(F.slice("parts", 1, F.size("parts") - 1), "/")
    own = F.col("name").rlike(OWN_FILE) & (F.size("parts") > 1)
    heading = F.nullif(F.trim(F.regexp_extract("text", r"(?m)^#{1,6}[ \t]+(.*)$", 1)), F.lit(""))
    texts = found.select("key", F.when(own, folder).otherwise(F.regexp_replace("path", r"(?i)\.md$", "")).alias("node"), "text", heading.alias("heading"), (~own).alias("leaf"))
    # of several files for one section its own comes first
    texts = texts.groupBy("key", "node").agg(F.min_by(F.struct("text", "heading"), F.struct("leaf", "text")).alias("x"))
    parts = F.split("node", "/")
    above = texts.select("key", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("node")).distinct()
    rows = above.join(texts, ["key", "node"], "left")
    order = F.row_number().over(Window.partitionBy("key").orderBy(natural(F.col("node")), "node")) - 1
    title = F.coalesce(F.col("x.heading"), F.replace(plain(F.element_at(parts, -1)), F.lit("-"), F.lit(" ")))
    parent = F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"))
    return rows.select("key", "node", parent.alias("parent"), F.size(parts).alias("level"), title.alias("title"), order.alias("ord"), F.col("x.text").alias("text"))


def learned(files: DataFrame, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """``(name, letter, is_part)``: the part that a folder's or section's name says, from the trees that letter their parts.

    A part's own name goes before that of a section within parts; a name
    counts if enough trees agree on its letter.
    """
    parts = F.split("path", "/")
    own = F.regexp_extract(parts[0], LETTERED, 1)
    rows = files.select("key", parts.alias("parts"), own.alias("letter")).where("letter <> '' and size(parts) > 1")
    said = rows.select("key", "letter", F.explode(F.array(F.struct(plain(F.col("parts")[0]).alias("name"), F.lit(True).alias("is_part")), F.struct(plain(F.col("parts")[1]).alias("name"), F.lit(False).alias("is_part")))).alias("s"))
    votes = said.select("key", "letter", "s.*").where("name <> ''").distinct().groupBy("name", "is_part", "letter").agg(F.count("*").alias("n"))
    best = votes.groupBy("name", "is_part").agg(F.max_by("letter", F.struct("n", -F.ascii("letter"))).alias("letter"), F.max("n").alias("n"), F.sum("n").alias("total"))
    best = best.where((F.col("n") >= least) & (F.col("n") >= share * F.col("total")))
    return best.groupBy("name").agg(F.max_by(F.struct("letter", "is_part"), "is_part").alias("x")).select("name", "x.letter", "x.is_part")


def inferred(files: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``(key, name, letter, is_part, wrapper)``: parts of the names that don't state them, in trees of ``files(key, path, page)``.

    One folder around everything that no part is called after is a wrapper, and
    its own folders are looked at. In a tree without letters names go in the
    order of their first pages; one that the lexicon doesn't know, or a loose
    file, belongs to the part that is open. Where some folders have a letter the
    others get theirs by name alone. Trees lettered throughout, and those of
    which no name is known, get none.
    """
    parts = F.split("path", "/")
    rows = files.where(~F.element_at(parts, -1).rlike(NAVIGATION) | (F.size(parts) > 1)).select("key", "page", parts.alias("parts"))
    tops = rows.groupBy("key").agg(F.collect_set(F.when(F.size("parts") > 1, F.col("parts")[0])).alias("dirs"), F.max(F.size("parts")).alias("deep")).where("size(dirs) > 0")
    single = tops.where("size(dirs) = 1 and deep > 2").select("key", F.col("dirs")[0].alias("wrapper")).where(~F.col("wrapper").rlike(LETTERED)).withColumn("name", plain(F.col("wrapper")))
    single = single.join(lexicon.select("name"), "name", "left_anti").select("key", "wrapper")
    rows = rows.join(single, "key", "left")
    inside = F.when(F.col("wrapper").isNull(), F.col("parts")).when(F.col("parts")[0] == F.col("wrapper"), F.slice("parts", 2, F.size("parts")))
    rows = rows.withColumn("inside", inside).where("inside is not null and size(inside) > 0").where(~((F.size("inside") == 1) & F.col("inside")[0].rlike(NAVIGATION)))
    names = rows.groupBy("key", "wrapper", F.col("inside")[0].alias("name")).agg(F.min("page").alias("page"), F.max(F.size("inside") > 1).alias("is_dir"))
    names = names.withColumn("own", F.nullif(F.regexp_extract("name", LETTERED, 1), F.lit(""))).withColumn("plain", plain(F.col("name")))
    names = names.join(lexicon.select(F.col("name").alias("plain"), "letter", "is_part"), "plain", "left")
    tree = Window.partitionBy("key")
    names = names.withColumn("n_dirs", F.count_if("is_dir").over(tree)).withColumn("n_own", F.count_if(F.col("is_dir") & F.col("own").isNotNull()).over(tree))
    order = Window.partitionBy("key").orderBy(F.col("page").asc_nulls_last(), "name").rowsBetween(Window.unboundedPreceding, 0)
    open_ = F.last(F.coalesce("own", "letter"), ignorenulls=True).over(order)
    found = F.when(F.col("n_own") == F.col("n_dirs"), None).when(F.col("n_own") > 0, F.col("letter")).otherwise(open_)
    out = names.withColumn("found", found).where("found is not null and own is null")
    return out.select("key", "name", F.col("found").alias("letter"), F.coalesce("is_part", F.lit(False)).alias("is_part"), "wrapper")
