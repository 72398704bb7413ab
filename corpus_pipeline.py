"""The corpus pipeline: quality rules, near duplicates, repeated passages, secrets, packing.

Each stage works on what the one before kept. All but the last return the columns of
documents, so that a stage can be left out or run alone on any table of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.llm import neardup, packing, quality, secrets, suffixes
from umbra.llm.common import fresh, load, split_by, stage

#: About 50 words: the shortest passage that counts as repeated.
PASSAGE_BYTES = suffixes.PASSAGE_BYTES


def with_text(docs: DataFrame, text) -> DataFrame:
    """`docs` with another text, and its length where there is such a column."""
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; a null or empty text is rejected, as it has too few words."""
    return quality.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, of the smallest known id. Rows of one id and text count as one.

    Rows are told apart by id and text together, never by id alone, and a null id is a value
    like others. Rows without a shingle stay; with a known id, their repeats count as one.
    """
    of_text = F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    key = F.concat(F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit("")), F.lit(":"), of_text)
    held = docs.select(F.struct("*").alias("d"), F.col("doc_id"), F.col("text"), key.alias("key"))
    groups = stage(neardup.near_duplicates(held, key="key"), "groups")
    gone = groups.where("NOT chosen").select("key").distinct()
    some, none = split_by(held, gone, "key")
    left = none.unionByName(some.join(gone, "key", "left_anti").select(*none.columns))
    again = groups.where("chosen AND (doc_id IS NOT NULL OR n_shingles > 0)").groupBy("key").count().where("count > 1").select("key")
    if again.limit(1).count():
        some, none = split_by(left, again, "key")
        once = some.join(again, "key", "left_semi").dropDuplicates(["key", "text"])
        left = none.unionByName(once).unionByName(some.join(again, "key", "left_anti"))
    return left.select("d.*")


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of PASSAGE_BYTES or more that stand elsewhere too go from the texts; half a character left at a cut goes with them.

    A null text stays null; an empty table gives an empty one.
    """
    left = suffixes.repeats_removed(docs.select(F.struct("*").alias("d"), F.col("text")), PASSAGE_BYTES)
    out = left.select("d.*", suffixes.whole_characters(F.col("kept")).alias(fresh(docs, "_kept")))
    text = F.when(F.col("text").isNotNull(), F.col(out.columns[-1]))
    return with_text(out, text).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mask. The spans follow from the text, so equal texts share them; a null text stays null."""
    found = stage(secrets.secrets(docs).where("size(found) > 0").select(F.col("text_md5").alias("tid"), "found").dropDuplicates(["tid"]), "found")
    held = docs.select(F.struct("*").alias("d"), F.col("text").alias("t"), F.md5(F.encode("text", "UTF-8")).alias("tid"))
    some, none = split_by(held, found, "tid")
    some = some.join(found, "tid", "left").select("d", F.when(F.col("found").isNull(), F.col("t")).otherwise(secrets.masked(F.col("t"), F.col("found"))).alias("t"))
    out = none.select("d", "t").unionByName(some).select("d.*", F.col("t").alias(fresh(docs, "_masked")))
    return with_text(out, F.col(out.columns[-1])).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences; a null or empty text is one piece of the closing id."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenisation and packing cannot be said in SQL; tests hold the result against brute force.
ORACLE_SQL = None
