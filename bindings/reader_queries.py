"""Readers over text lines that Spark writes from the tables; the SQL reads the columns."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindings.registry import joined, load, query
from umbra.operators import design as Dg
from umbra.plans.lineage import checkpoint_root
from umbra.sources import hits as H
from umbra.sources import plexes as X
from umbra.sources import proteins as P
from umbra.sources import quant as Q
from umbra.sources import taxonomy as N


def tabbed(*cells) -> Column:
    return F.concat_ws("\t", *[c if isinstance(c, Column) else F.lit(c) for c in cells])


def spaced(*cells) -> Column:
    return F.concat_ws("  ", *[c if isinstance(c, Column) else F.lit(c) for c in cells])


def s(c: str) -> Column:
    return F.col(c).cast("string")


def source(spark, sf: str, name: str) -> DataFrame:
    """A table spread over the cores; one small file would be parsed by one task."""
    df = load(spark, sf, name)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() > cores else df.repartition(cores)


def scratch(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def put_table(df: DataFrame, path: str, sep: str = "\t") -> str:
    df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]).write.option(
        "header", True
    ).option("sep", sep).option("quote", "" if sep == "\t" else '"').csv(path)
    return path


# ---------------------------------------------------------------- proteins
@query("fasta_records", """
SELECT source AS protein_id, CAST(count(*) - 1 AS BIGINT) AS n_duplicates, min(doc_id) AS description,
       CAST(arg_min(length(regexp_replace(text, '\\s+', '', 'g')), doc_id) AS BIGINT) AS length,
       arg_min(md5(regexp_replace(text, '\\s+', '', 'g')), doc_id) AS seq_md5
FROM documents GROUP BY source""")
def fasta_records(spark, sf):
    docs = load(spark, sf, "documents")
    text = F.concat(F.lit(">"), "source", F.lit(" "), s("doc_id"), F.lit("\n"), "text")
    rec = P.parse_fasta(docs.select(F.col("doc_id").alias("_row"), text.alias("value")))
    first = P.first_record(rec, ["_row"], ["protein_id"])
    return first.select(
        "protein_id", "n_duplicates", F.col("description").cast("long").alias("description"),
        F.col("length").cast("long").alias("length"), F.md5("seq").alias("seq_md5"))


@query("fasta_worklist_text", """
SELECT '>D' || doc_id || chr(10) || text AS value FROM documents""")
def fasta_worklist_text(spark, sf):
    from umbra.sources.sinks import fasta_text

    docs = load(spark, sf, "documents")
    return docs.select(fasta_text(F.concat(F.lit("D"), s("doc_id")), F.col("text")).alias("value"))


def eggnog_lines(spark, sf) -> tuple[DataFrame, str]:
    part = load(spark, sf, "part")
    cells = {c: F.lit("-") for c in P.EGGNOG_COLUMNS}
    cells["query"] = F.concat(F.lit("P"), s("p_partkey"))
    cells["seed_ortholog"] = F.concat(s("p_size"), F.lit("."), F.regexp_replace("p_name", " ", "_"))
    cells["Description"] = F.col("p_name")
    ko = F.concat(F.lit("ko:K"), s("p_size"), F.lit(",ko:K"), F.substring("p_brand", 7, 3))
    cells["KEGG_ko"] = F.when(F.col("p_size") > 20, ko).otherwise("-")
    cells["KEGG_Pathway"] = F.when(
        F.col("p_size") > 30, F.concat(F.lit("map000"), s("p_size"), F.lit(",map01100"))
    ).when(F.col("p_size") > 25, "map01100").otherwise("-")
    cells["CAZy"] = F.when(F.col("p_type") == "PROMO", "GH13").otherwise("-")
    cells["PFAMs"] = F.when(F.col("p_type") == "SMALL", "DUF1234").when(
        F.col("p_type") == "LARGE", "Peptidase_S8").otherwise("-")
    body = part.select(tabbed(*cells.values()).alias("value"))
    header = "#" + "\t".join(P.EGGNOG_COLUMNS)
    extra = spark.createDataFrame([("## made from part",), (header,)], "value string")
    return extra.unionByName(body), header


EGGNOG_SQL = """egg AS (
  SELECT 'P' || p_partkey AS protein_id, CAST(p_size AS VARCHAR) AS eggnog_taxid, p_name AS eggnog_desc,
    CASE WHEN p_size > 20 THEN
      CASE WHEN CAST(p_size AS VARCHAR) = substr(p_brand, 7) THEN ['K' || p_size]
           ELSE list_sort(['K' || p_size, 'K' || substr(p_brand, 7)]) END ELSE [] END AS ko,
    CASE WHEN p_size > 30 THEN ['map000' || p_size, 'map01100']
         WHEN p_size > 25 THEN ['map01100'] ELSE [] END AS pathway,
    CASE WHEN p_type = 'PROMO' THEN ['GH13'] ELSE [] END AS cazy,
    CASE WHEN p_type = 'SMALL' THEN ['DUF1234'] WHEN p_type = 'LARGE' THEN ['Peptidase_S8']
         ELSE [] END AS pfams_emapper
  FROM part)"""


@query("eggnog_cells", f"""WITH {EGGNOG_SQL}
SELECT protein_id, eggnog_taxid, eggnog_desc, array_to_string(ko, ',') AS ko,
  array_to_string(pathway, ',') AS pathway, array_to_string(cazy, ',') AS cazy,
  array_to_string(pfams_emapper, ',') AS pfams_emapper FROM egg""")
def eggnog_cells(spark, sf):
    lines, _ = eggnog_lines(spark, sf)
    egg = P.typed_eggnog(P.parse_eggnog(lines, P.eggnog_header(lines)))
    return egg.select("protein_id", "eggnog_taxid", "eggnog_desc",
                      *[joined(c).alias(c) for c in ("ko", "pathway", "cazy", "pfams_emapper")])


@query("profile_library", """
SELECT 'T' || p_partkey AS name, CASE WHEN p_size > 5 THEN 'NF' || p_partkey END AS accession,
       p_name AS description FROM part""")
def profile_library(spark, sf):
    part = load(spark, sf, "part")
    acc = F.when(F.col("p_size") > 5, F.concat(F.lit("ACC   NF"), s("p_partkey"), F.lit("\n"))).otherwise("")
    text = F.concat(F.lit("HMMER3/f\nNAME  T"), s("p_partkey"), F.lit("\n"), acc, F.lit("DESC  "), "p_name",
                    F.lit("\nLENG  100\n"))
    return P.parse_hmm_library(part.select(text.alias("value")))


@query("cluster_pairs", """
SELECT 'P' || p_partkey AS protein_id, 'R' || p_type AS family_id FROM part""")
def cluster_pairs(spark, sf):
    part = load(spark, sf, "part")
    return P.parse_clusters(part.select(
        tabbed(F.concat(F.lit("R"), "p_type"), F.concat(F.lit("P"), s("p_partkey"))).alias("value")))


@query("gff_genes", """
SELECT 'S' || l_suppkey AS contig, l_orderkey AS start, l_orderkey + CAST(l_quantity AS BIGINT) AS "end",
  CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand,
  'P' || l_partkey || '.' || l_linenumber AS protein_id
FROM lineitem WHERE l_linestatus = 'O'""")
def gff_genes(spark, sf):
    li = source(spark, sf, "lineitem")
    kind = F.when(F.col("l_linestatus") == "O", "CDS").otherwise("gene")
    line = tabbed(
        F.concat(F.lit("S"), s("l_suppkey")), "made", kind, s("l_orderkey"),
        (F.col("l_orderkey") + F.col("l_quantity").cast("long")).cast("string"), ".",
        F.when(F.col("l_returnflag") == "R", "-").otherwise("+"), "0",
        F.concat(F.lit("Note=x;ID=P"), s("l_partkey"), F.lit("."), s("l_linenumber")))
    return P.parse_gff(li.select(line.alias("value")))


@query("context_table", """
SELECT 'P' || p_partkey AS protein_id, CAST(p_size AS BIGINT) AS n_cazymes_in_window,
  p_type = 'PROMO' AS prophage, p_type = 'SMALL' AS pul,
  CASE WHEN p_type = 'PROMO' THEN 'prophage' WHEN p_type = 'SMALL' THEN 'pul' ELSE '' END AS context_flags
FROM part""")
def context_table(spark, sf):
    part = load(spark, sf, "part")
    flag = lambda t: F.when(F.col("p_type") == t, "True").otherwise("False")
    line = tabbed(F.concat(F.lit("P"), s("p_partkey")), s("p_size"), flag("PROMO"), flag("SMALL"))
    out = P.parse_context(part.select(line.alias("value")),
                          ["protein_id", "n_cazymes_in_window", "prophage", "pul"])
    return out.withColumn("context_flags", joined("context_flags"))


@query("signal_peptides", """
SELECT 'P' || p_partkey AS protein_id, p_type AS sp_class FROM part""")
def signal_peptides(spark, sf):
    part = load(spark, sf, "part")
    line = tabbed(F.concat(F.lit("P"), s("p_partkey")), F.col("p_type"), "0.01", "0.99", "")
    comment = spark.createDataFrame([("# ID\tPrediction",)], "value string")
    return P.parse_signalp(comment.unionByName(part.select(line.alias("value"))))


@query("membrane_segments", """
SELECT 'L' || l_orderkey || '.' || l_partkey || '.' || l_suppkey AS protein_id,
  CAST(2 * l_linenumber AS INTEGER) AS n_tmh, CAST(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS INTEGER) AS n_tmb
FROM lineitem""")
def membrane_segments(spark, sf):
    li = source(spark, sf, "lineitem")
    labels = F.concat(F.expr("repeat('iiHHHHhhh', l_linenumber)"), F.lit("ooo"),
                      F.when(F.col("l_returnflag") == "A", "BBBB").otherwise(""), F.lit("i"))
    pid = F.concat(F.lit("L"), s("l_orderkey"), F.lit("."), s("l_partkey"), F.lit("."), s("l_suppkey"))
    return P.parse_tmbed(li.select(F.concat(pid, F.lit(" d\nAAA\n"), labels).alias("value")))


@query("failure_table", """
SELECT 'P' || p_partkey AS protein_id, p_size AS length, 'error of ' || p_name AS error FROM part""")
def failure_table(spark, sf):
    part = load(spark, sf, "part")
    head = spark.createDataFrame([("protein_id\tlength\terror",)], "value string")
    line = tabbed(F.concat(F.lit("P"), s("p_partkey")), s("p_size"), F.concat(F.lit("error of "), "p_name"))
    return P.parse_failures(head.unionByName(part.select(line.alias("value"))))


# ---------------------------------------------------------------- search hits
def tblout_lines(li: DataFrame) -> DataFrame:
    fixed = [F.concat(F.lit("P"), s("l_partkey")), "-", F.concat(F.lit("F"), s("l_suppkey")),
             F.when(F.col("l_returnflag") == "A", "-").otherwise(
                 F.concat(F.lit("PF"), s("l_suppkey"), F.lit("."), s("l_linenumber"))),
             s("l_discount"), s("l_extendedprice")] + ["0.0"] * 12
    text = F.when(F.col("l_linestatus") == "O", F.lit("Uncharacterized protein")).otherwise("-")
    return li.select(spaced(*fixed, text).alias("value"))


@query("hmm_table", """
SELECT 'P' || l_partkey AS protein_id, 'F' || l_suppkey AS name,
  CASE WHEN l_returnflag <> 'A' THEN 'PF' || l_suppkey || '.' || l_linenumber END AS accession,
  CASE WHEN l_linestatus = 'O' THEN 'Uncharacterized protein' END AS description,
  l_discount AS evalue, l_extendedprice AS score FROM lineitem""")
def hmm_table(spark, sf):
    hits = H.parse_tblout(tblout_lines(source(spark, sf, "lineitem")))
    return hits.select("protein_id", "name", "accession", "description", "evalue", "score")


@query("hmm_table_by_query", """
SELECT 'P' || l_suppkey AS protein_id, 'P' || l_partkey AS name, l_discount AS evalue, l_extendedprice AS score
FROM lineitem WHERE l_suppkey <> l_partkey""")
def hmm_table_by_query(spark, sf):
    li = source(spark, sf, "lineitem")
    fixed = [F.concat(F.lit("P"), s("l_partkey")), "-", F.concat(F.lit("P"), s("l_suppkey")), "-",
             s("l_discount"), s("l_extendedprice")] + ["0.0"] * 12
    hits = H.by_query(H.parse_tblout(li.select(spaced(*fixed, "-").alias("value"))))
    return hits.select("protein_id", "name", "evalue", "score")


@query("hmm_domains", """
SELECT 'P' || l_partkey AS protein_id, 'GH' || l_suppkey AS name, l_discount AS evalue,
  round(l_quantity / 50, 6) AS coverage
FROM lineitem WHERE l_quantity / 50 >= 0.35 AND l_discount <= 0.05""")
def hmm_domains(spark, sf):
    li = source(spark, sf, "lineitem")
    end = (F.col("l_quantity").cast("int") + 9).cast("string")
    cells = [F.concat(F.lit("P"), s("l_partkey")), "-", "300", F.concat(F.lit("GH"), s("l_suppkey"), F.lit(".hmm")),
             "-", "50", "1e-20", "80.0", "0.0", "1", "1", "0.1", s("l_discount"), s("l_extendedprice"), "0.0",
             "10", end, "10", "200", "10", "200", "0.95", "-"]
    hits = H.parse_domtblout(li.select(spaced(*cells).alias("value")), 0.35, 0.05)
    return hits.select("protein_id", "name", "evalue", F.round("qcov", 6).alias("coverage"))


def diamond_lines(li: DataFrame) -> DataFrame:
    """Nine columns; lines of status O are in the twelve-column layout."""
    nine = tabbed(F.concat(F.lit("P"), s("l_partkey")), F.concat(F.lit("T"), s("l_suppkey")),
                  (F.col("l_quantity") * 2).cast("string"), "150", s("l_discount"), s("l_extendedprice"),
                  (F.lit(100.0) - F.col("l_linenumber") * 10).cast("string"), "80",
                  F.concat(F.lit("title (VFC00"), s("l_linenumber"), F.lit(") "), s("l_suppkey")))
    twelve = tabbed(F.concat(F.lit("P"), s("l_partkey")), "T", *["1"] * 10)
    return li.select(
        F.when(F.col("l_linestatus") == "O", twelve).otherwise(nine).alias("value"),
        F.col("l_returnflag").alias("tag"))


DIAMOND_SQL = """dia AS (
  SELECT 'P' || l_partkey AS protein_id, l_returnflag AS db, 'T' || l_suppkey AS name,
    'title (VFC00' || l_linenumber || ') ' || l_suppkey AS description,
    l_quantity * 2 AS ident, l_discount AS evalue, l_extendedprice AS score, 100.0 - l_linenumber * 10 AS qcov
  FROM lineitem WHERE l_linestatus = 'F'
    AND l_discount <= CASE l_returnflag WHEN 'A' THEN 0.02 ELSE 0.08 END
    AND 100.0 - l_linenumber * 10 >= 50
    AND l_quantity * 2 >= CASE l_returnflag WHEN 'R' THEN 60 ELSE 30 END)"""


def diamond_hits(spark, sf) -> DataFrame:
    return H.parse_diamond(
        diamond_lines(source(spark, sf, "lineitem")), F.col("tag"), evalue=0.08, qcov=50, ident=30,
        max_evalues={"A": 0.02}, min_idents={"R": 60}).drop("tag")


@query("diamond_hits_per_database", f"""WITH {DIAMOND_SQL}
SELECT protein_id, db, name, description, ident, evalue, score, CAST(qcov AS DOUBLE) AS qcov FROM dia""")
def diamond_hits_per_database(spark, sf):
    return diamond_hits(spark, sf).select(
        "protein_id", "db", "name", "description", "ident", "evalue", "score", "qcov")


@query("kofam_calls", """
SELECT 'P' || l_partkey AS protein_id, 'K' || l_suppkey AS name, l_extendedprice AS score,
  l_discount AS evalue, 'family ' || l_suppkey AS description
FROM lineitem WHERE l_returnflag = 'R'""")
def kofam_calls(spark, sf):
    li = source(spark, sf, "lineitem")
    line = tabbed(F.when(F.col("l_returnflag") == "R", "*").otherwise(" "), F.concat(F.lit("P"), s("l_partkey")),
                  F.concat(F.lit("K"), s("l_suppkey")), "100", s("l_extendedprice"), s("l_discount"),
                  F.concat(F.lit('"family '), s("l_suppkey"), F.lit('"')))
    hits = H.parse_kofam(li.select(line.alias("value")))
    return hits.select("protein_id", "name", "score", "evalue", "description")


@query("interpro_matches", """
SELECT 'P' || l_partkey AS protein_id, CASE WHEN l_returnflag = 'A' THEN 'Pfam' ELSE 'Gene3D' END AS db,
  'S' || l_suppkey AS name, CASE WHEN l_linestatus = 'O' THEN 'domain ' || l_suppkey END AS description,
  CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 'IPR' || l_suppkey END AS ipr, l_discount AS evalue
FROM lineitem""")
def interpro_matches(spark, sf):
    li = source(spark, sf, "lineitem")
    db = F.when(F.col("l_returnflag") == "A", "Pfam").otherwise("Gene3D")
    desc = F.when(F.col("l_linestatus") == "O", F.concat(F.lit("domain "), s("l_suppkey"))).otherwise("-")
    short = [F.concat(F.lit("P"), s("l_partkey")), "md5", "300", db, F.concat(F.lit("S"), s("l_suppkey")), desc,
             "10", "120", s("l_discount"), "T", "01-01-2026"]
    full = tabbed(*short, F.concat(F.lit("IPR"), s("l_suppkey")), "-", "GO:1")
    long = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "R")
    hits = H.parse_interproscan(li.select(F.when(long, full).otherwise(tabbed(*short)).alias("value")))
    return hits.select("protein_id", "db", "name", "description", "ipr", "evalue")


@query("structure_hits", """
SELECT 'P' || l_partkey AS protein_id, 'T' || l_suppkey AS name, l_returnflag AS db, l_extendedprice AS score,
  l_discount AS evalue
FROM lineitem WHERE l_quantity / 50 >= 0.5 AND 1 - l_tax >= 0.95 AND l_discount <= 0.05""")
def structure_hits(spark, sf):
    li = source(spark, sf, "lineitem")
    line = tabbed(F.concat(F.lit("P"), s("l_partkey"), F.lit(".pdb_A")), F.concat(F.lit("T"), s("l_suppkey")), "0.3",
                  "150", s("l_discount"), s("l_extendedprice"), (1 - F.col("l_tax")).cast("string"),
                  "0.9", (F.col("l_quantity") / 50).cast("string"), "header", F.col("l_returnflag"))
    header = "#query\ttarget\tfident\talnlen\tevalue\tbits\tprob\talntmscore\tqtmscore\ttheader\ttarget_db"
    hits = H.parse_foldseek(li.select(line.alias("value")), header, evalue=0.05, prob=0.95, tm=0.5)
    return hits.select("protein_id", "name", "db", "score", "evalue")


# Lines of status F are files with a header, the others files of the layout without one.
@query("structure_hits_from_files", """
SELECT 'P' || l_partkey AS protein_id, 'T' || l_suppkey AS name, CASE WHEN l_linestatus = 'F' THEN l_returnflag ELSE 'foldseek' END AS db,
  l_extendedprice AS score, l_discount AS evalue FROM lineitem
WHERE CASE WHEN l_linestatus = 'F' THEN l_quantity / 50 ELSE l_linenumber / 8 END >= 0.5 AND 1 - l_tax >= 0.95 AND l_discount <= 0.05""")
def structure_hits_from_files(spark, sf):
    li = load(spark, sf, "lineitem")
    cells = {
        "query": F.concat(F.lit("P"), s("l_partkey"), F.lit(".pdb_A")), "target": F.concat(F.lit("T"), s("l_suppkey")), "fident": F.lit("0.3"),
        "alnlen": F.lit("150"), "evalue": s("l_discount"), "bits": s("l_extendedprice"), "prob": (1 - F.col("l_tax")).cast("string"),
        "alntmscore": (F.col("l_linenumber") / 8).cast("string"), "lddt": F.lit("0.8"), "theader": F.lit("header"),
    }
    named = [c.alias(n) for n, c in cells.items()]
    path = scratch(spark, "structures")
    qtm = (F.col("l_quantity") / 50).cast("string").alias("qtmscore")
    put_table(li.where("l_linestatus = 'F'").select(*named, qtm, F.col("l_returnflag").alias("target_db")), f"{path}/new")
    li.where("l_linestatus <> 'F'").select(*named).write.option("sep", "\t").option("quote", "").csv(f"{path}/old")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        hits = H.read_foldseek(spark, [f"{path}/new", f"{path}/old"], evalue=0.05, prob=0.95, tm=0.5)
    return hits.select("protein_id", "name", "db", "score", "evalue")


@query("profile_profile_hits", """
SELECT 'O' || l_orderkey AS protein_id, 'PF' || l_partkey AS name, 'Supplier ' || l_suppkey AS description,
  100 - l_quantity AS score FROM lineitem WHERE 100 - l_quantity >= 90""")
def profile_profile_hits(spark, sf):
    li = source(spark, sf, "lineitem")
    label = F.rpad(F.concat(F.lit("PF"), s("l_partkey"), F.lit(" Supplier "), s("l_suppkey")), 30, " ")
    line = F.concat(F.lpad(s("l_linenumber"), 3, " "), F.lit(" "), label, F.lit(" "),
                    F.lpad((100 - F.col("l_quantity")).cast("string"), 5, " "),
                    F.lit(" 1e-30 1e-30  100.0   0.0  150  10-160    5-155 (200)"))
    text = F.concat(F.lit("Query         O"), s("l_orderkey"), F.lit("\nMatch_columns 200\n\n No Hit\n"), line, F.lit("\n"))
    return H.parse_hhr(li.select(text.alias("value"))).select("protein_id", "name", "description", "score")


# ---------------------------------------------------------------- quant tables
@query("manifest_samples", """
SELECT o_orderstatus || '_' || substr(o_orderpriority, 1, 1) AS sample, o_orderstatus AS experiment,
  substr(o_orderpriority, 1, 1) AS bioreplicate, count(*) AS n_fractions, 'DDA' AS data_type
FROM orders GROUP BY ALL""")
def manifest_samples(spark, sf):
    orders = load(spark, sf, "orders")
    line = tabbed(F.concat(F.lit("D:\\runs\\"), s("o_orderkey"), F.lit(".mzML")), F.col("o_orderstatus"),
                  F.substring("o_orderpriority", 1, 1), "DDA")
    out = Q.collapse_fractions(Q.parse_manifest(orders.select(line.alias("value"))))
    return out.select("sample", "experiment", "bioreplicate", "n_fractions", "data_type")


@query("design_from_manifest", """
SELECT o_orderstatus || '_' || substr(o_orderpriority, 1, 1) AS sample, o_orderstatus AS "group", substr(o_orderpriority, 1, 1) AS bioreplicate
FROM orders GROUP BY ALL""")
def design_from_manifest(spark, sf):
    orders = load(spark, sf, "orders")
    line = tabbed(F.concat(F.lit("/runs/"), s("o_orderkey"), F.lit(".raw")), F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1), "DDA")
    path = scratch(spark, "manifest")
    orders.select(line.alias("value")).write.text(path)
    return Dg.design_from_manifest(Q.read_manifest(spark, path))


STATUS_COLUMNS = {"A Intensity": "A", "N Intensity": "N", "R Intensity": "R"}
WIDE_SQL = """
  CAST(coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0) AS DOUBLE) AS A,
  CAST(coalesce(sum(l_quantity) FILTER (l_returnflag = 'N'), 0) AS DOUBLE) AS N,
  CAST(coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS DOUBLE) AS R"""


def flag_sums() -> list[Column]:
    """A missing flag is written as 0, as search engines do."""
    return [F.coalesce(F.sum(F.when(F.col("l_returnflag") == v, F.col("l_quantity"))), F.lit(0.0)).alias(k)
            for k, v in STATUS_COLUMNS.items()]


LONG_SQL = "UNPIVOT (value FOR sample IN (A, N, R))"


@query("peptide_table_values", f"""WITH w AS (SELECT 'PEP' || l_orderkey AS feature_id, {WIDE_SQL}
  FROM lineitem GROUP BY l_orderkey)
SELECT feature_id, sample, value FROM (FROM w {LONG_SQL}) WHERE value <> 0""")
def peptide_table_values(spark, sf):
    li = source(spark, sf, "lineitem")
    wide = li.groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("razor"), F.array_join(F.array_sort(F.collect_set(
            F.concat(F.lit("P"), s("l_partkey")))), ";").alias("mapped"), *flag_sums())
    table = wide.select(
        F.concat(F.lit("PEP"), s("l_orderkey")).alias("Peptide Sequence"),
        F.concat(F.lit("P"), s("razor")).alias("Protein"),
        F.concat(F.lit("P"), s("razor"), F.lit(" hypothetical protein")).alias("Protein ID"),
        F.col("mapped").alias("Mapped Proteins"), *STATUS_COLUMNS)
    path = put_table(table, scratch(spark, "combined_peptide"))
    return Q.read_fragpipe_features(spark, path, "peptide").values


@query("ion_table_candidates", """
SELECT l_orderkey || '_' || l_returnflag || '_2' AS feature_id, 'P' || min(l_partkey) AS razor,
  count(DISTINCT l_partkey) AS n_candidates FROM lineitem GROUP BY l_orderkey, l_returnflag""")
def ion_table_candidates(spark, sf):
    li = source(spark, sf, "lineitem")
    wide = li.groupBy("l_orderkey", "l_returnflag").agg(
        F.min("l_partkey").alias("razor"), F.array_join(F.array_sort(F.collect_set(
            F.concat(F.lit("P"), s("l_partkey"), F.lit(" text")))), ";").alias("mapped"),
        F.sum("l_quantity").alias("S1 Intensity"))
    table = wide.select(
        F.concat_ws("_", s("l_orderkey"), "l_returnflag").alias("Modified Sequence"),
        s("l_orderkey").alias("Peptide Sequence"), F.lit("2").alias("Charge"),
        F.concat(F.lit("P"), s("razor")).alias("Protein"), F.col("mapped").alias("Mapped Proteins"), "S1 Intensity")
    path = put_table(table, scratch(spark, "combined_ion"))
    out = Q.read_fragpipe_features(spark, path, "ion").features
    return out.select("feature_id", "razor", F.size("candidates").cast("long").alias("n_candidates"))


@query("peptides_without_intensities", """
SELECT 'PEP' || l_orderkey AS peptide, 'P' || min(l_partkey) AS razor, count(DISTINCT l_partkey) AS n_candidates
FROM lineitem GROUP BY l_orderkey""")
def peptides_without_intensities(spark, sf):
    li = source(spark, sf, "lineitem")
    table = li.groupBy("l_orderkey").agg(
        F.concat(F.lit("P"), F.min("l_partkey").cast("string")).alias("Protein"),
        F.array_join(F.collect_set(F.concat(F.lit("P"), s("l_partkey"))), ";").alias("Mapped Proteins"),
    ).select(F.concat(F.lit("PEP"), s("l_orderkey")).alias("Peptide Sequence"), "Protein", "Mapped Proteins")
    path = put_table(table, scratch(spark, "peptides"))
    out = Q.peptide_features(spark, path, "auto")
    return out.select("peptide", "razor", F.size("candidates").cast("long").alias("n_candidates"))


@query("protein_matrix_values", f"""WITH w AS (SELECT 'P' || l_partkey AS group_id, {WIDE_SQL}
  FROM lineitem GROUP BY l_partkey)
SELECT group_id, sample, value FROM (FROM w {LONG_SQL}) WHERE value <> 0""")
def protein_matrix_values(spark, sf):
    li = source(spark, sf, "lineitem")
    table = li.groupBy(F.concat(F.lit("P"), s("l_partkey")).alias("Protein")).agg(
        F.lit("true").alias("Is Decoy"), F.min("l_suppkey").alias("Protein Length"), *flag_sums())
    path = put_table(table, scratch(spark, "combined_protein"))
    return Q.read_protein_matrix(spark, path, "fragpipe").values


@query("protein_group_matrix_values", f"""WITH w AS (SELECT 'P' || l_partkey AS group_id, {WIDE_SQL}
  FROM lineitem GROUP BY l_partkey)
SELECT group_id, sample, value FROM (FROM w {LONG_SQL}) WHERE value <> 0""")
def protein_group_matrix_values(spark, sf):
    li = source(spark, sf, "lineitem")
    table = li.groupBy(F.concat(F.lit("P"), s("l_partkey")).alias("Protein.Group")).agg(
        F.lit("x").alias("Genes"), *[c.alias(v) for c, v in zip(flag_sums(), STATUS_COLUMNS.values())])
    path = put_table(table, scratch(spark, "pg_matrix"))
    return Q.read_protein_matrix(spark, path, "diann", regex="^[ANR]$").values


@query("long_feature_table", """
SELECT l_orderkey || '_2__' AS feature_id, min('P' || l_partkey) AS razor, count(DISTINCT l_returnflag) AS n_samples,
  round(sum(l_extendedprice), 2) AS total
FROM lineitem GROUP BY l_orderkey""")
def long_feature_table(spark, sf):
    li = source(spark, sf, "lineitem")
    table = li.select(
        F.concat(F.lit("P"), s("l_partkey")).alias("ProteinName"), s("l_orderkey").alias("PeptideSequence"),
        F.lit("2").alias("PrecursorCharge"), F.lit("NA").alias("FragmentIon"), F.lit("NA").alias("ProductCharge"),
        F.col("l_linestatus").alias("Condition"), F.col("l_returnflag").alias("Run"),
        F.col("l_returnflag").alias("BioReplicate"), F.col("l_extendedprice").alias("Intensity"))
    path = put_table(table, scratch(spark, "msstats"), ",")
    q = Q.read_msstats_csv(spark, path)
    sums = q.values.groupBy("feature_id").agg(
        F.count("*").alias("n_samples"), F.round(F.sum("value"), 2).alias("total"))
    return q.features.join(sums, "feature_id").select("feature_id", "razor", "n_samples", "total")


@query("processed_feature_table", """
SELECT CAST(l_orderkey AS VARCHAR) AS feature_id, l_returnflag AS sample, round(sum(l_extendedprice), 2) AS value
FROM lineitem GROUP BY ALL""")
def processed_feature_table(spark, sf):
    li = source(spark, sf, "lineitem")
    table = li.select(
        F.concat(F.lit("P"), s("l_partkey")).alias("PROTEIN"), s("l_orderkey").alias("PEPTIDE"),
        s("l_orderkey").alias("FEATURE"), F.col("l_returnflag").alias("RUN"),
        F.col("l_linestatus").alias("GROUP_ORIGINAL"), F.col("l_linestatus").alias("SUBJECT_ORIGINAL"),
        F.col("l_extendedprice").alias("INTENSITY"))
    q = Q.read_msstats_feature(spark, put_table(table, scratch(spark, "feature_level")))
    return q.values.select("feature_id", "sample", F.round("value", 2).alias("value"))


@query("processed_protein_table", """
SELECT 'P' || l_partkey AS group_id, l_returnflag AS sample, round(sum(l_quantity), 6) AS value
FROM lineitem GROUP BY ALL""")
def processed_protein_table(spark, sf):
    li = source(spark, sf, "lineitem")
    table = li.groupBy("l_partkey", "l_returnflag").agg(F.log2(F.sum("l_quantity")).alias("LogIntensities")).select(
        F.concat(F.lit("P"), s("l_partkey")).alias("Protein"), F.col("l_returnflag").alias("originalRUN"),
        F.lit("g").alias("GROUP_ORIGINAL"), F.lit("s").alias("SUBJECT_ORIGINAL"), "LogIntensities")
    q = Q.read_msstats_protein(spark, put_table(table, scratch(spark, "protein_level")))
    return q.values.select("group_id", "sample", F.round("value", 6).alias("value"))


def plex_run(spark, sf) -> X.PlexRun:
    """Three plex folders written from lineitem: flag = plex, status = channel."""
    li = source(spark, sf, "lineitem").where("l_returnflag IS NOT NULL")
    root = scratch(spark, "run")
    channels = {"F": "126", "O": "127N"}
    for i, flag in enumerate(("A", "N", "R"), 1):
        rows = li.where(F.col("l_returnflag") == flag).groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("razor"),
            F.array_join(F.collect_set(F.concat(F.lit("P"), s("l_partkey"))), ",").alias("mapped"),
            *[F.coalesce(F.sum(F.when(F.col("l_linestatus") == st, F.col("l_quantity"))), F.lit(0.0)).alias(
                f"Intensity {flag}{st}") for st in channels])
        pep = s("l_orderkey")
        table = rows.select(
            pep.alias("Peptide Sequence"), F.concat(F.lit("n"), pep).alias("Modified Sequence"),
            F.lit("2").alias("Charge"), F.concat(F.lit("P"), s("razor")).alias("Protein"),
            F.col("mapped").alias("Mapped Proteins"), F.lit("9").alias("Intensity"),
            *[f"Intensity {flag}{st}" for st in channels])
        put_table(table, f"{root}/TMT{i}/ion.tsv")
        psm = li.where(F.col("l_returnflag") == flag).select(
            pep.alias("Peptide"), F.concat(F.lit("n"), pep).alias("Modified Peptide"), F.lit("2").alias("Charge"),
            (1 - F.col("l_tax")).alias("Purity"))
        put_table(psm, f"{root}/TMT{i}/psm.tsv")
        lines = [(f"{ch} {flag}{st}",) for st, ch in channels.items()]
        spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{root}/TMT{i}/TMT{i}_annotation.txt")
    return X.read_plexes(spark, root, with_purity=True)


@query("plex_tables", """
SELECT 'TMT' || CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS plex,
  l_orderkey || '_n' || l_orderkey || '_2' AS feature_id, l_returnflag || l_linestatus AS sample,
  sum(l_quantity) AS value
FROM lineitem GROUP BY ALL""")
def plex_tables(spark, sf):
    return plex_run(spark, sf).values.select("plex", "feature_id", "sample", "value")


# The channel of status F is the reference of its plex, and the condition is the last letter of a name.
@query("design_from_plexes", """
SELECT DISTINCT l_returnflag || l_linestatus AS sample, 'TMT' || CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS plex,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS plex_order, l_linestatus AS "group"
FROM lineitem WHERE l_linestatus <> 'F'""")
def design_from_plexes(spark, sf):
    channels = X.resolve_reference(plex_run(spark, sf).design, name="*F")
    return Dg.design_from_plexes(channels, "([A-Z])$")


@query("plex_features_united", """
SELECT l_orderkey || '_n' || l_orderkey || '_2' AS feature_id, count(DISTINCT l_partkey) AS n_candidates
FROM lineitem GROUP BY l_orderkey""")
def plex_features_united(spark, sf):
    run = plex_run(spark, sf)
    return run.candidates.groupBy("feature_id").agg(F.count("*").alias("n_candidates"))


@query("spectrum_purity", """
SELECT 'TMT' || CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS plex,
  l_orderkey || '_n' || l_orderkey || '_2' AS feature_id, count(*) AS n_psms, round(avg(1 - l_tax), 6) AS mean_purity
FROM lineitem GROUP BY ALL""")
def spectrum_purity(spark, sf):
    psms = plex_run(spark, sf).psms
    return psms.groupBy("plex", "feature_id").agg(
        F.count("*").alias("n_psms"), F.round(F.avg("purity"), 6).alias("mean_purity"))


# ---------------------------------------------------------------- taxonomy and metadata
@query("peptide_lca_table", """
SELECT upper(regexp_replace(c_name, '[^A-Za-z]', '', 'g')) || chr(65 + CAST(c_nationkey AS INTEGER)) AS peptide,
  CAST(c_custkey AS VARCHAR) AS taxon_id, 'species' AS taxon_rank, CAST(n_regionkey AS VARCHAR) AS domain_id,
  CAST(c_nationkey AS VARCHAR) AS genus_id, CASE WHEN c_acctbal > 0 THEN CAST(c_custkey AS VARCHAR) END AS species_id
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def peptide_lca_table(spark, sf):
    c = load(spark, sf, "customer").join(F.broadcast(load(spark, sf, "nation")),
                                         F.col("c_nationkey") == F.col("n_nationkey"))
    table = c.select(
        F.concat("c_name", F.lit("["), F.char(F.lit(65) + F.col("c_nationkey")), F.lit("]")).alias("peptide"),
        s("c_custkey").alias("taxon_id"), F.lit("name").alias("taxon_name"), F.lit("species").alias("taxon_rank"),
        s("n_regionkey").alias("superkingdom_id"), F.lit("Bacteroides").alias("genus"), s("c_nationkey").alias("genus_id"),
        F.when(F.col("c_acctbal") > 0, s("c_custkey")).otherwise("").alias("species_id"))
    lca = N.read_peptide_lca(spark, put_table(table, scratch(spark, "pept2lca"), ","))
    return lca.select("peptide", "taxon_id", "taxon_rank", "domain_id", "genus_id", "species_id")


@query("taxonomy_dump", """
SELECT 'C' || c_custkey AS taxid, 'N' || c_nationkey AS parent, 'species' AS rank, c_name AS name FROM customer""")
def taxonomy_dump(spark, sf):
    c = load(spark, sf, "customer")
    bar = lambda *cells: F.concat(F.concat_ws("\t|\t", *cells), F.lit("\t|"))
    taxid = F.concat(F.lit("C"), s("c_custkey"))
    nodes = N.parse_nodes(c.select(bar(taxid, F.concat(F.lit("N"), s("c_nationkey")), F.lit("species")).alias("value")))
    sci = c.select(bar(taxid, F.col("c_name"), F.lit(""), F.lit("scientific name")).alias("value"))
    syn = c.select(bar(taxid, F.lit("other"), F.lit(""), F.lit("synonym")).alias("value"))
    return nodes.join(N.parse_names(sci.unionByName(syn)), "taxid")


@query("sample_metadata", """
SELECT s_name AS sample, CAST(s_nationkey AS VARCHAR) AS "group" FROM supplier""")
def sample_metadata(spark, sf):
    sup = load(spark, sf, "supplier")
    table = sup.select(F.col("s_name").alias("id"), s("s_nationkey").alias("group"))
    meta = Q.read_metadata(spark, put_table(table, scratch(spark, "metadata")), "id")
    return Q.apply_metadata(sup.select(F.col("s_name").alias("sample")), meta, ["group"])


@query("samples_without_metadata", """
SELECT s_name AS sample FROM supplier WHERE s_acctbal <= 0""")
def samples_without_metadata(spark, sf):
    sup = load(spark, sf, "supplier").withColumn("sample", F.col("s_name"))
    return Q.missing_metadata(sup, sup.where("s_acctbal > 0"))
