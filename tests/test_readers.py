"""Readers: formats, malformed rows, encodings."""

import gzip

import pytest
from makers import (diamond_line, domtblout_line, eggnog_text, foldseek_line, interpro_line,
                    kofam_line, put, tblout_line)

from umbra.errors import InputError
from umbra.sources import hits as H
from umbra.sources import proteins as P
from umbra.sources.lines import read_lines


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_fasta_ids_duplicates_and_multiline_records(spark, tmp_path):
    path = put(tmp_path / "p.faa", ">P1 first > one\nMKV\nAA\n>P1\nMKAAA\n>P2\nMKW\n")
    got = {r["protein_id"]: r for r in P.read_fasta(spark, path).collect()}
    assert set(got) == {"P1", "P2"}
    assert got["P1"]["seq"] == "MKVAA" and got["P1"]["length"] == 5
    assert got["P1"]["description"] == "first > one" and got["P1"]["n_duplicates"] == 1


def test_fasta_empty_identifier_is_refused(spark, tmp_path):
    path = put(tmp_path / "p.faa", ">good\nMKV\n>\nMKA\n")
    with pytest.raises(Exception, match="empty identifier"):
        P.read_fasta(spark, path).collect()


def test_fasta_bad_byte_costs_one_character(spark, tmp_path):
    (tmp_path / "p.faa").write_bytes(b">P1 desc\xa0here\nMKVAA\n")
    r = P.read_fasta(spark, str(tmp_path / "p.faa")).collect()
    assert [(x["protein_id"], x["seq"]) for x in r] == [("P1", "MKVAA")]


def test_eggnog_dashes_aliases_and_gzip(spark, tmp_path):
    path = put(tmp_path / "e", eggnog_text({"P1": {"KEGG_ko": "ko:K1,ko:K2", "seed_ortholog": "820.X"}}))
    r = P.typed_eggnog(P.read_eggnog(spark, path)).first()
    assert (r["ko"], r["pathway"], r["eggnog_taxid"]) == (["K1", "K2"], [], "820")
    old = put(tmp_path / "old", "#query_name\tseed_eggNOG_ortholog\tCOG Functional cat."
              "\teggNOG free text desc.\nP1\t820.ABC\tS\tsomething\n")
    r = P.read_eggnog(spark, old).first()
    assert (r["seed_ortholog"], r["COG_category"], r["Description"]) == ("820.ABC", "S", "something")
    with gzip.open(tmp_path / "c.gz", "wb") as fh:
        fh.write("#query\tseed_ortholog\tDescription\nP1\t820.S\tβ-glucosidase\n".encode())
    assert P.read_eggnog(spark, str(tmp_path / "c.gz")).first()["Description"] == "β-glucosidase"


def test_eggnog_without_header_fails_and_empty_is_empty(spark, tmp_path):
    with pytest.raises(InputError, match="#query"):
        P.read_eggnog(spark, put(tmp_path / "bad", "P1\t820.A\n"))
    assert P.read_eggnog(spark, put(tmp_path / "none", "## only a comment\n")).count() == 0


def test_tblout_malformed_rows_and_descriptions(spark, tmp_path):
    text = "\n".join([
        "# comment", tblout_line("t1", "q1", "PF00082.1", "Uncharacterized protein"),
        tblout_line("t3", "q3"), "t2 - q2 - 1e-5 10.0 0.0",
        tblout_line("bad", "q", evalue="not-a-number"), "short -"]) + "\r\n"
    df = H.parse_tblout(read_lines(spark, put(tmp_path / "t", text)))
    assert rows(df, "protein_id", "name") == [("t1", "q1"), ("t2", "q2"), ("t3", "q3")]
    got = {r["protein_id"]: r["description"] for r in df.collect()}
    assert got == {"t1": "Uncharacterized protein", "t2": None, "t3": None}


def test_iterative_search_is_keyed_on_the_query(spark, tmp_path):
    text = tblout_line("UniRef50_A", "P1") + "\n" + tblout_line("P2", "P2") + "\n"
    df = H.by_query(H.parse_tblout(read_lines(spark, put(tmp_path / "j", text)), "jackhmmer"))
    assert rows(df, "protein_id", "name") == [("P1", "UniRef50_A")]


def test_domains_are_filtered_and_the_suffix_removed(spark, tmp_path):
    text = "\n".join([domtblout_line("P1", "GH13.hmm", 100, 1, 90),
                      domtblout_line("P2", "GH5.hmm", 100, 1, 20),
                      domtblout_line("P3", "GH5.hmm", 100, 1, 90, "1e-3")])
    df = H.parse_domtblout(read_lines(spark, put(tmp_path / "d", text)))
    assert rows(df, "protein_id", "name") == [("P1", "GH13")]


def test_diamond_layout_thresholds_and_tags(spark, tmp_path):
    put(tmp_path / "dia" / "vfdb.tsv", "\n".join([
        diamond_line("P1", "VFG1", 95.0, "hemolysin"), diamond_line("P2", "VFG2", 31.0, "x"),
        "\t".join(["P3", "VFG1", "88.0", "150", "2", "0", "1", "150", "1", "150", "1e-40", "300"])]))
    put(tmp_path / "dia" / "merops.tsv", diamond_line("P2", "MER1", 31.0, "protease"))
    df = H.read_diamond(spark, str(tmp_path / "dia"), min_idents={"vfdb": 50})
    assert rows(df, "protein_id", "db") == [("P1", "vfdb"), ("P2", "merops")]
    with pytest.raises(ValueError, match="must be a number"):
        H.read_diamond(spark, str(tmp_path / "dia"), min_idents={"vfdb": "half"})


def test_unparsable_file_warns_and_empty_file_does_not(spark, tmp_path, recwarn):
    with pytest.warns(UserWarning, match="parsed 0 HMM hits"):
        H.read_hits(spark, put(tmp_path / "x", "this is no table\n"), H.parse_tblout, "HMM hits")
    recwarn.clear()
    H.read_hits(spark, put(tmp_path / "y", ""), H.parse_tblout, "HMM hits")
    assert H.read_hits(spark, str(tmp_path / "absent"), H.parse_tblout, "HMM hits").count() == 0
    assert not [w for w in recwarn if "parsed 0" in str(w.message)]


@pytest.mark.parametrize("text", ["", "# header\n", "P1\t-\tFam\n", "P1\t-\tF\t1\n\nP3\t\t\t\n",
                                  "\x00\x01 not text\n"])
@pytest.mark.parametrize("parse", [
    H.parse_tblout, H.parse_kofam, H.parse_interproscan, H.parse_domtblout, H.parse_diamond,
    H.parse_foldseek, P.parse_clusters, P.parse_signalp, P.parse_gff])
def test_every_parser_survives_malformed_input(spark, parse, text):
    lines = spark.createDataFrame([(x,) for x in text.split("\n")], "value string")
    assert parse(lines).collect() is not None


def test_kofam_interpro_signalp_tmbed_clusters(spark, tmp_path):
    k = H.parse_kofam(read_lines(spark, put(tmp_path / "k", kofam_line("P1", "K1", "alcohol dh") + "\n"
                                            + kofam_line("P2", "K2", "low", " ") + "\n")))
    assert rows(k, "protein_id", "name", "description") == [("P1", "K1", "alcohol dh")]
    short = "\t".join("P1 md5 300 Pfam PF1 Peptidase 10 120 1e-20 T 01".split())
    i = H.parse_interproscan(read_lines(spark, put(tmp_path / "i", short + "\n" + interpro_line(
        "P2", "Gene3D", "G3", "fold", "IPR1", "domain", "GO:1"))))
    assert rows(i, "protein_id", "db", "ipr") == [("P1", "Pfam", None), ("P2", "Gene3D", "IPR1")]
    s = P.read_signalp(spark, put(tmp_path / "s", "# x\nP1\tPILIN\t0\t1\t\n"))
    assert rows(s, "protein_id", "sp_class") == [("P1", "PILIN")]
    t = P.read_tmbed(spark, put(tmp_path / "t", ">P1\nAAAAAAAAAAAAA\niiHHHHhhhhiii\n>P2 d\nAA\niBBBbbbi\n"))
    assert rows(t, "protein_id", "n_tmh", "n_tmb") == [("P1", 2, 0), ("P2", 0, 2)]
    c = P.read_clusters(spark, put(tmp_path / "c", "R\tR\nR\tM\n"))
    assert rows(c, "protein_id", "family_id") == [("M", "R"), ("R", "R")]


def test_foldseek_priority_suffix_and_gate(spark, tmp_path):
    text = "\n".join([foldseek_line("P1.pdb_A", "AF-1", "AF-1", "afdb50", bits="900"),
                      foldseek_line("P1.pdb_A", "sp|X", "aerolysin toxin", "swissprot"),
                      foldseek_line("P2", "T", "x", "pdb", tm="0.2")])
    df = H.parse_foldseek(read_lines(spark, put(tmp_path / "f", text)))
    assert rows(H.best_hit(df, ["protein_id"]), "protein_id", "name") == [("P1", "AF-1")]
    best = H.best_hit(df, ["protein_id"], ["swissprot", "afdb50"])
    assert rows(best, "protein_id", "name") == [("P1", "sp|X")]
    assert H.is_legacy_foldseek(None)


def test_hhr_name_that_fills_its_column(spark, tmp_path):
    def line(i, name, prob):
        return f"{i:3d} {name:<30.30s} {prob:5.1f} 1e-30 1e-30  100.0   0.0  150  10-160    5-155 (200)"
    text = "\n".join(["Query         P1", "Match_columns 200", "",
                      " No Hit                             Prob E-value P-value  Score",
                      line(1, "A" * 30, 100.0), line(2, "PF00082.20 Peptidase S8", 99.0),
                      line(3, "PF1 low", 20.0), ""])
    df = H.read_hhr(spark, put(tmp_path / "P1.hhr", text))
    assert rows(df, "protein_id", "name", "score") == [
        ("P1", "A" * 30, 100.0), ("P1", "PF00082.20", 99.0)]
    assert rows(H.best_hit(df, ["protein_id"]), "name") == [("A" * 30,)]


def test_profile_library_and_gff_and_context_and_failures(spark, tmp_path):
    lib = P.read_hmm_library(spark, put(tmp_path / "lib", "HMMER3/f\nNAME  T1\nACC   NF1\nDESC  ribosomal\n"
                                        "LENG  1\n//\nHMMER3/f\nNAME  T2\nDESC  hypothetical protein\n//\n"))
    got = {r["name"]: (r["accession"], r["description"]) for r in lib.collect()}
    assert got == {"T1": ("NF1", "ribosomal"), "T2": (None, "hypothetical protein")}
    g = P.read_gff(spark, put(tmp_path / "g", "##gff\nc1\tx\tCDS\t10\t90\t.\t+\t0\tID=P1;n=1\n"
                              "c1\tx\tgene\t10\t90\t.\t+\t0\tID=g\n"))
    assert rows(g, "contig", "start", "end", "protein_id") == [("c1", 10, 90, "P1")]
    c = P.read_context(spark, put(tmp_path / "c", "protein_id\tn_cazymes_in_window\tprophage\tpul\n"
                                  "P1\t1\tTrue\tFalse\n"))
    assert c.first()["context_flags"] == ["prophage"] and c.first()["n_cazymes_in_window"] == 1
    f = P.read_failures(spark, put(tmp_path / "f", "protein_id\tlength\terror\n"))
    assert f is not None and f.count() == 0
    assert P.read_failures(spark, str(tmp_path / "nope")) is None


def test_files_with_other_column_orders_are_read_by_name(spark, tmp_path):
    from umbra.sources.lines import read_delimited

    put(tmp_path / "d" / "a.tsv", "x\ty\n1\t2\n")
    put(tmp_path / "d" / "b.tsv", "y\tx\tz\n20\t10\t30\n")
    df, names = read_delimited(spark, str(tmp_path / "d"))
    assert names == ["x", "y", "z"]
    assert sorted(map(tuple, df.select("x", "y", "z").collect())) == [("1", "2", None), ("10", "20", "30")]
