"""Writers of small input files for the tests."""

from umbra.sources.proteins import EGGNOG_COLUMNS


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def eggnog_text(rows, header=True):
    """rows: {id: {column: cell}}."""
    out = ["## annotation run"]
    if header:
        out.append("#" + "\t".join(EGGNOG_COLUMNS))
    for pid, cells in rows.items():
        full = {c: "-" for c in EGGNOG_COLUMNS}
        full.update({"query": pid, **cells})
        out.append("\t".join(full[c] for c in EGGNOG_COLUMNS))
    return "\n".join(out) + "\n"


def tblout_line(target, name, acc="-", desc="-", evalue="1e-30", score="100.0"):
    full, best = [evalue, score, "1.5"], [evalue, score, "1.2"]
    counts = ["1.3", "2", "1", "0", "2", "1", "1", "1"]  # expected, regions, clusters, ... domains
    return " ".join([target, "-", name, acc, *full, *best, *counts, desc])


def domtblout_line(target, name, qlen, start, end, evalue="1e-20"):
    sequence, domain = ["4e-18", "66.2", "0.7"], ["2", "3", evalue, evalue, "58.1", "0.4"]
    spans = [str(start), str(end), "31", "154", "27", "160"]
    return " ".join([target, "-", "214", name, "-", str(qlen), *sequence, *domain, *spans, "0.88", "-"])


def diamond_line(pid, target, ident, title, evalue="1e-40", score="300.0", qcov="90"):
    return "\t".join([pid, target, str(ident), "212", evalue, score, qcov, "74", title])


def foldseek_line(pid, target, desc, db, bits="400", evalue="1e-20", prob="0.99", tm="0.8"):
    return "\t".join([pid, target, "0.41", "143", evalue, bits, prob, tm, "0.7", desc, db])


def kofam_line(pid, ko, text, flag="*"):
    return "\t".join([flag, pid, ko, "132.5", "171.3", "3e-44", f'"{text}"'])


def interpro_line(pid, analysis, signature, desc, ipr="-", ipr_desc="-", go="-"):
    return "\t".join([pid, "0f3c", "188", analysis, signature, desc, "22", "97", "6.2E-15", "T",
                      "14-03-2025", ipr, ipr_desc, go])


# One protein for each way into a bin: id -> (annotation cells, its bin on this table alone)
PROTEINS = {
    "amylase": ({"KEGG_ko": "ko:K07405", "KEGG_Pathway": "map00500", "seed_ortholog": "1423.x1"}, "1_ko_pathway"),
    "two_kos": ({"KEGG_ko": "ko:K00850,ko:K16370", "KEGG_Pathway": "ko00030,ko01100", "CAZy": "GT5",
                 "seed_ortholog": "1423.x2"}, "1_ko_pathway"),
    "overview_map": ({"KEGG_ko": "ko:K00134", "KEGG_Pathway": "map01200"}, "2_ko_orphan"),
    "lone_ko": ({"KEGG_ko": "ko:K21471", "PFAMs": "NlpC_P60"}, "2_ko_orphan"),
    "domains": ({"PFAMs": "Peptidase_M23,SLH", "seed_ortholog": "562.y1"}, "3_annotated_no_ko"),
    "esterase": ({"CAZy": "CE4"}, "3_annotated_no_ko"),
    "duf": ({"PFAMs": "DUF2268", "seed_ortholog": "562.y2"}, "3d_duf_only"),
    "duf_and_upf": ({"PFAMs": "UPF0236,DUF4349"}, "3d_duf_only"),
    "seed_only": ({"seed_ortholog": "287.z1"}, "4_dark"),
    "unlisted_a": (None, "4_dark"),
    "unlisted_b": (None, "4_dark"),
}


def protein_rows(ids=None):
    return [(p, "", "MKL" * 50, 150) for p in (ids or PROTEINS)]


PROTEIN_SCHEMA = "protein_id string, description string, seq string, length int"
