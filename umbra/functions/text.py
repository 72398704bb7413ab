"""Column functions over identifiers, descriptions and sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A description that matches names a family, not a function.
UNINFORMATIVE_PATTERNS = (
    r"^DUF\d",
    r"^UPF\d",
    r"unknown function",
    r"uncharacteri",
    r"hypothetical",
    r"family not named",
    r"predicted protein",
    r"putative protein",
)
# KEGG global (011xx) and overview (012xx) maps.
GLOBAL_MAP_PATTERN = r"^(?:map|ko)?01[12]\d{2}$"
# Namespaces of decoys, contaminants and control sequences.
DECOY_PREFIXES = ("rev_", "CON__", "contam_")
CONTROL_PREFIXES = ("rev_", "CON__", "contam_", "ent_", "HUMANHOST_")
# Description patterns of toxin-like folds.
TOXIN_FOLD_PATTERNS = (
    "aerolysin",
    "CdiA",
    "contact-dependent",
    "holotoxin",
    "LXG",
    r"Ntox\d*",
    "nuclease toxin",
    "Rhs",
    "RTX",
    "Tc toxin",
    "zeta toxin",
)
# Pfam families that anchor a protein in the cell wall.
ANCHOR_PFAMS = ("PF00746", "PF00395")
# InterProScan analyses that describe shape only.
STRUCTURAL_ANALYSES = ("MobiDBLite", "Coils", "TMHMM", "Phobius", "SignalP")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str, empty: Sequence[str] = ("", "-")) -> Column:
    """Trimmed text, with the tool's empty marks read as missing."""
    t = F.trim(col(c))
    return F.when(~t.isin(*empty), t)


def first_token(c: Column | str) -> Column:
    """The text up to the first whitespace."""
    return F.regexp_extract(F.ltrim(col(c)), r"^(\S*)", 1)


def has_more_tokens(c: Column | str) -> Column:
    return F.trim(col(c)).rlike(r"\s")


def starts_with_any(c: Column | str, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.coalesce(F.startswith(col(c), F.lit(p)), F.lit(False))
    return out


def is_informative(
    desc: Column | str,
    patterns: Sequence[str] = UNINFORMATIVE_PATTERNS,
    empty: bool = False,
) -> Column:
    """Whether a description says something; `empty` is the answer for no description."""
    d = F.trim(col(desc))
    named = ~d.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))
    return F.when(d.isNull() | d.isin("", "-"), F.lit(empty)).otherwise(named)


def is_global_pathway(c: Column | str, pattern: str = GLOBAL_MAP_PATTERN) -> Column:
    return col(c).rlike(pattern)


def specific_pathways(paths: Column | str, pattern: str = GLOBAL_MAP_PATTERN) -> Column:
    """Pathway ids without the global and overview maps."""
    return F.filter(col(paths), lambda p: ~p.rlike(pattern))


def sortase_motif(seq: Column | str, stretch: int = 15, within: int = 40, tail: int = 8) -> Column:
    """LPxTG followed by a hydrophobic stretch and a charged tail."""
    s = F.upper(col(seq))
    gap = within - stretch
    body = s.rlike(rf"LP[A-Z]TG[A-Z]{{0,{gap}}}[ACFGILMPVW]{{{stretch}}}")
    charged = F.length(F.regexp_replace(F.right(s, F.lit(tail)), "[^KR]", "")) >= 2
    return F.coalesce(body & charged, F.lit(False))


def toxin_fold(desc: Column | str, patterns: Sequence[str] = TOXIN_FOLD_PATTERNS) -> Column:
    """Whether any pattern occurs as a whole word."""
    found = col(desc).rlike(r"(?i)\b(?:" + "|".join(patterns) + r")\b")
    return F.coalesce(found, F.lit(False))


def interpro_informative(
    analysis: Column | str,
    desc: Column | str,
    structural: Sequence[str] = STRUCTURAL_ANALYSES,
) -> Column:
    """A described match of an analysis that is not structural; prefixes are compared."""
    return ~starts_with_any(analysis, structural) & is_informative(desc)


def id_tier(c: Column | str, delimiters: str = "_|:.") -> Column:
    """Text through the first delimiter, or missing when there is none."""
    cls = "".join("\\" + d for d in delimiters)
    tag = F.regexp_extract(col(c), rf"^([^{cls}]*[{cls}])", 1)
    return F.when(tag != "", tag)


def id_key_shape(c: Column | str, delimiters: str = "_|:.") -> Column:
    """The identifier behind its tier tag with every run of digits masked."""
    cls = "".join("\\" + d for d in delimiters)
    rest = F.regexp_replace(col(c), rf"^[^{cls}]*[{cls}]", "")
    return F.regexp_replace(rest, r"\d+", "#")


def strip_version(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"\.\d+$", "")


def split_list(c: Column | str, sep: str = ",") -> Column:
    """A delimited cell as a sorted set; an empty cell is an empty array."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), sep), lambda x: F.trim(x))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda x: ~x.isin("", "-"))))


def strip_ko_prefix(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"^ko:", "")


def ko_list(c: Column | str) -> Column:
    """`ko:K1,ko:K2` as a sorted set of bare ids."""
    return F.array_sort(F.array_distinct(F.transform(split_list(c), strip_ko_prefix)))


def member_accessions(signatures: Column | str, library: str) -> Column:
    """Accessions of one member library in a list of `Library:accession` entries."""
    tag = library + ":"
    mine = F.filter(col(signatures), lambda s: F.startswith(s, F.lit(tag)))
    return F.array_sort(
        F.array_distinct(F.transform(mine, lambda s: F.substring(s, F.lit(len(tag) + 1), F.char_length(s))))
    )


def seed_taxid(c: Column | str) -> Column:
    """The taxid in front of the first dot of a seed ortholog."""
    t = F.substring_index(col(c), ".", 1)
    return F.when(t.rlike(r"^\d+$"), t)


def vfdb_category(title: Column | str) -> Column:
    """The category code in parentheses of a VFDB title."""
    code = F.regexp_extract(col(title), r"\((VFC\d+)\)", 1)
    return F.when(code != "", code)


def basename(path: Column | str) -> Column:
    """File name without folders of either slash kind and without its extension."""
    name = F.regexp_extract(col(path), r"([^/\\]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def feature_key(*parts: Column | str) -> Column:
    """Joined columns, with one slot per column even when a value is missing."""
    return F.concat_ws("_", *[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts])


def peptide_normalise(c: Column | str) -> Column:
    """Letters only, upper case."""
    return F.upper(F.regexp_replace(col(c), "[^A-Za-z]", ""))


def name_normalise(c: Column | str) -> Column:
    """A level name made safe for a formula: invalid characters become dots."""
    s = F.regexp_replace(col(c), r"[^A-Za-z0-9._]", ".")
    return F.when(s.rlike(r"^(?:[A-Za-z]|\.(?!\d))"), s).otherwise(F.concat(F.lit("X"), s))


def lineage_at_rank(lineage: Column | str, rank: str) -> Column:
    return F.element_at(col(lineage), F.lit(rank))


def natural_key(c: Column | str) -> list[Column]:
    """Sort key that puts `TMT10` after `TMT9`."""
    c = col(c)
    return [
        F.regexp_extract(c, r"^(.*?)\d*$", 1),
        F.regexp_extract(c, r"(\d*)$", 1).try_cast("long"),
        c,
    ]
