"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are the base patterns and, beyond them, long random-looking tokens. The hash
of each candidate's value is counted by distinct repositories and owners, over distinct
texts: copies of a text are one, of its smallest owner and repository, so that a document
copied to a second place takes no owner with it. A value of more than `max_owners` owners
or more than `max_repositories` repositories is a widely copied example; one of fewer,
and random-looking, is taken for a live credential. Such tokens outside the base spans are
added as `live`.

Counts start from (hash, text), so a value in a third of all rows is reduced before it is
shuffled; the join back is a plain one, which Spark splits where it is skewed.

Defined cases: a null text is an empty one and has no span; base spans never depend on
other rows; a null owner counts as one owner and a null repository as one repository;
rows that repeat are scanned each for itself, and count as one repository only if that
column says so; an empty table gives an empty one. Places are in characters (code
points), the end exclusive.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbra.llm.common import fresh, stage


class Kind(NamedTuple):
    """A pattern, the group that holds the value, and how long the value must be.

    The length is asked for after matching: a match that fails still uses up its text.
    """

    name: str
    pattern: str
    value: int
    least: int


ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    Kind("assign", ASSIGN, 2, 6),
    # A run that is too short holds no longer one, so its length can be part of the pattern.
    Kind("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    Kind("hex", "[0-9a-f]{24,}", 0, 24),
)
LIVE = Kind("live", "[A-Za-z0-9+/_=-]{20,}", 0, 20)
#: A value is an example when more owners, or more repositories, than these hold it.
MAX_OWNERS, MAX_REPOSITORIES = 1, 3
#: Different characters of a random-looking value.
LEAST_CHARACTERS = 10


def _matches(kind: Kind) -> Column:
    """Per text: the stretches between matches, and length, value and its hash of each match."""
    p = F.lit(kind.pattern)
    whole, value = F.regexp_extract_all("_t", p, F.lit(0)), F.regexp_extract_all("_t", p, F.lit(kind.value))
    found = F.struct(
        F.transform(F.split("_t", kind.pattern, -1), F.char_length).alias("gaps"),
        F.zip_with(whole, value, lambda w, v: F.struct(
            F.char_length(w).alias("size"), (F.char_length(v) >= kind.least).alias("ok"), F.md5(F.encode(v, "UTF-8")).alias("hash"),
            (v.rlike("[0-9]") & v.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(v, ""))) >= LEAST_CHARACTERS)).alias("random"),
        )).alias("found"),
    )
    return F.when(F.col("_t").rlike(kind.pattern), found)


def scan(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The rows with a number of their own (`row`), and the candidates: row, text_md5, kind, start, end, hash, random, owner, repository."""
    kinds = (*BASE, LIVE)
    row = fresh(docs, "row")
    held = docs.select(
        F.monotonically_increasing_id().alias(row), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text], F.md5(F.encode(F.coalesce(docs[text], F.lit("")), "UTF-8")).alias("text_md5")).alias("d"),
        docs[owner].cast("string").alias("owner"), docs[repository].cast("string").alias("repository"), F.coalesce(docs[text], F.lit("")).alias("_t"),
    )
    # Numbers given once and written, so that a task that runs again cannot change them.
    rows = stage(held.select(F.col(row).alias("row"), "d", "owner", "repository", *[_matches(k).alias(f"m{i}") for i, k in enumerate(kinds)]), "scanned")
    rows = rows.withColumn("text_md5", F.col("d.text_md5"))
    found = None
    for i, k in enumerate(kinds):
        hits = rows.where(f"m{i} IS NOT NULL").select("row", "text_md5", "owner", "repository", F.posexplode(F.arrays_zip(
            F.slice(f"m{i}.gaps", 1, F.size(f"m{i}.found")).alias("gap"), F.col(f"m{i}.found").alias("hit"))).alias("place", "x"))
        one = hits.select("row", "text_md5", "owner", "repository", F.lit(i).alias("kind"), "place", F.col("x.gap").alias("gap"), "x.hit.*")
        found = one if found is None else found.unionByName(one)
    # One document's matches, in order: lengths so far are the places.
    upto = "sum(gap + size) OVER (PARTITION BY row, kind ORDER BY place)"
    found = found.withColumn("end", F.expr(upto)).withColumn("start", F.col("end") - F.col("size")).where("ok")
    # A live candidate must lie outside the base spans.
    live = len(BASE)
    before = f"max(CASE WHEN kind < {live} THEN end END) OVER (PARTITION BY row ORDER BY start, kind)"
    after = f"min(CASE WHEN kind < {live} THEN start END) OVER (PARTITION BY row ORDER BY start DESC, kind DESC)"
    found = found.withColumns({"_b": F.expr(before), "_a": F.expr(after)})
    free = (F.coalesce(F.col("_b"), F.lit(0)) <= F.col("start")) & F.coalesce(F.col("_a") >= F.col("end"), F.lit(True))
    found = found.where((F.col("kind") < live) | (F.col("random") & free))
    return rows.select("row", "d"), found.select("row", "text_md5", "kind", "start", "end", "hash", "random", "owner", "repository")


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, n_repositories and n_owners, over distinct texts."""
    null_last = lambda c: F.min(F.struct(F.col(c).isNull().alias("unknown"), F.col(c).alias("value")))["value"]
    held = candidates.groupBy("hash", "text_md5").agg(null_last("owner").alias("owner"), null_last("repository").alias("repository"))
    held = stage(held, "held")
    count = lambda c, name: held.groupBy("hash", c).agg(F.lit(1).alias("one")).groupBy("hash").agg(F.sum("one").alias(name))
    return count("owner", "n_owners").join(count("repository", "n_repositories"), "hash")


def _joined(kinds: tuple[str, ...], spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    one = lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def secrets(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """The columns of `docs` but the text, with text_md5, n_<kind> of the base, base_sha256, spans, found, n_live, n_example and n_repositories.

    `found` has start, kind (its place in BASE, then live), end, live, n_owners and n_repositories of each span;
    n_repositories of a row is the largest of its spans, 0 without one.
    """
    rows, candidates = scan(docs, text, owner, repository)
    candidates = stage(candidates, "candidates")
    judged = candidates.join(ownership(candidates), "hash")
    copied = (F.col("n_owners") > max_owners) | (F.col("n_repositories") > max_repositories)
    judged = judged.withColumn("live", F.col("random") & ~copied)
    judged = judged.where((F.col("kind") < len(BASE)) | F.col("live"))
    per_row = judged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live", "n_owners", "n_repositories"))).alias("found"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean,n_owners:bigint,n_repositories:bigint>>")
    out = rows.join(per_row, "row", "left").withColumn("found", F.coalesce("found", empty))
    base = F.filter("found", lambda x: x["kind"] < len(BASE))
    names = tuple(k.name for k in (*BASE, LIVE))
    results = {f"n_{k.name}": F.expr(f"cast(size(filter(found, x -> x.kind = {i})) AS bigint)") for i, k in enumerate(BASE)}
    results |= {
        "base_sha256": F.sha2(_joined(names, base), 256), "spans": _joined(names, F.col("found")),
        "n_live": F.size(F.filter("found", lambda x: x["live"])).cast("bigint"),
        "n_example": F.size(F.filter("found", lambda x: (x["n_owners"] > max_owners) | (x["n_repositories"] > max_repositories))).cast("bigint"),
        "n_repositories": F.coalesce(F.array_max(F.transform("found", lambda x: x["n_repositories"])), F.lit(0).cast("bigint")),
    }
    kept = [c for c in docs.columns if c != text and c not in (*results, "found", "text_md5")]
    return out.select(*[F.col(f"d.`{c}`") for c in kept], "d.text_md5", "found", *[v.alias(n) for n, v in results.items()])


def masked(text: Column, found: Column, mask: str = "[SECRET]") -> Column:
    """`text` with the union of its spans (start, end ascending by start) replaced."""
    start = F.lit(0).cast("bigint")
    empty = F.struct(start.alias("at"), F.array().cast("array<string>").alias("parts"))
    step = lambda a, x: F.when(
        x["start"] >= a["at"],
        F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.concat(a["parts"], F.array(F.substring(text, (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit(mask))).alias("parts")),
    ).otherwise(F.struct(F.greatest(a["at"], x["end"]).alias("at"), a["parts"].alias("parts")))
    done = F.aggregate(found, empty, step)
    return F.concat(F.array_join(done["parts"], ""), F.substring(text, (done["at"] + 1).cast("int"), F.char_length(text)))
