"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from bindings import QUERIES  # noqa: E402

HEADLINE = (
    "annotate_job",            # evidence to bins
    "annotation_reused_by_id",  # annotation rows reused for prefixed ids
    "hmm_table",               # bulk ingest of a search output
    "feature_classes",         # the shared-peptide rule
    "quantify_job",            # roll-up, annotation, evidence
    "quantify_job_factors",    # organism size factors
    "channel_median_normalise",
    "reference_ratios",
    "median_polish_totals",
    "consensus_taxon",
    "taxonomy_verdicts",       # the peptide LCA comparison
    "protein_filters",
    "differential_abundance",  # moderated models, adjusted
    "bh_adjust",
    "gene_neighbourhoods",
    "tier_coverage",
    "source_agreement",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Capturing a Python stack per column call is a debugging aid.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["feature_plex_histogram"](spark, sf).collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # A full evaluation of every row and column, without a driver collect.
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf),
            }
        )
    )


if __name__ == "__main__":
    main()
