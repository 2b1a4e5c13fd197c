"""Batch jobs for the catalogue's entry points, each read -> plan -> write.

    python -m cinelake.jobs land --input FOLDER --output RAW_ROOT --day 2024-03-27
    python -m cinelake.jobs trusted-credits --input RAW_CSV_DIR --output TRUSTED_DIR [--report REPORT_DIR]
    python -m cinelake.jobs trusted-details --input RAW_JSON_DIR --output TRUSTED_DIR [--report REPORT_DIR]
    python -m cinelake.jobs refined --credits TRUSTED_CREDITS --details TRUSTED_DETAILS --output REFINED_DIR [--bucketed]
    python -m cinelake.jobs enrichment --credits RAW_CSV_DIR --details RAW_JSON_DIR --errors ERRORS_DIR [--found JSON_DIR]
    python -m cinelake.jobs analysis --refined REFINED_DIR --output RESULTS_DIR
    python -m cinelake.jobs catalogue --refined REFINED_DIR [--database DB] [--clean]
    python -m cinelake.jobs stream-details --input RAW_JSON_DIR --output TRUSTED_DIR --checkpoint CKPT_DIR

Master, executors and ``spark.checkpoint.dir`` come from spark-submit / the cluster.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake import functions as fx
from cinelake import operators as op
from cinelake.operators.quality import schema_diff
from cinelake.plans import analytics, enrich, star, trusted
from cinelake.session import build_session, materialize, scratch
from cinelake.sources.readers import landing_inventory, read_delimited, read_json_lines
from cinelake.sources.schemas import RAW_CREDITS_DDL, RAW_DETAILS_SCHEMA, TRUSTED_CREDITS_SCHEMA, TRUSTED_DETAILS_SCHEMA
from cinelake.sources.sinks import drop_unshown, land_once, publish_views, write_id_list, write_json_balanced, write_parquet
from cinelake.streaming.ingest import stream_trusted_details


def landing_job(spark: SparkSession, input_path: str, root: str, day: dt.date) -> list[str]:
    """Every *.csv of a folder under its dataset's dated path, unless a complete
    landing is there.  Returns the paths written.  Loops over the listing of files."""
    files = landing_inventory(spark, input_path, "*.csv")
    target = fx.landing_path(F.lit(f"{root.rstrip('/')}/Raw"), F.lit("Local"), F.lit("CSV"), "dataset", F.lit(day), "file_name")
    done = []
    for r in files.select("path", target.alias("target")).collect():
        # lines as they are: one column, no quoting; one task, so that the header stays first
        lines = spark.read.text(r.path).coalesce(1)
        plain = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
        if land_once(lines, r.target, "csv", sep="\u0001", quote="", escapeQuotes=False, **plain):
            done.append(r.target)
    return done


def write_report(table: DataFrame, funnel: op.Funnel, key: str, attrs: list[str], path: str) -> None:
    """V1, V2 and A6 of a written table, as small tables: the rows of every stage, counted while it was
    written (``funnel``; ``counts`` has the first and last), keys with several attribute
    tuples, and the column profile."""
    stages = funnel.rows(table.sparkSession)
    stages.write.mode("overwrite").parquet(f"{path}/funnel")
    ends = stages.agg(F.min_by("n_rows", "stage_no").alias("raw"), F.max_by("n_rows", "stage_no").alias("trusted"))
    ends.unpivot([], ["raw", "trusted"], "stage", "n_rows").write.mode("overwrite").parquet(f"{path}/counts")
    op.key_consistency(table, key, attrs).write.mode("overwrite").parquet(f"{path}/key_consistency")
    op.describe_profile(table).write.mode("overwrite").parquet(f"{path}/profile")


def trusted_credits_job(
    spark: SparkSession, input_path: str, output_path: str, mode: str = "errorifexists", report: str | None = None
) -> DataFrame:
    """Q1 + S1 + S4: every *.csv under the raw folder to the trusted credits table, with the
    quality report on request."""
    raw = read_delimited(spark, input_path, RAW_CREDITS_DDL, glob="*.csv", recursive=True)
    funnel = op.Funnel()
    write_parquet(trusted.trusted_credits(raw, **({"counted": funnel} if report else {})), output_path, mode=mode)
    out = spark.read.parquet(output_path)
    if report:
        write_report(out, funnel, "id", ["tituloPrincipal", "tituloOriginal", "anoLancamento", "genero", "notaMedia", "numeroVotos"], report)
    return out


def trusted_details_job(spark: SparkSession, input_path: str, output_path: str, report: str | None = None) -> DataFrame:
    """Q2 + S2 + S5: JSON lines under dated folders to trusted details, partitioned by
    the extraction date read from each file's folder.  Dynamic partition overwrite:
    re-running a date replaces that date only.  With the quality report on request."""
    raw = read_json_lines(spark, input_path, RAW_DETAILS_SCHEMA)
    funnel = op.Funnel()
    out = trusted.trusted_details(raw, path_col=F.col("_metadata.file_path"), **({"counted": funnel} if report else {}))
    write_parquet(out, output_path, mode="overwrite", partition_by=["extraction_date"])
    out = spark.read.parquet(output_path)
    if report:
        write_report(out, funnel, "imdb_id", ["id", "title", "release_date", "revenue", "budget", "extraction_date"], report)
    return out


def check_columns(df: DataFrame, expected: T.StructType, name: str) -> None:
    """V6: every expected column present with its type (order and extra columns are
    allowed); raises with the named differences otherwise."""
    actual = T.StructType([f for f in df.schema.fields if f.name in set(expected.fieldNames())])
    diffs = [d for d in schema_diff(actual, expected) if d != "column order differs"]
    if diffs:
        raise ValueError(f"{name}: " + "; ".join(diffs))


def refined_job(
    spark: SparkSession, credits_path: str, details_path: str, output_root: str, bucketed: bool = False, n_buckets: int = 64
) -> star.Star:
    """Q5-Q9 + S6 + S7: star schema from the trusted tables, written once.  The
    trusted inputs are checked against their expected schemas first (V6).  Artists and dates keep
    their ids from build to build (``keys`` beside the builds), and a build whose audit finds a
    missing key or a null stays unpublished.  With
    ``bucketed`` the tables are catalogued with the fact and the film dimension
    bucketed on the film id (S14, co-located joins for repeated analysis)."""
    credits, details = spark.read.parquet(credits_path), spark.read.parquet(details_path)
    check_columns(credits, TRUSTED_CREDITS_SCHEMA, "trusted credits")
    check_columns(details, TRUSTED_DETAILS_SCHEMA, "trusted details")
    with scratch(spark):
        s = star.build_star(credits, details, materialize_inputs=False, keys=f"{output_root.rstrip('/')}/keys")
        if not bucketed:
            star.write_star(s, output_root)
            return star.read_star(spark, output_root)
        names = star.write_star_bucketed(s, output_root, n_buckets=n_buckets)
    t = spark.table
    return star.Star(
        t(names["dim_actor"]), t(names["dim_date"]), t(names["dim_movie"]),
        t(names["fact_movie_actor"]), t(names["dim_genre"]),
    )


def enrichment_job(spark: SparkSession, credits_path: str, details_path: str, errors_path: str, found_path: str | None = None) -> dict:
    """Q3 + Q4 + S8 + S9: candidate ids of the wanted genres, the ids without details
    written as the error list, the details of the others as JSON files of at most 100
    records, and the success figures.  Both inputs are parsed once."""
    with scratch(spark):
        candidates = trusted.candidate_ids(read_delimited(spark, credits_path, RAW_CREDITS_DDL, glob="*.csv", recursive=True))
        details = materialize(read_json_lines(spark, details_path, RAW_DETAILS_SCHEMA), "details")
        marked = materialize(enrich.mark_found(candidates, details, "id", "imdb_id"), "marked")
        write_id_list(marked.filter("not found"), errors_path)
        if found_path:
            found = details.join(marked.filter("found").select(F.col("id").alias("imdb_id")), "imdb_id", "left_semi")
            write_json_balanced(found.select(*RAW_DETAILS_SCHEMA.fieldNames()), found_path, ["imdb_id", "id"])
        return op.success_rate(marked, "found").first().asDict()


#: Q11-Q21 by the name of their result.
ANALYSES = {
    "releases_per_year": analytics.releases_per_year,
    "popularity_per_year": analytics.popularity_per_year,
    "budget_revenue_per_year": lambda s: analytics.budget_revenue_per_year(s, 1900, 2100),
    "budget_revenue_fit": analytics.budget_revenue_fit,
    "rating_popularity_fit": analytics.rating_popularity_fit,
    "seasonal_share": analytics.seasonal_share,
    "top_artists_popularity": analytics.top_artists_popularity,
    "top_artists_revenue": analytics.top_artists_revenue,
    "artist_recurrence": analytics.artist_recurrence,
    "rating_by_genre": analytics.rating_by_genre,
    "top_popular_per_genre": analytics.top_popular_per_genre,
}


def analysis_job(spark: SparkSession, refined_root: str, output: str) -> list[str]:
    """Q11-Q21 over the current build of the refined layer, one Parquet result each."""
    s = star.read_star(spark, refined_root)
    for name, fn in ANALYSES.items():
        fn(s).write.mode("overwrite").parquet(f"{output.rstrip('/')}/{name}")
    return list(ANALYSES)


def catalogue_job(spark: SparkSession, refined_root: str, database: str | None = None, clean: bool = False) -> list[str]:
    """The current build in the catalogue, as views that are replaced without a gap, over tables
    with column statistics.  With ``clean`` tables of other builds leave the catalogue."""
    names = ["dim_actor", "dim_date", "dim_movie", "dim_genre", "fact_movie_actor"]
    build = star.current_build(spark, refined_root)
    views = publish_views(spark, build, names, ["fact_movie_actor"], database)
    if clean:
        drop_unshown(spark, names, build, database)
    return views


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cinelake.jobs")
    parser.add_argument("--input-bytes", type=int, default=None, help="expected input volume, sizes the partitions")
    sub = parser.add_subparsers(dest="job", required=True)
    p = sub.add_parser("land")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--day", type=dt.date.fromisoformat, required=True)
    p = sub.add_parser("trusted-credits")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--report", default=None, help="folder for the quality report")
    p = sub.add_parser("trusted-details")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--report", default=None, help="folder for the quality report")
    p = sub.add_parser("refined")
    p.add_argument("--credits", required=True)
    p.add_argument("--details", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--bucketed", action="store_true", help="catalogue tables bucketed on the film id")
    p.add_argument("--buckets", type=int, default=64, help="a bucket of the fact should be a few hundred MB")
    p = sub.add_parser("enrichment")
    p.add_argument("--credits", required=True)
    p.add_argument("--details", required=True)
    p.add_argument("--errors", required=True)
    p.add_argument("--found", default=None, help="folder for the found details as JSON")
    p = sub.add_parser("analysis")
    p.add_argument("--refined", required=True)
    p.add_argument("--output", required=True)
    p = sub.add_parser("catalogue")
    p.add_argument("--refined", required=True)
    p.add_argument("--database", default=None)
    p.add_argument("--clean", action="store_true", help="take other builds' tables out of the catalogue")
    p = sub.add_parser("stream-details")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--checkpoint", required=True)
    args = parser.parse_args(argv)

    spark = build_session(input_bytes=args.input_bytes)
    if args.job == "land":
        print(json.dumps(landing_job(spark, args.input, args.output, args.day)))
    elif args.job == "trusted-credits":
        trusted_credits_job(spark, args.input, args.output, report=args.report)
    elif args.job == "trusted-details":
        trusted_details_job(spark, args.input, args.output, report=args.report)
    elif args.job == "refined":
        refined_job(spark, args.credits, args.details, args.output, bucketed=args.bucketed, n_buckets=args.buckets)
    elif args.job == "stream-details":
        stream_trusted_details(spark, args.input, args.output, args.checkpoint)
    elif args.job == "analysis":
        print(json.dumps(analysis_job(spark, args.refined, args.output)))
    elif args.job == "catalogue":
        print(json.dumps(catalogue_job(spark, args.refined, args.database, args.clean)))
    else:
        print(json.dumps(enrichment_job(spark, args.credits, args.details, args.errors, args.found)))


if __name__ == "__main__":
    main()
