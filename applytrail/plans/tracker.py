"""The batch plans: mail tables, application tables, funnel tables, feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applytrail.operators import applications as A
from applytrail.operators import funnel as N
from applytrail.operators import mail as M
from applytrail.operators import screening as Q
from applytrail.sources.readers import application_metadata
from applytrail.sources.scratch import cut, spread


def mail_table(emails: DataFrame) -> DataFrame:
    """Clean mails with extracted fields to the keyed analysis table."""
    table = M.conform_dates(M.flatten_analysis(emails))
    table = M.select_analysis_columns(M.drop_empty(M.drop_unrelated(table)))
    return M.with_clean_keys(table)


def jobs_table(saved: DataFrame) -> DataFrame:
    """Saved jobs with grouping keys."""
    return M.with_clean_keys(saved)


def application_funnel(mail: DataFrame, jobs: DataFrame, asof: Column) -> DataFrame:
    """Every application with its milestone flags and one of seven outcomes."""
    return N.outcome7(A.unify_applications(mail, jobs), asof)


def funnel_summary(mail: DataFrame, jobs: DataFrame, asof: Column) -> DataFrame:
    return N.funnel_counts(A.verified_funnel(A.unify_applications(mail, jobs)), asof)


def stage_funnel(mail: DataFrame, jobs: DataFrame, asof: Column) -> DataFrame:
    """Stages reached and the simple outcome per application with a company."""
    events = M.drop_unkeyed(N.stage_events(mail, jobs))
    return N.outcome3(N.job_funnel(events, asof))


def feature_table(exports: DataFrame, thresh: int = 2) -> DataFrame:
    """Application exports to the wide feature table with sparse features dropped."""
    features = Q.with_features(Q.with_questions(application_metadata(spread(exports))))
    features = cut(features.select(*Q.METADATA, "features"), "features")
    columns = Q.ordered_features(features, thresh)
    return Q.fill_flags(Q.drop_sparse(Q.feature_matrix(features, columns), columns, thresh))


def quick_apply_table(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(questions, jobs): feature columns with the job url, and the keyed job list."""
    questions, jobs = M.split_by_prefix(features, ("Ask_", "Req_"), [F.col("Job_Url").alias("job_url")])
    named = jobs.select(
        F.col("Application_Date").alias("linkedin_date"), F.col("Company_Name").alias("company"),
        F.col("Job_Title").alias("role"), F.col("Job_Url").alias("job_url"),
    )
    return questions, M.with_clean_keys(named)
