"""Extracted fields: a caller's extractor over subject and body, quarantine of failures."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.operators.mail import parse_analysis


def enrich(df: DataFrame, extractor: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Add ``analysis_json``: the extractor's JSON text per message, and nothing else.

    The extractor maps a batch of message texts to JSON texts inside the tasks. It may be
    expensive or answer differently when asked again, so Spark must not repeat it freely.
    """
    udf = F.pandas_udf(extractor, T.StringType()).asNondeterministic()
    blank = F.lit("")
    text = F.concat(F.lit("Email Subject: "), F.coalesce("subject", blank),
                    F.lit("\n\nEmail Body: "), F.coalesce("body", blank))
    return df.withColumn("analysis_json", udf(text))


def analyse(df: DataFrame, extractor: Callable[[pd.Series], pd.Series]) -> DataFrame:
    return parse_analysis(enrich(df, extractor))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) by the ``error`` column; quarantined rows get a stub analysis."""
    good = df.filter(F.col("error").isNull())
    stub = F.struct(
        F.col("error").alias("error"),
        F.lit("Not Job Related").alias("category"),
        F.lit(True).alias("is_automated"),
        F.lit("Not analysed.").alias("summary"),
    )
    return good, df.filter(F.col("error").isNotNull()).withColumn("analysis", stub)


# Keyword rules in order of precedence: category, type, what the lower-cased subject and body must hold.
RULES = (
    ("Bot/Auto-Reply", "Unrelated", r"\b(out of (the )?office|automatic reply|auto-?reply)\b"),
    ("Job Offer", "Offer", r"\b(offer letter|(pleased|happy|delighted) to offer|job offer)\b"),
    ("Rejection", "Rejection", r"\b(unfortunately|regret|unsuccessful|other candidates|not (be )?(moving|proceeding|taking)|position has been filled)\b"),
    ("Technical Test Request", "Application update", r"\b((coding|technical|programming) (test|challenge|assessment|task)|take-home)\b"),
    ("Personality Test Request", "Application update", r"\b(personality|psychometric|aptitude) (test|assessment|questionnaire)\b"),
    ("Interview Invitation", "Application update", r"\b(interview|video call with|meet the team)\b"),
    ("Request for Information", "Application update", r"\b(please (send|provide|upload|complete)|missing documents?|further information)\b"),
    ("Confirmation of Application", "Application update", r"\b(thank(s| you) for (applying|your application|your interest)|(received|submitted) your application|application (was )?(sent|received|submitted))\b"),
    ("Job Ad", "Job ad", r"\b(job alert|new jobs|recommended (for you|jobs)|jobs (for you|you may like))\b"),
    ("Recruiter Reach-out", "Unknown", r"\b(came across your profile|your (profile|background) (caught|stood)|would you be open)\b"),
)
NO_RULE = ("Unknown", "Unknown")


def rule_extractor(df: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """Add ``category``, ``type`` and ``analysis_json`` by the first rule that a message fits.

    The rules become one expression of the scan: no Python, no shuffle. A message that fits
    none, an empty one too, is ``Unknown``.
    """
    text = F.lower(F.concat_ws("\n", "subject", "body"))

    fitting = [F.when(text.rlike(pattern), F.lit(category)) for category, _, pattern in rules]
    types = F.create_map(*[F.lit(x) for r in (*rules, NO_RULE) for x in r[:2]])
    named = df.withColumn("category", F.coalesce(*fitting, F.lit(NO_RULE[0])))
    return named.withColumn("type", F.element_at(types, F.col("category"))).withColumn(
        "analysis_json", F.to_json(F.struct("type", "category")))
