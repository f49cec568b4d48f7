"""Stages, outcomes, flows and timelines over applications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from applytrail.functions.dates import older_than, period, whole_days
from applytrail.operators.applications import (
    BOARD_REJECTION, KEYS, PERSONALITY_TEST, TECHNICAL_TEST,
    has_value, is_confirmation, is_interview, is_rejection,
)

# Stage names and their labels on the event timeline.
STAGES = ("Applied", "Assessment", "Interview", "Explicit Rejection")
EVENT_LABELS = {
    "Applied": "Application Submitted",
    "Assessment": "Assessment Received",
    "Interview": "Interview Invitation",
    "Explicit Rejection": "Explicit Rejection",
}
GHOSTED_AFTER_DAYS = 21


def stage_events(mail: DataFrame, jobs: DataFrame) -> DataFrame:
    """Dated stage events of every mail and board entry; no shuffle.

    A board rejection carries no date of its own and takes the entry's applied date.
    """
    def entry(condition: Column, stage: str, date: str) -> Column:
        return F.when(condition, F.struct(F.lit(stage).alias("stage"), F.col(date).alias("event_date")))

    test = has_value("update_category", PERSONALITY_TEST) | has_value("update_category", TECHNICAL_TEST)
    from_mail = F.array(
        entry(is_confirmation(), "Applied", "date"),
        entry(test, "Assessment", "date"),
        entry(is_interview(), "Interview", "date"),
        entry(is_rejection(), "Explicit Rejection", "date"),
    )
    from_board = F.array(
        entry(F.lit(True), "Applied", "applied_date"),
        entry(has_value("outcome", BOARD_REJECTION), "Explicit Rejection", "applied_date"),
    )
    return mail.select(*KEYS, F.inline(F.array_compact(from_mail))).unionByName(
        jobs.select(*KEYS, F.inline(F.array_compact(from_board)))
    )


def first_per_stage(events: DataFrame) -> DataFrame:
    """Earliest date per (company, role, stage)."""
    return events.groupBy(*KEYS, "stage").agg(F.min("event_date").alias("stage_date"))


def job_funnel(events: DataFrame, asof: Column) -> DataFrame:
    """Stages reached and last update per application, straight from the events.

    The last update is the newest of the first dates per stage; keeping one minimum
    per stage makes that a single aggregation instead of two chained ones.
    """
    mins = {s: f"_first_{i}" for i, s in enumerate(STAGES)}
    seen = {s: f"_seen_{i}" for i, s in enumerate(STAGES)}
    grouped = events.groupBy(*KEYS).agg(
        *[F.min(F.when(F.col("stage") == s, F.col("event_date"))).alias(c) for s, c in mins.items()],
        *[F.max((F.col("stage") == s).cast("int")).alias(c) for s, c in seen.items()],
    )
    hit = {s: F.col(c) == 1 for s, c in seen.items()}
    stage_list = F.array_sort(F.array_compact(F.array(*[F.when(h, F.lit(s)) for s, h in hit.items()])))
    return grouped.select(
        *KEYS,
        F.greatest(*mins.values()).alias("last_update"),
        stage_list.alias("stage_list"),
        hit["Assessment"].alias("hit_test"),
        hit["Interview"].alias("hit_interview"),
        hit["Explicit Rejection"].alias("hit_rejection"),
    ).withColumn("days_since_update", whole_days(asof, F.col("last_update")))


def outcome3(df: DataFrame, labels: tuple[str, str, str] = ("Rejection", "Ghosted", "Active")) -> DataFrame:
    """Rejected, silent for more than three weeks, or still active."""
    rejected, ghosted, active = labels
    return df.withColumn(
        "outcome",
        F.when(F.col("hit_rejection"), rejected)
        .when(F.col("days_since_update") > GHOSTED_AFTER_DAYS, ghosted)
        .otherwise(active),
    )


def _outcome7(interview: Column, test: Column, rejected: Column, days: Column) -> Column:
    return (
        F.when(interview & rejected, "Interview Rejection")
        .when(interview, "Active Interview / Offer")
        .when(test & rejected, "Failed Assessment")
        .when(test, "Assessment Pending")
        .when(rejected, "Screening Rejection")
        .when(days > GHOSTED_AFTER_DAYS, "Ghosted >3 Weeks")
        .otherwise("Active / Pending")
    )


def with_has_test(apps: DataFrame) -> DataFrame:
    return apps.withColumn("has_test", F.greatest("has_p_test", "has_t_test"))


def outcome7(apps: DataFrame, asof: Column) -> DataFrame:
    """Seven outcomes from the milestone flags; silence counts from the application date."""
    apps = with_has_test(apps).withColumn("days_since_app", whole_days(asof, F.col("first_applied_date")))
    return apps.withColumn("final_outcome", _outcome7(
        F.col("has_interview") == 1, F.col("has_test") == 1, F.col("is_rejected") == 1, F.col("days_since_app"),
    ))


def outcome7_from_stages(funnel: DataFrame) -> DataFrame:
    """The same seven outcomes from stages; silence counts from the last update."""
    return funnel.withColumn("final_status", _outcome7(
        F.col("hit_interview"), F.col("hit_test"), F.col("hit_rejection"), F.col("days_since_update"),
    ))


def funnel_counts(funnel: DataFrame, asof: Column) -> DataFrame:
    """Totals of the application funnel in one row, from one pass."""
    tech, psych = F.col("has_t_test") == 1, F.col("has_p_test") == 1
    interview, rejected = F.col("has_interview") == 1, F.col("is_rejected") == 1
    counts = funnel.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(tech).alias("n_technical_test"),
        F.count_if(psych).alias("n_psychometric_test"),
        F.count_if(interview).alias("n_interview"),
        F.count_if(rejected).alias("n_rejected"),
        F.count_if(interview & rejected).alias("n_rejected_after_interview"),
        F.count_if((tech | psych) & ~interview & rejected).alias("n_rejected_after_test"),
        F.count_if(~rejected & older_than(F.col("first_date"), asof, GHOSTED_AFTER_DAYS)).alias("n_ghosted"),
    )
    return counts.withColumns({
        "n_rejected_at_screening":
            F.expr("n_rejected - n_rejected_after_interview - n_rejected_after_test"),
        "n_active": F.expr("n_total - n_rejected - n_ghosted"),
    })


def _edges(counts: DataFrame, edges: list[tuple[str, str, str]]) -> DataFrame:
    """One wide row of counts to (source, target, value) rows."""
    rows = [
        F.struct(F.lit(s).alias("source"), F.lit(t).alias("target"), F.col(c).alias("value"))
        for s, t, c in edges
    ]
    return counts.select(F.inline(F.array(*rows)))


def stage_flows(funnel: DataFrame) -> DataFrame:
    """Twelve edges: stage to stage, and furthest stage to terminal outcome."""
    test, interview = F.col("hit_test"), F.col("hit_interview")
    furthest = {"Applied": ~test & ~interview, "Assessment": test & ~interview, "Interview": interview}
    terminal = {"Rejected": "Rejection", "Ghosted": "Ghosted", "Still Active": "Active"}
    aggs = [
        F.count_if(test).alias("to_test"),
        F.count_if(interview & ~test).alias("to_interview"),
        F.count_if(test & interview).alias("test_to_interview"),
    ]
    edges = [("Applied", "Assessment", "to_test"), ("Applied", "Interview", "to_interview"),
             ("Assessment", "Interview", "test_to_interview")]
    for i, (stage, reached) in enumerate(furthest.items()):
        for j, (target, outcome) in enumerate(terminal.items()):
            aggs.append(F.count_if(reached & (F.col("outcome") == outcome)).alias(f"end_{i}_{j}"))
            edges.append((stage, target, f"end_{i}_{j}"))
    return _edges(funnel.agg(*aggs), edges)


def outcome_flows(apps: DataFrame, asof: Column) -> DataFrame:
    """Ten edges of the detailed flow, both ways into the interview stage merged.

    As with every flow here, an application without any date is neither ghosted
    nor pending.
    """
    apps = with_has_test(apps).withColumn("days", whole_days(asof, F.col("first_applied_date")))
    test, interview = F.col("has_test") == 1, F.col("has_interview") == 1
    rejected, old = F.col("is_rejected") == 1, F.col("days") > GHOSTED_AFTER_DAYS
    start = ~test & ~interview
    start_name, test_name, interview_name = "Total Applications", "Taken Assessment", "Interview Stage"
    flows = [
        (start_name, "Screening Rejection", start & rejected),
        (start_name, "Ghosted >3 Weeks", start & ~rejected & old),
        (start_name, "Active / Pending", start & ~rejected & ~old),
        (start_name, test_name, test),
        (start_name, interview_name, ~test & interview),
        (test_name, "Failed Assessment", test & ~interview & rejected),
        (test_name, "Assessment Pending", test & ~interview & ~rejected),
        (test_name, interview_name, test & interview),
        (interview_name, "Interview Rejection", interview & rejected),
        (interview_name, "Offer / Active Interview", interview & ~rejected),
    ]
    counts = apps.agg(*[F.count_if(c).alias(f"edge_{i}") for i, (_, _, c) in enumerate(flows)])
    return _edges(counts, [(s, t, f"edge_{i}") for i, (s, t, _) in enumerate(flows)])


def stage_totals(funnel: DataFrame) -> DataFrame:
    """Totals over the stage funnel in one row: tests, interviews, ends by furthest stage."""
    test, interview, rejected = F.col("hit_test"), F.col("hit_interview"), F.col("hit_rejection")
    counts = funnel.agg(
        F.count(F.lit(1)).alias("total_apps"),
        F.count_if(test).alias("tests"),
        F.count_if(interview).alias("interviews"),
        F.count_if(F.col("outcome") == "Ghosted").alias("ghosted_total"),
        F.count_if(F.col("outcome") == "Active").alias("active_total"),
        F.count_if(F.col("outcome") == "Rejection").alias("rejected_total"),
        F.count_if(interview & rejected).alias("rej_after_interview"),
        F.count_if(test & ~interview & rejected).alias("rej_after_test"),
    )
    return counts.withColumn(
        "rej_at_screening", F.expr("rejected_total - rej_after_interview - rej_after_test")
    )


def event_timeline(first_events: DataFrame) -> DataFrame:
    """Stage firsts under their display labels; other stages are left out."""
    label = F.create_map(*[F.lit(x) for pair in EVENT_LABELS.items() for x in pair])
    return first_events.filter(F.col("stage").isin(*EVENT_LABELS)).select(
        F.col("stage_date").alias("date"), F.try_element_at(label, F.col("stage")).alias("event_type")
    )


def stage_timeline(first_events: DataFrame, unit: str = "day") -> DataFrame:
    """Applications reaching a stage per period."""
    return first_events.groupBy(period(F.col("stage_date"), unit).alias("period"), "stage").agg(
        F.count(F.lit(1)).alias("events")
    )


def outcome_timeline(apps: DataFrame, unit: str = "day") -> DataFrame:
    return apps.groupBy(period(F.col("first_applied_date"), unit).alias("apply_period"), "final_outcome").agg(
        F.count(F.lit(1)).alias("applications")
    )


def application_volume(apps: DataFrame, unit: str = "day") -> DataFrame:
    return apps.groupBy(period(F.col("first_applied_date"), unit).alias("apply_period")).agg(
        F.count(F.lit(1)).alias("applications")
    )


def response_rate(apps: DataFrame) -> DataFrame:
    """Share of each outcome, and the share of applications that got any answer."""
    answered = ~F.col("final_outcome").isin("Ghosted >3 Weeks", "Active / Pending")
    counts = apps.groupBy("final_outcome").agg(
        F.count(F.lit(1)).alias("applications"), F.count_if(answered).alias("_answered")
    )
    # at most seven rows are left here, one per outcome
    whole = Window.partitionBy(F.lit(0))
    return counts.select(
        "final_outcome", "applications",
        (F.col("applications") / F.sum("applications").over(whole)).alias("share"),
        (F.sum("_answered").over(whole) / F.sum("applications").over(whole)).alias("response_rate"),
    )


def work_type_distribution(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("work_type").agg(F.count(F.lit(1)).alias("jobs"))


def location_distribution(jobs: DataFrame) -> DataFrame:
    """Jobs per work type and location, with subtotals and the grand total."""
    return jobs.rollup("work_type", "location").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("jobs")
    )


def distinct_total(mail_groups: DataFrame) -> DataFrame:
    return mail_groups.agg(F.sum("distinct_roles").alias("distinct_total"))
