"""Pasted saved-jobs text to a table, one column expression per parsing step.

Nothing here shuffles: a dump is split into blocks, each block into lines, and the
fields are read off the line array inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applytrail.functions.dates import relative_to_date
from applytrail.functions.text import normalise_dump, strip

# Whole lines that carry no information.
NOISE_LINES = (
    r"0 notifications", r"Saved .*", r"In Progress .*", r"Applied · .*", r"Interview · .*",
    r"Archived", r"Date posted", r"About archived jobs", r"Previous", r"Next", r"Learn more",
    r"Only open jobs can be unarchived\.", r"Saved jobs move to Archived.*",
    r"Did you hear back\?", r"YesNo", r"Yes", r"No", r"Not seeing some jobs\?", r"•\s*\d*",
)

# Whole lines that report a status.
STATUS_LINES = (
    r"Applied \d+\w* ago", r"Applied just now", r"\(?No longer accepting applications\)?",
    r"\(?Posted .* ago\)?", r"\(?Reposted .* ago\)?", r"Application viewed", r"Resume downloaded",
    r"Not moving forward", r"Interview",
)

# Words that place a line.
WORKPLACE_WORDS = ("(hybrid)", "(on-site)", "(remote)", "hybrid", "on-site", "remote")
WORKPLACE_TAGS = ("(Remote)", "(Hybrid)", "(On-site)")
LOCATION_HINTS = ("remote", "hybrid", "on-site", "metropolitan area")

# Output columns, in order.
COLUMNS = (
    "role", "company", "location", "work_type", "is_open", "listing_status", "raw_applied",
    "applied_date", "raw_posted", "posted_date", "raw_reposted", "reposted_date", "app_viewed",
    "resume_downloaded", "outcome",
)


def _whole_line(patterns: tuple[str, ...]) -> str:
    return r"(?iU)^(" + "|".join(patterns) + r")$"


def blocks(df: DataFrame, text: str = "value") -> DataFrame:
    """One row per job block: its position and its non-blank trimmed lines."""
    split = df.select("*", F.posexplode(F.split(text, r"(?U)Notes\s*Add note")).alias("block", "_block_text"))
    lines = F.transform(F.split("_block_text", "\n"), strip)
    return split.withColumn("lines", F.filter(lines, lambda line: line != "")).drop("_block_text", text)


def drop_noise(lines: Column) -> Column:
    return F.filter(lines, lambda line: ~line.rlike(_whole_line(NOISE_LINES)))


def status_lines(lines: Column) -> Column:
    return F.filter(lines, lambda line: line.rlike(_whole_line(STATUS_LINES)))


def header_lines(lines: Column) -> Column:
    return F.filter(lines, lambda line: ~line.rlike(_whole_line(STATUS_LINES)))


def split_status(df: DataFrame) -> DataFrame:
    """Noise removed, lines parted into header and statuses; blocks without a header go."""
    kept = df.withColumn("lines", drop_noise(F.col("lines")))
    parted = kept.withColumns({"statuses": status_lines(F.col("lines")), "header": header_lines(F.col("lines"))})
    return parted.filter(F.size("header") > 0).drop("lines")


def role_company(df: DataFrame) -> DataFrame:
    """Role and company line from the header lines."""
    first, second = F.get("header", F.lit(0)), F.get("header", F.lit(1))
    tagged = first.rlike("[·•]")
    for tag in WORKPLACE_TAGS:
        tagged = tagged | first.contains(tag)
    single = F.size("header") == 1
    return df.withColumns({
        "role": F.when(~single | ~tagged, first),
        "company_line": F.when(~single, second).when(tagged, first),
    })


def company_location(df: DataFrame) -> DataFrame:
    """Company and location from the company line."""
    parts = F.split("company_line", r"(?U)\s*[·•]\s*", 2)
    left, right = strip(F.get(parts, F.lit(0))), strip(F.get(parts, F.lit(1)))
    paired = F.size(parts) == 2
    bare_workplace = F.lower(right).isin(*WORKPLACE_WORDS)
    hinted = F.lit(False)
    for hint in LOCATION_HINTS:
        hinted = hinted | F.lower(left).contains(hint)
    return df.withColumns({
        "company": F.when(paired, F.when(~bare_workplace, left)).when(~hinted, left),
        "location": F.when(paired & bare_workplace, F.concat_ws(" ", left, right))
                     .when(paired, right).when(hinted, left),
    })


def work_type(df: DataFrame) -> DataFrame:
    """Workplace tag out of the location into its own column."""
    tag = F.nullif(F.regexp_extract("location", r"(?i)\((remote|hybrid|on-site)\)", 0), F.lit(""))
    word = F.substring(tag, F.lit(2), F.length(tag) - 2)
    return df.withColumns({
        "work_type": F.concat(F.upper(F.left(word, F.lit(1))), F.lower(F.substr(word, F.lit(2)))),
        "location": F.when(tag.isNotNull(), strip(F.replace("location", tag, F.lit(""))))
                     .otherwise(F.col("location")),
    })


def status_facts(df: DataFrame) -> DataFrame:
    """What the status lines say: raw dates, open or closed, viewed, outcome."""
    def first(test) -> Column:
        return F.get(F.filter("statuses", lambda s: test(F.lower(s))), F.lit(0))

    def any_has(word: str) -> Column:
        return F.exists("statuses", lambda s: F.lower(s).contains(word))

    def bare(c: Column) -> Column:
        return F.regexp_replace(c, r"^[() ]+|[() ]+$", "")

    closed, downloaded = any_has("accepting"), any_has("downloaded")
    raw_reposted = bare(first(lambda s: s.contains("reposted")))
    return df.withColumns({
        "raw_applied": first(lambda s: s.startswith("applied")),
        "raw_posted": bare(first(lambda s: s.contains("posted") & ~s.contains("reposted"))),
        "raw_reposted": raw_reposted,
        "is_open": ~closed,
        "listing_status": F.when(closed, "closed").when(raw_reposted.isNotNull(), "reposted").otherwise("open"),
        "resume_downloaded": downloaded,
        "app_viewed": any_has("viewed") | downloaded,
        "outcome": F.when(any_has("not moving forward"), "Not moving forward")
                    .when(any_has("interview"), "Interview"),
    })


def saved_jobs(df: DataFrame, asof: Column, text: str = "value", keep: tuple[str, ...] = (),
               legacy_minutes: bool = False) -> DataFrame:
    """Fifteen columns per saved job. ``asof`` is the moment the dump was pasted."""
    parsed = blocks(df, text)
    for step in (split_status, role_company, company_location, work_type, status_facts):
        parsed = step(parsed)
    parsed = parsed.withColumns({
        f"{name}_date": relative_to_date(F.col(f"raw_{name}"), asof, legacy_minutes)
        for name in ("applied", "posted", "reposted")
    })
    return parsed.select(*keep, *COLUMNS)


def dump_records(df: DataFrame, text: str = "value") -> DataFrame:
    """Normalised dump, one row per record line."""
    lines = F.split(normalise_dump(F.col(text)), "\n")
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(lines).alias("line_no", "record")).filter(F.col("record") != "")
