"""Pieces of oracle SQL: the operators' meaning, written for DuckDB."""

from __future__ import annotations

from checks.registry import ASOF
from checks.standins import ctes

NOW = f"TIMESTAMP '{ASOF}'"


def squash(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


def company_clean(c: str, extra: str = "") -> str:
    words = rf"regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"
    bare = rf"regexp_replace({words}, '\b(inc|llc|corp|corporation|ltd|limited|co{extra})\b', '', 'g')"
    return f"coalesce({squash(bare)}, 'unknown')"


def role_clean(c: str) -> str:
    flat = rf"regexp_replace(lower({c}), '\(.*?\)|\[.*?\]', '', 'g')"
    words = rf"regexp_replace({flat}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"
    return f"coalesce({squash(words)}, 'unknown')"


ENDINGS = (
    " careers africa", " careers", " south africa", " sa", " pty ltd", r" \(pty\) ltd", " ltd", " limited",
    r" inc\.", " inc", " corporation", r" corp\.", " corp", " group", " holdings", " holding",
)


def norm_company(c: str) -> str:
    name = f"trim(lower(coalesce({c}, '')))"
    for ending in ENDINGS:
        name = rf"regexp_replace({name}, '\s*{ending}$', '')"
    return name


def norm_title(c: str) -> str:
    return f"translate(trim(lower(coalesce({c}, ''))), '-/_', '   ')"


def placeholder_null(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN ('', 'none', 'null', 'n/a') THEN NULL ELSE {c} END"


MAIL = f"""{ctes('mail_rows', 'job_rows')},
mail AS (SELECT *, {company_clean('company')} AS company_clean, {role_clean('role')} AS role_clean FROM mail_rows),
jobs AS (SELECT *, {company_clean('company')} AS company_clean, {role_clean('role')} AS role_clean FROM job_rows)"""

INTERVIEW = "update_category = 'Interview Invitation' AND NOT coalesce(is_automated, FALSE)"
REJECTED = "update_category = 'Rejection' OR notification_type = 'Rejection'"


def flag(condition: str) -> str:
    return f"max(CASE WHEN {condition} THEN 1 ELSE 0 END)"


GROUPS = f"""{MAIL},
mail_groups AS (
  SELECT company_clean AS m_company, role_clean AS m_role, count(DISTINCT update_category) AS distinct_roles,
    count(*) AS mail_count, min("date") AS mail_date,
    {flag("update_category = 'Personality Test Request'")} AS has_p_test,
    {flag("update_category = 'Technical Test Request'")} AS has_t_test,
    {flag(INTERVIEW)} AS has_interview, {flag(REJECTED)} AS is_rejected_mail,
    {flag("update_category = 'Confirmation of Application'")} AS is_confirmation,
    {flag("is_automated OR update_category = 'Bot/Auto-Reply'")} AS is_automated
  FROM mail GROUP BY ALL),
job_groups AS (
  SELECT company_clean AS l_company, role_clean AS l_role, count(*) AS linkedin_count,
    min(applied_date) AS linkedin_date, {flag("outcome = 'Not moving forward'")} AS is_rejected_li
  FROM jobs GROUP BY ALL)"""

APPS = f"""{GROUPS},
apps AS (
  SELECT coalesce(m_company, l_company) AS company_clean, coalesce(m_role, l_role) AS role_clean,
    coalesce(has_p_test, 0) AS has_p_test, coalesce(has_t_test, 0) AS has_t_test,
    coalesce(is_confirmation, 0) AS is_confirmation, coalesce(is_automated, 0) AS is_automated,
    coalesce(has_interview, 0) AS has_interview,
    greatest(coalesce(is_rejected_mail, 0), coalesce(is_rejected_li, 0)) AS is_rejected,
    coalesce(distinct_roles, 0) AS distinct_roles, coalesce(mail_count, 0) AS mail_count,
    coalesce(linkedin_count, 0) AS linkedin_count,
    least(mail_date, linkedin_date) AS first_applied_date
  FROM mail_groups FULL OUTER JOIN job_groups ON m_company = l_company AND m_role = l_role)"""

# outcome by (interview, test, rejected) as three binary digits, each for a young and an old application
OUTCOME_BY_STATE = """[['Active / Pending', 'Ghosted >3 Weeks'], ['Screening Rejection', 'Screening Rejection'],
    ['Assessment Pending', 'Assessment Pending'], ['Failed Assessment', 'Failed Assessment'],
    ['Active Interview / Offer', 'Active Interview / Offer'], ['Interview Rejection', 'Interview Rejection'],
    ['Active Interview / Offer', 'Active Interview / Offer'], ['Interview Rejection', 'Interview Rejection']]"""

OUTCOMES = f"""{APPS},
outcomes AS (
  SELECT *, {OUTCOME_BY_STATE}[1 + 4 * has_interview + 2 * has_test + is_rejected]
      [1 + coalesce(days_since_app > 21, FALSE)::INT] AS final_outcome
  FROM (SELECT *, greatest(has_p_test, has_t_test) AS has_test,
          datesub('day', first_applied_date, {NOW}) AS days_since_app FROM apps))"""

EVENTS = f"""{MAIL},
stage_events AS (
  SELECT company_clean, role_clean, 'Applied' AS stage, "date" AS event_date FROM mail WHERE update_category = 'Confirmation of Application'
  UNION ALL SELECT company_clean, role_clean, 'Assessment', "date" FROM mail WHERE update_category IN ('Personality Test Request', 'Technical Test Request')
  UNION ALL SELECT company_clean, role_clean, 'Interview', "date" FROM mail WHERE {INTERVIEW}
  UNION ALL SELECT company_clean, role_clean, 'Explicit Rejection', "date" FROM mail WHERE {REJECTED}
  UNION ALL SELECT company_clean, role_clean, 'Applied', applied_date FROM jobs
  UNION ALL SELECT company_clean, role_clean, 'Explicit Rejection', applied_date FROM jobs WHERE outcome = 'Not moving forward'),
firsts AS (SELECT company_clean, role_clean, stage, min(event_date) AS stage_date FROM stage_events GROUP BY ALL)"""

FUNNEL = f"""{EVENTS},
funnel AS (
  SELECT *, CASE WHEN hit_rejection THEN 'Rejection' WHEN days_since_update > 21 THEN 'Ghosted' ELSE 'Active' END AS outcome
  FROM (SELECT company_clean, role_clean, max(stage_date) AS last_update, list_sort(list(stage)) AS stage_list,
      bool_or(stage = 'Assessment') AS hit_test, bool_or(stage = 'Interview') AS hit_interview,
      bool_or(stage = 'Explicit Rejection') AS hit_rejection,
      datesub('day', max(stage_date), {NOW}) AS days_since_update
    FROM firsts GROUP BY company_clean, role_clean))"""


def edges(source_rows: list[tuple[str, str, str]], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{s}' AS source, '{t}' AS target, count(*) FILTER (WHERE {c}) AS value FROM {table}"
        for s, t, c in source_rows
    )


def lcs_ratio(a: str, b: str) -> str:
    """Indel ratio by a list fold over bit masks (strings up to 60 characters)."""
    full = f"((CAST(1 AS BIGINT) << length({a})) - 1)"
    mask = (
        f"list_sum(list_transform(range(0, length({a})), lambda k: CASE WHEN substring({a}, CAST(k + 1 AS INT), 1) = "
        f"substring({b}, CAST(i AS INT), 1) THEN CAST(1 AS BIGINT) << k ELSE 0 END))"
    )
    masks = f"list_transform(range(1, length({b}) + 1), lambda i: CAST({mask} AS BIGINT))"
    state = f"list_reduce(list_prepend({full}, {masks}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full})"
    total = f"(length({a}) + length({b}))"
    common = f"(length({a}) - bit_count({state}))"
    return (
        f"CASE WHEN {total} = 0 THEN 1.0 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0 "
        f"ELSE (1.0::DOUBLE - ({total} - 2 * {common})::DOUBLE / {total}::DOUBLE) * 100.0::DOUBLE / 100.0::DOUBLE END"
    )
