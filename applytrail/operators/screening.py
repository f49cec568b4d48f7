"""Screening questions of job applications to skill and requirement features.

An application's questions arrive in one string, so its features are worked out
inside the row: no explode-and-regroup, no shuffle, and an employer with millions
of applications is spread over as many tasks as its rows are.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applytrail.functions.text import WHITE_SPACE, strip
from applytrail.sources.scratch import cut

# Questions a profile answers by itself.
AUTOFILL_QUESTIONS = (
    "description", "company", "school", "dates of employment", "dates attended",
    "your title", "major / field of study", "degree", "first name", "last name",
    "email address", "mobile phone number", "please submit a resume or linkedin profile",
    "please submit a resume", "headline", "cover letter", "location (city)",
    "location", "city", "state / province", "country", "industry", "photo",
    "summary", "additional attachments", "e-mailadres", "linkedin profile", "linkedin",
    "what is your current location?", "mobiel telefoonnummer",
    "dien een cv of linkedin-profiel in",
)

# Legal and contact questions.
ADMIN_TERMS = (
    "certify", "authorize", "privacy", "background check", "criminal", "submit a resume",
    "cover letter", "first name", "last name", "email", "phone", "location (city)",
)

# Numbers that may be spelled out before "years".
NUMBER_WORDS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")

# Topics and the words that name them.
TOPICS = {
    "Python": ("python",),
    "SQL": ("sql", "mysql", "postgresql", "access", "nosql"),
    "Excel": ("excel", "spreadsheet", "pivot table", "pivottable"),
    "PowerBI": ("powerbi", "power bi"),
    "Tableau": ("tableau",),
    "DataVisualisation": ("visualization", "visualisation"),
    "AWS": ("aws", "amazon web services"),
    "Azure": ("azure",),
    "Git": ("git", "version control"),
    "NLP": ("nlp", "natural language processing"),
    "OCR": ("ocr", "optical character recognition"),
    "RPA": ("rpa", "robotic process automation"),
    "GIS": ("gis", "spatial data"),
    "Pandas_Numpy": ("pandas", "numpy"),
    "Scikit_Learn": ("scikit-learn", "scikit learn"),
    "Linux": ("linux", "linux command line", "ubuntu"),
    "SSIS": ("ssis", "sql server integration services"),
    "Medidata": ("medidata", "medidata rave"),
    "DevOps": (
        "web development framework", "backend systems", "frontend", "full stack", "full-stack",
        "devops", "scrum",
    ),
    "DataScience": ("data science", "machine learning", "ai ", "artificial intelligence"),
    "DataEngineering": ("data engineering", "data pipelines", "etl", "extract", "transform", "load"),
    "DataAnalysis": ("data analysis", "analytics", "business analyst"),
    "BankingFinancial": (
        "financial services", "finance", "investment management", "portfolio construction",
        "banking", "private client investment platforms",
    ),
    "CustomerSuccess": ("customer success", "customer support", "client reporting"),
    "ConsultingStrategy": (
        "consulting", "advisory", "analysis", "strategy", "planning", "stra", "digital strategy",
    ),
    "OR": ("process", "operations research", "process engineer", "optimisation", "optimization"),
    "Hardware": ("physical products", "solar", "battery", "inverter", "networking"),
    "SupplyChain": ("supply chain", "supl", "logistics", "operations"),
    "Sales": ("sales", "sale", "b2b"),
    "Management": ("management", "mgmt"),
    "Engineering": ("engineering", "eng", "engineer", "construction"),
    "Hospitality": ("hospitality", "food and beverage services", "service"),
    "Automotive": ("automotive", "parts industry"),
    "ClientFacing": ("client-facing", "customer-facing", "front office environment"),
    "Lang_English": ("english", "eng"),
    "Lang_Afrikaans": ("afrikaans", "afr"),
    "Lang_Arabic": ("arabic", "ara"),
    "Lang_Chinese": ("chinese", "chi"),
    "Lang_Dutch": ("dutch", "dut"),
    "Ind_IT": ("urn:li:industry:116", "urn:li:industry:96", "urn:li:industry:4"),
    "Ind_ManagementConsulting": ("urn:li:industry:11",),
    "Ind_RealEstate": ("urn:li:industry:30",),
    "Ind_Logistics": ("urn:li:industry:31",),
    "Ind_Hospitality": ("urn:li:industry:34",),
    "Ind_Banking": ("urn:li:industry:41",),
    "Ind_FinancialServices": ("urn:li:industry:43",),
    "Ind_Construction": ("urn:li:industry:48",),
    "Ind_Healthcare": ("urn:li:industry:14",),
    "Ind_Retail": ("urn:li:industry:27",),
}

METADATA = ("Application_Date", "Company_Name", "Job_Title", "Job_Url")
REQUIREMENT_FLAGS = (
    "Req_Hybrid", "Req_Remote", "Req_Onsite", "Ask_Visa_Auth", "Req_Bachelors", "Req_Masters",
)
WHOLE = 2**31 - 1   # longer than any text
QUESTION_TYPE = "array<struct<position:int,question:string,answer:string>>"


INDUSTRY_PREFIX = "urn:li:industry:"
INDUSTRIES = {t: synonyms for t, synonyms in TOPICS.items() if t.startswith("Ind_")}
SKILLS = {t: synonyms for t, synonyms in TOPICS.items() if t not in INDUSTRIES}


def _words(synonyms: tuple[str, ...]) -> str:
    return r"(?U)\b(?:" + "|".join(re.escape(s) for s in synonyms) + r")\b"


WORD_BREAK = r"(?U)\W+"
# a synonym of word characters only is looked up among a text's words, any other is a phrase
PHRASES = [(s, t) for t, synonyms in SKILLS.items() for s in synonyms if not s.isalnum()]
TOPICS_OF_WORD: dict[str, list[str]] = {}
for _topic, _synonyms in SKILLS.items():
    for _word in filter(str.isalnum, _synonyms):
        TOPICS_OF_WORD.setdefault(_word, []).append(_topic)
# a phrase occurs as words only in a text that has its first word
OPENERS = sorted({re.match(r"\w+", p).group() for p, _ in PHRASES})


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _stripped(trimmed: Column) -> Column:
    """A text without blanks at its ends stripped of other white space, which few texts have."""
    edge = F.left(trimmed, F.lit(1)).isin(*WHITE_SPACE) | F.right(trimmed, F.lit(1)).isin(*WHITE_SPACE)
    return F.when(edge, strip(trimmed)).otherwise(trimmed)


def _differ(rows: Column, field: str) -> Column:
    """Whether no two of an array's structs agree in a field."""
    return F.size(F.array_distinct(F.transform(rows, lambda r: r[field]))) == F.size(rows)


def parse_questions(c: Column) -> Column:
    """``q: a | q: a`` text to an array of (position, question, answer).

    A repeated question keeps its first position and its last answer; only rows that have
    one fold their questions one by one. Every step reads the one before it through its
    lambda argument: a column used inside a lambda would be worked out again for each element.
    """
    def row(position: Column, question: Column, answer: Column) -> Column:
        return F.struct(position.alias("position"), question.alias("question"), answer.alias("answer"))

    fields = F.filter(F.split(c, r"\|(?=[^|:]+:)"), lambda f: f.contains(":"))
    cells = F.transform(fields, lambda f, i: row(
        i + 1, F.trim(F.substring_index(f, ":", 1)), F.trim(F.substring(f, F.instr(f, ":") + 1, F.lit(WHOLE)))))
    pairs = F.transform(cells, lambda q: row(q["position"], _stripped(q["question"]), _stripped(q["answer"])))

    def add(seen: Column, q: Column) -> Column:
        again = F.exists(seen, lambda s: s["question"] == q["question"])
        replaced = F.transform(seen, lambda s: row(
            s["position"], s["question"],
            F.when(s["question"] == q["question"], q["answer"]).otherwise(s["answer"])))
        appended = F.concat(seen, F.array(row(F.size(seen) + 1, q["question"], q["answer"])))
        return F.when(again, replaced).otherwise(appended)

    none = F.array().cast(QUESTION_TYPE)
    listed = _bound(pairs, lambda ps: F.when(_differ(ps, "question"), ps).otherwise(F.aggregate(ps, none, add)))
    return F.coalesce(listed, none)


def with_questions(df: DataFrame, source: str = "Question And Answers") -> DataFrame:
    return df.withColumn("questions", parse_questions(F.col(f"`{source}`")))


def _rows(exploded: DataFrame, column: str) -> DataFrame:
    """Rows of an outer explode without the ones standing for an empty array.

    A plain explode makes Spark filter on the array's size first, which computes the
    whole array a second time.
    """
    return exploded.filter(F.col(column).isNotNull())


def explode_questions(df: DataFrame) -> DataFrame:
    """Long table: one row per application and distinct question."""
    others = [c for c in df.columns if c != "questions"]
    return _rows(df.select(*others, F.inline_outer("questions")), "position")


def is_admin_question(question: Column) -> Column:
    return _is_admin(F.lower(question))


def _is_admin(lowered: Column) -> Column:
    return reduce(Column.__or__, [lowered.contains(t) for t in ADMIN_TERMS], lowered.isin(*AUTOFILL_QUESTIONS))


def drop_admin_questions(df: DataFrame) -> DataFrame:
    return df.filter(~is_admin_question(F.col("question")))



def _by_initial(words: tuple[str, ...]) -> str:
    """A pattern of words that tries only those of the initial that stands there."""
    of: dict[str, list[str]] = {}
    for w in words:
        of.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{initial}(?:{'|'.join(rest)})" for initial, rest in of.items())


YEARS_PATTERN = r"(?U)(\d+|" + _by_initial(NUMBER_WORDS) + r")\s*\+?\s*years?"


def _as_number(word: Column) -> Column:
    spelled = F.when(word.isin(*NUMBER_WORDS), F.array_position(F.array(*[F.lit(w) for w in NUMBER_WORDS]), word).cast("int"))
    return F.when(word.rlike(r"^\d+$"), word.try_cast("int")).otherwise(spelled)


def required_years(question: Column) -> Column:
    """The first number, in digits or words, directly before ``year(s)``."""
    return _years(F.lower(question))


def _years(lowered: Column) -> Column:
    return F.when(lowered.contains("year"), _bound(F.regexp_extract(lowered, YEARS_PATTERN, 1), _as_number))


def telling_words(lowered: Column) -> Column:
    """Words of a lower-case text that name a topic or open a phrase that does."""
    plain = F.length(lowered) == F.octet_length(lowered)   # ASCII only, where the plain class is the same and cheaper
    words = F.when(plain, F.split(lowered, r"\W+")).otherwise(F.split(lowered, WORD_BREAK))
    return F.filter(words, lambda w: w.isin(*{*TOPICS_OF_WORD, *OPENERS}))


def skill_topics(lowered: Column, words: Column) -> Column:
    """Skill topics a lower-case text and its ``telling_words`` mention.

    Single words are found by lookup; phrases are looked for where a word opens one, and
    need their pattern only where they occur.
    """
    none = F.array().cast("array<string>")
    known = F.create_map(*[
        x for word, names in TOPICS_OF_WORD.items()
        for x in (F.lit(word), F.array(*[F.lit(n) for n in names]))])
    by_word = F.flatten(F.transform(words, lambda w: F.coalesce(F.try_element_at(known, w), none)))
    by_phrase = F.array_compact(F.array(*[
        F.when(lowered.contains(phrase) & lowered.rlike(_words((phrase,))), F.lit(topic))
        for phrase, topic in PHRASES]))
    named = F.when(F.exists(words, lambda w: w.isin(*OPENERS)), F.concat(by_word, by_phrase)).otherwise(by_word)
    return F.when(F.size(words) > 0, F.array_distinct(named)).otherwise(none)


def industry_topics(lowered: Column) -> Column:
    """Industry topics of the codes in a lower-case text; of the first code if none is listed."""
    found = F.array_compact(F.array(*[
        F.when(lowered.rlike(_words(synonyms)), F.lit(topic)) for topic, synonyms in INDUSTRIES.items()]))
    code = F.nullif(F.regexp_extract(lowered, INDUSTRY_PREFIX + r"(\d+)", 1), F.lit(""))
    unlisted = F.array_compact(F.array(F.concat(F.lit("Ind_URN_"), code)))
    return _bound(found, lambda listed: F.when(F.size(listed) > 0, listed).otherwise(unlisted))


def _read(questions: Column, carried: tuple[str, ...], whole_field: bool, admin: bool, numbered: bool) -> Column:
    """Structs of ``carried`` fields of questions, their ``topics``, ``required_years`` and ``flags``.

    Each step copies what it passes on, so no step passes on more than the next ones read.
    Without ``numbered`` only questions that can have a topic are searched for years.
    """
    def kept(q: Column) -> list[Column]:
        return [q[c].alias(c) for c in carried]

    texts = F.transform(questions, lambda q: F.struct(
        *kept(q), F.lower(q["question"]).alias("text"),
        F.lower(F.concat_ws(":", q["question"], q["answer"]) if whole_field else q["question"]).alias("field")))
    if not admin:
        texts = F.filter(texts, lambda q: ~_is_admin(q["text"]))
    worded = F.transform(texts, lambda q: F.struct(
        *kept(q), q["text"].alias("text"), telling_words(q["text"]).alias("words"),
        F.when(q["field"].contains(INDUSTRY_PREFIX), q["field"]).alias("field")))

    def years(q: Column) -> Column:
        return _years(q["text"]) if numbered else F.when((F.size(q["words"]) > 0) | q["field"].isNotNull(), _years(q["text"]))

    return F.transform(worded, lambda q: F.struct(
        *kept(q),
        F.when(q["field"].isNotNull(), F.concat(skill_topics(q["text"], q["words"]), industry_topics(q["field"])))
        .otherwise(skill_topics(q["text"], q["words"])).alias("topics"),
        years(q).alias("required_years"),
        _flags(q["text"]).alias("flags"),
    ))


def read_questions(questions: Column, whole_field: bool = True, admin: bool = True) -> Column:
    """Question structs plus their ``topics``, ``required_years`` and requirement ``flags``.

    Industry codes sit in the answer, after the first colon. ``whole_field`` looks for
    them over question and answer; other topics only read questions. ``admin`` says whether
    legal and contact questions are among them.
    """
    return _read(questions, ("position", "question", "answer"), whole_field, admin, numbered=True)


def tag_topics(df: DataFrame, whole_field: bool = True) -> DataFrame:
    """Long table of the questions that count, with topics, required years and flags."""
    others = [c for c in df.columns if c != "questions"]
    return _rows(df.select(*others, F.inline_outer(read_questions(F.col("questions"), whole_field, admin=False))), "position")


# Flags and the terms that raise them; of a group the first counts.
WORK_MODES = (("Req_Hybrid", ("hybrid",)), ("Req_Remote", ("remote",)), ("Req_Onsite", ("onsite", "office")))
VISA = (("Ask_Visa_Auth", ("visa", "sponsorship")),)
DEGREES = (("Req_Bachelors", ("bachelor", "bsc")), ("Req_Masters", ("master", "msc")))


def _flag(lowered: Column, group: tuple, shown: Callable[[str], Column] = F.lit) -> Column:
    """The first flag of a group that a lower-case text raises, as ``shown``; else null."""
    choices = [F.when(reduce(Column.__or__, [lowered.contains(t) for t in terms]), shown(name)) for name, terms in group]
    return F.coalesce(*choices)


def _flags(lowered: Column) -> Column:
    """All flags that a lower-case text raises."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(_flag(lowered, g, lambda n: F.array(F.lit(n))), none) for g in (WORK_MODES, VISA, DEGREES)])


def work_mode_flag(question: Column) -> Column:
    return _flag(F.lower(question), WORK_MODES)


def visa_flag(question: Column) -> Column:
    return _flag(F.lower(question), VISA)


def degree_flag(question: Column) -> Column:
    return _flag(F.lower(question), DEGREES)


def with_features(df: DataFrame, whole_field: bool = True) -> DataFrame:
    """Add ``features``, a map from feature name to required years (null for flags).

    Reads the ``questions`` array of the row; of several years for one feature the
    last question's count stays.
    """
    feature_type = "array<struct<feature:string,years:int>>"

    def named(names: Column, prefix: str, years: Column) -> Column:
        return F.transform(names, lambda n: F.struct(
            F.concat(F.lit(prefix), n).alias("feature"), years.cast("int").alias("years")))

    none, nothing = F.lit(None), F.array().cast(feature_type)
    read = _read(F.col("questions"), (), whole_field, admin=False, numbered=False)
    listed = F.flatten(F.transform(read, lambda r: F.concat(
        F.when(F.size(r["topics"]) == 0, nothing).when(r["required_years"].isNull(), named(r["topics"], "Ask_", none)).otherwise(
            F.concat(named(r["topics"], "Ask_", none), named(r["topics"], "Req_Years_", r["required_years"]))),
        F.when(F.size(r["flags"]) == 0, nothing).otherwise(named(r["flags"], "", none)),
    )))

    def add(seen: Column, f: Column) -> Column:
        again = F.exists(seen, lambda s: s["feature"] == f["feature"])
        replaced = F.transform(seen, lambda s: F.when(s["feature"] == f["feature"], f).otherwise(s))
        return F.when(again, replaced).otherwise(F.concat(seen, F.array(f)))

    once = _bound(listed, lambda fs: F.when(_differ(fs, "feature"), fs).otherwise(
        F.aggregate(fs, nothing, add)))
    return df.withColumn("features", F.map_from_entries(once))


def long_features(df: DataFrame) -> DataFrame:
    """One (feature, years) row per feature an application shows."""
    others = [c for c in df.columns if c not in ("features", "questions")]
    return _rows(df.select(*others, F.explode_outer("features").alias("feature", "years")), "feature")


def pinned_features() -> list[str]:
    """Every feature name the fixed topic list can produce, in order."""
    per_topic = [f"{kind}_{t}" for t in TOPICS for kind in ("Ask", "Req_Years")]
    return per_topic + list(REQUIREMENT_FLAGS)


def feature_names(long: DataFrame, thresh: int = 2) -> DataFrame:
    """Feature names carried by at least ``thresh`` applications."""
    return (
        long.groupBy("feature").agg(F.count(F.lit(1)).alias("applications"))
        .filter(F.col("applications") >= thresh)
    )


def ordered_features(df: DataFrame, thresh: int = 2) -> list[str]:
    """Names carried by at least ``thresh`` applications: listed ones in order, then unlisted industries.

    The names are the matrix' columns, so they must reach the driver; industry codes are few.
    """
    found = {r["feature"] for r in feature_names(long_features(df.select("features")), thresh).collect()}
    listed = [f for f in pinned_features() if f in found]
    return listed + sorted(found.difference(listed))


def feature_matrix(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """One column per feature: years as numbers, the rest as flags, null where absent.

    ``features`` pins the columns (the fixed list by default), so no extra pass over
    the data has to find them.
    """
    others = [c for c in df.columns if c not in ("features", "questions")]
    cells = [
        (F.try_element_at("features", F.lit(f)) if f.startswith("Req_Years_")
         else F.when(F.map_contains_key("features", f), F.lit(True))).alias(f)
        for f in (features if features is not None else pinned_features())
    ]
    return df.select(*others, *cells)


def drop_sparse(df: DataFrame, columns: list[str], thresh: int = 2) -> DataFrame:
    """Drop those of ``columns`` with fewer than ``thresh`` values.

    Counting is one aggregate over the frame; its single row decides the schema, so
    this is the one step that runs a job while the plan is being built. The frame is
    written once, and both the count and its reader start from there.
    """
    df = cut(df, "sparse")
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if counts[c] < thresh])


def fill_flags(df: DataFrame) -> DataFrame:
    """Missing flags become false; missing years stay null."""
    flags = [c for c, t in df.dtypes if c.startswith(("Ask_", "Req_")) and t == "boolean"]
    return df.fillna(False, subset=flags) if flags else df


def skill_frequency(long: DataFrame) -> DataFrame:
    """Applications asking for each topic."""
    asked = long.filter(F.col("feature").startswith("Ask_"))
    return asked.groupBy(F.substr("feature", F.lit(5)).alias("topic")).agg(
        F.count(F.lit(1)).alias("applications")
    )


def skill_by_month(long: DataFrame, date: str) -> DataFrame:
    """Applications asking for each topic, per month."""
    asked = long.filter(F.col("feature").startswith("Ask_"))
    return asked.groupBy(
        F.substr("feature", F.lit(5)).alias("topic"), F.date_trunc("month", F.col(date)).alias("month")
    ).agg(F.count(F.lit(1)).alias("applications"))
