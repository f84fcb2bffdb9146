"""Session events and transcripts: state, text, usage, result lines, grading, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def session_state(events: DataFrame, session: str = "session", order: str = "ord") -> DataFrame:
    """The last status of each session: done, blocked (idle but an action is asked for), failed, running."""
    status = events.where(F.col("type").startswith("session.status_"))
    last = status.groupBy(session).agg(F.max_by(F.struct("type", "stop_reason"), order).alias("s"))
    idle = F.col("s.type") == "session.status_idle"
    state = F.when(idle & (F.col("s.stop_reason") == "requires_action"), "blocked").when(idle, "done").when(F.col("s.type") == "session.status_terminated", "failed").otherwise("running")
    return last.select(session, state.alias("state"))


def transcript(events: DataFrame, session: str = "session", order: str = "ord") -> DataFrame:
    """Message texts of each session in order, joined by blank lines. A session's messages meet in one row: it is their concatenation."""
    texts = events.where("type = 'agent.message'").select(session, order, F.posexplode("texts").alias("block", "text"))
    return texts.groupBy(session).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "block", "text"))), lambda s: s["text"]), "\n\n").alias("transcript"))


def usage(events: DataFrame, session: str = "session") -> DataFrame:
    """Tokens by session and kind; what isn't a number counts as 0."""
    return events.where("model_usage is not null").select(session, F.explode("model_usage").alias("kind", "n")).groupBy(session, "kind").agg(F.sum(F.coalesce(F.col("n").try_cast("long"), F.lit(0))).alias("tokens"))


def result_lines(transcripts: DataFrame, id_pattern: str = "[A-Z][A-Z0-9]*[0-9]", session: str = "session") -> DataFrame:
    """Lines ``ID key=value ...``: per session and id the fields of its last line, and how many there were."""
    from quillspark.functions.text import clean_value, unwrap

    lines = transcripts.select(session, F.posexplode(F.split("transcript", "\n")).alias("pos", "raw")).withColumn("line", unwrap(F.col("raw")))
    hits = lines.where(F.col("line").rlike(f"^{id_pattern}\\s+[A-Za-z_]+="))
    pair = F.regexp_extract_all("line", F.lit(r"([A-Za-z_]+)=(?:\"[^\"]*\"|\S+)"), F.lit(0))
    fields = F.map_from_entries(F.transform(pair, lambda p: F.struct(F.substring_index(p, "=", 1), clean_value(F.regexp_replace(p, "^[^=]*=", "")))))
    found = hits.select(session, "pos", F.regexp_extract("line", f"^({id_pattern})", 1).alias("id"), "line", fields.alias("fields"))
    return found.groupBy(session, "id").agg(F.max_by("fields", "pos").alias("fields"), F.max_by("line", "pos").alias("line"), F.count(F.lit(1)).alias("occurrences"))


def grade(results: DataFrame, transcripts: DataFrame, checks: DataFrame, session: str = "session") -> DataFrame:
    """Each check (id, field, expected, pattern, evidence) against each session's lines: passed and why not.

    ``expected`` is compared, ``pattern`` searched in the field, ``evidence`` in the transcript; null
    ones don't matter. A check without line fails. The checks, written by hand, go to the sessions as
    one array of a subquery: a session has a row for each check, whether it has its line or not.
    """
    names = ("id", "field", "expected", "pattern", "evidence")
    every = checks.agg(F.collect_list(F.struct(*(F.col(c).cast("string").alias(c) for c in names))).alias("c")).scalar()
    c = transcripts.withColumn("__every", every).select(*(F.col(x) for x in transcripts.columns), F.explode("__every").alias("__c")).select(*transcripts.columns, "__c.*")
    j = c.join(results.select(session, "id", "fields", "occurrences"), [session, "id"], "left")
    value = F.col("fields")[F.col("field")]
    ok = lambda cond, when: F.when(when.isNull(), True).otherwise(F.coalesce(cond, F.lit(False)))
    why = F.when(F.col("fields").isNull(), "no line").when(~ok(value == F.col("expected"), F.col("expected")), "another value").when(~ok(F.regexp_like(value, F.col("pattern")), F.col("pattern")), "no match").when(~ok(F.regexp_like("transcript", F.concat(F.lit("(?m)"), F.col("evidence"))), F.col("evidence")), "no evidence")
    return j.select(session, "id", "field", why.isNull().alias("passed"), why.alias("why"), F.coalesce("occurrences", F.lit(0)).alias("occurrences"))


def verdicts(graded: DataFrame, session: str = "session") -> DataFrame:
    return graded.groupBy(session).agg(F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def prompt(checks: DataFrame) -> DataFrame:
    """The format table a session is asked for, from the rows that grade it."""
    lines = F.array_sort(F.collect_list(F.struct("id", "field", "ask")))
    return checks.agg(F.array_join(F.transform(lines, lambda s: F.concat(s["id"], F.lit(" "), s["field"], F.lit("=<"), s["ask"], F.lit(">"))), "\n").alias("prompt"))


def reusable(cache: DataFrame, config: Column, model: Column) -> DataFrame:
    """Cached agents that fit: same model and same digest of the configuration."""
    return cache.where((F.col("model") == model) & (F.col("config_sha") == F.sha2(config.cast("binary"), 256)) & (F.coalesce("id", F.lit("")) != ""))
