"""Functions that SQL text can call: vetting of a statement as a table function and as an array, and a question's intent.

They are temporary SQL functions of the session, written from the same rules as their DataFrame forms, so a
plan holds plain expressions and no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from leakscope.operators.guard import GUARD_RULES, INTENT_SOURCES, INTENT_WORDS, GuardRule

FINDING = "guard_type STRING, pattern STRING, message STRING"


def literal(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _broken(argument: str, rule: GuardRule) -> str:
    if rule.guard_mode == "exact":
        return f"{argument} = {literal(rule.pattern)}"
    if rule.guard_mode == "contains":
        return f"{argument} ILIKE {literal('%' + rule.pattern + '%')}"
    if rule.guard_mode == "regex":
        return f"{argument} RLIKE {literal('(?is)' + rule.pattern)}"
    raise ValueError(f"unknown guard mode {rule.guard_mode}")


def register(spark: SparkSession, rules: Sequence[GuardRule] = GUARD_RULES) -> None:
    """Make ``sql_findings``, ``validate_sql``, ``question_intent`` and ``question_sources`` known to the session's SQL.

    ``SELECT * FROM validate_sql('...')`` vets one statement. For a table of statements
    ``SELECT id, inline(found) FROM (SELECT id, sql_findings(text) AS found FROM t)`` tests each where it is, without a join.
    A null statement breaks no rule.
    """
    fields = [f"named_struct('guard_type', {literal(r.guard_type)}, 'pattern', {literal(r.pattern)}, "
              f"'message', {literal(r.message)})" for r in rules]
    tested = ", ".join(f"CASE WHEN {_broken('statement', r)} THEN {f} END" for r, f in zip(rules, fields, strict=True))
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION sql_findings(statement STRING)
        RETURNS ARRAY<STRUCT<guard_type: STRING, pattern: STRING, message: STRING>>
        RETURN array_compact(array({tested}))""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION validate_sql(statement STRING) RETURNS TABLE ({FINDING})
        RETURN SELECT guard_type, pattern, message FROM (SELECT inline(found) FROM (SELECT sql_findings(statement) AS found))""")
    cases = " ".join(
        f"WHEN {' OR '.join(f'contains(lower(question), {literal(w)})' for w in words)} THEN {literal(name)}"
        for name, words in INTENT_WORDS)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION question_intent(question STRING) RETURNS STRING
        RETURN CASE {cases} END""")
    sources = " ".join(f"WHEN {literal(name)} THEN array({', '.join(map(literal, found))})" for name, found in INTENT_SOURCES.items())
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION question_sources(question STRING) RETURNS ARRAY<STRING>
        RETURN CASE question_intent(question) {sources} END""")
