"""Notice classification over whole documents and scoring of logged responses."""

from pyspark.sql import functions as F

from procurelytics import constants as K
from procurelytics.operators import evaluate, keywords
from procurelytics.plans import bindings as B
from procurelytics.plans.catalog import views as V
from procurelytics.plans.registry import query, shown, sql
from procurelytics.sources import payloads


def held(words):
    return " OR ".join(f"contains(lower(title), {V.text(w)})" for w in words)


RULES = " ".join(f"WHEN {held(words)} THEN '{label}'" for words, label in K.EVENT_RULES)
COUNTRY = " ".join(f"WHEN contains(lower(title), {V.text(name)}) THEN {V.text(name)}" for name in K.COUNTRY_NAMES)
CODES = "[" + ", ".join(V.text(c) for c in K.HTS_DESCRIPTIONS) + "]"


@query("classify_events", sql("notices", f"SELECT doc_id, CASE {RULES} ELSE 'TRADE_NOTICE' END AS event_type FROM notices", ints="doc_id"))
def classify_events(spark, d):
    return shown(payloads.classify_events(B.notices(spark, d), "title"), "doc_id", "event_type")


@query("extract_country", sql("notices", f"""
SELECT doc_id, country_code, coalesce({V.mapped('country_code', K.WATCHED_COUNTRIES)}, upper(word)) AS country_name FROM (
SELECT *, {V.mapped('word', K.COUNTRY_NAMES)} AS country_code FROM (SELECT doc_id, CASE {COUNTRY} END AS word FROM notices))""", ints="doc_id"))
def extract_country(spark, d):
    return shown(payloads.extract_country(B.notices(spark, d), "title"), "doc_id", "country_code", "country_name")


@query("extract_hts", sql("notices", f"""
SELECT doc_id, hts_code, {V.mapped('hts_code', K.HTS_DESCRIPTIONS, "''")} AS hts_description FROM (
SELECT doc_id, coalesce(list_filter(regexp_extract_all(title, '\\b(\\d{{4}})\\b', 1), lambda t: list_contains({CODES}, t))[1], '0000') AS hts_code FROM notices)""", ints="doc_id"))
def extract_hts(spark, d):
    return shown(payloads.extract_hts(B.notices(spark, d), "title"), "doc_id", "hts_code", "hts_description")


@query("severity_score", sql("notices", f"""
SELECT doc_id, {V.mapped('upper(doc_type)', K.NOTICE_SEVERITY, "'MODERATE'")} AS severity, {V.mapped('upper(doc_type)', K.NOTICE_IMPACT, '30')} AS impact_score
FROM notices""", ints="doc_id", doubles="impact_score"))
def severity_score(spark, d):
    return shown(payloads.severity_score(B.notices(spark, d), "doc_type"), "doc_id", "severity", "impact_score")


@query("keyword_table", sql("notices", """
SELECT doc_id, keyword, coalesce(label, 'NONE') AS label FROM (
  SELECT doc_id, min(place) AS place FROM notices LEFT JOIN ranked ON contains(lower(title), keyword) GROUP BY doc_id)
LEFT JOIN ranked USING (place)""", ints="doc_id").replace("WITH ", """WITH items AS (SELECT item_id, string_split(lower(text), ' ') AS w FROM benchmark),
phrases AS (SELECT item_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS keyword FROM items),
ranked AS (SELECT keyword, min(CAST(item_id AS VARCHAR)) AS label, row_number() OVER (ORDER BY length(keyword) DESC, keyword) AS place FROM phrases GROUP BY 1),
""", 1))
def keyword_table(spark, d):
    """Whole notices against a table of phrases that grows with the benchmark."""
    out = keywords.first_keyword(B.notices(spark, d), "title", B.phrase_table(spark, d), otherwise="NONE")
    return shown(out, "doc_id", "keyword", "label")


@query("keyword_rules", sql("notices", f"SELECT doc_id, CASE {RULES} ELSE 'TRADE_NOTICE' END AS event_type FROM notices", ints="doc_id"))
def keyword_rules(spark, d):
    """The rules of ``classify_events`` as a keyword table."""
    rules = keywords.rule_table(spark, K.EVENT_RULES)
    out = keywords.first_keyword(B.notices(spark, d), "title", rules, otherwise=K.DEFAULT_EVENT_TYPE, into=("word", "event_type"))
    return shown(out, "doc_id", "event_type")


# --- responses ---------------------------------------------------------------------------
@query("eval_tool_accuracy", sql("eval_scored", "SELECT prompt_id, tool_accuracy, array_to_string(unexpected, '|') AS unexpected_tools FROM eval_scored", doubles="tool_accuracy"))
def eval_tool_accuracy(spark, d):
    return shown(evaluate.eval_tool_accuracy(B.evaluation_log(spark, d)), "prompt_id", "tool_accuracy", "unexpected_tools")


@query("eval_keywords", sql("eval_scored", """
SELECT prompt_id, len(kw) AS keyword_hits, len(required_keywords) - len(kw) AS keyword_misses, keyword_score FROM eval_scored""",
                            ints="keyword_hits keyword_misses", doubles="keyword_score"))
def eval_keywords(spark, d):
    return shown(evaluate.eval_keywords(B.evaluation_log(spark, d)), "prompt_id", "keyword_hits", "keyword_misses", "keyword_score")


@query("eval_banned", sql("eval_scored", "SELECT prompt_id, banned_phrase_violations FROM eval_scored", ints="banned_phrase_violations"))
def eval_banned(spark, d):
    return shown(evaluate.eval_banned(B.evaluation_log(spark, d)), "prompt_id", "banned_phrase_violations")


@query("eval_traceability", sql("eval_scored", "SELECT prompt_id, numbers_in_response, numbers_traceable, n_flags, hallucination_score FROM eval_scored",
                                ints="numbers_in_response numbers_traceable n_flags", doubles="hallucination_score"))
def eval_traceability(spark, d):
    out = evaluate.eval_traceability(B.evaluation_log(spark, d))
    return shown(out, "prompt_id", "numbers_in_response", "numbers_traceable", F.size("hallucination_flags").alias("n_flags"), "hallucination_score")


@query("eval_special", sql("eval_scored", "SELECT prompt_id, n_special FROM eval_scored", ints="n_special"))
def eval_special(spark, d):
    return shown(evaluate.eval_special(B.evaluation_log(spark, d)), "prompt_id", F.size("special_flags").alias("n_special"))


@query("eval_groundedness", sql("eval_scored", "SELECT prompt_id, groundedness_score FROM eval_scored", doubles="groundedness_score"))
def eval_groundedness(spark, d):
    return shown(evaluate.eval_groundedness(B.evaluation_log(spark, d)), "prompt_id", "groundedness_score")


@query("eval_composite", sql("eval_scored", """
SELECT run_id, prompt_id, category, difficulty, tool_accuracy, keyword_score, hallucination_score, groundedness_score, overall_score, passed FROM eval_scored""",
                             doubles="tool_accuracy keyword_score hallucination_score groundedness_score overall_score"))
def eval_composite(spark, d):
    return shown(evaluate.eval_composite(B.evaluation_log(spark, d)), "run_id", "prompt_id", "category", "difficulty", "tool_accuracy",
                 "keyword_score", "hallucination_score", "groundedness_score", "overall_score", "passed")


def summary(by):
    group = f"{by}, " if by else ""
    return sql("eval_scored", f"""
SELECT {group}count(*) AS n, sum(CASE WHEN passed THEN 1 ELSE 0 END) AS n_passed, avg(CASE WHEN passed THEN 100.0 ELSE 0.0 END) AS pass_pct,
       avg(overall_score) AS avg_score, avg(tool_accuracy) AS avg_tool_accuracy, avg(keyword_score) AS avg_keyword,
       avg(hallucination_score) AS avg_hallucination, avg(groundedness_score) AS avg_groundedness, avg(latency_seconds) AS avg_latency
FROM eval_scored {'GROUP BY 1' if by else ''}""", ints="n n_passed",
               doubles="pass_pct avg_score avg_tool_accuracy avg_keyword avg_hallucination avg_groundedness avg_latency")


@query("eval_by_category", summary("category"))
def eval_by_category(spark, d):
    return shown(evaluate.eval_summary(evaluate.eval_composite(B.evaluation_log(spark, d)), "category"))


@query("eval_by_difficulty", summary("difficulty"))
def eval_by_difficulty(spark, d):
    return shown(evaluate.eval_summary(evaluate.eval_composite(B.evaluation_log(spark, d)), "difficulty"))


@query("eval_summary", summary(None))
def eval_summary(spark, d):
    return shown(evaluate.eval_summary(evaluate.eval_composite(B.evaluation_log(spark, d))))


@query("failed_prompts", sql("eval_scored", """
SELECT run_id, prompt_id, category, difficulty, prompt, overall_score, tool_accuracy, hallucination_score, n_flags
FROM eval_scored WHERE NOT passed""", ints="n_flags", doubles="overall_score tool_accuracy hallucination_score"))
def failed_prompts(spark, d):
    out = evaluate.failed_prompts(evaluate.eval_composite(B.evaluation_log(spark, d)))
    return shown(out.withColumn("n_flags", F.size("hallucination_flags")).drop("hallucination_flags"))


@query("eval_scope", sql("eval_scored", """
SELECT prompt_id, difficulty, category, overall_score, passed FROM eval_scored WHERE difficulty = 'hard'
UNION ALL SELECT prompt_id, difficulty, category, overall_score, passed FROM eval_scored WHERE category = 'multi-tool'""", doubles="overall_score"))
def eval_scope(spark, d):
    """The two kinds of scope: a difficulty, and a category by its slug."""
    log, columns = B.evaluation_log(spark, d), ["prompt_id", "difficulty", "category", "overall_score", "passed"]
    return shown(evaluate.eval_composite(log, scope="hard").select(columns).unionByName(evaluate.eval_composite(log, scope="Multi Tool").select(columns)))


@query("eval_history", sql("eval_scored", """
SELECT *, avg_score - first_value(avg_score) OVER (ORDER BY started, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS change_since_first FROM (
SELECT run_id, min(ts) AS started, count(*) AS n_prompts, avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END) AS pass_rate, avg(overall_score) AS avg_score,
       avg(tool_accuracy) AS avg_tool_accuracy, avg(hallucination_score) AS avg_hallucination, avg(latency_seconds) AS avg_latency
FROM eval_scored GROUP BY 1)""", ints="n_prompts",
                           doubles="pass_rate avg_score avg_tool_accuracy avg_hallucination avg_latency change_since_first"))
def eval_history(spark, d):
    return shown(evaluate.eval_history(evaluate.eval_composite(B.evaluation_log(spark, d))))
