"""Batch scoring of logged text responses.  Each response is scored on its own row by
array expressions; only the reports aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from procurelytics import constants as K
from procurelytics.functions import text as tx
from procurelytics.operators.ranking import as_list, series_window


def _share(hits: Column, of: Column, empty: float) -> Column:
    return F.when(F.coalesce(F.size(of), F.lit(0)) > 0, F.size(hits) / F.size(of)).otherwise(empty)


def eval_tool_accuracy(log: DataFrame) -> DataFrame:
    """Share of expected tools that were called (1 if none is expected) and the calls
    nobody expected, repeats kept."""
    expected, actual = F.col("expected_tools"), F.col("actual_tools")
    hits = F.filter(expected, lambda t: F.array_contains(actual, t))
    others = F.when(F.size(expected) > 0, F.filter(actual, lambda t: ~F.array_contains(expected, t)))
    return log.withColumns({
        "tool_accuracy": _share(hits, expected, 1.0),
        "unexpected_tools": F.coalesce(others, F.array().cast("array<string>")),
    })


def _held(phrases: Column, text: Column) -> Column:
    return tx.let(F.lower(text), lambda lowered: F.filter(phrases, lambda p: F.contains(lowered, F.lower(p))))


def eval_keywords(log: DataFrame) -> DataFrame:
    wanted = F.col("required_keywords")
    hits = _held(wanted, F.col("response"))
    return log.withColumns({
        "keyword_hits": F.size(hits),
        "keyword_misses": F.size(wanted) - F.size(hits),
        "keyword_score": _share(hits, wanted, 1.0),
    })


def eval_banned(log: DataFrame) -> DataFrame:
    return log.withColumn("banned_phrase_violations", F.size(_held(F.col("banned_phrases"), F.col("response"))))


def _special_flags() -> Column:
    """Flags of the special checks: a person named after a title, or no word of doubt."""
    response = F.col("response")
    person = F.regexp_extract(response, K.NAMED_PERSON_PATTERN, 1)
    doubt = F.lit(False)
    for phrase in K.UNCERTAINTY_PHRASES:
        doubt = doubt | F.lower(response).contains(phrase)
    return F.array_compact(F.array(
        F.when((F.col("special") == "should_not_name_person") & (F.length(person) > 0),
               F.concat(F.lit("Fabricated person name: "), person)),
        F.when((F.col("special") == "should_express_uncertainty") & ~doubt,
               "Did not express uncertainty when expected"),
    ))


def eval_special(log: DataFrame) -> DataFrame:
    return log.withColumn("special_flags", _special_flags())


def _near(number: Column, known: Column) -> Column:
    exact = (known == 0) & (number == 0)
    return exact | ((known != 0) & (F.abs(F.try_divide(number - known, known)) < 0.05))


def eval_traceability(log: DataFrame) -> DataFrame:
    """Share of a response's numbers within 5% of a tool number.  A response without
    numbers scores 0 and is not checked further; any flag lifts a 0 to 0.5."""
    staged = log.withColumns({
        "_said": tx.amounts(F.col("response"), skip_years=True),
        "_known": tx.amounts(F.array_join("tool_outputs", " ")),
    })
    lost = tx.let(F.col("_known"), lambda known: F.filter("_said", lambda n: ~F.exists(known, lambda t: _near(n, t))))
    staged = staged.withColumn("_lost", lost)
    flags = F.concat(
        F.transform("_lost", lambda n: F.concat(F.lit("Untraceable number: "), n.cast("string"))), _special_flags()
    )
    total = F.size("_said")
    staged = staged.withColumns({
        "numbers_in_response": total,
        "numbers_traceable": total - F.size("_lost"),
        "hallucination_flags": F.when(total > 0, flags).otherwise(F.array().cast("array<string>")),
    })
    share = F.when(total > 0, F.size("_lost") / total).otherwise(0.0)
    score = F.when((F.size("hallucination_flags") > 0) & (share == 0), 0.5).otherwise(share)
    return staged.withColumn("hallucination_score", score).drop("_said", "_known", "_lost")


def eval_groundedness(log: DataFrame) -> DataFrame:
    """Share of sentences with more than 30% of their distinct longer words in the tool
    text; 0.5 without tool output or sentences."""
    tools = F.lower(F.array_join("tool_outputs", " "))
    parts = F.transform(F.split("response", r"[.!?\n]"), lambda s: F.trim(F.regexp_replace(s, r"[\r\t]", " ")))
    staged = log.withColumn("_sentences", F.filter(parts, lambda s: F.length(s) > 20))

    def share_held(words, held):
        return F.try_divide(F.size(F.filter(words, lambda w: F.contains(held, w))), F.size(words))

    def grounded(sentence, held):
        share = tx.let(tx.long_words(F.lower(sentence)), lambda words: share_held(words, held))
        return F.coalesce(share > 0.3, F.lit(False))

    hits = tx.let(tools, lambda held: F.filter("_sentences", lambda s: grounded(s, held)))
    share = F.try_divide(F.size(hits), F.size("_sentences"))
    has_tools = F.coalesce(F.size("tool_outputs"), F.lit(0)) > 0
    score = F.when(has_tools, F.coalesce(share, F.lit(0.5))).otherwise(0.5)
    return staged.withColumn("groundedness_score", score).drop("_sentences")


def in_scope(log: DataFrame, scope="all", max_n=0) -> DataFrame:
    """One difficulty, one category (by slug), or all; ``max_n`` above 0 keeps the first
    prompts by id."""
    if scope in ("easy", "medium", "hard"):
        log = log.where(F.col("difficulty") == scope)
    elif scope != "all":
        slug = F.translate(F.lower("category"), " _", "--")
        log = log.where(slug == scope.lower().replace(" ", "-").replace("_", "-"))
    return log.orderBy("prompt_id").limit(max_n) if max_n > 0 else log


def eval_composite(log: DataFrame, *, weights=K.COMPOSITE_WEIGHTS, scope="all", max_n=0) -> DataFrame:
    """All scores and the weighted total; a response passes at 60 with a hallucination
    score below 0.5."""
    scored = in_scope(log, scope, max_n)
    for step in (eval_tool_accuracy, eval_keywords, eval_banned, eval_traceability, eval_groundedness):
        scored = step(scored)
    tool, keyword, trace, ground, clean = weights
    total = (
        F.col("tool_accuracy") * tool + F.col("keyword_score") * keyword
        + (1 - F.col("hallucination_score")) * trace + F.col("groundedness_score") * ground
        + F.when(F.col("banned_phrase_violations") == 0, 1.0).otherwise(0.0) * clean
    )
    return scored.withColumn("overall_score", total).withColumn(
        "passed", (F.col("overall_score") >= 60) & (F.col("hallucination_score") < 0.5)
    )


def eval_summary(scored: DataFrame, by=None) -> DataFrame:
    """Count, passes and mean scores, overall or per group."""
    passed = F.when(F.col("passed"), 1).otherwise(0)
    return scored.groupBy(*as_list(by)).agg(
        F.count("*").alias("n"),
        F.sum(passed).alias("n_passed"),
        (F.avg(passed) * 100).alias("pass_pct"),
        F.avg("overall_score").alias("avg_score"),
        F.avg("tool_accuracy").alias("avg_tool_accuracy"),
        F.avg("keyword_score").alias("avg_keyword"),
        F.avg("hallucination_score").alias("avg_hallucination"),
        F.avg("groundedness_score").alias("avg_groundedness"),
        F.avg("latency_seconds").alias("avg_latency"),
    )


def failed_prompts(scored: DataFrame) -> DataFrame:
    return scored.where(~F.col("passed")).select(
        "run_id", "prompt_id", "category", "difficulty", "prompt", "overall_score",
        "tool_accuracy", "hallucination_score", "hallucination_flags",
    )


def eval_history(scored: DataFrame) -> DataFrame:
    """One row per run, with the change of its mean score since the first run.  The window
    runs over one reduced row per run, so no response is scored twice."""
    runs = scored.groupBy("run_id").agg(
        F.min("timestamp").alias("started"),
        F.count("prompt_id").alias("n_prompts"),
        F.avg(F.col("passed").cast("double")).alias("pass_rate"),
        F.avg("overall_score").alias("avg_score"),
        F.avg("tool_accuracy").alias("avg_tool_accuracy"),
        F.avg("hallucination_score").alias("avg_hallucination"),
        F.avg("latency_seconds").alias("avg_latency"),
    )
    in_time = series_window(None, "started", "run_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return runs.withColumn("change_since_first", F.col("avg_score") - F.first("avg_score").over(in_time))
