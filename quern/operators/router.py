"""Routing of tasks to models: a score from length and keywords, a capability filter, and the first of a rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that make a task complex, wherever they occur in it; fixed values.
KEYWORDS = ["design", "analysis", "explain", "compare", "translate", "optimize", "refactor", "bug", "debug", "legal", "medical", "code", "implement", "security", "accuracy"]
MODEL = "name string, provider string, cost_score double, power_score double, capabilities array<string>"


def task_score(task: Column) -> Column:
    t = F.lower(task)
    n = F.length(t)
    score = F.when(n > 200, 3).when(n > 80, 2).when(n > 40, 1).otherwise(0)
    for word in KEYWORDS:
        score = score + F.when(F.contains(t, F.lit(word)), 2).otherwise(0)
    return score


def ranked(models: DataFrame, min_capability: str | None = None) -> DataFrame:
    """Candidates with pos (their place in the list), missing scores as 1000 for cost and 0 for power."""
    out = models.withColumns({"cost": F.coalesce("cost_score", F.lit(1000.0)), "power": F.coalesce("power_score", F.lit(0.0)), "has": F.coalesce("capabilities", F.array().cast("array<string>"))})
    return out.where(F.array_contains("has", min_capability)) if min_capability else out


def route(tasks: DataFrame, models: DataFrame, key: str = "task_id", task: str = "task", min_capability: str | None = None, prefer: list[str] | None = None) -> DataFrame:
    """key, score, model, provider, reason for each task; no candidates, no model.

    Every choice is the same for all tasks of one kind, so the few models are reduced to four picks first and these are joined to the tasks as
    one row: tasks are never multiplied by models.
    """
    m = ranked(models, min_capability)
    cheap = F.struct("cost", -F.col("power"), "pos")
    strong = F.struct(-F.col("power"), "cost", "pos")
    pick = F.struct("name", "provider")
    basic = F.array_contains("has", "chat") | F.array_contains("has", "general")
    wish = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(prefer or []))):
        wish = F.when(F.contains(F.lower(F.coalesce("name", F.lit(""))), F.lit(p.lower())) | F.contains(F.lower(F.coalesce("provider", F.lit(""))), F.lit(p.lower())), i).otherwise(wish)
    picks = m.withColumn("wish", wish).agg(
        F.min_by(pick, F.when(basic, cheap)).alias("basic"), F.min_by(pick, strong).alias("strong"), F.min_by(pick, cheap).alias("cheap"),
        F.min_by(F.struct("name", "provider", "wish"), F.when(F.col("wish").isNotNull(), F.struct("wish", "cost", -F.col("power"), "pos"))).alias("wished"),
    )
    scored = tasks.select(key, task_score(F.col(task)).alias("score")).crossJoin(F.broadcast(picks))  # picks is one row
    low, high = (F.col("score") <= 1) & F.col("basic").isNotNull(), (F.col("score") >= 3) & F.col("strong").isNotNull()
    wished = high & F.col("wished").isNotNull()
    names = F.array(*(F.lit(p) for p in prefer)) if prefer else F.array(F.lit(""))
    kind = F.when(low, "cheapest suitable").when(wished, F.concat(F.lit("preference "), F.get(names, F.col("wished.wish")))).when(high, "best power").when(F.col("cheap").isNotNull(), "fallback cheapest")
    chosen = lambda f: F.when(low, F.col(f"basic.{f}")).when(wished, F.col(f"wished.{f}")).when(high, F.col(f"strong.{f}")).otherwise(F.col(f"cheap.{f}"))
    return scored.select(key, "score", chosen("name").alias("model"), chosen("provider").alias("provider"), kind.alias("reason"))


def catalogue_texts(df: DataFrame, json: str, *keys: str) -> DataFrame:
    """catalogue() of JSON texts, with keys; texts that aren't such JSON give no rows."""
    return catalogue(df.select(*keys, F.from_json(json, CATALOGUE).alias("_c")).select(*keys, "_c.providers"), *keys)


def catalogue(providers: DataFrame, *keys: str) -> DataFrame:
    """A row for each model of a nested catalogue (providers: map of name to struct with models)."""
    flat = providers.select(*keys, F.explode("providers").alias("provider", "p")).select(*keys, "provider", F.col("p.api").alias("api"), F.explode("p.models").alias("m"))
    return flat.select(*keys, "provider", "api", "m.id", "m.name", "m.reasoning", "m.input", F.col("m.cost.input").alias("cost_input"), F.col("m.cost.output").alias("cost_output"), F.col("m.contextWindow").alias("context_window"), F.col("m.maxTokens").alias("max_tokens"))


CATALOGUE = "providers map<string, struct<baseUrl string, api string, models array<struct<id string, name string, reasoning boolean, input array<string>, cost struct<input double, output double, cacheRead double, cacheWrite double>, contextWindow long, maxTokens long>>>>"
