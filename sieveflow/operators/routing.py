"""Task -> local model lookup, and D10: provider / model per message."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The reference's default model table and task routing.
# ---------------------------------------------------------------------------
LOCAL_MODELS = {
    "reasoning": "deepseek-r1:32b",
    "general": "llama3.1:8b",
    "efficient": "phi3:mini",
    "coding": "codellama:34b",
    "large_context": "llama3.3:70b",
}
TASK_ROUTING = {
    "summary": "general",
    "analysis": "reasoning",
    "quick": "efficient",
    "code": "coding",
    "complex": "reasoning",
    "default": "general",
}
REMOTE_MODEL = "claude-3-sonnet-20240229"
FALLBACK_THRESHOLD_TOKENS = 2000
# ---------------------------------------------------------------------------

# Tasks sent to the remote provider when local models are not primary (ours).
COMPLEX_TASKS = ("analysis", "complex")


def _map_literal(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def model_for_task(task: Column | str, local_models: dict | None = None,
                   task_routing: dict | None = None) -> Column:
    """``task -> model key`` (missing -> 'default'), then ``key -> model``
    (missing -> the 'general' model)."""
    models = local_models or LOCAL_MODELS
    routing = task_routing or TASK_ROUTING
    t = F.col(task) if isinstance(task, str) else task
    key = F.coalesce(F.element_at(_map_literal(routing), t), F.lit("default"))
    return F.coalesce(F.element_at(_map_literal(models), key), F.lit(models["general"]))


def estimated_tokens(text: Column | str) -> Column:
    """Token estimate (ours): ceil(characters / 4)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.ceil(F.char_length(t) / F.lit(4)).cast("long")


def route_messages(messages: DataFrame, *, task: Column | str | None = None,
                   use_local_ai: bool = True, local_ai_primary: bool = False,
                   fallback_enabled: bool = True,
                   threshold_tokens: int = FALLBACK_THRESHOLD_TOKENS,
                   remote_model: str = REMOTE_MODEL) -> DataFrame:
    """Add ``task``, ``tokens``, ``provider`` ('local' / 'remote') and
    ``model``. Long texts go to the remote provider when fallback is on;
    otherwise local models take everything when primary, and the simple tasks
    when not."""
    t = F.lit("default") if task is None else (F.col(task) if isinstance(task, str) else task)
    tokens = estimated_tokens("text")
    if not use_local_ai:
        remote = F.lit(True)
    else:
        long_text = (tokens > F.lit(int(threshold_tokens))) if fallback_enabled else F.lit(False)
        by_task = F.lit(False) if local_ai_primary else t.isin(*COMPLEX_TASKS)
        remote = long_text | by_task
    return (messages.withColumn("task", t).withColumn("tokens", tokens)
            .withColumn("provider", F.when(remote, F.lit("remote")).otherwise(F.lit("local")))
            .withColumn("model", F.when(remote, F.lit(remote_model))
                        .otherwise(model_for_task("task"))))
