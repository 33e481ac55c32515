"""Model output to predictions, and the inference loop around a pluggable model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_object_text(text: Column) -> Column:
    """From the first ``{`` to the last ``}``, code fences or prose around it dropped; null if there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def _kind(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def parse_outputs(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, criterion_scores, needs_review, error)`` from generated text.

    Scores come from a ``criterion_scores`` object or else from a ``criterion_results`` list.
    Errors, the first that applies: ``no_json`` (no braces, not one JSON object, repeated keys),
    ``needs_review`` (no boolean), ``criterion_results`` (neither form, or an empty list),
    ``criterion_id``, ``duplicate_criterion_id``, ``score`` (no number), ``empty``.
    """
    numeric = ("BIGINT", "DECIMAL", "DOUBLE")
    v = F.try_parse_json(json_object_text(F.col(text)))
    d = df.select(key, v.alias("v"))
    d = d.select(key, "v", F.try_variant_get("v", "$.criterion_scores", "variant").alias("direct"), F.try_variant_get("v", "$.criterion_results", "variant").alias("list"), F.try_variant_get("v", "$.needs_review", "variant").alias("nr"))
    is_direct, is_list = F.coalesce(_kind(F.col("direct")) == "OBJECT", F.lit(False)), F.coalesce(_kind(F.col("list")) == "ARRAY", F.lit(False))
    pairs = F.map_entries(F.try_variant_get("direct", "$", "map<string,variant>"))
    direct = F.transform(pairs, lambda e: F.struct(e["key"].alias("k"), F.lit("STRING").alias("kk"), _kind(e["value"]).alias("t"), F.try_variant_get(e["value"], "$", "double").alias("s")))
    items = F.try_variant_get("list", "$", "array<variant>")

    def item(x: Column) -> Column:
        cid, score = F.try_variant_get(x, "$.criterion_id", "variant"), F.try_variant_get(x, "$.score", "variant")
        return F.struct(F.try_variant_get(cid, "$", "string").alias("k"), _kind(cid).alias("kk"), _kind(score).alias("t"), F.try_variant_get(score, "$", "double").alias("s"))

    d = d.withColumn("e", F.when(is_direct, direct).when(is_list, F.transform(items, item)))
    ids = F.transform("e", lambda x: x["k"])
    error = (
        F.when(F.col("v").isNull() | (_kind(F.col("v")) != "OBJECT"), "no_json")
        .when(~F.coalesce(_kind(F.col("nr")) == "BOOLEAN", F.lit(False)), "needs_review")
        .when(~is_direct & (~is_list | (F.coalesce(F.size("e"), F.lit(0)) <= 0)), "criterion_results")
        .when(F.exists("e", lambda x: x["k"].isNull() | (x["k"] == "") | ~F.coalesce(x["kk"] == "STRING", F.lit(False))) & ~is_direct, "criterion_id")
        .when(F.size(ids) != F.size(F.array_distinct(ids)), "duplicate_criterion_id")
        .when(F.exists("e", lambda x: ~F.coalesce(x["t"].isin(*numeric), F.lit(False)) | x["s"].isNull()), "score")
        .when(F.size("e") == 0, "empty")
    )
    d = d.withColumn("error", error)
    good = F.col("error").isNull()
    return d.select(key, F.when(good, F.map_from_entries(F.transform("e", lambda x: F.struct(x["k"], x["s"])))).alias("criterion_scores"), F.when(good, F.try_variant_get("nr", "$", "boolean")).alias("needs_review"), "error")


def prompts(chat: DataFrame) -> DataFrame:
    """Chat rows without their last, assistant, message; others are left out."""
    last = F.element_at("messages", -1)
    return chat.where((F.size("messages") > 0) & (last["role"] == "assistant")).select("id", F.slice("messages", 1, F.size("messages") - 1).alias("messages"))


def first_prompts(chat: DataFrame, limit: int, order: str = "id") -> DataFrame:
    """The first prompts in export order (a limit is the feature here)."""
    return prompts(chat).orderBy(order).limit(limit)


def run_model(prompt_rows: DataFrame, predict: Callable[[list[list[dict]]], list[str]], batch: int = 16) -> DataFrame:
    """``(id, output)``: ``predict`` turns lists of messages into texts, batch by batch on the executors."""
    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for s in range(0, len(f), batch):
                part = f.iloc[s : s + batch]
                chats = [[{"role": m["role"], "content": m["content"]} for m in x] for x in part["messages"]]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "output": predict(chats)})

    return prompt_rows.select("id", "messages").mapInPandas(run, "id string, output string")
