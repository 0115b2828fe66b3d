"""Calls to outside judges: batches of rows, retries, budgets, validated answers."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from typing import Protocol, TypeVar

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import ship

T = TypeVar("T")


class CallFailed(RuntimeError):
    """A call that failed in every attempt."""


def with_backoff(call: Callable[[], T], attempts: int = 5, base: float = 1.0, most: float = 30.0, jitter: float = 0.25, sleep: Callable[[float], None] = time.sleep) -> T:
    """Try a call again after growing pauses with jitter."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Exception as e:
            if attempt == attempts:
                raise CallFailed(f"{attempts} attempts failed, the last with: {e}") from e
            pause = min(most, base * 2 ** (attempt - 1))
            sleep(max(0.0, pause * (1 + random.uniform(-jitter, jitter))))
    raise AssertionError


class Judge(Protocol):
    """Answers a batch of questions (dicts) with as many dicts; it is built on each worker from its own state."""

    def answer(self, questions: list[dict]) -> list[dict]: ...


class RuleJudge:
    """Deterministic stand-in: 'yes' where the two names share a word, with the share of common words as confidence."""

    def answer(self, questions: list[dict]) -> list[dict]:
        out = []
        for q in questions:
            a, b = set(str(q.get("a") or "").upper().split()), set(str(q.get("b") or "").upper().split())
            share = len(a & b) / max(1, len(a | b))
            out.append({"verdict": "yes" if a & b else "no", "confidence": round(100 * share)})
        return out


def parse_items(content: str) -> list[dict]:
    """Objects of an answer text: a JSON array, an object that holds one, a single object, or the objects found in other text."""
    try:
        found = json.loads(content)
    except (TypeError, json.JSONDecodeError):
        found, at, reader = [], 0, json.JSONDecoder()
        while (at := (content or "").find("{", at)) >= 0:
            try:
                item, end = reader.raw_decode(content, at)
                found.append(item)
                at = end
            except json.JSONDecodeError:
                at += 1
    if isinstance(found, dict):
        found = next((v for v in found.values() if isinstance(v, list)), [found] if found else [])
    return [x for x in found if isinstance(x, dict)]


def ask(questions: DataFrame, judge: Judge, fields: list[str], batch: int = 6, budget: int | None = None, attempts: int = 3) -> DataFrame:
    """(row_id, verdict, confidence, error) for rows with row_id and ``fields``.

    Equal questions are asked once.  A batch whose answers do not match in number, or that
    fails in every attempt, gives nulls with the error, so a later run asks again.
    ``budget`` bounds the questions of the whole run: the first ones by a hash of the
    question are asked, the rest get the error "budget".
    """
    ship(questions.sparkSession)
    key = F.sha2(F.to_json(F.struct(*fields)), 256)
    keyed = questions.withColumn("_key", key)
    distinct = keyed.select("_key", *fields).dropDuplicates(["_key"])
    over = None
    if budget is not None:
        asked = distinct.orderBy("_key").limit(budget)
        over = distinct.join(asked.select("_key"), "_key", "left_anti").select("_key", F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("double").alias("confidence"), F.lit("budget").alias("error"))
        distinct = asked

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                answers, error, rows = [{}] * len(part), None, part[fields].to_dict("records")

                def call(rows: list[dict] = rows) -> list[dict]:
                    got = judge.answer(rows)
                    if len(got) != len(rows):
                        raise ValueError(f"{len(got)} answers to {len(rows)} questions")
                    return got

                try:
                    answers = with_backoff(call, attempts, 0.01, 1.0)
                except CallFailed as e:
                    error = str(e)
                yield pd.DataFrame(
                    {
                        "_key": part["_key"].to_numpy(),
                        "verdict": [a.get("verdict") for a in answers],
                        "confidence": [float(a["confidence"]) if isinstance(a.get("confidence"), (int, float)) and not isinstance(a.get("confidence"), bool) else None for a in answers],
                        "error": [error] * len(part),
                    }
                )

    made = distinct.mapInPandas(run, "_key string, verdict string, confidence double, error string")
    made = made if over is None else made.unionByName(over)
    return keyed.select("row_id", "_key").join(made, "_key").drop("_key")


def valid_only(answers: DataFrame, allowed: DataFrame, column: str = "verdict") -> DataFrame:
    """Answers whose value is in the allowed list (column ``category``); others become null."""
    ok = allowed.select(F.col("category").alias("_ok")).distinct()
    joined = answers.join(ok, F.col(column) == F.col("_ok"), "left")
    return joined.withColumn(column, F.col("_ok")).drop("_ok")


def second_opinion(first: DataFrame, second: DataFrame, least: float = 60.0) -> DataFrame:
    """First answers with ``verified``: the second judge gave the same and was sure enough."""
    s = second.select("row_id", F.col("verdict").alias("_v"), F.col("confidence").alias("_c"))
    agreed = (F.col("verdict") == F.col("_v")) & (F.col("_c") >= least)
    return first.join(s, "row_id", "left").withColumn("verified", F.coalesce(agreed, F.lit(False))).drop("_v", "_c")


class OverlapPicker:
    """Deterministic stand-in for a model that picks one of a row's candidates: the one that shares most words with it."""

    def answer(self, questions: list[dict]) -> list[dict]:
        out = []
        for q in questions:
            asked = set(str(q["asked"] or "").upper().split())
            shared = [len(asked & set(str(c["name"] or "").upper().split())) for c in q["candidates"]]
            best = max(range(len(shared)), key=lambda i: (shared[i], -i), default=None)
            sure = best is not None and shared[best] > 0
            out.append({"match_index": best + 1 if sure else None, "confidence": round(100 * shared[best] / len(asked)) if sure else 0})
        return out


def pick_candidates(asked: DataFrame, candidates: DataFrame, judge: Judge, most: int = 5, attempts: int = 3) -> DataFrame:
    """(row_id, src_id, confidence, error): the one of a row's candidates that the judge picks.

    ``asked``: row_id, name; ``candidates``: row_id, src_id, name, rank (the ``most`` first
    ones are shown).  The judge gets the name and the list and answers match_index (from 1,
    null for none) and confidence; an index outside the list is none.  A call that fails in
    every attempt leaves nulls with the error.
    """
    ship(asked.sparkSession)
    shown = candidates.where(F.col("rank") <= most).groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("rank", "src_id", "name"))).alias("candidates"))
    questions = asked.select("row_id", F.col("name").alias("asked")).join(shown, "row_id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                listed = [dict(c) if isinstance(c, dict) else c.asDict() for c in r.candidates]
                try:
                    got = with_backoff(lambda r=r, listed=listed: judge.answer([{"asked": r.asked, "candidates": listed}])[0], attempts, 0.01, 1.0)
                    at, error = got.get("match_index"), None
                    at = int(at) - 1 if isinstance(at, (int, float, str)) and str(at).lstrip("-").isdigit() and 1 <= int(at) <= len(listed) else None
                    confidence = float(got.get("confidence") or 0)
                except CallFailed as e:
                    at, confidence, error = None, None, str(e)
                rows.append((r.row_id, None if at is None else listed[at]["src_id"], confidence, error))
            yield pd.DataFrame(rows, columns=["row_id", "src_id", "confidence", "error"]).astype({"src_id": "Int64"})

    return questions.mapInPandas(run, "row_id long, src_id long, confidence double, error string")
