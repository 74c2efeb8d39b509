"""Models behind an interface, so that everything around them is deterministic.

A provider turns a text message into a reply text, or None if it failed, and
raises ``Truncated`` if the reply was cut off. It is called from ``mapInPandas`` by partition; the caller writes the replies before
using them twice.
"""

from __future__ import annotations

import json
import os
import random
import re
import time
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.config import env_int
from tenderloom.runtime import ship

ATTEMPTS = 3


class Truncated(Exception):
    """The reply was cut off for length: asking the same again is no use, asking for less may be."""


class Reply(str):
    """A reply that knows what it cost; a plain text costs nothing known."""

    prompt_tokens: int = 0
    completion_tokens: int = 0


class Provider(Protocol):
    def reply(self, system: str, message: str) -> str | None: ...


class RulesProvider:
    """A stand-in without a model: each sentence that obliges is an item. It is no substitute for a model's judgement."""

    # Words that oblige, by strength, and forms of an allowed equivalent.
    MUST = re.compile(r"\b(must|shall|has to|have to|muss|müssen|ist zu|sind zu|required)\b", re.I)
    SHOULD = re.compile(r"\b(should|soll|sollen|sollte)\b", re.I)
    OPTIONAL = re.compile(r"\b(may|can|optional|kann|können|darf)\b", re.I)
    EQUIVALENT = re.compile(r"\b(or equivalent|oder gleichwertig|gleichwertige?|equivalent)\b", re.I)
    STANDARD = re.compile(r"\b(?:DIN|EN|ISO|ÖNORM|VDE)(?: (?:EN|ISO))* ?\d+(?:-\d+)*")

    def reply(self, system: str, message: str) -> str | None:
        items = []
        for s in re.split(r"(?<=[.!?])\s+", message.split("\n\n", 1)[-1]):
            s = " ".join(s.split())
            strength = "must" if self.MUST.search(s) else "should" if self.SHOULD.search(s) else "optional" if self.OPTIONAL.search(s) else None
            if strength and len(s) >= 5:
                items.append({"bullet_point": s[:80], "description_en": s, "description_de": None, "priority": strength, "equivalence_allowed": True if self.EQUIVALENT.search(s) else None, "confidence": "low", "standards": self.STANDARD.findall(s)})
        return json.dumps({"extractions": items}, ensure_ascii=False)


class ReplayProvider:
    """Replies that were recorded, by message; others fail."""

    def __init__(self, replies: dict[str, str]):
        self.replies = replies

    def reply(self, system: str, message: str) -> str | None:
        return self.replies.get(message)


class HttpProvider:
    """A chat endpoint that speaks the common JSON protocol. The key comes from the environment variable named, at the worker."""

    def __init__(self, url: str, model: str, key_variable: str, timeout: float = 120):
        self.url, self.model, self.key_variable, self.timeout = url, model, key_variable, timeout

    def reply(self, system: str, message: str) -> str | None:
        key = os.environ.get(self.key_variable)
        if not key:
            raise RuntimeError(f"{self.key_variable} is not set")
        body = {"model": self.model, "temperature": 0, "response_format": {"type": "json_object"}, "messages": [{"role": "system", "content": system}, {"role": "user", "content": message}]}
        for attempt in range(1, ATTEMPTS + 1):
            try:
                request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {key}"})
                with urllib.request.urlopen(request, timeout=self.timeout) as r:
                    answer = json.load(r)
                choice = answer["choices"][0]
                if choice.get("finish_reason") == "length":
                    raise Truncated
                text = Reply(choice["message"]["content"])
                json.loads(text)
                usage = answer.get("usage") or {}
                text.prompt_tokens, text.completion_tokens = int(usage.get("prompt_tokens") or 0), int(usage.get("completion_tokens") or 0)
                return text
            except ValueError:
                continue  # a malformed reply is asked for again at once
            except OSError:
                if attempt < ATTEMPTS:
                    time.sleep(2 ** (attempt - 1) + random.random() / 2)
        return None


REPLIES = "key string, message string, reply string, truncated boolean, prompt_tokens long, completion_tokens long"


def ask(messages: DataFrame, provider: Provider, system: str | None = None, in_flight: int | None = None) -> DataFrame:
    """``messages`` (key, message, and system unless it is given) with ``reply``, null where the provider failed, ``truncated``, whether for length, and the tokens used where the provider tells. Each task has so many calls in flight."""
    ship(messages.sparkSession)
    threads = in_flight or env_int("CONCURRENCY_LIMIT", 3)

    def one(system: str, message: str) -> tuple[str | None, bool, int, int]:
        try:
            text = provider.reply(system, message)
        except Truncated:
            return None, True, 0, 0
        return (None if text is None else str(text)), False, getattr(text, "prompt_tokens", 0), getattr(text, "completion_tokens", 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for b in batches:
                got = list(pool.map(one, b["system"], b["message"]))
                for i, c in enumerate(("reply", "truncated", "prompt_tokens", "completion_tokens")):
                    b[c] = [g[i] for g in got]
                yield b[[c.split()[0] for c in REPLIES.split(", ")]]

    told = F.col("system") if system is None else F.lit(system)
    return messages.select("key", "message", told.alias("system")).mapInPandas(run, REPLIES)


def usage(replies: DataFrame, stage: str) -> DataFrame:
    """(stage, calls, failed, truncated, prompt_tokens, completion_tokens) of the replies of a stage."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return replies.agg(F.count("*").alias("calls"), F.count_if(F.col("reply").isNull() & ~F.col("truncated")).alias("failed"), F.count_if("truncated").alias("truncated"), n("prompt_tokens").alias("prompt_tokens"), n("completion_tokens").alias("completion_tokens")).select(F.lit(stage).alias("stage"), "*")
