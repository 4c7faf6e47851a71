"""A provider whose replies depend on the text alone, good and bad ones."""

from __future__ import annotations

import sys
from datetime import datetime
from types import MappingProxyType
from typing import Any

from pyspark import cloudpickle

# Shipped to the tasks with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class LengthProvider:
    """Answers by text length, so that SQL can tell the outcome of each text.

    Some texts get no reply, some an unknown language, some make the call fail.
    """

    def enrich(self, texts: list[str]) -> list[dict[str, Any] | None]:
        return [self._reply(len(text)) for text in texts]

    @staticmethod
    def _reply(length: int) -> dict[str, Any] | None:
        kind = length % 10
        if kind == 0:
            return None
        if kind == 1:
            raise RuntimeError("no answer")
        return {
            "languages": ["xx" if kind == 2 else "fr"],
            "sentiment_score": length / 100,
            "topics": [f"t{kind}"],
        }


class StepProvider:
    """Answers only texts whose length leaves a remainder below ``step`` by five."""

    def __init__(self, step: int):
        self.step = step

    def enrich(self, texts: list[str]) -> list[dict[str, Any] | None]:
        return [{"languages": ["en"], "sentiment_score": len(t) / 100} if len(t) % 5 < self.step else None for t in texts]


class OddProvider:
    """Answers only single texts, and some of them in ways no model allows."""

    def enrich(self, texts: list[str]) -> list[Any]:
        if len(texts) > 1:
            raise ValueError("one at a time")
        good = {"languages": ["en"], "topics": ["a", "b"]}
        return {
            0: [],
            1: [{**good, "languages": [None]}],
            2: [{**good, "topics": [1, None]}],
            3: [{**good, "translation": 5}],
            4: [{**good, "intent": datetime(2024, 1, 1)}],
            5: [MappingProxyType(good)],
            6: [{**good, "entities": [{"name": 3, "type": "Person"}]}],
            7: [{**good, "sentiment_score": float("nan")}],
            8: [{**good, "extra": {1, 2}}],
        }.get(len(texts[0]) % 10, [good])
