"""Deterministic model clients for tests."""

import json

from docsheaf import constants as C
from docsheaf.operators.calls import CallError


def rule_model():
    """Answers a request by the length of its text: every 17th length is refused,
    every 13th gets a reply cut short, the rest get a full record."""

    def call(request: dict) -> str:
        assert request["model"] and request["temperature"] == C.MODEL_TEMPERATURE
        prompt = request["messages"][-1]["content"]
        start = prompt.index(C.TEXT_START_MARKER) + len(C.TEXT_START_MARKER) + 1
        text = prompt[start : -len(C.TEXT_END_MARKER) - 1]
        size = len(text)
        if size % 17 == 0:
            raise CallError("bad request", "status", 400)
        if size % 13 == 0:
            return '{"summary": "Cut short", "sentiment": {"label": "Negative", "conf'
        return json.dumps(
            {
                "summary": text,
                "entities": {"people": text.split(" ")[:2], "places": [], "organizations": [f"Org {size % 7}"]},
                "sentiment": {"label": C.LABELS[size % 3], "confidence": (size % 101) / 100},
                "key_questions": [f"Why {size}?"],
            },
            ensure_ascii=False,
        )

    return call
