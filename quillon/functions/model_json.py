"""Strict JSON out of model replies, as Arrow UDFs: Spark's own JSON functions accept single quotes and trailing text."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from quillon.schemas import REPLY
from quillon.sources.shared import slices

_CHECK = pa.struct([("rule_id", pa.string()), ("hit", pa.bool_()), ("severity", pa.string()), ("score", pa.float64()), ("reason", pa.string()), ("excerpt", pa.string())])
#: REPLY as an Arrow type.
PARSED = pa.struct([("checks", pa.list_(pa.field("element", _CHECK))), ("confidence", pa.string())])
#: Fixed value: how a reply marks a block of JSON.
_FENCED = re.compile(r"```(?:json)?\s*(\{.*\})\s*```", re.DOTALL)


def _parsed(text: str):
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


def fenced_or_braced(text: str) -> dict | list | None:
    """JSON of a fenced block, else from the first brace to its partner (braces in strings count too), else of the whole text."""
    text = text.strip()
    if found := _FENCED.search(text):
        if (value := _parsed(found[1].strip())) is not None:
            return value
    start = text.find("{")
    depth = 0
    for at in (m.start() for m in re.finditer(r"[{}]", text)):
        depth += 1 if text[at] == "{" else -1 if at >= start else 0
        if depth == 0 and at > start:
            if (value := _parsed(text[start : at + 1])) is not None:
                return value
            break
    return _parsed(text)


def first_to_last_brace(text: str) -> dict | list | None:
    """JSON of the whole text, else from the first opening to the last closing brace."""
    value = _parsed(text)
    if value is None and 0 <= text.find("{") < text.rfind("}"):
        value = _parsed(text[text.find("{") : text.rfind("}") + 1])
    return value


def without_fence(text: str) -> dict | list | None:
    """JSON of a text whose first and last line may be a fence."""
    lines = text.strip().splitlines()
    if lines and lines[0].startswith("```"):
        lines = lines[1:]
        if lines and lines[-1].startswith("```"):
            lines.pop()
    return _parsed("\n".join(lines).strip())


def _check(c: dict) -> dict:
    score = c.get("score")
    try:
        score = None if score is None else float(score)
    except (TypeError, ValueError):
        score = None
    string = lambda k: None if c.get(k) is None else str(c[k])
    return {"rule_id": string("rule_id"), "hit": bool(c.get("hit", False)), "severity": string("severity"), "score": score, "reason": string("reason"), "excerpt": string("excerpt")}


def holds_checks(how: Callable[[str], dict | list | None]) -> Callable[[str], bool]:
    """Whether a reply holds a JSON object, so that it need not be asked for again."""
    return lambda text: isinstance(how(text or ""), dict)


def reply_parser(how: Callable[[str], dict | list | None]):
    """A UDF from a reply to (checks, confidence); null if it holds no JSON object. A task parses some replies of a batch at a time.

    A filter on what was parsed would be pushed below joins with a second call of the UDF; as nondeterministic it is called once.
    """

    def one(text: str | None) -> dict:
        value = how(text) if text else None
        if not isinstance(value, dict):
            return {"checks": None, "confidence": None}
        checks = value.get("checks")
        confidence = value.get("confidence", 0.5)
        confidence = str(float(confidence) if isinstance(confidence, bool) else confidence)
        return {"checks": [_check(c) for c in checks if isinstance(c, dict)] if isinstance(checks, list) else [], "confidence": confidence}

    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for replies in slices(batch, batch):
                yield pa.array(list(map(one, replies.to_pylist())), PARSED)

    return F.arrow_udf(parse, REPLY).asNondeterministic()
