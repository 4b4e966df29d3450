"""Configuration of a run: models, judges, pair building, output files. Read from JSON, or from YAML where a parser is installed."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import PurePosixPath
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

KINDS = ("experimental", "open_source", "closed_source", "reference")


@dataclass(frozen=True)
class Model:
    name: str
    model_name: str
    model_type: str = "open_source"
    settings: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Ranking:
    top_k: int = 1
    bottom_k: int = 1
    #: On the scale of aggregate_score, which is 0 to 5.
    min_score_diff: float = 0.0


@dataclass(frozen=True)
class Config:
    generators: tuple[Model, ...]
    judges: tuple[Model, ...]
    ranking: Ranking
    folder: str

    def file(self, name: str) -> str:
        return f"{self.folder}/{name}"


def base_url(endpoint: str) -> str:
    """The API root of an endpoint: without a trailing slash or chat path, with a version."""
    url = endpoint.strip().rstrip("/").removesuffix("/chat/completions").rstrip("/")
    return url if urlsplit(url).path.rstrip("/").rpartition("/")[2].startswith("v") else f"{url}/v1"


def _models(items, what: str) -> tuple[Model, ...]:
    out = []
    for item in items or []:
        rest = dict(item)
        try:
            name = rest.pop("name")
            model = Model(name, str(rest.pop("model_name", name)), str(rest.pop("model_type", "open_source")), rest)
        except KeyError as e:
            raise ValueError(f"{what}: an entry has no {e}") from None
        if model.model_type not in KINDS:
            raise ValueError(f"{what} {name}: model_type {model.model_type!r} is none of {KINDS}")
        out.append(model)
    twice = {m.model_name for m in out if sum(n.model_name == m.model_name and n.model_type == m.model_type for n in out) > 1}
    if twice:
        raise ValueError(f"{what}: {sorted(twice)} are configured twice, so their candidates would share ids")
    return tuple(out)


def parse_config(text: str, raw_data: str) -> Config:
    """A configuration; results lie beside the raw data in a folder named after it."""
    try:
        spec = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError:
            raise ValueError("the configuration is no JSON, and no YAML parser is installed") from None
        spec = yaml.safe_load(text)
    if not isinstance(spec, dict) or not spec.get("generators"):
        raise ValueError("the configuration names no generators")
    ranking = Ranking(**{k: v for k, v in (spec.get("ranking") or {}).items() if k in Ranking.__dataclass_fields__})
    if ranking.top_k < 1 or ranking.bottom_k < 1:
        raise ValueError("top_k and bottom_k must be 1 at least")
    path = PurePosixPath(raw_data)
    return Config(_models(spec["generators"], "generators"), _models(spec.get("judges"), "judges"), ranking, spec.get("output_dir") or f"{path.parent}/{path.stem}")


def read_config(spark: SparkSession, path: str, raw_data: str) -> Config:
    """A configuration file in any store that Spark reads."""
    return parse_config("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()), raw_data)


def model_table(spark: SparkSession, models: tuple[Model, ...]) -> DataFrame:
    """(model_type, model_name, gen_config as JSON) of configured models."""
    rows = [(m.model_type, m.model_name, json.dumps(m.settings, sort_keys=True, ensure_ascii=False)) for m in models]
    return spark.createDataFrame(rows, "model_type string, model_name string, gen_config string")
