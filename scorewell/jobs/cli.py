"""Shared argument handling for the spark-submit entry points."""

from __future__ import annotations

import importlib
import json
import logging

from scorewell.functions.models import LinearModel
from scorewell.sources.registry import resolve

log = logging.getLogger("scorewell")


def load_model(name: str, spec: str | None = None, factory: str | None = None,
               uri: str | None = None):
    """A model from an inline/file JSON spec or a ``module:function`` factory.

    JSON spec: ``{"weights": {"f1": 0.5, ...}, "bias": 0.0, "link": "identity"}``.
    A factory is called as ``factory(name=..., uri=...)`` and returns any
    object with ``name`` and ``column(df)`` (``LinearModel``/``PythonModel``).
    """
    if factory:
        module, _, attr = factory.partition(":")
        return getattr(importlib.import_module(module), attr)(name=name, uri=uri)
    if not spec:
        raise ValueError(f"model {name!r}: give --model-spec or --model-factory")
    text = spec if spec.lstrip().startswith("{") else open(spec).read()
    cfg = json.loads(text)
    return LinearModel.of(name, cfg["weights"], bias=cfg.get("bias", 0.0),
                          link=cfg.get("link", "identity"))


def resolve_version(spark, registry_table: str | None, name: str, stage: str):
    """(uri, version) from the registry table, or (None, None) without one."""
    if not registry_table:
        return None, None
    uri, version = resolve(spark.table(registry_table), name, stage)
    log.info("model %s stage %s -> %s", name, stage, uri)
    return uri, version
