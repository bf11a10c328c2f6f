"""Settings from a YAML or JSON file with ${NAME} taken from the environment."""

from __future__ import annotations

import importlib
import json
import os
import re
from dataclasses import dataclass, field, fields

_NAME = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}")


def substitute(value, environ=None):
    """value with each ${NAME} replaced, in strings, lists and dicts; an unknown name stays as it is."""
    environ = os.environ if environ is None else environ
    if isinstance(value, str):
        return _NAME.sub(lambda m: environ.get(m[1], m[0]), value)
    if isinstance(value, list):
        return [substitute(v, environ) for v in value]
    if isinstance(value, dict):
        return {k: substitute(v, environ) for k, v in value.items()}
    return value


def callable_named(name: str | None):
    """The function that `package.module:function` names; None for None."""
    if not name:
        return None
    module, _, function = name.partition(":")
    if not function:
        raise ValueError(f"{name} is not of the form package.module:function")
    return getattr(importlib.import_module(module), function)


@dataclass(frozen=True)
class Settings:
    """Secrets have no default: they come from the environment or are missing.

    extractor, ask_role, ask_sentence and embed name functions as
    `package.module:function`.  dictionary is a JSON file of names by label,
    {"label": ["name", ...]}, that a rule extracts by where no extractor is
    named.  schema_dir holds ontology files (see ``ontology_files``), any of
    which may be missing.  graph is a saved graph that the build starts from.
    """

    data_dir: str = "data/markdown"
    schema_dir: str | None = None
    stages: dict[str, bool] = field(default_factory=dict)
    selected_files: list[str] = field(default_factory=list)
    max_docs: int | None = None
    chunk_size: int = 800
    similarity_threshold: float = 0.72
    semantic_window: int = 2
    doc_max_retries: int = 2
    exact_match_property: str = "name"
    max_exact_nodes: int = 2000
    extractor: str | None = None
    dictionary: str | None = None
    ask_role: str | None = None
    ask_sentence: str | None = None
    embed: str | None = None
    graph: str | None = None


def load_settings(path: str, environ=None, **overrides) -> Settings:
    """File values, then LOOMGRAPH_<NAME> of the environment where the file has none, then defaults; overrides win."""
    environ = os.environ if environ is None else environ
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    try:
        found = json.loads(raw)
    except ValueError:
        import yaml

        found = yaml.safe_load(raw) or {}
    found = substitute(found, environ)
    out = {}
    for f in fields(Settings):
        if f.name in found:
            out[f.name] = found[f.name]
        elif (name := f"LOOMGRAPH_{f.name.upper()}") in environ:
            out[f.name] = json.loads(environ[name]) if f.type not in ("str", "str | None") else environ[name]
    return Settings(**(out | overrides))
