"""Settings of a count.

``defaults.toml`` is the schema: each of its tables becomes a class of immutable records whose fields have the
table's keys, types and values; an array of tables becomes a class and a tuple of its records.  ``load``
lays a file and the environment over it.  The file is the first of: the argument, $TALLYFORGE_CONFIG,
./tally.toml.  A key that the schema lacks is ignored; a value of another type is an error that names the
key.  Records of an array in a file replace the whole array.
"""

from __future__ import annotations

import os
import re
import tomllib
from collections.abc import Mapping
from dataclasses import field, make_dataclass, replace
from pathlib import Path

ENVIRONMENT = {
    "TALLYFORGE_ROOT": ("images_root",),
    "TALLYFORGE_READ_WORKERS": ("vision", "read_workers"),
    "TALLYFORGE_TELEMETRY": ("telemetry", "enabled"),
}
_TRUE = ("1", "true", "yes", "on")


def _value(given, default, key: str):
    """``given`` in the type of ``default``; lists are tuples, and a float may be written as an integer."""
    if isinstance(default, tuple):
        if not isinstance(given, list):
            raise ValueError(f"{key}: a list is wanted, not {given!r}")
        return tuple(_value(v, default[0], key) for v in given) if default else tuple(given)
    if isinstance(default, float) and type(given) is int:
        return float(given)
    if type(given) is not type(default):
        raise ValueError(f"{key}: {type(default).__name__} is wanted, not {given!r}")
    return given


def _frozen(value):
    return tuple(map(_frozen, value)) if isinstance(value, list) else value


def _record(name: str, table: Mapping) -> type:
    """A class whose fields are the table's keys, with its values as defaults."""
    return make_dataclass(name.title(), [(k, type(_frozen(v)), field(default=_frozen(v))) for k, v in table.items()], frozen=True, module=__name__)


def _laid(record, given: Mapping, key: str):
    """``record`` with what ``given`` has of its fields."""
    known = record.__dataclass_fields__
    return replace(record, **{k: _value(v, getattr(record, k), f"{key}.{k}") for k, v in given.items() if k in known})


_DEFAULTS = tomllib.loads((Path(__file__).parent / "defaults.toml").read_text(encoding="utf-8"))
_TABLES = {k: _record(k, v) for k, v in _DEFAULTS.items() if isinstance(v, dict)}
_ARRAYS = {k: _record({"parties": "party", "candidates": "candidate"}[k], v[0]) for k, v in _DEFAULTS.items() if isinstance(v, list) and isinstance(v[0], dict)}
Contest, Target, Vision, Classify, Locate, Search, Mark, Filename, Telemetry = (_TABLES[k] for k in ("contest", "target", "vision", "classify", "locate", "search", "mark", "filename", "telemetry"))
Party, Candidate = _ARRAYS["parties"], _ARRAYS["candidates"]


def _default(key: str, value):
    if key in _TABLES:
        return _TABLES[key]()
    if key in _ARRAYS:
        return tuple(_ARRAYS[key](**{k: _frozen(v) for k, v in row.items()}) for row in value)
    return _frozen(value)


class _Shortcuts:
    @property
    def names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.candidates)

    @property
    def party_labels(self) -> tuple[str, ...]:
        return tuple(p.label for p in self.parties)

    def prompt(self) -> str:
        return self.vision.prompt.strip().replace("{contest}", self.contest.name)


Config = make_dataclass("Config", [(k, object, field(default=_default(k, v))) for k, v in _DEFAULTS.items()], bases=(_Shortcuts,), frozen=True, module=__name__)


def java_regex(pattern: str) -> str:
    """The pattern with named groups as Java writes them."""
    return re.sub(r"\(\?P<", "(?<", pattern)


def _from_text(text: str, default):
    """A value of the environment in the type of ``default``."""
    return text.lower() in _TRUE if isinstance(default, bool) else type(default)(text)


def from_mapping(data: Mapping, environ: Mapping[str, str] = os.environ) -> Config:
    config, new = Config(), {}
    for key, given in data.items():
        if key in _TABLES:
            new[key] = _laid(getattr(config, key), given, key)
        elif key in _ARRAYS:
            empty = _ARRAYS[key]()
            new[key] = tuple(_laid(empty, row, key) for row in given)
            for row in given:
                if missing := empty.__dataclass_fields__.keys() - row.keys():
                    raise ValueError(f"{key}: {sorted(missing)} missing in {row!r}")
        elif key in _DEFAULTS:
            new[key] = _value(given, getattr(config, key), key)
    config = replace(config, **new)
    for name, (*table, key) in ENVIRONMENT.items():
        if text := environ.get(name):
            of = getattr(config, table[0]) if table else config
            of = replace(of, **{key: _from_text(text, getattr(of, key))})
            config = replace(config, **{table[0]: of}) if table else of
    return config


def load(path: str | None = None, environ: Mapping[str, str] = os.environ) -> Config:
    given = path or environ.get("TALLYFORGE_CONFIG") or ("tally.toml" if os.path.exists("tally.toml") else None)
    return from_mapping(tomllib.loads(Path(given).read_text(encoding="utf-8")) if given else {}, environ)
