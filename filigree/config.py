"""Settings: defaults, then a mapping, then an overlay, then environment variables ``FILIGREE_SECTION__NAME``; checked when built."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields


class ConfigError(ValueError):
    """A setting that cannot hold."""


@dataclass(frozen=True)
class Chunking:
    max_tokens: int = 512
    overlap_tokens: int = 50
    min_tokens: int = 100
    tokens_per_word: float = 1.33


@dataclass(frozen=True)
class Quality:
    balance_tolerance: float = 0.01
    balance_error: float = 0.05
    late_days: int = 120
    strict: bool = False


@dataclass(frozen=True)
class Retrieval:
    vector_weight: float = 0.7
    keyword_weight: float = 0.3
    hops: int = 2
    seeds: int = 10
    keep: int = 5


@dataclass(frozen=True)
class Requests:
    per_second: float = 8.0
    burst: int = 16


@dataclass(frozen=True)
class Config:
    chunking: Chunking = field(default_factory=Chunking)
    quality: Quality = field(default_factory=Quality)
    retrieval: Retrieval = field(default_factory=Retrieval)
    requests: Requests = field(default_factory=Requests)

    def checked(self) -> Config:
        c = self.chunking
        if not 0 <= c.overlap_tokens < c.max_tokens or c.min_tokens > c.max_tokens or c.tokens_per_word <= 0:
            raise ConfigError("chunking: the overlap and the least size must lie under the most")
        if not 0 <= self.quality.balance_tolerance <= self.quality.balance_error:
            raise ConfigError("quality: the tolerance must not exceed the error bound")
        if min(self.retrieval.vector_weight, self.retrieval.keyword_weight, self.retrieval.hops) < 0:
            raise ConfigError("retrieval: weights and hops must not be negative")
        if self.requests.per_second <= 0 or self.requests.burst < 1:
            raise ConfigError("requests: the rate and the burst must be positive")
        return self


def merged(base: Mapping, over: Mapping) -> dict:
    """``over`` laid over ``base``, level by level."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def load(base: Mapping | None = None, overlay: Mapping | None = None, environ: Mapping[str, str] | None = None) -> Config:
    values = merged(merged(asdict(Config()), base or {}), overlay or {})
    for name, text in (os.environ if environ is None else environ).items():
        if name.startswith("FILIGREE_") and "__" in name:
            section, _, key = name.removeprefix("FILIGREE_").lower().partition("__")
            values = merged(values, {section: {key: text}})
    sections = {}
    for f in fields(Config):
        kind = f.default_factory
        known = {x.name: type(getattr(kind(), x.name)) for x in fields(kind)}
        given = values.pop(f.name)
        if unknown := set(given) - set(known):
            raise ConfigError(f"{f.name}: unknown settings {sorted(unknown)}")
        try:
            sections[f.name] = kind(**{k: v.strip().lower() in ("1", "true", "yes") if known[k] is bool and isinstance(v, str) else known[k](v) for k, v in given.items()})
        except (TypeError, ValueError) as e:
            raise ConfigError(f"{f.name}: {e}") from e
    if values:
        raise ConfigError(f"unknown sections {sorted(values)}")
    return Config(**sections).checked()
