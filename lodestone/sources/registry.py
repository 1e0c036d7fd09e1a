"""Named index stores."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

Factory = Callable[..., Any]
_FACTORIES: dict[str, Factory] = {}
DEFAULT_STORE = "parquet"


def _key(name: str | None) -> str:
    return (name or "").strip().lower()


def register_store(name: str, factory: Factory) -> None:
    if not _key(name):
        raise ValueError("a store needs a name")
    if not callable(factory):
        raise TypeError("a store factory must be callable")
    _FACTORIES[_key(name)] = factory


def unregister_store(name: str) -> None:
    _FACTORIES.pop(_key(name), None)


def get_store(name: str) -> Factory | None:
    return _FACTORIES.get(_key(name))


def stores() -> list[str]:
    return sorted(_FACTORIES)


@dataclass(frozen=True)
class StoreConfig:
    """Which store to open and under which table names."""

    provider: str = DEFAULT_STORE
    table: str = "chunks"
    postings: str | None = None
    url: str | None = None
    token: str | None = None

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> StoreConfig:
        """From string options, such as the environment; blank values count as absent."""
        def value(name: str) -> str | None:
            return (options.get(name) or "").strip() or None

        provider = _key(value("provider") or DEFAULT_STORE)
        if provider != DEFAULT_STORE and not value("url"):
            raise RuntimeError(f"store '{provider}' needs a url")
        return cls(provider, value("table") or "chunks", value("postings"), value("url"), value("token"))


def jdbc_url(url: str) -> str:
    """A database address as Spark's JDBC source takes it."""
    text = url.strip()
    for scheme in ("postgresql://", "postgres://"):
        if text.startswith(scheme):
            return "jdbc:postgresql://" + text[len(scheme):]
    return text


def open_store(spark: SparkSession, config: StoreConfig = StoreConfig(), **more: Any) -> Any:
    factory = get_store(config.provider or DEFAULT_STORE)
    if factory is None:
        raise ValueError(f"unknown store '{config.provider}'")
    return factory(spark=spark, config=config, **more)
