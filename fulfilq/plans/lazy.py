"""A read-only mapping whose values are built on first access.

Building a DataFrame costs driver time (each step is analyzed eagerly), so a
plan that needs one table should not pay for constructing all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any


class Lazy(Mapping):
    def __init__(self, factories: dict[str, Callable[[], Any]]):
        self._factories = dict(factories)
        self._built: dict[str, Any] = {}

    def __getitem__(self, key: str) -> Any:
        if key not in self._built:
            self._built[key] = self._factories[key]()
        return self._built[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)
