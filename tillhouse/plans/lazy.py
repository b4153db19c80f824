"""A mapping whose values are built on first access (and then kept).

Building a DataFrame in PySpark analyses its plan at once, so wiring every
model of a layer up front costs seconds of driver time even when a question
reads two of them; with this mapping only the models actually used are built.
"""

from __future__ import annotations

from collections.abc import Callable, MutableMapping


class LazyDict(MutableMapping):
    def __init__(self, factories: dict[str, Callable[[], object]]):
        self._factories = dict(factories)
        self._values: dict[str, object] = {}

    def __getitem__(self, key):
        if key not in self._values:
            self._values[key] = self._factories[key]()
        return self._values[key]

    def __setitem__(self, key, value):
        self._factories.setdefault(key, lambda: value)
        self._values[key] = value

    def __delitem__(self, key):
        self._factories.pop(key)
        self._values.pop(key, None)

    def __iter__(self):
        return iter(self._factories)

    def __len__(self):
        return len(self._factories)

    def __contains__(self, key):
        return key in self._factories


def merged(*maps) -> LazyDict:
    """Union of mappings (later ones win) without building any value."""
    factories = {}
    for m in maps:
        for k in m:
            factories[k] = (lambda m=m, k=k: m[k])
    return LazyDict(factories)
