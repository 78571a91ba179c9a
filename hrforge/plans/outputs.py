"""Named outputs of multi-output operators, built only when asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


class Outputs(dict):
    """A dict of DataFrames whose entries are built on first access.

    Some outputs need an eager step (id assignment checkpoints its rows); a
    caller that only wants, say, the rejections should not pay for it.
    """

    def __init__(self, **makers: Callable[[], DataFrame]):
        super().__init__()
        self._makers = makers

    def __getitem__(self, key: str) -> DataFrame:
        if not dict.__contains__(self, key):
            dict.__setitem__(self, key, self._makers[key]())
        return dict.__getitem__(self, key)

    def __contains__(self, key: object) -> bool:
        return key in self._makers

    def keys(self):
        return self._makers.keys()
