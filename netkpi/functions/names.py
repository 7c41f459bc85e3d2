"""Column-name clean-up. Two results for one name are an error, never a silent overwrite."""
from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame


def feature_name(name: str) -> str:
    """Brackets to blank, blank and hyphen to underscore, lower case: `Plan (auto)` -> `plan__auto_`."""
    return re.sub(r"[ -]", "_", re.sub(r"[\[\](){}]", " ", name)).lower()


def raw_name(name: str, fixes: Mapping[str, str] | None = None) -> str:
    """camelCase to snake_case, brackets removed, repeated underscores joined; `fixes` applied last."""
    out = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", re.sub(r"[\[\](){}]", "", name))
    out = re.sub(r"_+", "_", re.sub(r"[ -]", "_", out)).lower()
    return (fixes or {}).get(out, out)


def rename_all(df: DataFrame, clean: Callable[[str], str]) -> DataFrame:
    names = [clean(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after clean-up: {twice}")
    return df.toDF(*names)
