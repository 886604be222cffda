"""Column-name rules.

Names are schema metadata: they are rewritten on the driver and applied with a
single ``toDF``/``select``, never per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config

# A word of a name: a capital with the lower-case letters and digits after
# it, or such letters and digits without one.
_WORD = re.compile(r"[A-Z][0-9a-z]*|[0-9a-z]+")
_ALNUM_RUN = re.compile(r"[0-9a-zA-Z]+")


def standardize_name(name: str) -> str:
    """The words of a name, every capital beginning one, in lower case and
    joined by ``_``."""
    return "_".join(word.lower() for word in _WORD.findall(name))


def simple_name(name: str) -> str:
    """Runs of letters and digits in lower case, joined by ``_``;
    capitals are not split."""
    return "_".join(run.lower() for run in _ALNUM_RUN.findall(str(name)))


def standardize_columns(df: DataFrame, mode: str = "split_capitals") -> DataFrame:
    fn = standardize_name if mode == "split_capitals" else simple_name
    return df.toDF(*[fn(c) for c in df.columns])


def dedupe_names(names: list[str]) -> list[str]:
    """V4: keep the first occurrence of each name, in order."""
    seen: set[str] = set()
    out = []
    for n in names:
        if n not in seen:
            seen.add(n)
            out.append(n)
    return out


def strip_prefix(name: str) -> str:
    """``onehot__x`` -> ``x``: the part after the last ``__``."""
    return name.split("__")[-1] if "__" in name else name


def sanitize_metric_name(c: Column | str) -> Column:
    """Q5 on a column of names: characters outside ``[a-zA-Z0-9_-./ ]`` -> ``_``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, config.METRIC_NAME_PATTERN, "_")


def sanitize_metric_name_py(name: str) -> str:
    return re.sub(config.METRIC_NAME_PATTERN, "_", name)


def drop_list_names(raw_names: list[str]) -> set[str]:
    """Static drop lists match a column by either naming rule."""
    out = set()
    for n in raw_names:
        out.add(standardize_name(n))
        out.add(simple_name(n))
    return out
