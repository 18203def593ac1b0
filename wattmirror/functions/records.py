"""Typed columns out of JSON text, parsing each record once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_schema(paths: list[str]) -> str:
    """Schema with a text field per path (a or a.b), so that casts stay strict."""
    top: list[str] = []
    nested: dict[str, list[str]] = {}
    for path in paths:
        head, _, leaf = path.partition(".")
        if leaf:
            nested.setdefault(head, []).append(leaf)
        elif head not in top:
            top.append(head)
    parts = [f"`{name}` string" for name in top]
    parts += [f"`{head}` struct<{', '.join(f'`{leaf}`: string' for leaf in leaves)}>"
              for head, leaves in nested.items()]
    return ", ".join(parts)


def project(df: DataFrame, columns: list[tuple[str, str, str | None]], lenient: bool = False,
            data: str = "data", keep: list[str] | None = None) -> DataFrame:
    """Select (name, source, type): a source starting with ``$.`` is a path into the record.

    A value of the wrong type is an error unless ``lenient``, which makes it NULL.
    """
    paths = [source[2:] for _, source, _ in columns if source.startswith("$.")]
    parsed = df.withColumn("__r", F.from_json(data, record_schema(paths))) if paths else df

    def column(source: str, type_: str | None) -> Column:
        if not source.startswith("$."):
            return F.col(source)
        text = F.col(f"__r.{source[2:]}")
        return text.try_cast(type_) if lenient else text.cast(type_)

    return parsed.select(*[column(source, type_).alias(name) for name, source, type_ in columns], *(keep or []))
