"""Named target schemas and conforming a DataFrame to one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from sensorlake.operators.mapping import apply_mapping


@dataclass(frozen=True)
class SchemaSpec:
    """A target table: its columns, the staged type of each, and optional source names."""

    name: str
    fields: tuple[tuple[str, str, str], ...]  # (column, staged type, target type)

    @property
    def columns(self) -> list[str]:
        return [name for name, _, _ in self.fields]

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, _, t in self.fields))

    @property
    def staged(self) -> T.StructType:
        """What a text scan yields: every column as a string, cast once in the mapping."""
        return T.StructType([T.StructField(n, T.StringType()) for n in self.columns])

    def mapping(self, sources: dict[str, str] | None = None) -> list[tuple[str, str, str, str]]:
        sources = sources or {}
        return [(sources.get(n, n), s, n, t) for n, s, t in self.fields]


# The two table definitions.
SCHEMAS = {
    "accel5": SchemaSpec(
        "accel5",
        (
            ("id", "string", "string"),
            ("timestamp", "string", "timestamp_ntz"),
            ("accel_x", "double", "double"),
            ("accel_y", "double", "double"),
            ("accel_z", "double", "double"),
        ),
    ),
    "sensor6": SchemaSpec(
        "sensor6",
        (
            ("user_id", "string", "string"),
            ("activity", "string", "string"),
            ("timestamp", "string", "timestamp_ntz"),
            ("sensor1", "double", "double"),
            ("sensor2", "double", "double"),
            ("sensor3", "double", "double"),
        ),
    ),
}


def conform(df: DataFrame, spec: SchemaSpec, sources: dict[str, str] | None = None) -> DataFrame:
    """Map ``df`` onto ``spec``; columns ``df`` does not have become typed NULLs."""
    have = {c.lower() for c in df.columns}
    missing = {
        src: F.lit(None).cast(staged)
        for src, staged, _, _ in spec.mapping(sources)
        if src.split(".")[0].lower() not in have
    }
    return apply_mapping(df.withColumns(missing) if missing else df, spec.mapping(sources))
