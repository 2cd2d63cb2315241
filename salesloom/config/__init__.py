"""Declared schema, required columns and header aliases (all small, all from YAML)."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from functools import cached_property
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesloom.functions.text import normalize_value

HERE = Path(__file__).parent

# Declared type names and the Spark types they stand for.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int64": T.LongType(),
    "integer": T.LongType(),
    "float64": T.DoubleType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampNTZType(),
}

# Date columns whose missing year is taken from the sale date.
YEAR_FROM_SALE = (
    "shipped_at",
    "delivered_at",
    "return_shipped_at",
    "return_delivered_at",
    "return_reviewed_at",
)

# Columns stamped by the load itself, never read from a file.
LOAD_COLUMNS = (
    "load_id",
    "session_load_id",
    "file_name",
    "file_hash",
    "loaded_at",
    "source_sheet",
    "header_row_detected",
)
ROW_NUMBER = "source_row_number"


class ConfigError(ValueError):
    """The configuration contradicts itself or names something unknown."""


def resolve_type(name: str) -> T.DataType:
    """Spark type of a declared type name, ignoring case and outer spaces."""
    try:
        return TYPE_NAMES[str(name).strip().lower()]
    except KeyError:
        raise ConfigError(f"Unsupported type name: {name}") from None


def struct_type(schema: dict[str, str], columns: list[str] | None = None) -> T.StructType:
    """Nullable StructType for ``columns`` (default: all) in the order given."""
    names = list(schema) if columns is None else columns
    unknown = [n for n in names if n not in schema]
    if unknown:
        raise ConfigError(f"Columns not in the declared schema: {unknown}")
    return T.StructType([T.StructField(n, resolve_type(schema[n]), True) for n in names])


def _section(path: str | Path, key: str, empty):
    with open(path, encoding="utf-8") as handle:
        return (yaml.safe_load(handle) or {}).get(key, empty)


def load_aliases(path: str | Path = HERE / "column_aliases.yml") -> dict[str, list[str]]:
    return _section(path, "column_aliases", {})


def load_required(path: str | Path = HERE / "required.yml") -> list[str]:
    return _section(path, "required_columns", [])


def load_schema(path: str | Path = HERE / "schema.yml") -> dict[str, str]:
    return _section(path, "schema", {})


@dataclass(frozen=True)
class Config:
    """Everything the ingestion needs to know about the target table."""

    aliases: dict[str, list[str]] = field(default_factory=load_aliases)
    required: list[str] = field(default_factory=load_required)
    schema: dict[str, str] = field(default_factory=load_schema)

    @cached_property
    def alias_targets(self) -> dict[str, str]:
        """Normalised alias -> target; a spelling claimed by two targets is an error."""
        targets: dict[str, str] = {}
        for target, spellings in self.aliases.items():
            for spelling in spellings:
                normal = normalize_value(spelling)
                if targets.setdefault(normal, target) != target:
                    raise ConfigError(
                        f"Alias '{spelling}' (normalised '{normal}') names both "
                        f"'{targets[normal]}' and '{target}'"
                    )
        return targets

    @cached_property
    def version(self) -> str:
        """Digest of the layout: files read under another one are to be read again."""
        content = json.dumps([self.aliases, self.required, list(self.schema.items())], sort_keys=True)
        return hashlib.sha256(content.encode()).hexdigest()[:12]

    @property
    def file_columns(self) -> list[str]:
        """Schema columns that come from file cells."""
        return [c for c in self.schema if c not in LOAD_COLUMNS and c != ROW_NUMBER]

    def struct(self, columns: list[str] | None = None) -> T.StructType:
        return struct_type(self.schema, columns)

    def alias_table(self, spark: SparkSession) -> DataFrame:
        """(alias_norm, alias_target): one row per distinct normalised alias."""
        return spark.createDataFrame(
            list(self.alias_targets.items()), "alias_norm string, alias_target string"
        )
