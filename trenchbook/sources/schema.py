"""Table schemas and routing files: small configuration read on the driver."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

SPARK_TYPES = {"string": T.StringType(), "number": T.DoubleType(), "integer": T.LongType()}


@dataclass(frozen=True)
class Field:
    """One column: its name, its title in reports, its type and format, and what its values must satisfy."""

    name: str
    type: str = "string"
    title: str | None = None
    required: bool = False
    unique: bool = False
    enum: tuple[str, ...] = ()
    format: str = "default"


@dataclass(frozen=True)
class TableSchema:
    """Columns of a table in order, and the texts that count as missing."""

    fields: tuple[Field, ...]
    missing_values: tuple[str, ...] = ("",)
    name: str = ""
    properties: dict = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return list(dict.fromkeys(f.name for f in self.fields))

    def struct(self) -> T.StructType:
        """Published types: numbers as doubles, the rest as text."""
        return T.StructType(
            [
                T.StructField(
                    f.name,
                    SPARK_TYPES.get(f.type, T.StringType()),
                    not f.required,
                    {"title": f.title or f.name, "type": f.type},
                )
                for f in self.fields
            ]
        )


def parse_schema(declared: dict) -> TableSchema:
    """Schema from its declaration."""
    fields = []
    for f in declared["fields"]:
        rules = f.get("constraints", {})
        fields.append(
            Field(
                f["name"],
                f.get("type", "string"),
                f.get("title"),
                bool(rules.get("required")),
                bool(rules.get("unique")),
                tuple(rules.get("enum", ())),
                f.get("format") or "default",
            )
        )
    name = declared.get("tablename") or declared.get("layername") or ""
    rest = {k: v for k, v in declared.items() if k not in ("fields", "missingValues")}
    return TableSchema(tuple(fields), tuple(declared.get("missingValues", [""])), name, rest)


def load_schema(path: str | Path) -> TableSchema:
    """Schema from a JSON file."""
    return parse_schema(json.loads(Path(path).read_text(encoding="utf8")))


def load_routing(path: str | Path) -> dict[str, str]:
    """Routing map from lines "ending:target"."""
    lines = Path(path).read_text(encoding="utf8").splitlines()
    return dict(line.strip().split(":", 1) for line in lines if line.strip())


def load_columns(path: str | Path) -> list[str]:
    """Column names, one per line."""
    lines = Path(path).read_text(encoding="utf8").splitlines()
    return [line.strip() for line in lines if line.strip()]
