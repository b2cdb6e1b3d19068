"""What an entity, a dimension and a fact table are made of."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

# Texts that a feed uses for "no value".
NULL_TOKENS = ("NULL", "null", "N/A", "")

# Load states and quality verdict.
STATUS_NEW = "NEW"
STATUS_LOADED = "LOADED"
VALID = "VALID"

LINEAGE = T.StructType(
    [
        T.StructField("_load_timestamp", T.TimestampNTZType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_file_row_number", T.LongType()),
    ]
)

# A rule is a flag and a function giving the condition under which a row fails.
# The function is called late because a Column needs a running session.
Rule = tuple[str, Callable[[], Column]]


@dataclass(frozen=True)
class Entity:
    """One feed: its text columns in file order, and how it is typed and checked."""

    name: str
    key: str
    columns: tuple[str, ...]
    # Values parsed once, under names the projection and the rules then use.
    parse: Callable[[], dict[str, Column]]
    project: Callable[[], list[Column]]
    rules: tuple[Rule, ...]
    delta_parse: Callable[[], dict[str, Column]]
    delta_rules: tuple[Rule, ...]
    # Longest text each column should hold; reported on, not enforced.
    limits: Mapping[str, int]

    @property
    def raw_table(self) -> str:
        return f"raw_{self.name}"

    @property
    def staging_table(self) -> str:
        return f"stg_{self.name}"

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


@dataclass(frozen=True)
class Dimension:
    """A history-keeping dimension over one staging table."""

    name: str
    key: str
    surrogate: str
    attributes: tuple[str, ...]
    compare: tuple[str, ...]
    initial_compare: tuple[str, ...]

    @property
    def table(self) -> str:
        return f"dim_{self.name}"


@dataclass(frozen=True)
class Lookup:
    """Natural key -> surrogate key of the current row of a dimension."""

    dimension: Dimension

    @property
    def natural(self) -> str:
        return self.dimension.key

    @property
    def surrogate(self) -> str:
        return self.dimension.surrogate


@dataclass(frozen=True)
class Fact:
    name: str
    key: str
    surrogate: str
    lookups: tuple[Lookup, ...]
    attributes: tuple[str, ...]
    compare: tuple[str, ...]
    initial_compare: tuple[str, ...]
    initial_update: tuple[str, ...]

    @property
    def table(self) -> str:
        return f"fact_{self.name}"


@dataclass(frozen=True)
class Model:
    """A whole flow: feeds, dimensions, one fact table, and their table schemas."""

    entities: tuple[Entity, ...]
    dimensions: tuple[Dimension, ...]
    fact: Fact
    schemas: Mapping[str, T.StructType]
    steps: Mapping[str, object]
    marts: Mapping[str, Callable[..., DataFrame]]

    def entity(self, name: str) -> Entity:
        return next(e for e in self.entities if e.name == name)
