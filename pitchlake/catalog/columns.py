"""Column and table descriptions, and the Spark schemas made from them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SPARK_TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


@dataclass(frozen=True)
class Column:
    """One documented column.

    ``low``/``high`` are inclusive bounds and ``allowed`` is a closed value set; both apply to
    non-null values only. ``deprecated`` is the last year in which the feed filled the column.
    """

    name: str
    dtype: str
    tags: tuple[str, ...]
    description: str
    required: bool = False
    low: float | None = None
    high: float | None = None
    allowed: tuple[str, ...] = ()
    deprecated: int | None = None

    def __post_init__(self) -> None:
        if self.dtype not in SPARK_TYPES:
            raise ValueError(f"{self.name}: unknown type {self.dtype!r}")
        if not self.description.strip():
            raise ValueError(f"{self.name}: a description is required")

    @property
    def definition(self) -> str:
        """The description followed by the rules a value of this column obeys."""
        parts = [self.description]
        if self.required:
            parts.append("Never null.")
        if self.low is not None:
            parts.append(f"Between {self.low:g} and {self.high:g}.")
        if self.allowed:
            parts.append("One of " + ", ".join(self.allowed) + ".")
        if self.deprecated:
            parts.append(f"Not filled after {self.deprecated}.")
        return " ".join(parts)

    @property
    def struct_field(self) -> T.StructField:
        return T.StructField(
            self.name,
            SPARK_TYPES[self.dtype],
            not self.required,
            {"comment": self.description},
        )


@dataclass(frozen=True)
class TableLayout:
    """Columns of a table plus how its files are split and ordered.

    ``lookup_by`` names columns whose files hold Bloom filters; ``buckets`` a column and the number of
    buckets that its hash deals rows to, so that tables alike join on it without a shuffle.
    """

    columns: tuple[Column, ...]
    comment: str
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    key: tuple[str, ...] = field(default=())
    lookup_by: tuple[str, ...] = ()
    buckets: tuple[str, int] | None = None

    def __post_init__(self) -> None:
        names = self.names
        if len(names) != len(set(names)):
            raise ValueError("column names must be unique")
        unknown = {*self.partition_by, *self.cluster_by, *self.key, *self.lookup_by} - set(names)
        unknown |= {self.buckets[0]} - set(names) if self.buckets else set()
        if unknown:
            raise ValueError(f"layout refers to unknown columns {sorted(unknown)}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([c.struct_field for c in self.columns])

    def __getitem__(self, name: str) -> Column:
        for column in self.columns:
            if column.name == name:
                return column
        raise KeyError(name)


# The groups a column tag may name.
TAG_GROUPS = {
    "identifier": "ids and join keys",
    "pitch_context": "state of the game when the pitch is thrown",
    "pitch_physics": "flight and spin of the pitch",
    "pitch_location": "where the pitch crosses the plate, and the strike zone",
    "outcome_pitch": "result of the pitch",
    "outcome_at_bat": "result of the plate appearance",
    "batted_ball": "ball off the bat",
    "expected_stats": "model-based expectations",
    "runner": "runners on base",
    "score_state": "score around the pitch",
    "temporal": "calendar and rest-day fields",
    "team": "teams",
    "handedness": "batting and throwing side",
    "physics": "low-level measurements",
    "post_hit": "known only after contact",
    "join_key": "identifiers meant for joins",
    "mlb_canonical": "values that follow the league's own scheme",
}


def tagged(columns: tuple[Column, ...], tag: str) -> list[Column]:
    """Columns carrying ``tag``, in table order."""
    return [c for c in columns if tag in c.tags]
