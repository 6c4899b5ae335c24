"""Column registry: metadata that drives selects, schemas and preprocessing.

``AttributeSpec`` describes one column (names, source table, logical type,
role, encoding, transform, value map). ``FeatureRegistry`` is a plain
driver-side object; it generates ``Column`` lists and ``StructType``s, never
touches row data. Specs are keyed by ``(source_table, technical_name)`` so
same-named columns of different tables do not leak into each other.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credal.functions import clean as C

# Fixed vocabularies of the registry.
TYPES = ("categorical", "numerical", "binary", "datetime", "identifier")
ROLES = ("feature", "target", "identifier", "drop", "meta")
ENCODINGS = ("one_hot", "ordinal", "target", "binary", "none")
TRANSFORMS = ("log", "standard", "robust", "none")

_SPARK_TYPE = {
    "categorical": T.StringType(),
    "numerical": T.DoubleType(),
    "binary": T.IntegerType(),
    "datetime": T.TimestampType(),
    "identifier": T.LongType(),
}


@dataclass(frozen=True)
class AttributeSpec:
    name: str                       # technical (lower-case) name
    source_table: str
    type: str = "numerical"
    role: str = "feature"
    encoding: str = "none"
    transform: str = "none"
    raw_name: str | None = None     # header in the raw file
    business_name: str | None = None
    value_map: Mapping[str, str] | None = None
    unknown_value: str | None = None
    description: str = ""
    params: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self):
        for attr, allowed in (("type", TYPES), ("role", ROLES), ("encoding", ENCODINGS), ("transform", TRANSFORMS)):
            if getattr(self, attr) not in allowed:
                raise ValueError(f"{self.name}: {attr}={getattr(self, attr)!r} not in {allowed}")

    def to_record(self) -> dict:
        """Flat record; dict values serialised to a JSON string."""
        d = asdict(self)
        d["value_map"] = json.dumps(dict(self.value_map), sort_keys=True) if self.value_map else None
        d["params"] = json.dumps(dict(self.params), sort_keys=True, default=str) if self.params else None
        return d


class FeatureRegistry:
    """Ordered specs with an index by (source_table, name)."""

    def __init__(self, specs: Iterable[AttributeSpec] = ()):
        self._specs: list[AttributeSpec] = []
        self._index: dict[tuple[str, str], AttributeSpec] = {}
        for s in specs:
            self.add(s)

    def add(self, spec: AttributeSpec) -> None:
        key = (spec.source_table, spec.name)
        if key in self._index:
            raise ValueError(f"duplicate spec {key}")
        self._specs.append(spec)
        self._index[key] = spec

    def __iter__(self):
        return iter(self._specs)

    def __len__(self):
        return len(self._specs)

    def get(self, table: str, name: str) -> AttributeSpec:
        return self._index[(table, name)]

    # E01 ------------------------------------------------------------------------
    def columns(self, table: str | None = None, role: str | None = None, type: str | None = None,
                encoding: str | None = None, transform: str | None = None,
                present_in: Sequence[str] | None = None) -> list[str]:
        """Technical names filtered by table/role/type/encoding/transform and,
        optionally, presence in a DataFrame's columns (case-insensitive)."""
        have = {c.lower() for c in present_in} if present_in is not None else None
        out = []
        for s in self._specs:
            if table is not None and s.source_table != table:
                continue
            if role is not None and s.role != role:
                continue
            if type is not None and s.type != type:
                continue
            if encoding is not None and s.encoding != encoding:
                continue
            if transform is not None and s.transform != transform:
                continue
            if have is not None and s.name.lower() not in have:
                continue
            out.append(s.name)
        return out

    def rename_map(self, table: str) -> dict[str, str]:
        """Raw header → technical name for one table."""
        return {s.raw_name: s.name for s in self._specs if s.source_table == table and s.raw_name}

    # schema ---------------------------------------------------------------------
    def struct_type(self, table: str, raw: bool = True) -> T.StructType:
        """Explicit schema (no inference). Raw headers when ``raw``; binary and
        categorical raw columns are read as strings and recoded later."""
        fields = []
        for s in self._specs:
            if s.source_table != table:
                continue
            name = (s.raw_name or s.name) if raw else s.name
            dtype = _SPARK_TYPE[s.type]
            if raw and s.type in ("binary", "categorical"):
                dtype = T.StringType()
            fields.append(T.StructField(name, dtype, True))
        return T.StructType(fields)

    # C01 ------------------------------------------------------------------------
    def select_exprs(self, table: str, is_test: bool = False, columns: Sequence[str] | None = None) -> list[Column]:
        """One output expression per attribute of ``table``, by priority
        identifier → target → value map → binary → categorical → passthrough."""
        have = {c.lower() for c in columns} if columns is not None else None
        out = []
        for s in self._specs:
            if s.source_table != table or (have is not None and s.name.lower() not in have):
                continue
            src = F.col(s.name)
            if s.type == "identifier" or s.role == "identifier":
                e = C.identifier(src)
            elif s.role == "target":
                e = C.target_for_split(src, is_test)
            elif s.value_map:
                e = C.value_map_recode(src, s.value_map, s.unknown_value)
            elif s.type == "binary":
                e = C.binary_label_map(src, C.BINARY_PAIRS + C.NUMERIC_PAIRS)
            elif s.type == "categorical":
                e = C.normalize_category(src)
            elif s.type == "numerical":
                e = C.coerce_numeric(src)
            else:
                e = src
            out.append(e.alias(s.name))
        return out

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        """The registry as a ``feature_registry`` table."""
        schema = T.StructType([
            T.StructField(n, t, True) for n, t in (
                ("name", T.StringType()), ("source_table", T.StringType()), ("type", T.StringType()),
                ("role", T.StringType()), ("encoding", T.StringType()), ("transform", T.StringType()),
                ("raw_name", T.StringType()), ("business_name", T.StringType()), ("value_map", T.StringType()),
                ("unknown_value", T.StringType()), ("description", T.StringType()), ("params", T.StringType()))])
        rows = [tuple(s.to_record()[f.name] for f in schema.fields) for s in self._specs]
        return spark.createDataFrame(rows, schema)

    def to_json(self) -> str:
        return json.dumps([s.to_record() for s in self._specs], indent=1, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> FeatureRegistry:
        specs = []
        for d in json.loads(text):
            d = dict(d)
            d["value_map"] = json.loads(d["value_map"]) if d.get("value_map") else None
            d["params"] = json.loads(d["params"]) if d.get("params") else {}
            specs.append(AttributeSpec(**d))
        return cls(specs)


# E02 ----------------------------------------------------------------------------
TRANSFORMER_PRIORITY = ("log", "robust", "standard", "binary", "one_hot", "ordinal", "target")


def dedupe_by_priority(lists: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """A column goes to one transformer only, the first in
    log > robust > standard > binary > one-hot > ordinal > target."""
    seen: set[str] = set()
    out: dict[str, list[str]] = {}
    for kind in TRANSFORMER_PRIORITY:
        keep = []
        for c in lists.get(kind, ()):
            if c not in seen:
                seen.add(c)
                keep.append(c)
        out[kind] = keep
    return out


# E03 ----------------------------------------------------------------------------
def validate_columns(spark: SparkSession, registry: FeatureRegistry, df_columns: Sequence[str],
                     tables: Sequence[str] | None = None, exclude_tables: Sequence[str] = ()) -> DataFrame:
    """Columns unknown to the registry and registry columns missing from
    the frame (case-insensitive) as a DataFrame ``(column, issue)``."""
    expected = {s.name.lower() for s in registry
                if (tables is None or s.source_table in tables) and s.source_table not in exclude_tables}
    have = {c.lower() for c in df_columns}
    rows = [(c, "unknown") for c in sorted(have - expected)] + [(c, "missing") for c in sorted(expected - have)]
    return spark.createDataFrame(rows, "column string, issue string")
