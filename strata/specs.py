"""Load contracts: what a table is called, how it is keyed and how it grows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

# Default freshness limit in hours per schedule tier.
FRESHNESS_HOURS = {"hourly": 6, "daily": 48, "weekly": 192}

AUDIT_COLUMNS = ("inserted_at", "updated_at")


def key_list(keys: str | Sequence[str]) -> list[str]:
    """A key as a list of column names; a comma-separated string is a composite key."""
    parts = keys.split(",") if isinstance(keys, str) else list(keys)
    names = [p.strip() for p in parts if p.strip()]
    if not names:
        raise ValueError("a key needs at least one column")
    return names


@dataclass(frozen=True)
class FieldMapping:
    """One target column: dotted source path, target name, optional named transform."""

    source: str
    column: str
    transform: str | None = None


@dataclass(frozen=True)
class LoadSpec:
    """Contract of one loaded table."""

    name: str
    target_schema: str
    target_table: str
    primary_key: tuple[str, ...]
    incremental_strategy: str = "full_refresh"
    incremental_column: str | None = None
    load_method: str = "stage_copy"
    layer: str = "raw"
    field_mappings: tuple[FieldMapping, ...] = ()
    custom_metadata: tuple[Mapping[str, str], ...] = ()
    auto_timestamps: tuple[str, ...] = AUDIT_COLUMNS
    schedule_tier: str = "daily"
    freshness_max_hours: int | None = None
    skip_zero_rows_check: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "primary_key", tuple(key_list(self.primary_key)))

    @property
    def full_name(self) -> str:
        return f"{self.target_schema}.{self.target_table}"

    @property
    def max_age_hours(self) -> int:
        if self.freshness_max_hours is not None:
            return self.freshness_max_hours
        return FRESHNESS_HOURS.get(self.schedule_tier, FRESHNESS_HOURS["daily"])

    @property
    def expected_columns(self) -> list[str]:
        return [m.column for m in self.field_mappings]


def spec_from_config(table: Mapping, source: Mapping | None = None) -> LoadSpec:
    """Build a spec from one table entry of a source configuration; source-level tags are defaults."""
    tags = {**(source or {}).get("default_tags", {}), **table.get("tags", {})}
    stamps = table.get("auto_timestamps", AUDIT_COLUMNS)
    return LoadSpec(
        name=table["name"],
        target_schema=table["target_schema"],
        target_table=table["target_table"],
        primary_key=tuple(key_list(table["primary_key"])),
        incremental_strategy=table.get("incremental_strategy", "full_refresh"),
        incremental_column=table.get("incremental_column") or None,
        load_method=table.get("load_method", "stage_copy"),
        layer=tags.get("layer", "raw"),
        field_mappings=tuple(
            FieldMapping(m["source"], m["column"], m.get("transform"))
            for m in table.get("field_mappings") or ()
        ),
        custom_metadata=tuple(table.get("custom_metadata") or ()),
        auto_timestamps=() if stamps is False else tuple(stamps),
        schedule_tier=tags.get("schedule_tier", "daily"),
        freshness_max_hours=table.get("freshness_max_hours"),
        skip_zero_rows_check=bool(table.get("skip_zero_rows_check", False)),
    )


def specs_from_config(config: Mapping) -> list[LoadSpec]:
    """All specs of one source configuration (a mapping with an ``assets`` list)."""
    return [spec_from_config(t, config) for t in config.get("assets") or ()]


def read_specs(path: str) -> list[LoadSpec]:
    """Specs of a YAML source configuration file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return specs_from_config(yaml.safe_load(f) or {})
