"""Nomenclature model variants 1-4 as parameters of the same operators
(A5, W3, R6, R6b, R6c, Q11).  No operator is duplicated per model."""

from __future__ import annotations

from dataclasses import dataclass, field

from gondola.config import CUSTOMER_STANDARDS, ITEM_PLACEHOLDERS, MISCLASS_COLUMNS, PRODUCT_STANDARDS
from gondola.operators.kpis import Grain, kpi_grains


@dataclass(frozen=True)
class Model:
    model_id: int
    n_levels: int
    dimensions: tuple[str, ...]
    misclass_columns: tuple[str, ...]
    placeholder_level: str | None
    map_encoding: str | None = None       # correspondence table text encoding
    map_rename: bool = False              # model 1 renames native columns of the map
    strip_map: bool = True                # oldest model does not strip the map
    customer_mapping: bool = False
    placeholders: tuple[str, ...] = field(default_factory=lambda: tuple(ITEM_PLACEHOLDERS))

    @property
    def standards(self) -> list[str]:
        return PRODUCT_STANDARDS[: self.n_levels]

    @property
    def grains(self) -> list[Grain]:
        return kpi_grains(self.n_levels, list(self.dimensions))


MODELS: dict[int, Model] = {
    1: Model(1, 2, ("", "Dep"), ("product_name", "classification", *PRODUCT_STANDARDS[:2]),
             placeholder_level=None, map_rename=True, strip_map=False),
    2: Model(2, 3, ("", "Dep"), ("product_name", "classification", *PRODUCT_STANDARDS[:3]),
             placeholder_level="level_3_standard", map_encoding="windows-1252"),
    3: Model(3, 4, ("", "Dep"), ("product_name", "classification", *PRODUCT_STANDARDS),
             placeholder_level="level_4_standard"),
    4: Model(4, 4, ("", "Dep", "c1Dep", "c2Dep", "c3Dep"), tuple(MISCLASS_COLUMNS),
             placeholder_level="level_4_standard", map_encoding="windows-1252", customer_mapping=True),
}

__all__ = ["MODELS", "Model", "CUSTOMER_STANDARDS"]
