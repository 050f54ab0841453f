"""Layer path resolution (S11): ``(base, layer, table) -> path``.

Hand-over between jobs is by path convention; trailing slashes on the base
folders are normalised so no path ever contains ``//`` after the scheme.
"""

from __future__ import annotations

from dataclasses import dataclass

from tillroll.schemas import DATASET_FOLDER

LAYERS = ("raw", "bronze", "silver", "gold")


@dataclass(frozen=True)
class LayerPaths:
    raw_base: str
    clean_base: str
    mart_base: str
    dataset: str = DATASET_FOLDER

    def raw(self, filename: str, snapshot: str = "latest") -> str:
        return f"{_strip(self.raw_base)}/{self.dataset}/{snapshot}/{filename}"

    def bronze(self, table: str) -> str:
        return f"{_strip(self.clean_base)}/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{_strip(self.clean_base)}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{_strip(self.mart_base)}/gold/{table}"

    def layer(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
        return getattr(self, layer)(table)

    @classmethod
    def under(cls, root: str, dataset: str = DATASET_FOLDER) -> "LayerPaths":
        """All layers below one root folder (tests, local runs, scratch)."""
        r = _strip(root)
        return cls(f"{r}/raw", f"{r}/clean/{dataset}", f"{r}/mart/{dataset}", dataset)


def _strip(base: str) -> str:
    return base.rstrip("/")
