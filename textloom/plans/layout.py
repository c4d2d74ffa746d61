"""Where the stages keep their tables.

A result of a source lies in a version folder of its own, ``.../source=<name>/subset=<subset>/version=<version>``; the manifest
tells which version counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import quote

# the subset folder of sources that are not divided
WHOLE = "__whole__"


@dataclass(frozen=True)
class Layout:
    root: str

    def raw(self, content_type: str, source: str = "") -> str:
        return self._table("raw", content_type, source)

    def cleaned(self, content_type: str, source: str = "") -> str:
        return self._table("cleaned", content_type, source)

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def chunk_shards(self) -> str:
        return f"{self.root}/text/shards"

    @property
    def dataset(self) -> str:
        return f"{self.root}/text/dataset"

    @property
    def dialogues(self) -> str:
        return f"{self.root}/chat/dataset"

    @property
    def language_stats(self) -> str:
        return f"{self.root}/text/language_stats"

    def version(self, folder: str, subset: str | None, version: str) -> str:
        return f"{folder}/subset={quote(subset, safe='') if subset is not None else WHOLE}/version={version}"

    def _table(self, stage: str, content_type: str, source: str) -> str:
        folder = f"{self.root}/{stage}/{content_type}"
        return f"{folder}/source={source}" if source else folder
