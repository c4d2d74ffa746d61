"""Typed options of the stages.  The defaults are fixed values of the normative rules; limits that drop data are off (None)."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------- fixed values
ALLOWED_LANGS = ("ru", "en")
MIN_SOURCE_CHARS = 100
CHARS_PER_TOKEN = {"ru": 4.0, "en": 6.0}
DEFAULT_CHARS_PER_TOKEN = 4.0
SAFETY_MARGIN = 1.15
TARGET_TOKENS, STRIDE_TOKENS, MIN_TOKENS = 512, 448, 128
SHARD_MB = 1024
SEED = 42
# ------------------------------------------------------------ end fixed values


@dataclass(frozen=True)
class CleanOptions:
    allowed_langs: tuple[str, ...] = ALLOWED_LANGS
    remove_code: bool = True
    max_text_chars: int | None = None


@dataclass(frozen=True)
class ChunkOptions:
    target_tokens: int = TARGET_TOKENS
    stride_tokens: int = STRIDE_TOKENS
    min_tokens: int = MIN_TOKENS
    max_chunks: int | None = None
    chars_per_token: dict[str, float] = field(default_factory=lambda: dict(CHARS_PER_TOKEN))
    default_chars_per_token: float = DEFAULT_CHARS_PER_TOKEN
    safety_margin: float = SAFETY_MARGIN
    max_document_chars: int | None = None


@dataclass(frozen=True)
class AssemblyOptions:
    seed: int = SEED
    base_tier: int | None = None
    shuffle_documents: bool = True
    chunking: ChunkOptions = field(default_factory=ChunkOptions)
    shard_bytes: int = SHARD_MB * 1024 * 1024
    tier_overrides: dict[str, int] = field(default_factory=dict)
    min_messages: int | None = None
    max_tokens: int | None = None
