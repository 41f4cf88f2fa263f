"""Run configuration. Values become literals in the plan."""

from __future__ import annotations

from dataclasses import dataclass

# Stage numbers in chain order, and the language the chain keeps.
STAGES = (
    "normalize",
    "attributes",
    "preliminary",
    "html",
    "code",
    "dedup",
    "language",
    "toxicity",
    "pii",
)
ENGLISH = "en"

# Texts that a pretrained model gets in one call.
MODEL_BATCH_SIZE = 1000


@dataclass(frozen=True)
class PrepConfig:
    min_char_len: int = 50
    max_char_len: int = 20_000
    min_ascii_ratio: float = 0.65
    max_symbol_ratio: float = 0.25
    require_english: bool = True
    toxicity_threshold: float = 0.7
    shard_size: int = 10_000
    input_limit: int = 0
    # "document": a noisy class/id drops everything after it, until some noise
    # tag closes. "element": only that element is dropped.
    noise_scope: str = "document"
    model_batch_size: int = MODEL_BATCH_SIZE

    def __post_init__(self) -> None:
        if self.noise_scope not in ("document", "element"):
            raise ValueError(f"unknown noise_scope: {self.noise_scope}")
        if self.shard_size < 1:
            raise ValueError("shard_size must be at least 1")
        if self.model_batch_size < 1:
            raise ValueError("model_batch_size must be at least 1")
